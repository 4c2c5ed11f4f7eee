"""Joins on hot keys: the same rows as a plain join, and no task with most of them."""

from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from tarn.operators.relational import lookup, many_to_many
from tarn.operators.words import stem_counts, stem_vocabulary
from tarn.plans import user_profiles as up


@pytest.fixture
def whole_partitions(spark):
    """Leave every shuffle partition as it is, and more of them."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def hot_sides(spark):
    """A third of either side's rows on item 0."""
    left = spark.range(3000).selectExpr("id AS user", "if(id % 3 = 0, 0, id % 700) AS item", "double(id % 5) AS rating")
    right = spark.range(1500).selectExpr("if(id % 3 = 0, 0, id % 700) AS item", "concat('s', id) AS stem", "1 + id % 4 AS n")
    return left, right


@pytest.mark.parametrize("unit_rows", [10, 100, 10**6])
def test_many_to_many_equals_a_plain_join(spark, unit_rows):
    left, right = hot_sides(spark)
    expected = Counter(map(tuple, left.join(right, "item").select("user", "item", "rating", "stem", "n").collect()))
    got = many_to_many(left, right, "item", unit_rows).select("user", "item", "rating", "stem", "n")
    assert Counter(map(tuple, got.collect())) == expected


def test_a_hot_item_is_split_among_tasks(spark, whole_partitions):
    left, right = hot_sides(spark)
    joined = many_to_many(left, right, "item", 60)
    hot = joined.where("item = 0").groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    rows = sorted(r.n for r in hot if r.n)
    assert sum(rows) == 1003 * 502 and len(rows) > 24 and rows[-1] < 5 * median(rows)


def test_user_tags_with_a_hot_item(spark):
    left, right = hot_sides(spark)
    rows = lambda frame: sorted(map(tuple, frame.select("user", "rank", "stem", "score").collect()))
    assert rows(up.user_tags(left, right, unit_rows=50)) == rows(up.user_tags(left, right, unit_rows=10**9))


def test_rows_without_a_key_drop_out(spark):
    left = spark.createDataFrame([(None, 1), (1, 2), (1, 3)], "k long, a long")
    right = spark.createDataFrame([(None, 1), (1, 2), (2, 3)], "k long, b long")
    assert sorted(map(tuple, many_to_many(left, right, "k", 1).collect())) == [(1, 2, 2), (1, 3, 2)]


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_lookup(spark, max_bytes):
    left, _ = hot_sides(spark)
    table = spark.range(0, 700, 2).selectExpr("id AS item", "id * 2 AS twice")
    expected = Counter(map(tuple, left.join(table, "item").collect()))
    assert Counter(map(tuple, lookup(left, table, "item", max_bytes).collect())) == expected


def test_each_token_is_stemmed_once(spark):
    tags = spark.createDataFrame([(i, w) for i in range(300) for w in ("Running", "runs", "toys", None)], "item long, word string")
    vocabulary = stem_vocabulary(tags, "word")
    assert sorted(map(tuple, vocabulary.collect())) == [("running", "run"), ("runs", "run"), ("toys", "toy")]
    counts = stem_counts(tags, "word", "item", vocabulary=vocabulary).collect()
    assert {(r["item"], r.stem, r.n) for r in counts} == {(i, s, n) for i in range(300) for s, n in (("run", 2), ("toy", 1))}
    assert {(r.stem, r.n) for r in stem_counts(tags, "word").collect()} == {("run", 600), ("toy", 300)}
