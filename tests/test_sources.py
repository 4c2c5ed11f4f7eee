"""Readers, writers and line formats."""

import gzip

import pytest
from pyspark.sql import functions as F

from tarn.operators.relational import broadcast_if_small
from tarn.session import materialise, scratch_path, shared_dir
from tarn.sources import lines as ln
from tarn.sources import tabular as tb
from tarn.sources.tables import spread


def text(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_adjacency(spark):
    parsed = ln.adjacency_edges(text(spark, "1\t2, 3,,4", " 5 \t", "6\t7"))
    assert parsed.dtypes == [("src", "bigint"), ("dst", "bigint")]
    assert sorted(parsed.collect()) == [(1, 2), (1, 3), (1, 4), (6, 7)]


def test_adjacency_malformed(spark):
    bad = text(spark, "1\t2,x", "y\t3", "no tab", "4\t5")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ln.adjacency_edges(bad).collect()
    assert sorted(ln.adjacency_edges(bad, malformed="drop").collect()) == [(1, 2), (4, 5)]
    with pytest.raises(ValueError):
        ln.adjacency_edges(bad, malformed="ignore")


def test_basket_lines_keep_repeats_and_drop_nothing_else(spark, tmp_path):
    (tmp_path / "b.txt").write_text("A  B\tA \n\n C\n")
    rows = ln.basket_items(ln.read_lines(spark, str(tmp_path / "b.txt"))).collect()
    by_basket = {}
    for row in rows:
        by_basket.setdefault(row.basket, []).append(row["item"])
    assert sorted(by_basket.values()) == [["A", "B", "A"], ["C"]]


def test_vectors(spark):
    row = text(spark, "1 -2.5 3e2").select(ln.vector_from_text(ln.F.col("value")).alias("v")).first()
    assert row.v == [1.0, -2.5, 300.0]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        text(spark, "1  2").select(ln.vector_from_text(ln.F.col("value"))).collect()
    lenient = text(spark, "1 x").select(ln.vector_from_text(ln.F.col("value"), "drop").alias("v"))
    assert lenient.first().v == [1.0, None]


def test_csv(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a, b", 0.5), (2, None, 1.5)], "id long, name string, x double")
    path = str(tmp_path / "csv")
    tb.write_csv(rows, path)
    back = tb.read_csv(spark, path, rows.schema)
    assert sorted(back.collect()) == sorted(rows.collect())
    checked = tb.require_not_null(back, ["id", "x"])
    assert [f.nullable for f in checked.schema] == [False, True, False]
    assert sorted(checked.collect()) == sorted(rows.collect())
    with pytest.raises(Exception, match="null in column name"):
        tb.require_not_null(back, ["name"]).collect()
    assert dict(tb.read_csv_inferred(spark, path).dtypes) == {"id": "int", "name": "string", "x": "double"}
    strings = tb.read_csv_strings(spark, path)
    assert strings.schema == tb.string_schema(["id", "name", "x"])
    assert sorted(tb.typed(strings, {"id": "bigint", "x": "double"}).collect()) == sorted(rows.collect())


def test_csv_malformed_number(spark):
    strings = spark.createDataFrame([("1",), ("bad",)], "x string")
    assert [r.x for r in tb.typed(strings, {"x": "double"}, "null").collect()] == [1.0, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tb.typed(strings, {"x": "double"}).collect()


def test_json(spark, tmp_path):
    with gzip.open(tmp_path / "x.json.gz", "wt") as f:
        f.write('{"id": 1, "name": "a"}\n{"id": 2}\n')
    frame = tb.read_json(spark, str(tmp_path / "x.json.gz"), "id long, name string")
    assert sorted(frame.collect(), key=lambda r: r.id) == [(1, "a"), (2, None)]
    assert dict(tb.read_json(spark, str(tmp_path / "x.json.gz")).dtypes) == {"id": "bigint", "name": "string"}
    times = spark.sql("SELECT 1L AS id, TIMESTAMP_NTZ'2024-01-15 10:11:12.123456' AS ts")
    path = str(tmp_path / "json")
    for _ in range(2):  # the second write replaces the first
        tb.write_json(times, path)
    assert tb.read_json(spark, path, times.schema).collect() == times.collect()


def test_shared_folder_and_materialise(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert scratch_path(spark, "a").startswith(shared_dir(spark))
    stored = materialise(spark.range(10).where("id > 6"))
    assert [r.id for r in stored.collect()] == [7, 8, 9]
    assert "Range" not in stored._jdf.queryExecution().toString()


def test_broadcast_and_spread_depend_on_size(spark):
    frame = spark.range(1000)

    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(broadcast_if_small(frame)) and not hinted(broadcast_if_small(frame, 100))
    assert spread(frame).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(frame, max_bytes=10) is frame


def test_csv_loses_nothing(spark, tmp_path):
    texts = ["  padded  ", "", None, "two\nlines", "a\r\nb", "cr\rend", 'say "hi", "', '"', "\\N", "\\\\N", "\\", ",", "\t", "é x", "N", "\\n"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, name string")
    path = str(tmp_path / "csv")
    tb.write_csv(rows, path)
    assert sorted(tb.read_csv(spark, path, rows.schema).collect()) == sorted(rows.collect())
    with pytest.raises(Exception, match="MALFORMED|cannot parse|FAILFAST|NumberFormat"):
        tb.read_csv(spark, path, "id bigint, name bigint").collect()
    lenient = tb.read_csv(spark, path, "id bigint, name bigint", mode="PERMISSIVE")
    assert lenient.count() == len(texts)


def test_json_keeps_microseconds(spark, tmp_path):
    rows = spark.sql("SELECT TIMESTAMP'2024-02-03 04:05:06.123456' AS a, TIMESTAMP_NTZ'2024-02-03 04:05:06.654321' AS b")
    path = str(tmp_path / "json")
    tb.write_json(rows, path)
    assert tb.read_json(spark, path, rows.schema).collect() == rows.collect()


def test_required_columns_of_any_type(spark):
    rows = spark.sql(
        "SELECT DATE'2024-01-01' AS d, TIMESTAMP'2024-01-01 00:00:00' AS t, true AS b, array(1, 2) AS l,"
        " map('k', 1) AS m, named_struct('x', 1, 'y', 'z') AS s, X'00' AS r, current_timestamp()::timestamp_ntz AS n"
    )
    names = rows.columns
    optional = rows.select(*[F.when(F.rand() < 2, F.col(c)).alias(c) for c in names])
    checked = tb.require_not_null(optional, names)
    assert [f.name for f in checked.schema if f.nullable] == []
    assert checked.select("d", "b", "l", "s").collect() == rows.select("d", "b", "l", "s").collect()
    with pytest.raises(Exception, match="null in column b"):
        tb.require_not_null(optional.withColumn("b", F.when(F.rand() > 2, F.col("b"))), ["b"]).collect()


TEXTS = ["two\nlines", "\\N", "\\\\N", "", None, ' "quoted", ', "a\r\nb", "tab\t ", "plain", "12"]


@pytest.mark.parametrize("read", [tb.read_csv_strings, tb.read_csv_inferred])
def test_reading_without_a_schema_loses_nothing(spark, tmp_path, read):
    rows = [(str(k), t) for k, t in enumerate(TEXTS)]
    tb.write_csv(spark.createDataFrame(rows, "n string, t string"), str(tmp_path / "t.csv"), file_rows=3)
    back = [(str(r.n), r.t) for r in read(spark, str(tmp_path / "t.csv")).collect()]
    assert sorted(back) == rows


def test_reading_without_a_schema_fails_on_bad_rows(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n3\n")
    for read in (tb.read_csv_strings, tb.read_csv_inferred):
        with pytest.raises(Exception, match="MALFORMED|Malformed"):
            read(spark, str(tmp_path / "bad.csv")).collect()
    assert tb.read_csv_strings(spark, str(tmp_path / "bad.csv"), mode="PERMISSIVE").count() == 2


def test_texts_with_line_breaks_are_read_by_many_tasks(spark, tmp_path):
    rows = spark.range(2000).selectExpr("id", "concat('line one ', id, '\\nline two ', repeat('x', 500)) AS t").coalesce(1)
    path = str(tmp_path / "many.csv")
    tb.write_csv(rows, path, file_bytes=100_000)
    files = list((tmp_path / "many.csv").glob("*.csv"))
    assert len(files) >= 10 and max(f.stat().st_size for f in files) < 150_000
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        back = tb.read_csv(spark, path, rows.schema)
        tasks = back.groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) >= 5 and max(r["count"] for r in tasks) < 600
        assert sorted(back.collect()) == sorted(rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lines_keep_their_numbers_under_any_split(spark, tmp_path):
    lines = [f"item{k % 7} item{k}" + " " * (k % 50) for k in range(3000)]
    for part in range(3):
        (tmp_path / f"part-{part}").write_text("\n".join(lines[part * 1000 : (part + 1) * 1000]) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("3000", "17000", "10000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "100")
            rows = ln.read_numbered_lines(spark, str(tmp_path)).collect()
            assert sorted(map(tuple, rows)) == list(enumerate(lines))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
