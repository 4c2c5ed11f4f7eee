"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from catalogue import inputs
from catalogue.jobs import JOBS
from tarn.operators.relational import joined_count, top_k
from tarn.sources.tables import read_table

SF_DIR = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(params=["10MB", "-1"], ids=["small", "large"])
def broadcast_limit(request, spark):
    """Join choices for small tables, and for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", list(JOBS))
def test_no_cross_joins(spark, broadcast_limit, name):
    text = plan(JOBS[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    first, second = entry(spark), entry(spark)
    assert first.columns == second.columns == ["user", "rank", "other", "shared"]
    assert first.count() > 0


def test_date_filter_reaches_the_scan(spark, capsys):
    queries()["filter_group_count"](spark, SF_DIR).explain("formatted")
    text = capsys.readouterr().out
    text = text[text.index("PushedFilters") :]
    assert "GreaterThanOrEqual(ts,2024-01-15" in text and "EqualTo(event_type,error)" in text


def test_scan_reads_two_columns(spark):
    text = plan(read_table(spark, SF_DIR, "events").groupBy("event_type").agg(F.max("value")))
    assert "ReadSchema: struct<event_type:string,value:double>" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan(inputs.edges(spark, SF_DIR))


def test_facts_are_counted_before_the_join(spark):
    lines, part = read_table(spark, SF_DIR, "lineitem"), read_table(spark, SF_DIR, "part")
    text = plan(joined_count(lines, part, "l_partkey", "p_partkey", "p_type"))
    join = text.index("Join")
    assert "partial_count" in text[join:] and "partial_sum" in text[:join]


def test_top_k_cuts_before_the_shuffle(spark):
    text = plan(top_k(read_table(spark, SF_DIR, "lineitem"), ["l_partkey"], ["l_orderkey", "l_quantity"], 3))
    exchange = text.index("Exchange")
    assert "WindowGroupLimit" in text[:exchange] and "WindowGroupLimit" in text[exchange:]


def test_assignment_does_not_shuffle(spark):
    from tarn.operators.clustering import GivenCentersKMeans

    points = inputs.points(spark, SF_DIR)
    model = GivenCentersKMeans(0, {0: [0.0] * 64, 1: [1.0] * 64})
    assert "Exchange" not in plan(model.assign(points))


def test_item_mean_rmse_reads_the_lines_once(spark):
    text = plan(JOBS["rmse_item_mean"](spark, SF_DIR))
    assert text.count("lineitem.parquet") == 1
