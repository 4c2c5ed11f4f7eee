"""The driver's tables in the shape the jobs read. See FIXTURES.md for the mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.sources.tables import read_table, spread


def _order_lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    lines = spread(read_table(spark, sf_dir, "lineitem"))
    orders = read_table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(*columns)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "documents").select("text"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer -> part bought, both in one number space of nodes."""
    return _order_lines(spark, sf_dir, "o_custkey", "l_partkey").toDF("src", "dst")


def basket_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brands of an order, one row per line, repeats kept."""
    lines = spread(read_table(spark, sf_dir, "lineitem"))
    part = read_table(spark, sf_dir, "part")
    return lines.join(part, lines.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").alias("basket"), F.col("p_brand").alias("item")
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer, part, a tenth of the quantity; the timestamp counts days."""
    lines = _order_lines(spark, sf_dir, "o_custkey", "l_partkey", "l_quantity", "o_orderdate")
    return lines.select(
        F.col("o_custkey").alias("user"),
        F.col("l_partkey").alias("item"),
        (F.col("l_quantity") / 10).alias("rating"),
        F.datediff("o_orderdate", F.lit("1970-01-01")).cast("bigint").alias("ts"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS item",
        "concat('The ', p_name, ' of ', p_brand, ' (', 1990 + p_size, ')') AS title",
        "concat(p_type, '|', p_brand) AS genres",
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order line a short text: market segment, order priority, month of shipping."""
    lines = _order_lines(spark, sf_dir, "l_partkey", "l_shipdate", "o_custkey", "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer")
    return lines.join(customer, lines.o_custkey == customer.c_custkey).selectExpr(
        "l_partkey AS item",
        "concat_ws(' ', c_mktsegment, substr(o_orderpriority, 3), date_format(l_shipdate, 'MMMM'))"
        " AS tag",
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with their label and a two-way truth made of the lower and upper labels."""
    return read_table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id",
        "CAST(embedding AS array<double>) AS point",
        "label",
        "int(label >= 5) AS truth",
    )


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn of a conversation beside the turn that follows it."""
    turns = spread(read_table(spark, sf_dir, "conversations")).select("conv_id", "turn", "text")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    return turns.join(following, ["conv_id", "turn"])
