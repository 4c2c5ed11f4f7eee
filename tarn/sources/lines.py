"""Line formats: adjacency lists, baskets, vectors and center files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarn.functions.text import WHITESPACE, words
from tarn.operators.relational import broadcast_if_small
from tarn.session import stored


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) as rows of one column, ``value``."""
    return spark.read.text(path)


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) as rows ``(line, value)``, numbered from 0 over all files in the order of their names.

    The number depends on the files alone, not on how they were split for reading: a line's place
    in its block is added to the lines of all blocks before it. The lines are stored once with their
    places, so that both are of the same reading. Names of equal length go by their letters, shorter
    ones first, so that numbered parts stay in order.
    """
    place = F.monotonically_increasing_id().alias("place")
    block = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    marked = stored(read_lines(spark, path).select("value", *block, place), "lines")
    # one row a block; a block's lines are consecutive in one task
    blocks = stored(marked.groupBy("file", "block").agg(F.min("place").alias("first"), F.count("*").alias("n")), "line-blocks")
    before = lambda window: F.coalesce(F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = blocks.withColumn("inside", before(Window.partitionBy("file").orderBy("block")))
    files = blocks.groupBy("file").agg(F.sum("n").alias("n"))
    files = files.select("file", before(Window.orderBy(F.length("file"), "file")).alias("earlier"))
    starts = inside.join(files, "file").select("file", "block", (F.col("earlier") + F.col("inside") - F.col("first")).alias("shift"))
    numbered = marked.join(broadcast_if_small(stored(starts, "line-starts")), ["file", "block"])
    return numbered.select((F.col("place") + F.col("shift")).alias("line"), "value")


def _number(column: Column, kind: str, malformed: str) -> Column:
    if malformed == "fail":
        return column.cast(kind)
    if malformed == "drop":
        return column.try_cast(kind)
    raise ValueError("malformed must be 'fail' or 'drop'")


def adjacency_edges(lines: DataFrame, value: str = "value", malformed: str = "fail") -> DataFrame:
    """``src <tab> dst,dst,...`` to one row ``(src, dst)`` per listed neighbour.

    Empty entries are skipped, so a node without neighbours gives no edge.
    ``malformed='drop'`` leaves out edges with an unreadable end.
    """
    fields = F.split(value, "\t", 2)
    entries = lines.select(
        _number(F.trim(fields[0]), "bigint", malformed).alias("src"),
        F.explode(F.split(F.get(fields, F.lit(1)), ",")).alias("entry"),
    ).where("entry <> ''")
    edges = entries.select("src", _number(F.trim("entry"), "bigint", malformed).alias("dst"))
    return edges.dropna() if malformed == "drop" else edges


def basket_items(lines: DataFrame, value: str = "value", basket: str | None = None) -> DataFrame:
    """One basket a line, codes separated by white space, to rows ``(basket, item)``.

    Repeated codes stay repeated. ``basket`` names the column with the line's number, as
    :func:`read_numbered_lines` gives it; without one the lines of this scan are numbered, and
    another scan may number them otherwise.
    """
    number = F.monotonically_increasing_id() if basket is None else F.col(basket)
    numbered = lines.select(number.alias("basket"), value)
    return numbered.select("basket", F.explode(F.split(value, WHITESPACE)).alias("item")).where(
        "item <> ''"
    )


def vector_from_text(value: Column, malformed: str = "fail") -> Column:
    """Numbers separated by one space to ``array<double>``."""
    return F.transform(F.split(value, " "), lambda x: _number(x, "double", malformed))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return read_lines(spark, path).select(vector_from_text(F.col("value")).alias("point"))


def read_centers(spark: SparkSession, path: str) -> DataFrame:
    """Center file to ``(cluster, center)``; the cluster id is the line number from 0.

    The file holds k short lines and is read as one value, because only inside one
    value is the order of lines certain. Blank lines do not count.
    """
    numbered = F.filter(F.split("value", r"\R"), lambda line: F.trim(line) != "")
    return (
        spark.read.text(path, wholetext=True)
        .select(F.posexplode(numbered).alias("cluster", "line"))
        .select("cluster", F.transform(words(F.col("line")), lambda x: x.cast("double")).alias("center"))
    )
