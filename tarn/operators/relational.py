"""Counting, joining and ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.session import materialise

#: A key with more than one in so many rows is hot; there are never more hot keys than this.
HOT_SHARE = 1024
#: Rows of either side that one unit of a hot key's many-to-many join holds.
UNIT_ROWS = 4096
#: Rows that a task should get where a shuffle's width is chosen here.
TASK_ROWS = 262_144
BROADCAST_BYTES = 64 * 1024 * 1024


def count_by(rows: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key; a null key forms a group of its own."""
    return rows.groupBy(*keys).agg(F.count("*").alias(name))


def most_frequent(rows: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Rows per key, largest first, equal counts by key."""
    return count_by(rows, key, name=name).orderBy(F.desc(name), key)


def joined_count(
    facts: DataFrame, dims: DataFrame, fact_key: str, dim_key: str, by: str, name: str = "n"
) -> DataFrame:
    """Join ``facts`` to ``dims`` and count by ``by``, largest first.

    Facts are counted per join key first, so the shuffle carries one row per key and
    map task, however often a key repeats.
    """
    per_key = count_by(facts, fact_key, name="_facts")
    return (
        per_key.join(dims.select(dim_key, by), per_key[fact_key] == dims[dim_key])
        .groupBy(by)
        .agg(F.sum("_facts").alias(name))
        .orderBy(F.desc(name), by)
    )


def top_k(
    rows: DataFrame, group: list[str], order: list[Column | str], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group, numbered from 1. ``order`` must be total.

    Spark keeps only k rows a group in each map task before it shuffles.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def tasks_for(rows: DataFrame, task_rows: int = TASK_ROWS) -> int:
    """Tasks of about ``task_rows`` rows each, one a core at least. Counts ``rows``, so pass a stored frame.

    Adaptive execution sizes tasks by shuffled bytes, which compress well where rows are narrow; a task
    then holds ever more rows until those bytes are reached. With a width by rows its memory does not grow.
    """
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // task_rows))


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring ``df``; otherwise leave the join to Spark.

    Reads ``df`` once, so pass a stored or materialised frame.
    """
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("size")).first()["size"]
    return F.broadcast(df) if (size or 0) <= max_bytes else df


def many_to_many(left: DataFrame, right: DataFrame, key: str, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """Inner equi-join on ``key`` in which no task holds all rows of a hot key.

    A key's rows on both sides are counted first. Where their product exceeds ``unit_rows`` squared, the
    left rows are dealt to slices and the right rows to blocks of about ``unit_rows``, and each slice
    meets each block in a unit of its own: no unit makes more than some ``unit_rows`` squared rows, and
    a row is copied only once for every ``unit_rows`` rows of the other side. Other keys join as
    usual. Rows without a key drop out. Both frames are read twice, so pass stored or cheap ones.
    """
    heavy = (
        left.groupBy(key).agg(F.count("*").alias("_left"))
        .join(right.groupBy(key).agg(F.count("*").alias("_right")), key)
        .where(F.col("_left") * F.col("_right") > unit_rows * unit_rows)
        .select(key, F.ceil(F.col("_left") / unit_rows).cast("int").alias("_slices"), F.ceil(F.col("_right") / unit_rows).cast("int").alias("_blocks"))
    )
    heavy = materialise(heavy)
    if heavy.isEmpty():
        return left.join(right, key)
    heavy = broadcast_if_small(heavy)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    place = lambda rows, n: F.pmod(F.xxhash64(*rows.columns), F.col(n)).cast("int")
    hot_left = left.join(heavy, key).withColumn("_slice", place(left, "_slices")).withColumn("_block", every("_blocks"))
    hot_right = right.join(heavy, key).withColumn("_block", place(right, "_blocks")).withColumn("_slice", every("_slices"))
    extra = ["_slices", "_blocks"]
    # dealt by unit, so that a hot key's units are tasks of their own
    met = hot_left.drop(*extra).join(hot_right.drop(*extra).hint("shuffle_hash"), [key, "_slice", "_block"]).drop("_slice", "_block")
    rest = left.join(heavy, key, "left_anti").join(right, key)
    return rest.unionByName(met)


def lookup(rows: DataFrame, table: DataFrame, key: str, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Inner join of stored ``rows`` with a stored ``table`` that has each key at most once.

    A table measured as small goes to all tasks. Of a large one only the entries of hot keys do,
    at most ``HOT_SHARE`` of them, so that no task gets all rows of one key; other rows move to their
    entry.
    """
    hinted = broadcast_if_small(table, max_bytes)
    if hinted is not table:
        return rows.join(hinted, key)
    counts = materialise(count_by(rows, key, name="_rows"))
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    hot = materialise(counts.where(F.col("_rows") * HOT_SHARE > total).select(key))
    hot_entries = F.broadcast(materialise(table.join(F.broadcast(hot), key, "left_semi")))
    rest = rows.join(F.broadcast(hot), key, "left_anti")
    return rows.join(hot_entries, key).unionByName(rest.join(table, key))
