"""Term-frequency cosine between token lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tf_cosine(
    pairs: DataFrame, key: list[str], left: str, right: str, name: str = "cosine"
) -> DataFrame:
    """Cosine of the term counts of two token lists, one row per pair.

    ``pairs`` has a unique ``key`` and two array columns. No shared token gives 0; a side
    without tokens gives null. Tokens compare in lower case.

    Both lists of a pair are counted side by side, so tokens are never joined with tokens
    and a token common to all texts costs no more than a rare one.
    """
    sides = F.concat(
        F.transform(left, lambda t: F.struct(F.lower(t).alias("token"), F.lit(1).alias("side"))),
        F.transform(right, lambda t: F.struct(F.lower(t).alias("token"), F.lit(2).alias("side"))),
    )
    counts = (
        pairs.select(*key, F.explode_outer(sides).alias("term"))
        .groupBy(*key, "term.token")
        .agg(
            F.count_if(F.col("term.side") == 1).cast("double").alias("x"),
            F.count_if(F.col("term.side") == 2).cast("double").alias("y"),
        )
    )
    dot, xx, yy = (F.sum(F.col(a) * F.col(b)) for a, b in ("xy", "xx", "yy"))
    return counts.groupBy(*key).agg(F.try_divide(dot, F.sqrt(xx) * F.sqrt(yy)).alias(name))
