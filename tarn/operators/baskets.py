"""Market baskets: support, confidence and FP-Growth.

Input rows are ``(basket, item)``, one per occurrence. Nothing here builds the list of
a basket to pair it up: repeats collapse to ``(basket, item, times)`` and the number of
positional combinations follows from ``times``. So a basket that holds a large part of
all rows shrinks to its distinct items before anything is paired.

That collapsed table, made once by :func:`basket_contents`, is what all counts read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.operators.relational import UNIT_ROWS, broadcast_if_small, lookup, many_to_many
from tarn.session import materialise, stored

# Rules that may be brought to every executor at once.
MAX_BROADCAST_RULES = 200_000

# Distinct items of one basket that a single join group may hold before it is sliced: about
# two million pairs, or one and a half million triples.
SLICE_ITEMS = 2_000
SLICE_ITEMS_OF_TRIPLES = 200


def basket_contents(rows: DataFrame, positional: bool = True) -> DataFrame:
    """``(basket, item, times)``, stored; without ``positional`` a basket is a set of items.

    Repeats are summed in the map tasks and then by (basket, item), so no task ever
    holds the occurrences of a whole basket.
    """
    contents = rows.groupBy("basket", "item").agg(F.count("*").alias("times"))
    if not positional:
        contents = contents.withColumn("times", F.lit(1).cast("bigint"))
    return materialise(contents)


def basket_count(contents: DataFrame) -> int:
    return contents.select("basket").distinct().count()


def item_counts(contents: DataFrame) -> DataFrame:
    return contents.groupBy("item").agg(F.sum("times").alias("n"))


def frequent_items(contents: DataFrame, min_count: float) -> DataFrame:
    """Items that occur at least ``min_count`` times."""
    return item_counts(contents).where(F.col("n") >= min_count)


def keep_items(contents: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of the listed items. ``items`` is read once to decide on a broadcast."""
    return contents.join(broadcast_if_small(items.select("item")), "item", "left_semi")


def _large_baskets(contents: DataFrame, slice_items: int) -> DataFrame | None:
    """``(basket, slices)`` of baskets with more than ``slice_items`` items, if there are any."""
    large = (
        contents.groupBy("basket")
        .agg(F.count("*").alias("items"))
        .where(F.col("items") > slice_items)
        .select("basket", F.ceil(F.col("items") / slice_items).cast("int").alias("slices"))
    )
    return None if large.isEmpty() else materialise(large)


def _sides(contents: DataFrame, large: DataFrame | None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Two copies of ``contents`` and the keys to join them on.

    Normally the key is the basket. A large basket is cut into slices by its first item:
    the left copy is divided and the right copy repeated, so several tasks share its pairs.
    """
    if large is None:
        return contents, contents, ["basket"]
    sliced = contents.join(broadcast_if_small(large), "basket", "left").fillna(1, ["slices"])
    left = sliced.withColumn("slice", F.pmod(F.hash("item"), F.col("slices")))
    right = sliced.withColumn("slice", F.explode(F.expr("sequence(0, slices - 1)")))
    return left, right, ["basket", "slice"]


# Ways to pick positions for an ordered pair or triple of items from their multiplicities.
_WAYS = {
    2: "CASE WHEN a = b THEN na * (na - 1) DIV 2 ELSE na * nb END",
    3: """CASE WHEN a < b AND b < c THEN na * nb * nc
               WHEN a < b THEN na * (nb * (nb - 1) DIV 2)
               WHEN b < c THEN (na * (na - 1) DIV 2) * nc
               WHEN (na * (na - 1) DIV 2) % 3 = 0 THEN (na * (na - 1) DIV 6) * (na - 2)
               ELSE (na * (na - 1) DIV 2) * ((na - 2) DIV 3) END""",
}
_NAMES = {2: ["a", "b"], 3: ["a", "b", "c"]}


def _as(contents: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """``contents`` as the item ``name`` of a combination: columns name and n<name>."""
    return contents.select(*keys, F.col("item").alias(name), F.col("times").alias(f"n{name}"))


def _weighed(combinations: DataFrame, size: int) -> DataFrame:
    """Combinations of one basket with the number of position sets they occur at."""
    return combinations.selectExpr(*_NAMES[size], f"{_WAYS[size]} AS n").where("n > 0")


def _summed(weighed: DataFrame, size: int) -> DataFrame:
    return weighed.groupBy(*_NAMES[size]).agg(F.sum("n").alias("n"))


def _formed(
    contents: DataFrame, size: int, large: DataFrame | None = None, pairs: DataFrame | None = None
) -> DataFrame:
    """All weighed combinations of ``size`` items in each basket, items in order.

    ``pairs`` lists the first two items that a triple may have.
    """
    left, right, keys = _sides(contents, large)
    found = _as(left, "a", keys).join(_as(right, "b", keys), keys)
    found = found.where("a < b OR (a = b AND na > 1)")
    if size == 3:
        if pairs is not None:
            found = found.join(broadcast_if_small(pairs.select("a", "b")), ["a", "b"], "left_semi")
        found = found.join(_as(right, "c", keys), keys).where("b <= c")
    return _weighed(found, size)


def _counted(
    contents: DataFrame,
    size: int,
    min_count: float,
    slice_items: int,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Combinations with their counts, those of at least ``min_count``."""
    large = _large_baskets(contents, slice_items)
    if large is None:
        weighed = _formed(contents, size, pairs=pairs)
    else:
        weighed = _around_large_baskets(contents, size, min_count, large, pairs)
    return _summed(weighed, size).where(F.col("n") >= min_count)


def _around_large_baskets(
    contents: DataFrame, size: int, min_count: float, large: DataFrame, pairs: DataFrame | None
) -> DataFrame:
    """Weighed combinations, less those of large baskets that cannot reach ``min_count``.

    To any combination of an item, the large baskets add at most the item's ``reach``: its
    occurrences there, times the most frequent item of the same basket for each further
    item. So

    * only items whose reach alone is enough are combined inside large baskets;
    * of the other combinations, those that the remaining baskets bring near enough to
      ``min_count`` are looked up in the large baskets one by one.

    In set baskets an item's reach is the number of large baskets that hold it, and as a
    rule nothing is combined inside them at all.
    """
    names = _NAMES[size]
    hot = broadcast_if_small(large.select("basket"))
    inside = materialise(contents.join(hot, "basket", "left_semi"))
    elsewhere = contents.join(hot, "basket", "left_anti")
    outside = materialise(_summed(_formed(elsewhere, size, pairs=pairs), size))

    peaks = materialise(inside.groupBy("basket").agg(F.max("times").cast("double").alias("peak")))
    most = F.col("times") * F.pow("peak", F.lit(size - 1))
    reach = materialise(
        inside.join(broadcast_if_small(peaks), "basket")
        .groupBy("item")
        .agg((F.sum(most) * 1.000001).alias("reach"))
    )
    strong = keep_items(inside, reach.where(F.col("reach") >= min_count))
    among_strong = _formed(strong, size, large, pairs)

    near = outside
    for name in names:
        near = near.join(reach.toDF(name, f"reach_{name}"), name)
    near = (
        near.withColumn("reach", F.least(*[f"reach_{name}" for name in names]))
        .where((F.col("reach") < min_count) & (F.col("n") + F.col("reach") >= min_count))
        .select(*names)
    )
    found = near.join(_as(inside, "a", ["basket"]), "a")
    for name in names[1:]:
        found = found.join(_as(inside, name, ["basket"]), ["basket", name])
    return outside.unionByName(among_strong).unionByName(_weighed(found, size))


def pair_counts(
    contents: DataFrame,
    min_count: float,
    items: DataFrame | None = None,
    slice_items: int = SLICE_ITEMS,
) -> DataFrame:
    """Pairs ``(a, b, n)`` with ``a <= b``, both items frequent, ``n >= min_count``.

    Positional baskets count every pair of positions, so a repeated item pairs with
    itself. Rows are cut to the frequent ``items`` before any pair is formed.
    """
    if items is None:
        items = materialise(frequent_items(contents, min_count))
    return _counted(keep_items(contents, items), 2, min_count, slice_items)


def triple_counts(
    contents: DataFrame,
    min_count: float,
    sets: bool = False,
    slice_items: int = SLICE_ITEMS_OF_TRIPLES,
) -> DataFrame:
    """Triples ``(a, b, c, n)`` with ``a <= b <= c`` and ``n >= min_count``.

    ``sets`` says that the contents are sets. Then a frequent triple has only frequent
    items and pairs, so both prune. In positional baskets repeats can lift a triple above
    its items, so an item goes only if all positional triples around it are too few.
    """
    if sets:
        items = materialise(frequent_items(contents, min_count))
        pairs = materialise(pair_counts(contents, min_count, items, slice_items))
    else:
        items = materialise(_possible_in_triples(contents, min_count))
        pairs = None
    return _counted(keep_items(contents, items), 3, min_count, slice_items, pairs)


def _possible_in_triples(contents: DataFrame, min_count: float) -> DataFrame:
    """Items that take part in at least ``min_count`` positional triples of any kind.

    In a basket of ``size`` positions those are the triples not avoiding the item's
    positions. The count is an upper bound, in floating point, for each single triple.
    """
    sizes = contents.groupBy("basket").agg(F.sum("times").alias("size"))
    triples = "CAST({0} AS DOUBLE) * ({0} - 1) * ({0} - 2) / 6"
    around = F.expr(f"{triples.format('size')} - {triples.format('(size - times)')}")
    return (
        contents.join(sizes, "basket")
        .groupBy("item")
        .agg(F.sum(around).alias("bound"))
        .where(F.col("bound") * 1.000001 >= min_count)
    )


def pair_confidence(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """``lhs -> rhs`` both ways with ``n(lhs, rhs) / n(lhs)``, best first."""
    rules = pairs.select(
        F.inline(F.expr("array(struct(a AS lhs, b AS rhs, n), struct(b AS lhs, a AS rhs, n))"))
    )
    base = items.select(F.col("item").alias("lhs"), F.col("n").alias("n_lhs"))
    return (
        rules.join(base, "lhs")
        .select("lhs", "rhs", (F.col("n") / F.col("n_lhs")).alias("confidence"))
        .orderBy(F.desc("confidence"), "lhs", "rhs")
    )


def triple_confidence(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(lhs1, lhs2) -> rhs`` with ``n(triple) / n(pair)``, best first, then by name.

    A rule whose pair is not among ``pairs`` is left out.
    """
    rules = (
        triples.select(
            F.inline(
                F.expr(
                    """array(struct(a AS lhs1, b AS lhs2, c AS rhs, n),
                             struct(a AS lhs1, c AS lhs2, b AS rhs, n),
                             struct(b AS lhs1, c AS lhs2, a AS rhs, n))"""
                )
            )
        )
        .groupBy("lhs1", "lhs2", "rhs")
        .agg(F.sum("n").alias("n"))
    )
    base = pairs.select(
        F.col("a").alias("lhs1"), F.col("b").alias("lhs2"), F.col("n").alias("n_lhs")
    )
    return (
        rules.join(base, ["lhs1", "lhs2"])
        .select("lhs1", "lhs2", "rhs", (F.col("n") / F.col("n_lhs")).alias("confidence"))
        .orderBy(F.desc("confidence"), "lhs1", "lhs2", "rhs")
    )


def basket_sets(contents: DataFrame) -> DataFrame:
    """``(basket, items)`` with distinct items in order, at most the item vocabulary."""
    return contents.groupBy("basket").agg(F.sort_array(F.collect_list("item")).alias("items"))


def fp_growth(
    baskets: DataFrame, min_support: float, min_confidence: float, partitions: int | None = None
) -> FPGrowthModel:
    """Fit FP-Growth on ``(basket, items)``. ``partitions`` spreads the conditional trees."""
    growth = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    return (growth.setNumPartitions(partitions) if partitions else growth).fit(baskets)


def rules_met(rules: DataFrame, baskets: DataFrame, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """``(basket, items, rule, antecedent, consequent)`` for every rule whose antecedent a basket holds.

    An inverted index: each rule waits at that item of its antecedent which the fewest baskets hold,
    so an item common to all baskets or rules brings none together unless a rule consists of it. A
    basket meets the rules that wait at its items, and holds the whole antecedent or not. The
    baskets and rules of a hot anchor are split among tasks.
    """
    present = baskets.select("basket", "items", F.explode(F.array_distinct("items")).alias("anchor"))
    often = stored(present.groupBy("anchor").agg(F.count("*").alias("baskets")), "item-baskets")
    rules = stored(rules.select("antecedent", "consequent").withColumn("rule", F.monotonically_increasing_id()), "rules")
    members = stored(rules.select("rule", F.explode("antecedent").alias("anchor")), "rule-items")
    # an item in no basket at all counts as the rarest: its rules wait where nobody comes
    seen = lookup(members, often, "anchor").unionByName(
        members.join(often, "anchor", "left_anti").withColumn("baskets", F.lit(0).cast("bigint"))
    )
    anchors = seen.groupBy("rule").agg(F.min(F.struct("baskets", "anchor"))["anchor"].alias("anchor"))
    waiting = stored(rules.join(anchors, "rule"), "rule-anchors")
    met = many_to_many(present, waiting, "anchor", unit_rows)
    return met.where(F.size(F.array_except("antecedent", "items")) == 0).drop("anchor")


def fp_predict(
    model: FPGrowthModel, baskets: DataFrame, max_rules: int = MAX_BROADCAST_RULES
) -> DataFrame:
    """``baskets`` with a ``prediction``: consequents of the rules that a basket satisfies.

    The model's own ``transform`` holds all rules in memory everywhere, which is the quick
    way for a counted, moderate number of them. More rules meet the baskets through an index
    by item (:func:`rules_met`).
    """
    rules = model.associationRules.select("antecedent", F.col("consequent")[0].alias("consequent"))
    if rules.limit(max_rules + 1).count() <= max_rules:
        return model.transform(baskets)
    added = (
        rules_met(rules, baskets)
        .where(~F.array_contains("items", F.col("consequent")))
        .groupBy("basket")
        .agg(F.collect_set("consequent").alias("prediction"))
    )
    none = F.array().cast(baskets.schema["items"].dataType)
    return baskets.join(added, "basket", "left").withColumn(
        "prediction", F.coalesce("prediction", none)
    )


def with_names(rows: DataFrame, items: DataFrame, key: str, name: str) -> DataFrame:
    """Basket rows with the item's name in place of its code; codes without a name drop out."""
    return rows.join(items.select(F.col(key).alias("item"), F.col(name).alias("name")), "item").select("basket", "name")
