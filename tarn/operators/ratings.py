"""Rating splits, RMSE, unseen items and ALS.

Ratings are rows ``(user, item, rating, ts)``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.operators.relational import top_k
from tarn.session import materialise, stored

#: Items of one slice, and users of one block, that meet in a unit of work: some 20 MB at rank 2.
SLICE_ITEMS, BLOCK_USERS = 524_288, 65_536
#: Items of one row on their way to the units, of one leaf within a unit, and users whose scores are held at once.
CHUNK_ITEMS, LEAF_ITEMS, STEP_USERS = 8_192, 512, 1_024
#: Ids are numbered within so many hash groups.
ID_GROUPS = 1024


def split_name(ts: Column) -> Column:
    """train, validation or test by the last digit of the timestamp: 6 / 2 / 2 of 10."""
    bucket = F.pmod(ts, F.lit(10))
    return (
        F.when(bucket < 6, "train").when(bucket.between(6, 7), "validation").when(bucket >= 8, "test")
    )


def with_split(ratings: DataFrame) -> DataFrame:
    return ratings.withColumn("split", split_name(F.col("ts")))


def train_union(ratings: DataFrame, user: DataFrame) -> DataFrame:
    """Training rows plus every rating of the users in ``user``, duplicates kept.

    The users' rows from all buckets join the training set, so those in the training
    buckets count twice and the others leak from validation and test, by design.
    """
    train = ratings.where(split_name(F.col("ts")) == "train")
    return train.unionByName(ratings.join(user, "user", "left_semi"))


def most_active_user(ratings: DataFrame) -> DataFrame:
    """The user with most ratings, the lowest id among equals: one row."""
    return (
        ratings.groupBy("user")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "user")
        .limit(1)
        .select("user")
    )


def unseen_items(items: DataFrame, ratings: DataFrame, user: DataFrame) -> DataFrame:
    """``(user, item)`` for every item that ``user`` has not rated; more than one user fails the job."""
    seen = ratings.join(user, "user", "left_semi").select("item").distinct()
    rest = items.select("item").join(seen, "item", "left_anti")
    return rest.select(user.select("user").scalar().alias("user"), "item")


def rmse(
    predictions: DataFrame, truth: DataFrame, denominator: str = "matched"
) -> DataFrame:
    """Root mean squared error of ``prediction`` against ``rating`` on (user, item).

    Only predicted pairs add to the sum. ``'matched'`` divides by their number, ``'all'``
    by all rows of ``truth``. Repeated pairs in ``truth`` each count.
    """
    matched = predictions.join(truth.select("user", "item", "rating"), ["user", "item"])
    error = F.pow(F.col("prediction") - F.col("rating"), 2)
    sums = matched.agg(F.sum(error).alias("squares"), F.count("*").alias("matched"))
    if denominator == "matched":
        n = F.col("matched")
    elif denominator == "all":
        n = truth.agg(F.count("*")).scalar()
    else:
        raise ValueError("denominator must be 'matched' or 'all'")
    return sums.select("matched", F.sqrt(F.try_divide(F.col("squares"), n)).alias("rmse"))


def rmse_by(predictions: DataFrame, truth: DataFrame, group: str) -> DataFrame:
    """``(group, matched, rmse)`` of each group of ``truth``, in one pass; divides by all its rows."""
    scored = truth.join(predictions.select("user", "item", "prediction"), ["user", "item"], "left")
    sums = scored.groupBy(group).agg(
        F.count("prediction").alias("matched"),
        F.sum(F.pow(F.col("prediction") - F.col("rating"), 2)).alias("squares"),
        F.count("*").alias("n"),
    )
    return sums.select(group, "matched", F.sqrt(F.col("squares") / F.col("n")).alias("rmse"))


def item_mean_predictions(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """Predict each pair by the item's mean training rating; unknown items drop out."""
    means = train.groupBy("item").agg(F.avg("rating").alias("prediction"))
    return pairs.select("user", "item").distinct().join(means, "item")


@dataclass(frozen=True)
class RatingModel:
    """A fitted model and the numbers it knows users and items by."""

    model: ALSModel
    users: DataFrame
    items: DataFrame


def item_mean_rmse(split: DataFrame) -> DataFrame:
    """``(matched, rmse)`` of the validation rows against the item's mean training rating.

    One pass: per item the validation ratings' squared distance from their own mean, and the distance
    of that mean from the training mean. Both come from centred moments, which tasks merge without
    ever subtracting large sums, so ratings far from zero lose nothing. Divides by all validation
    rows; those of items without training ratings add no error.
    """
    rating = F.col("rating").cast("double")
    held_out = F.col("split") == "validation"
    judged = split.where((F.col("split") == "train") | held_out).where(rating.isNotNull() | held_out)
    moments = judged.groupBy("item").agg(
        F.count_if(~held_out).alias("known"),
        F.count(F.when(held_out, rating)).alias("n"),
        F.var_pop(F.when(held_out, rating)).alias("spread"),
        # the slope over a flag is the difference of the two means
        F.regr_slope(rating, F.when(held_out, 1.0).otherwise(0.0)).alias("apart"),
    )
    error = F.col("n") * (F.col("spread") + F.col("apart") * F.col("apart"))
    return moments.agg(
        F.coalesce(F.sum(F.when(F.col("known") > 0, F.col("n"))), F.lit(0)).alias("matched"),
        F.sqrt(F.try_divide(F.sum(F.when(F.col("known") > 0, error)), F.sum("n"))).alias("rmse"),
    )


def numbered(rows: DataFrame, column: str) -> DataFrame:
    """Each value of ``column`` with an integer of its own, ``<column>_no``.

    Values are counted within hash groups, which many tasks do side by side; the numbers are
    dense but for the groups' difference in size.
    """
    group = F.pmod(F.xxhash64(column), F.lit(ID_GROUPS))
    place = F.row_number().over(Window.partitionBy("_group").orderBy(column)) - 1
    found = rows.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_group", group)
    return materialise(found.select(column, (place * ID_GROUPS + F.col("_group")).cast("int").alias(f"{column}_no")))


def als(
    train: DataFrame,
    rank: int = 2,
    iterations: int = 5,
    regularisation: float = 0.01,
    blocks: int = 10,
    seed: int = 1,
) -> RatingModel:
    """Explicit-feedback ALS on ids of any type; the result depends on the arguments alone.

    Pairs with an unknown user or item drop out of predictions. ``blocks`` spreads both factor
    matrices and is part of the model: take about two per core for data of many gigabytes.
    """
    users, items = numbered(train, "user"), numbered(train, "item")
    learner = ALS(
        rank=rank,
        maxIter=iterations,
        regParam=regularisation,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        userCol="user_no",
        itemCol="item_no",
        ratingCol="rating",
        coldStartStrategy="drop",
        seed=seed,
    )
    return RatingModel(learner.fit(train.join(users, "user").join(items, "item")), users, items)


def als_predict(fitted: RatingModel, pairs: DataFrame) -> DataFrame:
    """``(user, item, prediction)`` of every different pair whose user and item were in training."""
    known = pairs.select("user", "item").distinct().join(fitted.users, "user").join(fitted.items, "item")
    return fitted.model.transform(known).select("user", "item", "prediction")


def recommend_unseen(
    fitted: RatingModel, items: DataFrame, ratings: DataFrame, user: DataFrame
) -> DataFrame:
    """Unseen items of one user with title and predicted rating, best first."""
    scored = als_predict(fitted, unseen_items(items, ratings, user))
    return (
        scored.join(items.select("item", "title"), "item")
        .select("user", "item", "title", "prediction")
        .orderBy(F.desc("prediction"), "item")
    )


def normal_residuals(fitted: RatingModel, train: DataFrame, regularisation: float = 0.01) -> DataFrame:
    """``(user, n, residual)``: how far each user's factors are from solving its normal equations.

    The last half step of ALS solves, for each user with ``n`` ratings r of items with factors v,
    ``(sum of v v' + regularisation n I) x = sum of r v``. Both sides are made again here from the
    item factors, as plain sums; the residual is relative to the right side. A solved system leaves
    rounding errors of single precision.
    """
    rank = fitted.model.rank
    v = [F.col("v")[i].cast("double") for i in range(rank)]
    x = [F.col("x")[i].cast("double") for i in range(rank)]
    factors = fitted.model.itemFactors.select(F.col("id").alias("item_no"), F.col("features").alias("v"))
    rated = train.join(fitted.items, "item").join(factors, "item_no").join(fitted.users, "user")
    sums = rated.groupBy("user", "user_no").agg(
        F.count("*").alias("n"),
        *[F.sum(v[i] * v[j]).alias(f"a{i}_{j}") for i in range(rank) for j in range(i, rank)],
        *[F.sum(F.col("rating").cast("double") * v[i]).alias(f"b{i}") for i in range(rank)],
    )
    solved = sums.join(fitted.model.userFactors.select(F.col("id").alias("user_no"), F.col("features").alias("x")), "user_no")
    squares, right = F.lit(0.0), F.lit(0.0)
    for i in range(rank):
        row = F.lit(regularisation) * F.col("n") * x[i] - F.col(f"b{i}")
        for j in range(rank):
            row = row + F.col(f"a{min(i, j)}_{max(i, j)}") * x[j]
        squares, right = squares + row * row, right + F.col(f"b{i}") * F.col(f"b{i}")
    return solved.select("user", "n", F.sqrt(squares / F.greatest(right, F.lit(1e-30))).alias("residual"))


def factor_predictions(fitted: RatingModel, pairs: DataFrame) -> DataFrame:
    """``(user, item, prediction)`` of the different known pairs as the factors' products, by plain joins."""
    user = fitted.model.userFactors.select(F.col("id").alias("user_no"), F.col("features").alias("x"))
    item = fitted.model.itemFactors.select(F.col("id").alias("item_no"), F.col("features").alias("v"))
    known = pairs.select("user", "item").distinct().join(fitted.users, "user").join(fitted.items, "item")
    product = F.lit(0.0)
    for i in range(fitted.model.rank):
        product = product + F.col("x")[i].cast("double") * F.col("v")[i].cast("double")
    return known.join(user, "user_no").join(item, "item_no").select("user", "item", product.alias("prediction"))


def leaves(points: np.ndarray, most: int = LEAF_ITEMS) -> list[np.ndarray]:
    """The points' places in groups of at most ``most``: halves along the widest side, again and again."""
    todo, done = [np.arange(len(points))], []
    while todo:
        places = todo.pop()
        if len(places) <= most:
            done.append(np.sort(places))
            continue
        held = points[places]
        side = int(np.argmax(held.max(axis=0) - held.min(axis=0)))
        order = np.argpartition(held[:, side], len(places) // 2)
        todo += [places[order[: len(places) // 2]], places[order[len(places) // 2 :]]]
    return done


def best_items(
    left: np.ndarray, right: np.ndarray, sizes: np.ndarray, seen: np.ndarray, k: int, leaf_items: int = LEAF_ITEMS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, place, score)``: of each row of ``left`` the ``k`` rows of ``right`` with the largest products.

    ``seen`` lists the places to leave out, ``sizes`` many for each row of ``left``. Equal products go by
    place. Exact: the factors' box of a leaf bounds its products from both sides. So many leaves that
    they hold ``k`` places not seen give a least product that the k-th reaches, and only leaves whose upper
    bound reaches it are multiplied.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    groups = leaves(right, leaf_items) if len(left) and len(right) else []
    if groups:
        low, high = (np.array([f(right[g], axis=0) for g in groups]).T for f in (np.min, np.max))
        least_leaf, ends = min(map(len, groups)), np.cumsum(sizes)
    leaf_of, place_in = np.zeros(len(right), dtype=np.int64), np.zeros(len(right), dtype=np.int64)
    for number, g in enumerate(groups):
        leaf_of[g], place_in[g] = number, np.arange(len(g))
    for first in range(0, len(left) if groups else 0, STEP_USERS):
        x, n = left[first : first + STEP_USERS], sizes[first : first + STEP_USERS]
        plus, minus = np.maximum(x, 0), np.minimum(x, 0)
        upper, lower = plus @ high + minus @ low, plus @ low + minus @ high
        slack = 1e-9 * (np.abs(x) @ np.abs(right).max(axis=0))
        enough = -(-(k + n) // least_leaf)  # leaves that surely hold k places not seen
        ranked = -np.sort(-lower, axis=1) if enough.max() > 1 else lower.max(axis=1, keepdims=True)
        least = np.take_along_axis(ranked, np.minimum(enough - 1, ranked.shape[1] - 1)[:, None], axis=1)[:, 0] - slack
        least[enough > len(groups)] = -np.inf
        # what is seen, by leaf
        own = seen[ends[first] - n[0] : ends[first + len(x) - 1]]
        own_row, by_leaf = np.repeat(np.arange(len(x)), n), np.argsort(leaf_of[own], kind="stable")
        starts = np.searchsorted(leaf_of[own][by_leaf], np.arange(len(groups) + 1))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for number in np.argsort(-upper.max(axis=0)):
            rows = np.flatnonzero(upper[:, number] + slack >= least)
            if not len(rows):
                continue
            g = groups[number]
            scores = x[rows] @ right[g].T
            taken = by_leaf[starts[number] : starts[number + 1]]
            taken = taken[np.isin(own_row[taken], rows)]
            scores[np.searchsorted(rows, own_row[taken]), place_in[own[taken]]] = -np.inf
            if len(g) > k:
                least[rows] = np.maximum(least[rows], np.partition(scores, -k, axis=1)[:, -k])
            good = (scores >= least[rows][:, None]) & np.isfinite(scores)
            for tied in np.flatnonzero(good.sum(axis=1) > k):
                good[tied] = False
                good[tied, np.argsort(-scores[tied], kind="stable")[:k]] = True
            at, place = np.nonzero(good)
            found.append((rows[at], g[place], scores[at, place]))
        if found:
            row, place, score = (np.concatenate([f[c] for f in found]) for c in range(3))
            order = np.lexsort((place, -score, row))
            row, place, score = row[order], place[order], score[order]
            keep = np.arange(len(row)) - np.searchsorted(row, row) < k
            out.append((row[keep] + first, place[keep], score[keep]))
    empty = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
    return tuple(np.concatenate([o[c] for o in [*out, empty]]) for c in range(3))


def recommend_for_users(
    fitted: RatingModel, items: DataFrame, ratings: DataFrame, users: DataFrame, k: int = 10,
    slice_items: int = SLICE_ITEMS, block_users: int = BLOCK_USERS,
) -> DataFrame:
    """``(user, rank, item, title, prediction)``: for every user of ``users`` the ``k`` best items not rated yet.

    Items are dealt to slices and users to blocks; a unit meets one block with one slice, takes out what its
    users have rated, and returns ``k`` items a user (``best_items``), so that it need not multiply all of
    them. Slices travel in chunks of many items, and one copy serves a whole block. Users and items without
    factors drop out. Equal predictions go by item.
    """
    wanted = users.select("user").distinct().join(fitted.users, "user")
    wanted = stored(wanted.join(fitted.model.userFactors.selectExpr("id AS user_no", "features"), "user_no"), "wanted-users")
    known = items.select("item").distinct().join(fitted.items, "item")
    known = stored(known.join(fitted.model.itemFactors.selectExpr("id AS item_no", "features"), "item_no"), "known-items")
    slices, blocks = (1 + rows.count() // size for rows, size in ((known, slice_items), (wanted, block_users)))
    part = F.pmod(F.xxhash64("item_no"), F.lit(slices)).cast("int").alias("slice")
    block = F.pmod(F.xxhash64("user_no"), F.lit(blocks)).cast("int").alias("block")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # what a user has rated in one slice: no longer than the slice
    rated = ratings.select("user", "item").distinct().join(known.select("item", "item_no", part), "item")
    rated = rated.join(wanted.select("user", "user_no"), "user").groupBy("user_no", "slice").agg(F.collect_list("item_no").alias("seen"))
    asking = wanted.select("user_no", "features", block, every(slices).alias("slice")).join(rated, ["user_no", "slice"], "left")
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), "item_no"), F.lit(1 + slice_items // CHUNK_ITEMS)).alias("chunk")
    packed = known.select(part, chunk, F.struct("item", "item_no", "features").alias("entry"))
    packed = stored(packed.groupBy("slice", "chunk").agg(F.collect_list("entry").alias("entries")), "item-chunks")
    offered = packed.select("slice", "entries", every(blocks).alias("block"))
    item_type = known.schema["item"].dataType

    def best(asked: pa.Table, slice_: pa.Table) -> pa.Table:
        entries = slice_.column("entries").combine_chunks().flatten()
        item, no, features = entries.flatten()
        order = pc.sort_indices(item)
        item, no = item.take(order), no.take(order).to_numpy()
        rank = len(features.flatten()) // max(len(features), 1)
        right = features.flatten().to_numpy().astype(np.float64).reshape(len(no), rank)[order.to_numpy()]
        features = asked.column("features").combine_chunks().flatten()
        left = features.to_numpy().astype(np.float64).reshape(asked.num_rows, len(features) // max(asked.num_rows, 1))
        seen = asked.column("seen").combine_chunks()
        sizes = pc.fill_null(pc.list_value_length(seen), 0).to_numpy()
        by_no = np.argsort(no)
        seen = by_no[np.searchsorted(no[by_no], seen.flatten().to_numpy(zero_copy_only=False).astype(no.dtype))]
        row, place, score = best_items(left, right, sizes, seen, k)
        columns = [asked.column("user_no").take(pa.array(row)).combine_chunks(), item.take(pa.array(place)), pa.array(score, pa.float64())]
        return pa.table(columns, ["user_no", "item", "prediction"])

    unit = ["block", "slice"]
    found = asking.groupBy(*unit).cogroup(offered.groupBy(*unit)).applyInArrow(best, f"user_no int, item {item_type.simpleString()}, prediction double")
    titled = items.select("item", "title").dropDuplicates(["item"])
    named = found.join(wanted.select("user", "user_no"), "user_no")
    ranked = top_k(named, ["user"], [F.desc("prediction"), "item"], k)
    return ranked.join(titled, "item").select("user", "rank", "item", "title", "prediction")
