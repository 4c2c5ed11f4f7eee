"""User taste profiles: what a user's ratings add up to by tag, year and genre."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.operators.relational import TASK_ROWS, UNIT_ROWS, broadcast_if_small, many_to_many, tasks_for, top_k
from tarn.operators.ratings import numbered
from tarn.plans.item_profiles import ranked_list
from tarn.session import stored


def _scores(rated: DataFrame, trait: str, score, tasks: int) -> DataFrame:
    """Sum per (user, trait), rounded so that the ranking does not hang on a last bit."""
    sums = rated.repartition(tasks, "user", trait).groupBy("user", trait).agg(F.sum(score).alias("score"))
    return sums.repartition(tasks, "user").withColumn("score", F.round("score", 6))


def _best(scores: DataFrame, trait: str, k: int) -> DataFrame:
    return top_k(scores, ["user"], [F.desc("score"), trait], k)


def user_tags(ratings: DataFrame, tag_counts: DataFrame, k: int = 20, unit_rows: int = UNIT_ROWS, user_rows: int = TASK_ROWS) -> DataFrame:
    """Top tags: each rating counts once per occurrence of the tag on the item, by any tagger.

    Occurrences are already counted per (item, stem) and ratings are summed per
    (user, item), so the many-to-many join meets neither repeated tags nor repeated pairs;
    the raters and tags of a hot item are split among tasks. The tags of an item travel as one list of
    numbers (of ``unit_rows`` at most) a rating, and are added up where a user's ratings meet, so no row per
    user, item and tag is shuffled. The ratings of a user with very many are added up in several tasks.
    """
    numbers = numbered(tag_counts, "stem")
    lists = tag_counts.join(broadcast_if_small(numbers), "stem").groupBy("item", F.floor(F.col("stem_no") / unit_rows).alias("part"))
    lists = stored(lists.agg(F.sort_array(F.collect_list(F.struct("stem_no", "n"))).alias("tags")), "item-tag-lists")
    lists = lists.select("item", F.transform("tags", lambda t: t["stem_no"]).alias("nos"), F.transform("tags", lambda t: t["n"]).alias("counts"))
    # the narrowest integers that hold every count, as a list goes out once a rating
    most = lists.agg(F.max(F.array_max("counts"))).first()[0] or 0
    width = "tinyint" if most < 1 << 7 else "smallint" if most < 1 << 15 else "bigint"
    lists = lists.withColumn("counts", F.col("counts").cast(f"array<{width}>"))
    tasks = tasks_for(ratings)
    per_item = ratings.repartition(tasks, "user", "item").groupBy("user", "item").agg(F.sum("rating").alias("rating"))
    per_item = stored(per_item, "user-item-ratings")
    heavy = per_item.groupBy("user").agg(F.ceil(F.count("*") / user_rows).cast("int").alias("shares")).where("shares > 1")
    heavy = stored(heavy, "heavy-users")
    rated = many_to_many(per_item, lists, "item", unit_rows)
    place, score = ["user"], F.sum(F.col("rating") * F.col("counts").cast("bigint")).alias("score")
    if not heavy.isEmpty():
        rated = rated.join(broadcast_if_small(heavy), "user", "left")
        rated = rated.withColumn("share", F.coalesce(F.pmod(F.xxhash64("item"), F.col("shares")).cast("int"), F.lit(0)))
        place = ["user", "share"]
    rated = rated.select(*place, "rating", "nos", "counts").repartition(tasks, *place)
    sums = rated.select(*place, "rating", F.inline(F.arrays_zip("nos", "counts"))).groupBy(*place, "nos").agg(score)
    if len(place) > 1:
        sums = sums.groupBy("user", "nos").agg(F.sum("score").alias("score")).repartition(tasks, "user")
    named = sums.withColumnRenamed("nos", "stem_no").join(broadcast_if_small(numbers), "stem_no")
    return _best(named.select("user", "stem", F.round("score", 6).alias("score")), "stem", k)


def user_years(ratings: DataFrame, master: DataFrame, k: int = 10) -> DataFrame:
    """Top years over items that are in the master table."""
    rated = ratings.join(master.select("item", "year"), "item")
    return _best(_scores(rated, "year", F.col("rating"), tasks_for(ratings)), "year", k)


def user_genres(ratings: DataFrame, master: DataFrame, k: int = 10) -> DataFrame:
    """Top genres over items that are in the master table."""
    genres = master.select("item", F.explode("genre_words").alias("genre"))
    return _best(_scores(ratings.join(genres, "item"), "genre", F.col("rating"), tasks_for(ratings)), "genre", k)


def user_profile(tags: DataFrame, years: DataFrame, genres: DataFrame) -> DataFrame:
    """One row per user who has all three lists."""
    return (
        _scored_list(tags, "stem", "tags")
        .join(_scored_list(years, "year", "years"), "user")
        .join(_scored_list(genres, "genre", "genres"), "user")
    )


def _scored_list(rows: DataFrame, trait: str, name: str) -> DataFrame:
    """Top-k rows to one array of (name, score) per user; at most k entries."""
    pairs = rows.select("user", "rank", F.struct(F.col(trait).alias("name"), "score").alias("entry"))
    return ranked_list(pairs, "user", "entry", name)
