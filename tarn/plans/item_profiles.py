"""Item features: title words, genres, year, average rating and top tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions.stemming import stem_all
from tarn.functions.text import genre_words, title_words, year_of
from tarn.operators.relational import tasks_for, top_k
from tarn.operators.words import stem_counts, word_rows
from tarn.session import stored


def item_features(items: DataFrame, tokenizer: str = "word") -> DataFrame:
    """``(item, title, genres)`` to ``(item, year, title_words, genre_words)``."""
    return items.select(
        "item",
        year_of(F.col("title")).alias("year"),
        title_words(F.col("title"), tokenizer).alias("title_words"),
        stem_all(genre_words(F.col("genres"))).alias("genre_words"),
    )


def item_average(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("item").agg(F.avg("rating").alias("avg_rating"))


def item_tag_counts(tags: DataFrame) -> DataFrame:
    """``(item, tag text)`` to ``(item, stem, n)``: occurrences of each stemmed word.

    Equal texts of an item are counted before they are cut into words.
    """
    tags = stored(tags.select("item", "tag"), "item-tags")
    texts = tags.repartition(tasks_for(tags), "item", "tag").groupBy("item", "tag").agg(F.count("*").alias("texts"))
    return stem_counts(word_rows(texts, "tag", "item", "texts"), "word", "item", weight="texts")


def item_top_tags(tag_counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent tags of an item, equal counts by name."""
    return top_k(tag_counts, ["item"], [F.desc("n"), "stem"], k)


def ranked_list(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Top-k rows to one array per key in rank order; at most k entries."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", value)))
    return rows.groupBy(key).agg(F.transform(ordered, lambda e: e[value]).alias(name))


def item_master(
    features: DataFrame, ratings: DataFrame, tag_counts: DataFrame, k: int = 10
) -> DataFrame:
    """Features, average rating and tag list of items that have all three. Counts ``tag_counts``, so pass stored ones."""
    dealt = lambda rows, tasks=tasks_for(tag_counts): rows.repartition(tasks, "item")
    tags = ranked_list(item_top_tags(dealt(tag_counts), k), "item", "stem", "tags")
    return dealt(features).join(dealt(item_average(ratings)), "item").join(tags, "item")
