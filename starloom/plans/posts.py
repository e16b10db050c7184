"""Nested posts: titles, words and tagged words."""

from pyspark.sql import DataFrame, functions as F

from starloom.operators.aggregate import group_count, word_count

# Tags of proper nouns.
PROPER_NOUNS = ["NNP", "NNPS"]


def titles(posts: DataFrame) -> DataFrame:
    return posts.select("data.title", "data.author")


def title_words(posts: DataFrame) -> DataFrame:
    return word_count(titles(posts), "title")


def tagged_words(annotated: DataFrame, tags=PROPER_NOUNS) -> DataFrame:
    """Words with one of the tags, from ``pos: array<struct<result, metadata: map>>``."""
    return (
        annotated.select(F.explode("pos").alias("pos"))
        .where(F.col("pos.result").isin(list(tags)))
        .select(F.col("pos.metadata")["word"].alias("word"), F.col("pos.result").alias("tag"))
    )


def proper_nouns(annotated: DataFrame) -> DataFrame:
    return group_count(tagged_words(annotated), "word")
