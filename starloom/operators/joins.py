"""Join operators."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starloom.operators.clean import first_per_key


def join_chain(first: DataFrame, *steps, how="inner") -> DataFrame:
    """Join tables one after another; each step is ``(table, keys)`` or ``(table, keys, how)``."""
    return reduce(lambda df, step: df.join(step[0], step[1], step[2] if len(step) > 2 else how), steps, first)


def star_join(fact: DataFrame, *dimensions) -> DataFrame:
    """Fact to dimensions; each is ``(dimension, fact key, dimension key)``.

    No side is forced to be broadcast: Spark does so by measured size.
    """
    for dimension, fact_key, dim_key in dimensions:
        fact = fact.join(dimension, fact[fact_key] == dimension[dim_key])
    return fact


def match_plays(
    plays: DataFrame,
    songs: DataFrame,
    how="left",
    on=("title", "artist", "duration"),
    duration_scale=None,
    one_match=False,
) -> DataFrame:
    """Plays with the ``song_id`` and ``artist_id`` of the song they name.

    ``plays`` has ``song, artist, length``; ``songs`` has ``title,
    artist_name, duration``. ``on`` picks the columns that must agree,
    ``duration_scale`` rounds durations first (0 = whole seconds, halves up),
    ``one_match`` keeps the song with the smallest id where several agree. A
    popular song may hold much of the log: Spark splits such a join while it
    runs.
    """
    names = {"title": ("song", "title"), "artist": ("artist", "artist_name"), "duration": ("length", "duration")}

    def keyed(df, side):
        keys = {f"_{name}": F.col(names[name][side]) for name in on}
        if "duration" in on and duration_scale is not None:
            keys["_duration"] = keys["_duration"].cast(f"decimal(18,{duration_scale})")
        return df.withColumns(keys)

    keys = [f"_{name}" for name in on]
    songs = keyed(songs, 1).select(*keys, "song_id", "artist_id")
    if one_match:
        songs = first_per_key(songs, keys, ["song_id", "artist_id"])
    plays = keyed(plays, 0)
    return plays.join(songs, keys, how).drop(*keys)


def anti_values(universe: DataFrame, seen: DataFrame, on) -> DataFrame:
    """Distinct values of ``universe`` that do not occur in ``seen``, NULL treated as a value."""
    on = [on] if isinstance(on, str) else list(on)
    # Distinct first: EXCEPT would join all rows and drop repeats afterwards.
    return universe.select(*on).distinct().subtract(seen.select(*on).distinct())


def keep_ids(df: DataFrame, ids: DataFrame, on) -> DataFrame:
    """Rows whose key is in a set of qualifying ids."""
    return df.join(ids, on, "left_semi")


#: Length of the grams by which labels are found.
_GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """Distinct pieces of a length."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    pieces = F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, F.lit(size))))
    return F.when(F.length(text) >= size, pieces).otherwise(F.array().cast("array<string>"))


def contains_lookup(
    left: DataFrame, text: str, labels: DataFrame, label: str, code: str, order: Column | str
) -> DataFrame:
    """``left`` with the code of the first label (by ``order``) that contains ``text``, without regard to case.

    Labels are indexed by their grams of one to three characters, so the index
    is linear in their length. A text of up to three characters is a gram
    itself: the first label of each gram is known without looking at labels. A
    longer text meets only the labels that have the rarest of its grams (none if
    a gram is in no label) and is then searched in them. Every distinct text is
    looked up once. An empty text is in every label; NULL and unmatched text
    get a NULL code.
    """
    order = F.col(order) if isinstance(order, str) else order
    listed = labels.select(F.lower(label).alias("_label"), F.struct(F.col(code).alias("code")).alias("_code"), order.alias("_order"))
    entries = (
        listed.where("_label is not null")
        .groupBy("_label")
        .agg(F.min_by("_code", "_order").alias("_code"), F.min("_order").alias("_order"))
        .withColumn("_id", F.xxhash64("_label"))
    )
    by_size = [_grams(F.col("_label"), size) for size in range(1, _GRAM + 1)]
    pieces = entries.select("_id", "_code", "_order", F.explode(F.concat(F.array(F.lit("")), *by_size)).alias("_gram"))
    by_gram = pieces.groupBy("_gram").agg(F.count(F.lit(1)).alias("_labels"), F.min_by("_code", "_order").alias("_code"))
    texts = left.select(F.lower(text).alias("_text")).where("_text is not null").distinct()

    short = texts.where(F.length("_text") <= _GRAM).join(by_gram, F.col("_text") == F.col("_gram")).select("_text", "_code")
    # min() of a struct takes the rarest gram; a gram without labels sorts first and ends the search.
    rarity = F.struct(F.coalesce("_labels", F.lit(0)).alias("labels"), F.col("_gram").alias("gram"))
    rarest = (
        texts.where(F.length("_text") > _GRAM)
        .select("_text", F.explode(_grams(F.col("_text"), _GRAM)).alias("_gram"))
        .join(by_gram.select("_gram", "_labels"), "_gram", "left")
        .groupBy("_text")
        .agg(F.min(rarity).alias("_rarest"))
        .where("_rarest.labels > 0")
        .select("_text", F.col("_rarest.gram").alias("_gram"))
    )
    long = (
        rarest.join(pieces.select("_gram", "_id"), "_gram")
        .join(entries, "_id")
        .where(F.contains("_label", "_text"))
        .groupBy("_text")
        .agg(F.min_by("_code", "_order").alias("_code"))
    )
    found = short.unionByName(long).select("_text", F.col("_code.code").alias(code))
    return left.withColumn("_text", F.lower(F.col(text))).join(found, "_text", "left").drop("_text")


def join_two_counts(df: DataFrame, key_a, name_a, key_b, count_a="count_a", count_b="count_b") -> DataFrame:
    """Each distinct ``(key_a, name_a)`` with how often its key occurs in ``key_a`` and in ``key_b``.

    Keys that never occur in ``key_b`` drop out. The rows are counted before
    any join, so only distinct keys are joined.
    """
    by_name = df.groupBy(key_a, name_a).agg(F.count(key_a).alias("_n"))
    from_a = by_name.groupBy(key_a).agg(F.sum("_n").alias(count_a))
    from_b = df.groupBy(F.col(key_b).alias(key_a)).agg(F.count(key_b).alias(count_b))
    return by_name.drop("_n").join(from_a, key_a).join(from_b, key_a)
