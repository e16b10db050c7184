"""Preference formatting with DataFrame functions only.

For a pair of conversations the longest common prefix of turns (equal role and
text) is rendered once as the prompt; what follows is rendered as the chosen and
the rejected completion. A mask of runs ``length:flag`` covers each completion:
the text and end mark of assistant turns are learned (1), all else is not (0).

Defined results: turns are ordered by ``turn`` (nulls first), then role and
text, so repeated rows are repeated turns; a null role or text counts as ''; rows
without ``conv_id`` belong to no conversation; a pair with an unknown
conversation is left out. If one conversation is a prefix of the other, its
completion is empty, with an empty mask; equal conversations have two empty
completions. Extra columns are not read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"


def turn_lists(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and its turns, an array of structs ``turn, role, text`` in order."""
    turn = F.struct("turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    named = conversations.where(F.col("conv_id").isNotNull())
    return named.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def common_turns(one: Column, other: Column) -> Column:
    """Number of leading turns that are equal."""
    same = F.zip_with(one, other, lambda a, b: F.coalesce((a.role == b.role) & (a.text == b.text), F.lit(False)))
    differs = F.array_position(same, False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(same)).cast("int")


def _head(turn):
    return F.concat(F.lit(START), turn.role, F.lit("\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t.text, F.lit(END))), "")


def mask(turns: Column) -> Column:
    """Runs of characters that are learned (1) or not (0), in the rendered text."""

    def runs(turn):
        head, body = F.length(_head(turn)), F.length(turn.text) + len(END)
        learned = F.concat_ws(",", F.concat(head, F.lit(":0")), F.concat(body, F.lit(":1")))
        return F.when(turn.role == LEARNED, learned).otherwise(F.concat(head + body, F.lit(":0")))

    return F.array_join(F.transform(turns, runs), ",")


def preference_examples(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row for each row of ``pairs`` (``chosen_id, rejected_id``): prompt, completions and masks."""
    turns = turn_lists(conversations)
    chosen = turns.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("one"))
    rejected = turns.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("other"))
    both = pairs.select("chosen_id", "rejected_id").join(chosen, "chosen_id").join(rejected, "rejected_id")
    split = both.withColumn("n_common", common_turns(F.col("one"), F.col("other")))
    rest = {c: F.slice(c, F.col("n_common") + 1, F.greatest(F.size(c), F.lit(1))) for c in ("one", "other")}
    return split.select(
        "chosen_id",
        "rejected_id",
        "n_common",
        render(F.slice("one", F.lit(1), F.col("n_common"))).alias("prompt"),
        render(rest["one"]).alias("chosen"),
        render(rest["other"]).alias("rejected"),
        mask(rest["one"]).alias("chosen_mask"),
        mask(rest["other"]).alias("rejected_mask"),
    )


def neighbour_pairs(conversations: DataFrame) -> DataFrame:
    """Pairs of the conversations ``2i`` and ``2i + 1``: the one with more assistant text is chosen, or else the first."""
    said = F.sum(F.when(F.col("role") == LEARNED, F.length("text")).otherwise(0))
    length = conversations.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.coalesce(said, F.lit(0)).alias("said"))
    # The larger text first, then the smaller id.
    rank = F.struct("said", (-F.col("conv_id")).alias("order"))
    ends = length.groupBy(F.floor(F.col("conv_id") / 2).alias("pair")).agg(
        F.max(rank).alias("best"), F.min(rank).alias("worst"), F.count(F.lit(1)).alias("n")
    )
    return ends.where("n = 2").select((-F.col("best.order")).alias("chosen_id"), (-F.col("worst.order")).alias("rejected_id"))
