"""Chat formatting after a cumulative-snapshot collapse, in DataFrame functions only.

Chat logs often hold a conversation again and again as it grows. Every turn adds
a 128-bit hash to its conversation; the running sum over turns is a hash of the
prefix. A conversation whose whole hash is a prefix of a longer one, or the same
as one with a smaller id, is dropped by an anti-join; the others are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkfold.llm.common import stored

# Turns per stretch: running sums and texts are built per stretch first, so a
# conversation that holds a third of all rows is not one group.
STRETCH = 1024
SUMS = ("a", "b", "c", "d")


def _turn_hash() -> list[Column]:
    """Four sums of 32 bits each (sums of halves cannot overflow below 2^31 turns).

    Null parts are told from empty ones, since the hash skips nulls.
    """
    parts = ["turn", "role", "text"]
    nulls = [F.col(p).isNull() for p in parts]
    out = []
    for seed in ("x", "y"):
        h = F.xxhash64(F.lit(seed), *parts, *nulls)
        out += [h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)]
    return out


def _key() -> Column:
    return F.struct("n", *SUMS)


def _parts(turns: DataFrame) -> DataFrame:
    """One row per conversation and turn number with its sums; equal turns are summed together."""
    sums = [F.sum(h).alias(s) for h, s in zip(_turn_hash(), SUMS)]
    stretch = F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(1 << 62)))
    return turns.groupBy("conv_id", stretch.alias("stretch"), "turn").agg(F.count("*").alias("n"), *sums)


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, key, total``: hash of the conversation up to each turn, and its number of rows."""
    per_turn = _parts(turns)
    names = ("n", *SUMS)
    per_stretch = per_turn.groupBy("conv_id", "stretch").agg(*[F.sum(x).alias(f"s_{x}") for x in names])
    conversation = Window.partitionBy("conv_id")
    before = conversation.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_stretch.select(
        "conv_id", "stretch", F.sum("s_n").over(conversation).alias("total"),
        *[F.coalesce(F.sum(f"s_{x}").over(before), F.lit(0)).alias(f"o_{x}") for x in names])
    same = per_turn["conv_id"].eqNullSafe(offsets["conv_id"]) & (per_turn["stretch"] == offsets["stretch"])
    rows = per_turn.join(offsets, same).drop(offsets["conv_id"]).drop(offsets["stretch"])
    upto = Window.partitionBy("conv_id", "stretch").orderBy("turn")
    sums = [(F.sum(x).over(upto) + F.col(f"o_{x}")).alias(x) for x in names]
    return rows.select("conv_id", "total", *sums).select("conv_id", "total", _key().alias("key"))


def render(turns: DataFrame, system: str | None = None) -> DataFrame:
    """``conv_id, n_turns, rendered``: each turn as <|im_start|>role, text, <|im_end|>.

    Turns go by number (null first), then role and text; a null role is
    "unknown" and a null text is empty.
    """
    turn = F.struct(F.col("turn"), F.col("role"), F.col("text"))
    stretch = F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(1 << 62)))
    pieces = turns.groupBy("conv_id", stretch.alias("stretch")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns"), F.count("*").alias("n"))

    def line(t: Column) -> Column:
        return F.concat(F.lit("<|im_start|>"), F.coalesce(t["role"], F.lit("unknown")), F.lit("\n"),
                        F.coalesce(t["text"], F.lit("")), F.lit("<|im_end|>\n"))
    pieces = pieces.select("conv_id", "stretch", "n", F.array_join(F.transform("turns", line), "").alias("piece"))
    whole = pieces.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("stretch", "piece"))).alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: p["piece"]), "")
    if system is not None:
        text = F.concat(F.lit(f"<|im_start|>system\n{system}<|im_end|>\n"), text)
    return whole.select("conv_id", "n_turns", text.alias("rendered"))


def maximal_conversations(turns: DataFrame, system: str | None = None) -> DataFrame:
    """``conv_id, n_turns, rendered`` of the conversations that no other one continues.

    ``turns`` has ``conv_id, turn, role, text``; other columns are not looked at.
    A prefix is everything up to a turn number. Of equal conversations the one
    with the smallest id stays (null last). Rows with a null id are one
    conversation, repeated rows are turns said twice, and an empty table gives an
    empty result. What prefixes share is summed before it is joined, so a first
    turn that a third of all conversations begin with is one row.
    """
    turns = turns.select(F.col("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.col("role"), F.col("text"))
    heads = stored(prefixes(turns), "chat-heads")
    whole_id = F.when(F.col("total") == F.col("key.n"), F.struct(F.col("conv_id").isNull().alias("last"), F.col("conv_id")))
    longest = heads.groupBy("key").agg(F.max("total").alias("longest"), F.min(whole_id).alias("first"))
    # Stored, so that both sides of the join are plain exchanges, which Spark deals anew where a key is hot.
    longest = stored(longest, "chat-prefixes")
    # Only keys meet in the anti-join; texts move once it is known which conversations stay.
    whole = heads.where("total = key.n").withColumnRenamed("key", "own_key")
    own = F.struct(F.col("conv_id").isNull().alias("last"), F.col("conv_id"))
    continued = (F.col("own_key") == F.col("key")) & ((F.col("longest") > F.col("total")) | (F.col("first") < own))
    stay = stored(whole.join(longest, continued, "left_anti").select(F.col("conv_id").alias("kept")), "chat-kept")
    return render(turns.join(stay, F.col("conv_id").eqNullSafe(F.col("kept")), "left_semi"), system)
