"""Mixing sources to target weights by hash-threshold histograms.

Each document has a 64-bit hash of its id. A source takes whole copies of all
its documents as often as its target allows, and for the rest every document
whose hash lies below the source's threshold. Thresholds are found from sums by
(source, leading hash bits): the bucket in which the running sum passes the
budget is split by the next bits, only its documents are summed again, and so on
to the last bit. No document is ever sorted; a threshold of a smaller budget
lies below that of a larger one, so smaller mixes are subsets of larger ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkfold.llm.common import free_names, group_key, stored, word_count

# Hash bits looked at per round, 64 in all. The last round sees 2^-30 of a source.
ROUNDS = (10, 10, 10, 34)
_FLIP = -(1 << 63)


def size_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, size`` (words; a null text has 0)."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0,
                   max_repeat: int = 3) -> DataFrame:
    """``key, source_size, target``: one row per source.

    Sources in code-point order (null last) get the weights in turn. A target
    stops at ``max_repeat`` times the source; the excess goes to the others by
    weight until none is above. Sources are filled in order of limit by weight:
    those below the common level are the ones that stop. The windows run over
    one row per source, never over documents.
    """
    per_source = sizes.groupBy(group_key("source").alias("key")).agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("key"))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (turn - 1) % len(weights))
    every = Window.partitionBy(F.lit(0))
    by_limit = every.orderBy(F.col("limit") / F.col("weight"), "key")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
             / F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)))
    ranked = (per_source.withColumn("weight", weight)
              .withColumn("limit", F.col("source_size") * F.lit(float(max_repeat)))
              .withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
              .withColumn("level", level)
              .withColumn("stops", F.col("limit") <= F.col("level") * F.col("weight")))
    # The level of the first source that does not stop holds for all behind it.
    common = F.min(F.when(~F.col("stops"), F.struct(F.col("limit") / F.col("weight"), F.col("key"), F.col("level"))))
    target = F.when(F.col("stops"), F.col("limit")).otherwise(F.col("weight") * common.over(every)["level"])
    return ranked.select("key", "source_size", target.alias("target"))


def _bits(h: Column, start: int, width: int) -> Column:
    """``width`` bits of a hash, from bit ``start`` counted from the top."""
    return F.shiftrightunsigned(F.shiftleft(h, start), 64 - width)


def _round(edge: DataFrame, start: int, width: int) -> DataFrame:
    """The bucket of each source in which the running sum passes its need.

    ``edge``: key, need, size, h. Gives key, need (left for that bucket), mark.
    The window runs over at most 2^width sums of a source.
    """
    sums = edge.groupBy("key", "need", _bits(F.col("h"), start, width).alias("mark")).agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(Window.partitionBy("key").orderBy("mark"))
    passed = sums.withColumn("upto", upto).where(F.col("upto") > F.col("need"))
    first = passed.groupBy("key").agg(F.min(F.struct("mark", "upto", "size", "need")).alias("m"))
    return first.select("key", (F.col("m.need") - F.col("m.upto") + F.col("m.size")).alias("need"), F.col("m.mark").alias("mark"))


def source_bounds(sizes: DataFrame, weights: tuple[int, ...], share: float, max_repeat: int) -> DataFrame:
    """Per source ``key, source_size, target, whole, threshold, nearer``, from stored ``doc_id, key, size``."""
    h = F.xxhash64("doc_id")
    targets = stored(source_targets(sizes, weights, share, max_repeat), "mix-targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    targets = targets.withColumn("whole", whole)
    need = F.col("target") - F.col("whole") * F.col("source_size")
    edge = sizes.where("size > 0").select("key", "size", h.alias("h")).join(targets.select("key", need.alias("need")), "key")
    start = 0
    for width in ROUNDS:
        # Only the documents of the boundary bucket are looked at again.
        found = _round(edge, start, width)
        inside = edge.drop("need").join(found, "key").where(_bits(F.col("h"), start, width) == F.col("mark"))
        edge = stored(inside.drop("mark"), "mix-edge")
        start += width
    # What is left of a source is the one hash its threshold falls on.
    at = edge.groupBy("key").agg(F.first("h").alias("h"), F.first("need").alias("need"), F.sum("size").alias("size"))
    at = at.select("key", F.col("h").bitwiseXOR(F.lit(_FLIP)).alias("threshold"), (F.col("size") < 2 * F.col("need")).alias("nearer"))
    return targets.join(at, "key", "left")


def _copies(place: Column, b: Column) -> Column:
    """Whole copies, and one more below the threshold; a source without one has no rest to spend."""
    place = place.bitwiseXOR(F.lit(_FLIP))
    below = (place < b["threshold"]) | ((place == b["threshold"]) & b["nearer"])
    return b["whole"] + F.coalesce(below.cast("int"), F.lit(0))


def mix(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, max_repeat: int = 3) -> DataFrame:
    """How often each document is taken: ``doc_id, source, size, source_size, target, copies``.

    ``sizes`` holds ``doc_id, source, size``; other columns are not looked at. Documents below the threshold
    are taken once more than the source's whole copies; the document at the
    threshold is taken when that brings the sum nearer to the target. Rows with
    the same id share a hash and thus their fate. A null id hashes like any
    other, a null source is a source of its own (last), an empty table gives an
    empty result, and a source of size 0 has target 0.
    """
    # Nothing but ids and sizes is stored; the texts are read once.
    sizes = stored(sizes.select("doc_id", "source", "size"), "mix-sizes").withColumn("key", group_key("source"))
    bounds = source_bounds(sizes, weights, share, max_repeat).select("key", F.struct("*").alias("b"))
    copies = _copies(F.xxhash64("doc_id"), F.col("b"))
    return sizes.join(bounds, "key").select("doc_id", "source", "size", "b.source_size", "b.target", copies.alias("copies"))


def mixed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
               weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, max_repeat: int = 3) -> DataFrame:
    """The mix itself: every row as often as ``mix`` takes it, with its own columns.

    Bounds are joined by source, so rows need no unique id and no text moves.
    Null and empty texts have size 0 and are taken as often as whole copies of
    their source are, or once more below its threshold; very long texts count
    whole; a null source is a source; repeated rows share their fate; an empty table gives an empty
    result; other columns may have any names.
    """
    key, bound, copy = free_names(docs, "key", "bound", "copy")
    sizes = stored(size_table(docs, doc_id, text, source), "mix-sizes").withColumn("key", group_key("source"))
    bounds = source_bounds(sizes, weights, share, max_repeat).select(
        F.col("key").alias(key), F.struct("whole", "threshold", "nearer").alias(bound))
    copies = _copies(F.xxhash64(doc_id), F.col(bound))
    rows = docs.withColumn(key, group_key(source)).join(bounds, key)
    return rows.withColumn(copy, F.explode(F.array_repeat(F.lit(0), copies))).select(docs.columns)
