"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Every rule compares one share of a text with a cutoff. Cutoffs are chosen from
labelled documents so that, for every stratum at once and with probability
``1 - DELTA``, all rules together reject at most ``RISK`` of the good documents
(each rule has an equal part of it):

* the candidates of a rule are tried from the mildest to the strictest, each on
  the holdout half of the good labelled documents with the exact binomial test
  ``P(Bin(n, risk of the rule) <= rejected)``, and the first failure ends the sequence
  (fixed-sequence testing needs no correction inside a sequence);
* the level of every sequence is ``DELTA`` divided by the number of rules and
  strata (Bonferroni);
* the certified cutoffs hold all together, so any of them may be taken: all
  labels pick the one that rejects most bad documents for the good ones it
  costs, the mildest on ties.

A stratum without enough labels certifies nothing and keeps its documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkfold.functions.text import let
from inkfold.llm.common import GAP, UPPER, WHITE, free_names, group_key, stored

RISK = 0.05
DELTA = 0.05
# A good document rejected weighs as much as so many bad ones let through.
COST = 50
SYMBOLS = "#*$%&|<>"
# Rule: its candidates, from the mildest to the strictest.
RULES = {
    "symbol_share": (0.5, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01),
    "repeat_share": (0.19, 0.17, 0.15, 0.13, 0.11, 0.09, 0.07, 0.05),
    "copied_line_share": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1),
    "upper_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "word_chars_mean": (40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 12.0, 11.0, 10.0),
}


def _repeated_words(words: Column) -> Column:
    """Words in 5-word windows that occur twice or more in the text, first occurrence included.

    Windows are compared by 64-bit hash. Sorting (hash, place) puts equal windows
    side by side, so the cost follows the length of the text, also when all of it
    repeats; the words of overlapping windows are counted once.
    """
    def covered(places: Column) -> Column:
        def own(x: Column, i: Column) -> Column:
            return F.coalesce(F.least(F.lit(5), F.get(places, i + 1) - x), F.lit(5))
        return F.aggregate(F.transform(places, own), F.lit(0), lambda total, x: total + x)

    def of_pairs(pairs: Column) -> Column:
        def place(p: Column, i: Column) -> Column:
            twin = (F.get(pairs, i - 1)["h"].eqNullSafe(p["h"])) | (F.get(pairs, i + 1)["h"].eqNullSafe(p["h"]))
            return F.when(twin, p["i"]).otherwise(F.lit(-1))
        places = F.filter(F.transform(pairs, place), lambda x: x >= 0)
        return let(F.array_sort(places), covered)

    def of_windows(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(pairs, of_pairs))

    starts = F.sequence(F.lit(1), F.size(words) - 4)
    windows = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, F.lit(5))))
    return F.when(F.size(words) < 6, 0).otherwise(let(windows, of_windows)).cast("bigint")


def text_stats(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper (all bigint).

    A null text has no words. The text is split once.
    """
    def of_text(t: Column) -> Column:
        words = F.filter(F.split(F.btrim(t, F.lit(WHITE)), GAP), lambda w: w != "")
        lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")

        def without(chars: str) -> Column:
            return (F.length(t) - F.length(F.translate(t, chars, ""))).cast("bigint")
        return let(F.struct(words.alias("w"), lines.alias("l")), lambda s: F.struct(
            F.size(s["w"]).cast("bigint").alias("n_words"),
            (F.length(t) - without(WHITE)).cast("bigint").alias("word_chars"),
            without(SYMBOLS).alias("n_symbols"),
            (F.size(s["l"]) - F.size(F.array_distinct(s["l"]))).cast("bigint").alias("n_dup_lines"),
            _repeated_words(s["w"]).alias("n_repeat_words"),
            without(UPPER).alias("n_upper"),
            F.size(s["l"]).cast("bigint").alias("n_lines")))

    return let(F.coalesce(text, F.lit("")), of_text)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])


def rule_values(s: Column) -> dict[str, Column]:
    """The share each rule looks at; an empty text has 0."""
    def share(a: str, b: str) -> Column:
        return F.when(s[b] > 0, s[a] / s[b]).otherwise(F.lit(0.0))
    return {
        "symbol_share": share("n_symbols", "word_chars"), "repeat_share": share("n_repeat_words", "n_words"),
        "copied_line_share": share("n_dup_lines", "n_lines"), "upper_share": share("n_upper", "word_chars"),
        "word_chars_mean": share("word_chars", "n_words"),
    }


def _log_binomial_tail(n: Column, k: Column, p: float) -> Column:
    """ln P(Bin(n, p) <= k) for k < n p, summed exactly from the largest term down."""
    odds = p / (1 - p)
    steps = F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(F.array().cast("array<int>"))
    log_top = F.aggregate(steps, n * F.log(F.lit(1 - p)), lambda acc, j: acc + F.log((n - j + 1) / j * odds))

    def lower(acc: Column, j: Column) -> Column:
        term = acc["term"] * j / ((n - j + 1) * odds)
        return F.struct((acc["sum"] + term).alias("sum"), term.alias("term"))
    rest = F.aggregate(F.reverse(steps), F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term")), lower)
    return log_top + F.log(rest["sum"])


def fit_cutoffs(stats: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per stratum: ``stratum, <rule>...`` with the chosen cutoff or null.

    ``stats`` has ``doc_id, stratum, s`` (text_stats), ``labels`` has ``doc_id,
    quality``. Labels without an id or a quality are left out; a document
    labelled twice counts once, as bad if any label says so, and so does one that
    stands in the table several times: the test is of documents, drawn one by one,
    so every labelled id is one draw (its least row, if its rows differ). Copies
    under other ids are draws of their own, as they are labelled on their own. Halves are dealt by
    a hash of the id. One aggregation counts rejections for all candidates; what
    follows has one row per stratum, rule and candidate.
    """
    judged = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("_q"))
    own_risk = risk / len(RULES)
    passed = stats.where(~base_failed(F.col("s"))).join(judged, "doc_id")
    one = F.min(F.struct("stratum", "s", "_q")).alias("one")
    rows = passed.groupBy("doc_id").agg(one).select("doc_id", "one.*")
    hold = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0
    values = rule_values(F.col("s"))
    facts = rows.select("stratum", (F.col("_q") > 0).alias("good"), hold.alias("hold"), *[v.alias(k) for k, v in values.items()])
    counts = [F.count_if(F.col(r) > F.lit(c)).alias(f"{r}_{i}") for r, cuts in RULES.items() for i, c in enumerate(cuts)]
    sums = facts.groupBy("stratum", "good", "hold").agg(F.count("*").alias("n"), *counts)
    listed = F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(i).alias("i"), F.lit(c).alias("cutoff"), F.col(f"{r}_{i}").alias("x"))
        for r, cuts in RULES.items() for i, c in enumerate(cuts)])
    long = sums.select("stratum", "good", "hold", "n", F.inline(listed))

    def of(good: bool, hold: bool | None, what: str) -> Column:
        side = (F.col("good") == good) if hold is None else (F.col("good") == good) & (F.col("hold") == hold)
        return F.coalesce(F.sum(F.when(side, F.col(what))), F.lit(0))
    # Bad documents certify nothing, so all of them may serve the choice.
    tests = long.groupBy("stratum", "rule", "i", "cutoff").agg(
        of(True, True, "n").alias("n"), of(True, True, "x").alias("k"), of(True, None, "x").alias("good_lost"), of(False, None, "x").alias("bad_met"))
    strata = F.size(F.collect_set("stratum").over(Window.partitionBy(F.lit(0))))
    level = F.log(F.lit(delta) / (F.lit(len(RULES)) * strata))
    tested = F.col("k") < F.col("n") * own_risk
    passes = F.when(tested, _log_binomial_tail(F.col("n"), F.col("k"), own_risk) <= F.col("level")).otherwise(False)
    tests = tests.withColumn("level", level).withColumn("passes", passes)
    upto = Window.partitionBy("stratum", "rule").orderBy("i")
    certified = tests.withColumn("valid", F.min("passes").over(upto)).where("valid")
    gain = F.struct((F.col("bad_met") - COST * F.col("good_lost")).alias("gain"), (-F.col("i")).alias("mild"), "cutoff")
    chosen = certified.where("bad_met > 0").groupBy("stratum").pivot("rule", list(RULES)).agg(F.max(gain)["cutoff"])
    return chosen


def verdict(s: Column, cutoffs: dict[str, Column]) -> Column:
    """True unless the base rule fails or a cutoff is passed; a null cutoff rejects nothing."""
    over = [F.coalesce(v > cutoffs[r], F.lit(False)) for r, v in rule_values(s).items()]
    return ~(base_failed(s) | reduce(lambda a, b: a | b, over))


def quality_stats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """``doc_id, stratum, s``; a null stratum is a stratum of its own."""
    return docs.select(F.col(doc_id).alias("doc_id"), group_key(stratum).alias("stratum"), text_stats(F.col(text)).alias("s"))


def quality_rules(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``doc_id``, the counts of text_stats, ``base_failed`` and ``kept``, one row per input row.

    Null and empty texts have no words and fail the base rule. Repeated rows are
    judged each by itself, alike. Columns beside the three named are not looked
    at. An empty table gives an empty result; without labels only the base rule
    rejects. The counts are stored once, so texts are read and split once.
    """
    stats = stored(quality_stats(docs, doc_id, text, stratum), "quality-stats")
    cutoffs = stored(fit_cutoffs(stats, labels, risk, delta), "quality-cutoffs")
    s = F.col("s")
    return stats.join(cutoffs, "stratum", "left").select(
        "doc_id", "s.n_words", "s.word_chars", "s.n_symbols", "s.n_dup_lines", "s.n_repeat_words",
        base_failed(s).alias("base_failed"), verdict(s, {r: F.col(r) for r in RULES}).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang", doc_id: str = "doc_id",
              risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows that ``quality_rules`` keeps, with all their columns.

    Rows are stored with their counts, which serve the fit and the verdict: texts
    are read and split once, rows need no unique id and no text is shuffled. Null
    and empty texts fail; very long ones count whole; repeated rows are judged each; an empty
    table gives an empty result; other columns may have any names.
    """
    group, counts, cut = free_names(docs, "stratum", "counts", "cut")
    rows = stored(docs.withColumns({group: group_key(stratum), counts: text_stats(F.col(text))}), "quality-rows")
    stats = rows.select(F.col(doc_id).alias("doc_id"), F.col(group).alias("stratum"), F.col(counts).alias("s"))
    cutoffs = stored(fit_cutoffs(stats, labels, risk, delta), "quality-cutoffs")
    held = cutoffs.select(F.col("stratum").alias(group), F.struct(*RULES).alias(cut))
    keep = verdict(F.col(counts), {r: F.col(cut)[r] for r in RULES})
    return rows.join(held, group, "left").where(keep).select(docs.columns)
