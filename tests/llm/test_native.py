"""Quality rules, chat collapse, mixing and top-k search against plain Python."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from inkfold.llm import chat, mixing, quality, queries, topk

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain_stats(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


TEXTS = ["", None, " \n\t ", "one", "a b c d e a b c d e", "x " * 40, "a b c d e f\na b c d e f\n\n", "é# <b>| x y", "w" * 70_000,
         "p q r s t u p q r s t z p q r s t", "A\nA\nB\n A\nA", "a b c d e " * 3000]


def test_text_stats_match_plain_python(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string")
    rows = docs.select("doc_id", quality.text_stats(F.col("text")).alias("s")).select("doc_id", "s.*").collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_stats(TEXTS[r.doc_id]), TEXTS[r.doc_id]


def test_quality_query_on_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.REGISTRY["op7_quality_rules"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, chars, symbols, dup, rep = plain_stats(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert r.base_failed == (n < 10 or 100 * rep > 20 * n)
        assert not (r.kept and r.base_failed)


def test_binomial_tail_is_exact(spark):
    cases = [(1, 0), (50, 0), (400, 1), (2000, 7), (5000, 20), (90_000, 400)]
    df = spark.createDataFrame(cases, "n bigint, k bigint")
    for r in df.select("n", "k", quality._log_binomial_tail(F.col("n"), F.col("k"), 0.005).alias("x")).collect():
        logs = [math.lgamma(r.n + 1) - math.lgamma(j + 1) - math.lgamma(r.n - j + 1) + j * math.log(.005) + (r.n - j) * math.log(.995)
                for j in range(r.k + 1)]
        top = max(logs)
        assert r.x == pytest.approx(top + math.log(sum(math.exp(x - top) for x in logs)), rel=1e-9)


def _labelled(spark, n_good, n_bad, lang="en"):
    good = [(i, " ".join(f"word{(i * 7 + j) % 997}" for j in range(30)), lang) for i in range(n_good)]
    bad = [(10 ** 6 + i, " ".join(f"w{(i * 5 + j) % 991}##" for j in range(30)), lang) for i in range(n_bad)]
    docs = spark.createDataFrame(good + bad, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(d, int(d < 10 ** 6)) for d, _, _ in good + bad], "doc_id bigint, quality int")
    return docs, labels


def test_certified_cutoffs_reject_bad_and_spare_good(spark):
    docs, labels = _labelled(spark, 4000, 200)
    rows = quality.quality_rules(docs, labels).collect()
    assert all(r.kept == (r.doc_id < 10 ** 6) for r in rows)
    assert quality.keep_good(docs, labels).count() == 4000
    # Few labels certify nothing: the base rule alone decides.
    docs, labels = _labelled(spark, 100, 20)
    assert all(r.kept for r in quality.quality_rules(docs, labels).collect())


def test_quality_edges(spark):
    rows = [(1, None, None, "x"), (1, None, None, "x"), (None, "a b c d e f g h i j k", None, "x"), (2, "", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, kept string")
    labels = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0)], "doc_id bigint, quality int")
    found = quality.quality_rules(docs, labels).collect()
    assert sorted((r.n_words, r.kept) for r in found) == [(0, False), (0, False), (0, False), (11, True)]
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert quality.quality_rules(docs.limit(0), labels.limit(0)).count() == 0


def plain_cutoffs(rows, labels, halves):
    """Cutoffs by stratum, from (doc_id, text, stratum), (doc_id, quality) and whether an id is held out."""
    judged = {}
    for d, q in labels:
        if d is not None and q is not None:
            judged[d] = min(q, judged.get(d, q))
    seen, facts = set(), defaultdict(list)
    for d, text, stratum in rows:
        n, chars, symbols, dup, repeat = plain_stats(text)
        if d not in judged or d in seen or n < 10 or 100 * repeat > 20 * n:
            continue
        seen.add(d)
        lines = sum(bool(WORD.search(x)) for x in (text or "").split("\n"))
        upper = sum(c in quality.UPPER for c in text)
        share = lambda a, b: a / b if b else 0.0
        facts[stratum].append((judged[d] > 0, halves[d], {
            "symbol_share": share(symbols, chars), "repeat_share": share(repeat, n), "copied_line_share": share(dup, lines),
            "upper_share": share(upper, chars), "word_chars_mean": share(chars, n)}))
    risk, level = quality.RISK / len(quality.RULES), math.log(quality.DELTA / (len(quality.RULES) * max(1, len(facts))))

    def log_tail(n, k):
        terms = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(risk) + (n - j) * math.log1p(-risk) for j in range(k + 1)]
        return max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms))
    out = {}
    for stratum, docs in facts.items():
        for rule, cuts in quality.RULES.items():
            best = None
            for i, cut in enumerate(cuts):
                n = sum(good and hold for good, hold, _ in docs)
                k = sum(good and hold and v[rule] > cut for good, hold, v in docs)
                if not (k < n * risk and log_tail(n, k) <= level):
                    break
                bad = sum(not good and v[rule] > cut for good, _, v in docs)
                gain = (bad - quality.COST * sum(good and v[rule] > cut for good, _, v in docs), -i)
                if bad and (best is None or gain > best[0]):
                    best = (gain, cut)
            if best:
                out.setdefault(stratum, {})[rule] = best[1]
    return out


def halves_of(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    return {r.doc_id: r.h for r in df.select("doc_id", (F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0).alias("h")).collect()}


def test_cutoffs_and_verdicts_match_plain_python(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(2600):
        good, lang = i % 4 > 0, "en" if i % 3 else "de"
        words = [f"w{rng.integers(0, 900)}" + ("#" if rng.random() < (0.01 if good else 0.5) else "") for _ in range(rng.integers(8, 40))]
        rows.append((i, " ".join(words).upper() if not good and i % 5 == 0 else " ".join(words), lang))
    labels = [(i, int(i % 4 > 0)) for i in range(0, 2600)] + [(7, 0), (None, 1), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marked = spark.createDataFrame(labels, "doc_id bigint, quality int")
    want = plain_cutoffs([(d, t, "a" + s) for d, t, s in rows], labels, halves_of(spark, range(2600)))
    stats = quality.quality_stats(docs)
    found = {r.stratum: {k: r[k] for k in quality.RULES if r[k] is not None} for r in quality.fit_cutoffs(stats, marked).collect()}
    assert found == want and want["aen"]
    # Rows that stand in the table many times are one draw each.
    many = {r.stratum: {k: r[k] for k in quality.RULES if r[k] is not None} for r in quality.fit_cutoffs(stats.join(spark.range(5).select(F.lit(1))), marked).collect()}
    assert many == want


def test_repeated_rows_certify_nothing(spark):
    docs, labels = _labelled(spark, 40, 40)
    again = docs.join(spark.range(60).select(F.col("id").alias("copy")))
    assert all(r.kept for r in quality.quality_rules(again, labels).collect())


# Chat -----------------------------------------------------------------------


def plain_chat(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    def heads(talk):
        talk = sorted(talk)
        marks = sorted({t[:2] for t in talk})
        return [tuple(t for t in talk if t[:2] <= m) for m in marks]
    whole = {c: heads(t)[-1] for c, t in talks.items()}
    order = lambda c: (c is None, c or 0)
    gone = set()
    for a in whole:
        for b in whole:
            if a != b and whole[a] in heads(talks[b]) and (len(whole[b]) > len(whole[a]) or order(b) < order(a)):
                gone.add(a)
    return {c: "".join(f"<|im_start|>{t[3] if t[2] else 'unknown'}\n{t[5]}<|im_end|>\n" for t in whole[c]) for c in whole if c not in gone}


def test_chat_collapse_matches_plain_python(spark):
    rows = []
    for conv in range(60):
        for turn in range(conv % 5 + 1):
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", f"t{(conv // 10) % 3}-{turn}"))
    rows += [(100, 0, None, "a"), (101, 0, "user", None), (102, None, "user", "n"), (None, 0, "user", "x"), (103, 0, "user", "x"),
             (104, 0, "user", "twice"), (104, 0, "user", "twice"), (105, 0, "user", "twice"), (106, 5000, "user", "far"), (106, 1, "user", "near"),
             (107, 1, "user", "near")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("n", F.lit(1)).withColumn("key", F.lit("z"))
    found = {r.conv_id: r.rendered for r in chat.maximal_conversations(turns).collect()}
    assert found == plain_chat(rows)
    assert chat.maximal_conversations(turns.limit(0)).count() == 0


def test_long_chat_is_rendered_whole(spark):
    turns = spark.range(5000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    row, = chat.maximal_conversations(turns).collect()
    assert row.n_turns == 5000
    assert row.rendered.split("<|im_end|>\n")[4999] == "<|im_start|>user\n4999"


# Mixing ---------------------------------------------------------------------


def plain_targets(sizes, weights=(1, 2, 3), repeat=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > repeat * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: float(repeat * sizes[s]) for s in over}
        left -= sum(target[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("shape", ["even", "hot", "edge"])
def test_mix_comes_near_its_targets(spark, shape):
    if shape == "even":
        rows = [(i, f"s{i % 7}", i % 50 + 1) for i in range(5000)]
    elif shape == "hot":
        rows = [(i, "big" if i % 3 else f"t{i % 9}", i % 90 + 1) for i in range(5000)]
    else:
        rows = [(None, None, 5), (1, None, 7), (1, None, 7), (2, "a", 0), (3, "b", 100_000), (4, "\U0001f600", 3), (5, "￿", 2)]
    sizes = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint").withColumn("key", F.lit(1)).withColumn("target", F.lit(2))
    found = mixing.mix(sizes).collect()
    assert len(found) == len(rows)
    per_source, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, s, n in rows:
        per_source[s] += n
        largest[s] = max(largest[s], n)
    want = plain_targets(per_source)
    for r in found:
        assert 0 <= r.copies <= 3 and r.source_size == per_source[r.source]
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.copies * r.size
    for s in per_source:
        assert abs(taken[s] - want[s]) <= largest[s] * (2 if shape == "edge" else 1)
    again = mixing.mix(sizes.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_mix_of_nothing(spark):
    sizes = spark.createDataFrame([], "doc_id bigint, source string, size bigint")
    assert mixing.mix(sizes).count() == 0
    rows = mixing.mix(spark.createDataFrame([(1, "a", 0), (2, None, 0)], sizes.schema)).collect()
    assert [(r.target, r.copies) for r in rows] == [(0.0, 0), (0.0, 0)]


# Top-k ----------------------------------------------------------------------


def plain_top(rows, k):
    fine = [(i, np.floor(256 * np.array(v, dtype="float64")).astype("int64")) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in fine:
        if q % 50 == 0:
            def dot(b):
                n = min(len(a), len(b))
                return int(a[:n] @ b[:n])
            best = sorted(((-dot(b), i) for i, b in fine if i != q))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def test_top_k_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 100)
    monkeypatch.setattr(topk, "BLOCK", 3)
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=24) * (1 + i % 3)]) for i in range(1000)]
    rows += [(i + 1000, rows[3][1]) for i in range(200)] + [(1200, None), (1250, [None] * 24), (1300, [float("nan")] * 24),
             (1350, [float("inf")] + [0.0] * 23), (1400, [1.0]), (None, rows[0][1]), (1450, [])] + [(1500, [0.5] * 24)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit(1)).withColumn("shard", F.lit(1))
    found = topk.top_k(df, df.where("vec_id % 50 = 0"), 5).collect()
    assert sorted(map(tuple, found)) == plain_top(rows, 5)


def test_top_k_small_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (1, [2.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df, df.where("vec_id = 0")).collect()] == [(0, 1, 1, 131072), (0, 2, 1, 131072)]
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1e6, 1e8, 3.0e30])
def test_top_k_scores_are_exact_or_an_error(spark, size):
    rows = [(i, [size * (1 + i * 1e-7), size, 3.0]) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    scaled = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    want = sorted((-sum(a * b for a, b in zip(scaled[0], v)), i) for i, v in scaled.items() if i)
    if size > 1e7:
        with pytest.raises(Exception, match="64 bits"):
            topk.top_k(df, df.where("vec_id = 0"), 2).collect()
    else:
        assert [(r.vec_id, r.score) for r in topk.top_k(df, df.where("vec_id = 0"), 2).orderBy("rank").collect()] == [(i, -s) for s, i in want[:2]]


def test_mix_query_on_whole_table(spark):
    docs = {r.doc_id: (r.source, len((r.text or "").encode().split())) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = [r.asDict() for r in queries.REGISTRY["op9_mix_sources"](spark, SF_DIR).collect()]
    sizes, taken, largest = Counter(), Counter(), Counter()
    for source, n in docs.values():
        sizes[source] += n
        largest[source] = max(largest[source], n)
    targets = plain_targets(sizes)
    assert {r["doc_id"] for r in rows} == set(docs) and len(rows) == len(docs)
    for r in rows:
        source, n = docs[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (n, sizes[source]) and r["target"] == pytest.approx(targets[source])
        assert r["taken"] in (0, n, 2 * n, 3 * n)
        taken[source] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in sizes)
    again = {r["doc_id"]: r["taken"] for r in map(lambda r: r.asDict(), queries.REGISTRY["op9_mix_sources"](spark, SF_DIR).collect())}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_no_text_moves_before_the_anti_join(spark, monkeypatch):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "assistant", "b")], "conv_id bigint, turn bigint, role string, text string")
    written = []
    monkeypatch.setattr(chat, "stored", lambda df, name: written.append((name, df.columns)) or df)
    row, = chat.maximal_conversations(turns).collect()
    assert row.conv_id == 2 and all("text" not in columns for _, columns in written)
    assert {name for name, _ in written} == {"chat-heads", "chat-prefixes", "chat-kept"}
