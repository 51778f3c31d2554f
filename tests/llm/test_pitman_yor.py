"""The language model: counts and base against plain Python, seating against exact distributions."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from inkfold.llm import pitman_yor as py
from inkfold.llm import queries


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def plain_base(docs, held):
    train = Counter(t for i, (_, x) in enumerate(docs) if not held[i] for t in tokens(x))
    n, v = sum(train.values()), len(train)
    out = []
    for _, text in docs:
        own = tokens(text)
        out.append((len(own), sum(train[t] > 0 for t in own), n, sum(math.log10((train[t] + .5) / (n + .5 * (v + 1))) for t in own)))
    return out


def test_query_on_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    held = [zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in docs]
    rows = {r.doc_id: r for r in queries.REGISTRY["op5_lm_scores"](spark, SF_DIR).collect()}
    assert len(rows) == len(docs)
    for (doc_id, _), h, want in zip(docs, held, plain_base(docs, held)):
        r = rows[doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, *want[:3])
        assert r.base_score == pytest.approx(want[3], rel=1e-9)
        assert r.score < 0
    # Held-out perplexity is below that of the base.
    out = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    again = {r.doc_id: r.score for r in queries.REGISTRY["op5_lm_scores"](spark, SF_DIR).collect()}
    assert all(again[d] == r.score for d, r in rows.items())


def seating(pairs):
    """pairs: (word, context, customers)."""
    pairs = sorted(pairs)
    counts = np.array(list(Counter(w for w, *_ in pairs).values()))
    n = np.array([n for *_, n in pairs])
    return py.Seating(counts, np.array([c for _, c, _ in pairs], dtype="u8"), n, np.ones(len(n)))


def sweep(s, rng):
    """One sweep of a franchise that has no other part."""
    s.sweep(np.zeros(len(s.n)), 0, rng)


def exact_tables(pairs):
    """Distribution of (t of each pair) by enumerating all table counts of a small franchise."""
    def stirling(n, t):
        table = {(0, 0): 1.0}
        for m in range(n):
            for k in range(m + 2):
                table[m + 1, k] = table.get((m, k - 1), 0) + max(0.0, m - py.DISCOUNT * k) * table.get((m, k), 0)
        return table[n, t]

    def rising(a, step, n):
        return math.prod(a + step * i for i in range(n))
    import itertools

    weights = {}
    for ts in itertools.product(*(range(1, n + 1) for *_, n in pairs)):
        weight = 1.0
        by_context, by_word = Counter(), Counter()
        for (w, c, n), t in zip(pairs, ts):
            weight *= stirling(n, t)
            by_context[c] += t
            by_word[w] += t
        for t in by_context.values():
            weight *= rising(py.STRENGTH, py.DISCOUNT, t)
        # The root: one table per word (diffuse base).
        for t in by_word.values():
            weight *= rising(1 - py.DISCOUNT, 1, t - 1)
        weight /= rising(py.STRENGTH, 1, sum(ts))
        weights[ts] = weight
    total = sum(weights.values())
    return {k: w / total for k, w in weights.items()}


def test_gibbs_sweeps_reach_the_exact_seating():
    # Dishes are drawn side by side from the last state, so one dish per context keeps this exact.
    pairs = [(1, 3, 6)]
    exact = exact_tables(pairs)
    s, rng, seen = seating(pairs), np.random.default_rng(1), Counter()
    for _ in range(6000):
        sweep(s, rng)
        seen[tuple(s.t.astype(int))] += 1
    for ts, p in exact.items():
        assert seen[ts] / 6000 == pytest.approx(p, abs=0.025)


def test_sweeps_of_a_franchise_have_the_right_mean():
    pairs = [(1, 0, 5), (1, 1, 3), (2, 0, 4), (3, 1, 2)]
    exact = exact_tables(pairs)
    mean = np.sum([np.array(ts) * p for ts, p in exact.items()], axis=0)
    s, rng, total = seating(pairs), np.random.default_rng(2), np.zeros(4)
    for _ in range(6000):
        sweep(s, rng)
        total += s.t
    assert total / 6000 == pytest.approx(mean, rel=0.12)


def test_large_counts_are_drawn_within_bounds():
    s, rng = seating([(1, 0, 10 ** 7), (2, 0, 3), (1, 5, 10 ** 5), (3, 9, 1)]), np.random.default_rng(0)
    for _ in range(20):
        sweep(s, rng)
        assert (s.t >= 1).all() and (s.t <= s.n).all() and s.t[-1] == 1


def test_squeezed_numbers_come_back():
    for values in (np.zeros(0, "<u8"), np.array([0], "<u8"), np.array([2 ** 64 - 1, 1, 0], "<u8"), np.arange(100_000, dtype="<u8")):
        assert (py.spread(py.squeezed(values)) == values).all()
    assert len(py.squeezed(np.ones(100_000, "<u8"))) < 1000


def test_probabilities_of_a_context_sum_to_one():
    # Words 1 to 39 stand for hashes in their upper bits; contexts are names of the restaurants of words 0 to 4.
    top = 64 - py.CONTEXT_BITS
    pairs = [(w, c, 1 + (w * c) % 7) for w in range(1, 40) for c in range(0, 5) if (w + c) % 3]
    s, rng, kept = seating(pairs), np.random.default_rng(0), []
    for _ in range(py.SAMPLES):
        sweep(s, rng)
        kept.append((s.t.copy(), s.root(), s.table_totals()))
    words = np.arange(1, 40, dtype="u8") << np.uint64(top)
    customers = Counter()
    for _, c, n in pairs:
        customers[c] += n
    own = py.SAMPLES * s.n / py.DISCOUNT - sum(t for t, *_ in kept)
    model = {"words": py.squeezed(words), "counts": py.whole(np.bincount(s.word)), "contexts": py.whole(np.array([c for _, c, _ in sorted(pairs)])),
             "own": py.whole(own), "count": py.whole(np.bincount(s.word, s.n)), "root": py.whole(np.concatenate([r for _, r, _ in kept]))}
    sent = {"words": None, "contexts": py.whole(s.names), "tables": py.whole(np.concatenate([x for *_, x in kept]))}
    known = py.Globals(39, int(s.n.sum()), np.array([t.sum() for t, *_ in kept]))
    asked = np.append(words, np.uint64(99 << top))
    every = np.arange(len(asked))
    for part in (py.Part([model, sent]), py.Part([sent, model])):
        for context in (0, 1, 4, 200):
            name = np.uint64(context)
            count, root, _, _, own = part.answer(asked, np.ones(len(asked)), np.full(len(asked), name))
            *_, tables, _ = part.answer(np.array([name << np.uint64(top)]), np.ones(1), np.array([name]))
            spread_tables = np.repeat(tables, len(asked), axis=1)
            logs = py.log_probabilities(known, every, every, root, np.full(len(asked), customers[context]), spread_tables, own.copy())
            assert (10 ** logs).sum() == pytest.approx(1)
            assert count[-1] == 0 and (count[:-1] > 0).all()
    count, root, customers_, tables, own = py.Part([]).answer(np.array([5], dtype="u8"), np.ones(1), np.array([5], dtype="u8"))
    assert not count.any() and not root.any() and not customers_.any() and not tables.any() and not own.any()


def test_small_chunks_give_the_same_scores(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(int(i), " ".join(f"w{int(x)}" for x in rng.zipf(1.4, rng.integers(0, 60)) % 300)) for i in range(200)]
    folder = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(2).write.parquet(folder)
    docs = spark.read.parquet(folder)
    held = F.col("doc_id") % 5 == 1
    large = {r.doc_id: r for r in py.score(docs, held).collect()}
    monkeypatch.setattr(py, "CHUNK_TOKENS", 100)
    small = {r.doc_id: r for r in py.score(docs, held).collect()}
    assert all(small[d].score == pytest.approx(r.score, rel=1e-6) and small[d].base_score == pytest.approx(r.base_score) for d, r in large.items())


def test_edges(spark, tmp_path):
    rows = [(1, None), (1, None), (2, ""), (None, "Known WORDS known"), (3, "known words"), (4, "new " * 20_000), (6, "a\x1cb é")]
    folder = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit("x")).withColumn("held", F.lit(1)).write.parquet(folder)
    docs = spark.read.parquet(folder)
    found = py.score(docs, F.col("doc_id") == 4).collect()
    want = plain_base(rows, [d == 4 for d, _ in rows])
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=key)
    for a, b in zip(got, sorted(((d, *w) for (d, _), w in zip(rows, want)), key=key), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4])
    assert py.score(docs.limit(0), F.lit(False)).count() == 0
    # Nothing to learn from: all words are new.
    assert {(r.n_known, r.train_tokens) for r in py.score(docs, F.lit(True)).collect()} == {(0, 0)}


def test_word_ranges_grow_with_the_text(spark, monkeypatch, tmp_path):
    rows = [(i, " ".join(f"w{i * j % 97}" for j in range(50))) for i in range(300)]
    folder = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(folder)
    docs = spark.read.parquet(folder)
    monkeypatch.setattr(py, "PART_BYTES", 500)
    seen, seat = [], py.seat
    monkeypatch.setattr(py, "seat", lambda rows, parts: seen.append(parts) or seat(rows, parts))
    found = {r.doc_id: r for r in py.score(docs, F.col("doc_id") % 5 == 1).collect()}
    assert seen == [-(-sum(len(t) for _, t in rows) // 500)] and seen[0] > 50
    for (i, _), want in zip(rows, plain_base(rows, [i % 5 == 1 for i, _ in rows])):
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3] and r.base_score == pytest.approx(want[3])


def test_scores_of_pairs_met_once_are_exact(spark, monkeypatch, tmp_path):
    """Every pair of training words occurs once, so every seating is known: one table each."""
    rng, met, rows = np.random.default_rng(5), set(), []
    vocabulary = [f"w{i}" for i in range(60)]
    for i in range(30):
        before, words = None, []
        for w in rng.choice(vocabulary, 25):
            if (before, w) not in met:
                met.add((before, w))
                words.append(str(w))
                before = w
        if not words or (before, None) in met:
            # Its pairs stay unused; a later text may not end like an earlier one.
            words.append(f"last{i}")
            met.add((before, words[-1]))
            before = words[-1]
        met.add((before, None))
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(rng.choice([*vocabulary, "never", "new"], 12))) for i in range(20)]
    train = Counter(t for i, text in rows if i < 100 for t in tokens(text))
    after = lambda text: zip([None, *tokens(text)[:-1]], tokens(text))
    pairs = Counter(p for i, text in rows if i < 100 for p in after(text))
    assert set(pairs.values()) == {1}
    n, v, s, d = sum(train.values()), len(train), py.STRENGTH, py.DISCOUNT

    def p(c, w):
        root = (train[w] - d if train[w] else s + d * v) / (s + n)
        return ((1 - d) * pairs[c, w] + (s + d * train[c]) * root) / (s + train[c])
    folder = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(3).write.parquet(folder)
    for size in (py.CHUNK_TOKENS, 90):
        monkeypatch.setattr(py, "CHUNK_TOKENS", size)
        found = {r.doc_id: r.score for r in py.score(spark.read.parquet(folder), F.col("doc_id") >= 100).collect()}
        for i, text in rows:
            assert found[i] == pytest.approx(sum(math.log10(p(c, w)) for c, w in after(text)), rel=1e-9)
