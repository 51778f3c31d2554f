"""Spelling variants against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from inkfold.llm import queries, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(docs):
    out = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def plain_near(words):
    """Words that share what is left without one letter, or are it, checked one by one."""
    left = defaultdict(set)
    for w in words:
        left[w].add(w)
        for i in range(len(w)):
            left[w[:i] + w[i + 1:]].add(w)
    near = defaultdict(set)
    for group in left.values():
        for a, b in itertools.combinations(group, 2):
            if one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    return near


def plain_variants(counts):
    near, form = plain_near(counts), {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 10 * n else None
    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {(w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


@pytest.mark.parametrize("block,pairs", [(3, 7), (1024, 1 << 20)])
def test_near_pairs_match_brute_force(spark, monkeypatch, block, pairs):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "PAIRS", pairs)
    monkeypatch.setattr(spelling, "GATHER", 64)
    rng = random.Random(block)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for letters in ("ab", "abc", "abcdeéÿ") for _ in range(200)}
    words |= {"aaaa", "aaaaa", "aaaaaa", "abababab", "ababababa", "bababab"}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    found = [(r.a, r.b) for r in spelling.near_pairs(df).collect()]
    want = plain_near(words)
    assert len(found) == len(set(found))
    assert set(found) == {(a, b) for a in words for b in want[a]}


def test_pivots_are_the_cheapest_pair():
    rng = random.Random(1)
    for _ in range(300):
        places = sorted(rng.sample(range(9), rng.randint(3, 6)))
        cost = {p: rng.randint(0, 4) for p in places}
        best = min((cost[a] + cost[b]) for a, b in itertools.combinations(places, 2) if b - a >= 2)
        a, b = spelling.pivots(places, cost)
        assert b - a >= 2 and cost[a] + cost[b] == best


def test_odd_texts(spark):
    texts = [(1, None), (2, ""), (None, "Überfluß Überfluß"), (3, "lettering lettering " * 200), (4, "letterin"), (4, "letterin"), (5, "LETTERINGS " * 2000),
             (6, "x" * 3000 + " " + "x" * 3000 + " y" + "x" * 2999 + " y" + "x" * 2999), (7, "ÀÖ×÷øÿa ÀÖ×÷øÿa"), (8, "naïveté́ naïveté")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    assert {tuple(r) for r in spelling.spelling_variants(docs).collect()} == plain_variants(plain_counts(texts))
    assert spelling.spelling_variants(docs.limit(0)).count() == 0
    # Chains end where no form follows; on ties the first word is the form.
    counts = spark.createDataFrame([("aaaaaaa", 1), ("aaaaaab", 10), ("aaaaabb", 100), ("aaaabbb", 1000), ("caaaaab", 10), ("abaaaab", 10)], "word string, n bigint")
    assert {tuple(r) for r in spelling.variants(counts).collect()} == plain_variants({r.word: r.n for r in counts.collect()})


def test_query_on_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    found = queries.REGISTRY["op11_spelling_variants"](spark, SF_DIR)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain_variants(plain_counts(docs))
