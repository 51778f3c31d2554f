"""Line dedup against a plain search of all blocks."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from inkfold.llm import line_dedup, queries


def plain_dedup(docs, min_words):
    """docs: (doc_id, text) rows; (text left, lines, lines removed) of each row. Tries every run of lines."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0, i))
    lines = {i: [] if docs[i][1] is None else docs[i][1].split("\n") for i in order}
    gone, seen = {i: set() for i in order}, set()
    for i in order:
        words = [len(x.encode().split()) for x in lines[i]]
        for p in range(len(lines[i])):
            runs = [(q, tuple(lines[i][p:q])) for q in range(p + 1, len(lines[i]) + 1) if sum(words[p:q]) >= min_words]
            for q, run in runs:
                if run in seen:
                    gone[i] |= set(range(p, q))
            seen.update(r for _, r in runs)
    return [(None if docs[i][1] is None else "\n".join(x for p, x in enumerate(lines[i]) if p not in gone[i]), len(lines[i]), len(gone[i]))
            for i in range(len(docs))]


def run(spark, tmp_path, docs, min_words):
    folder = str(tmp_path / "docs")
    # One file, so that places follow the order of the list.
    spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("n_lines", F.lit("own")).withColumn("row", F.lit(1)).coalesce(1).write.parquet(folder)
    found = line_dedup.drop_repeated_lines(spark.read.parquet(folder), min_words=min_words)
    assert found.columns == ["doc_id", "text", "row", "n_lines", "n_removed"]
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in found.collect()), key=repr)


def want(docs, min_words):
    return sorted(((d, *rest) for (d, _), rest in zip(docs, plain_dedup(docs, min_words))), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_random_documents(spark, tmp_path, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 6))) for _ in range(12)]
    docs = []
    for i in range(40):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 12))]
        if docs and rng.random() < .5:
            other = rng.choice(docs)[1].split("\n")
            at = rng.randint(0, len(other))
            lines[1:1] = other[at:at + rng.randint(1, 9)]
        docs.append((rng.randint(0, 30), "\n".join(lines)))
    min_words = rng.choice([1, 4, 9])
    assert run(spark, tmp_path, docs, min_words) == want(docs, min_words)


def test_edges(spark, tmp_path):
    line = "one two three four five six seven eight nine ten"
    long = "\n".join(f"line {i} of a very" + "\n" * (i % 7) for i in range(40))
    docs = [(1, None), (2, ""), (2, ""), (3, line), (4, f"{line}\n{line}\nown"), (None, f"{line}\nnull goes last"), (None, None), (5, "\n\n\n"),
            (9, long), (8, long), (8, long), (10, "same same\n" * 20), (11, f" {line}"), (12, "short\nlines\nrepeat"), (13, "short\nlines\nrepeat")]
    assert run(spark, tmp_path, docs, 10) == want(docs, 10)


def test_very_long_copies(spark, tmp_path):
    long = "\n".join(f"line {i} of a long text" for i in range(20_000))
    blank = "head of a text with nothing" + "\n" * 5000 + "tail of a text with nothing"
    docs = [(1, long), (2, f"own line before\n{long}\nown line behind"), (3, blank), (4, f"{blank}\nmore"), (5, "tail of a text with nothing\nmore")]
    found = {r[0]: r[1:] for r in run(spark, tmp_path, docs, 10)}
    assert found == {1: (long, 20_000, 0), 2: ("own line before\nown line behind", 20_002, 20_000), 3: (blank, 5001, 0), 4: ("more", 5002, 5001),
                     5: ("tail of a text with nothing\nmore", 2, 0)}


def test_nothing_and_nothing_repeated(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_dedup.drop_repeated_lines(empty).count() == 0
    assert run(spark, tmp_path, [(1, "a\nb"), (2, "c\nd")], 1) == want([(1, "a\nb"), (2, "c\nd")], 1)


def test_query_on_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = queries.REGISTRY["op6_line_dedup"](spark, SF_DIR).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in rows), key=repr) == want(docs, line_dedup.MIN_WORDS)
