"""Token counts and packing against the libraries and plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from inkfold.llm import packing, queries, token_counts

WORDS = queries.tokenizer_path(queries.WORDS)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def count(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


ODD = ["", None, " \n", "one", "it's we'll  a1b2", "<|endoftext|>", "x<|endoftext|>y <|startoftext|> z", "<|ENDOFTEXT|>", "é é ﬁ ½", "a b c\x1cd\x85e",
       "日本語 テキスト", "!!!\t???\r\n$$$", "w" * 300, "tick 'S 'll '", "á ́b", "x\x0by\x0cz"]


def test_odd_texts_like_the_library(spark, library, tmp_path):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD * 2)], "doc_id bigint, text string").withColumn("digest", F.lit(1))
    folder = str(tmp_path / "docs")
    docs.write.parquet(folder)
    tokenizer = token_counts.Tokenizer.read(WORDS, white_separates=True)
    for r in token_counts.token_counts(spark.read.parquet(folder), tokenizer).collect():
        text = (ODD * 2)[r.doc_id]
        assert (r.n_bytes, r.n_tokens) == (len((text or "").encode()), count(library, text)), text


def test_query_on_whole_table(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.REGISTRY["op3_token_counts"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = count(library, texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)


@pytest.mark.parametrize("name", ["json", "model"])
def test_only_distinct_misses_are_encoded(spark, tmp_path, name):
    cache, folder = str(tmp_path / "cache"), str(tmp_path / "docs")
    path = WORDS if name == "json" else queries.tokenizer_path(queries.PIECES)
    tokenizer = token_counts.Tokenizer.read(path, white_separates=name == "json")

    def run(rows):
        spark.createDataFrame(rows, "doc_id bigint, text string").write.mode("overwrite").parquet(folder)
        out = {r.doc_id: r.n_tokens for r in token_counts.token_counts(spark.read.parquet(folder), tokenizer, cache).collect()}
        return out, spark.read.parquet(cache).count()
    first, n = run([(1, "a b"), (2, "a b"), (3, "c d e"), (None, "c d e")])
    assert n == 2 and first[1] == first[2] and first[3] == first[None]
    second, n = run([(4, "a b"), (5, "new text here")])
    assert n == 3 and second[4] == first[1]
    # Another version of the tokenizer shares no counts; equal content under white space does.
    if name == "json":
        third, n = run([(6, " a \n b\t")])
        assert n == 3 and third[6] == first[1]
        tokenizer = token_counts.Tokenizer.read(path, white_separates=False)
        run([(7, "a b")])
        assert spark.read.parquet(cache).count() == 4
    empty, _ = run([])
    assert empty == {}


# Packing --------------------------------------------------------------------


def plain_best_fit(lengths, size):
    """Row rooms left after best-fit decreasing, one rest at a time."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(size - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    size = rng.choice([8, 30, 64, 100])
    lengths = [rng.randint(1, rng.choice([size - 1, size // 2 + 1, 5])) for _ in range(rng.randint(0, 400))]
    histogram = {x: lengths.count(x) for x in set(lengths)}
    plan, n_rows = packing.best_fit_plan(histogram, size)
    used, ranks = {}, {x: [] for x in histogram}
    for length, rank, placed, per_row, row, at in plan:
        for k in range(placed):
            ranks[length].append(rank + k)
            cells = used.setdefault(row + k // per_row, set())
            own = set(range(at + k % per_row * length, at + (k % per_row + 1) * length))
            assert not own & cells and max(own) < size
            cells |= own
    assert all(sorted(r) == list(range(histogram[x])) for x, r in ranks.items())
    assert len(used) == n_rows
    assert all(cells == set(range(len(cells))) for cells in used.values())
    assert sorted(size - len(c) for c in used.values()) == plain_best_fit(lengths, size)


def test_room_tree_finds_the_least_room():
    rng = random.Random(1)
    tree, offered = packing.RoomTree(50), set()
    for _ in range(2000):
        room = rng.randint(0, 50)
        (offered.add if rng.random() < .4 else offered.discard)(room)
        tree.set(room, room in offered)
        want = rng.randint(1, 50)
        assert tree.least(want) == min((r for r in offered if r >= want), default=None)


def unpacked(rows, size, width):
    """doc_id -> sorted (start, ids) of all segments."""
    out, seen = {}, set()
    for r in rows:
        assert r.row_id not in seen and len(r.ids) == size * width and len(r.positions) == size * 4
        seen.add(r.row_id)
        ids, positions = np.frombuffer(r.ids, f"<u{width}"), np.frombuffer(r.positions, "<i4")
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and not ids[r.n_tokens:].any()
        for doc, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert positions[a:b].tolist() == list(range(b - a))
            out.setdefault(doc, []).append((start, ids[a:b].tolist()))
    assert seen == set(range(len(seen)))
    return {d: sorted(s) for d, s in out.items()}


def test_query_packs_every_token(spark):
    import base64

    import public_tokenizers
    import tiktoken

    with open(queries.tokenizer_path(queries.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    machine = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.REGISTRY["op4_token_packing"](spark, SF_DIR).collect()
    found = unpacked(rows, 2048, 2)
    want = {d: [*machine.encode_ordinary(t), queries.END] for d, t in texts.items()}
    assert {d: [x for _, s in parts for x in s] for d, parts in found.items()} == want
    rests = [len(w) % 2048 for w in want.values() if len(w) % 2048]
    assert len(rows) == sum(len(w) // 2048 for w in want.values()) + len(plain_best_fit(rests, 2048))


@pytest.mark.parametrize("width", [2, 4])
def test_pack_edges(spark, width):
    kind = f"<u{width}"
    lengths = [1, 1, 1, 5, 8, 9, 16, 17, 40, 3, 3, 7]
    rows = [(i if i % 5 else None, n, (np.arange(n) + 1).astype(kind).tobytes()) for i, n in enumerate(lengths)]
    tokens = spark.createDataFrame(rows, "doc_id bigint, n bigint, ids binary").withColumn("part", F.lit("x")).withColumn("rest", F.lit(1))
    found = unpacked(packing.pack(tokens, 8, width).collect(), 8, width)
    assert sorted(sum((s for _, s in parts if True), []) for d, parts in ((d, [p]) for d, ps in found.items() for p in ps)) == sorted(
        (np.arange(n) + 1)[a:a + 8].tolist() for n in lengths for a in range(0, n, 8))
    assert packing.pack(tokens.limit(0), 8, width).count() == 0


def test_odd_texts_are_packed(spark):
    from public_tokenizers import PATTERN

    with open(queries.tokenizer_path(queries.RANKS), "rb") as f:
        ranks = f.read()
    rows = [(1, None), (2, ""), (None, "a  b\n\n c"), (3, "x y " * 9000), (3, "x y " * 9000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"n": F.lit(1), "ids": F.lit("q"), "part": F.lit(2)})
    for width in (2, 4):
        found = unpacked(packing.pack_texts(docs, ranks, PATTERN, queries.END, 64, width).collect(), 64, width)
        encode = packing.byte_encoder(ranks, PATTERN)
        assert [x for _, s in found[None] for x in s] == [*encode("a  b\n\n c"), queries.END]
        assert found[1] == found[2] == [(0, [queries.END])]
        assert sum(len(s) for _, s in found[3]) == 2 * (len(encode("x y " * 9000)) + 1)
    assert packing.pack_texts(docs.limit(0), ranks, PATTERN, queries.END).count() == 0
