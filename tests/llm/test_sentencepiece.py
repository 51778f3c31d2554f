"""The transducer against the library (BPE), against every segmentation (unigram), and round trips."""

import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from inkfold.llm import queries
from inkfold.llm import sentencepiece as sp

PATH = queries.tokenizer_path(queries.PIECES)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def machine():
    return sp.Transducer(sp.Model.read(sp.model_bytes(PATH)))


def ids(machine, text):
    return np.frombuffer(machine.encode(text), dtype="<i4").tolist()


ODD = ["", " ", "  a  b   c ", "日本語テキスト、これは", "😀😀 emoji", "tab\tnl\n\n  x\r", "x" * 500, "    " * 20, "<s> </s> <0x41> <unk>",
       "é̃é", "the" * 50, "aaaaaaa" * 9 + " aaaa", "\x00\x01", "ﬁ ½", "a▁b"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_like_the_library(machine, library, text):
    assert ids(machine, text) == library.encode(text)
    assert machine.decode(library.encode(text)) == library.decode(library.encode(text))


def test_random_texts_like_the_library(machine, library, monkeypatch):
    monkeypatch.setattr(sp, "REMEMBERED", 50)
    rng, pieces = random.Random(2), list(machine.ids)
    for _ in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 12)))
        other = "".join(rng.choice("abcdeth ins  ,.\n<>ABéß0129語'") for _ in range(rng.randint(1, 60)))
        for t in (text, other):
            assert ids(machine, t) == library.encode(t)


def test_query_on_whole_table(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.REGISTRY["op1_sentencepiece"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == library.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids) and r.round_trip


def test_unigram_path_is_the_best_of_all():
    pieces = ["<unk>", "▁", "a", "b", "ab", "▁a", "ba", "aba", "bb"]
    scores = [0.0, -2.0, -1.5, -1.7, -2.1, -2.4, -2.2, -3.4, -3.05]
    model = sp.Model(pieces, scores, [sp.UNKNOWN] + [sp.NORMAL] * 8, sp.UNIGRAM, False, True, False)
    machine = sp.Transducer(model)

    def all_paths(text):
        if not text:
            yield 0.0, []
        for n in range(1, len(text) + 1):
            head = text[:n]
            score = scores[pieces.index(head)] if head in pieces[1:] else (-13.4 if n == 1 and head not in pieces else None)
            if score is not None:
                for rest, path in all_paths(text[n:]):
                    yield score + rest, [pieces.index(head) if head in pieces[1:] else 0, *path]
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice("ab bc") for _ in range(rng.randint(1, 9)))
        best = max(p[0] for p in all_paths(machine.normalize(text)))
        found = machine.shortest_path(machine.normalize(text))
        assert sum(scores[pieces.index(p)] if p in pieces else -13.4 for p in found) == pytest.approx(best)
    # Unknown characters side by side are one unknown id.
    assert ids(machine, "ccab") == [1, 0, 4]


def message(number, payload):
    """One length-delimited field of a protocol buffer message."""
    size, out = len(payload), bytearray([number << 3 | 2])
    while size > 127:
        out.append(size & 127 | 128)
        size >>= 7
    return bytes(out) + bytes([size]) + payload


def piece(text, score, kind):
    return message(1, message(1, text.encode()) + b"\x15" + struct.pack("<f", score) + bytes([3 << 3, kind]))


HARD = [*ODD, "ﬁne ½ Ⅷ ㍿ ｆｕｌｌ　ｗｉｄｔｈ", "e\u0301te\u0301 A\u030a\u0323 \u1100\u1161\u11a8", "\u00ad\u200b\ufeffx\u0007y", " \u3000 a \u00a0 b \u3000", "▁", "x ▁▁",
        "\u3000", "カ\u3099ガ ﾊﾟ", "<user>ab<user> <us er> <users>", "a<user\u0301", "<user>\u0301 new york▁city! abq", "e<user>\u0301<user>"]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nmt_nfkc_cf", "nfkc", "identity"])
@pytest.mark.parametrize("user", [[], ["<user>", "<user", "▁city!", "abq"]])
def test_character_map_and_own_pieces_like_the_library(rule, user):
    import sentencepiece

    spec = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec()
    with open(PATH, "rb") as f:
        data = f.read() + message(3, spec) + b"".join(piece(p, 0.0, sp.USER) for p in user)
    library, machine = sentencepiece.SentencePieceProcessor(model_proto=data), sp.Transducer(sp.Model.read(data))
    rng = random.Random(6)
    alphabet = ["a", "b", "e", "k", " ", "\u3000", "\u0301", "\u0323", "\u030a", "ﬁ", "Å", "A", "Ǆ", "<user>", "<us", "▁", "▁city!", "q", "\u1100", "\u1161", "\u11a8", "ｶ", "ﾞ", "\n", "\u200b"]
    for text in [*HARD, *("".join(rng.choices(alphabet, k=rng.randint(1, 25))) for _ in range(400))]:
        assert machine.normalize(text) == library.normalize(text), text
        assert ids(machine, text) == library.encode(text), text
        assert machine.decode(library.encode(text)) == library.decode(library.encode(text)), text


def test_own_pieces_of_a_unigram_model_like_the_library():
    import sentencepiece

    pieces = [("▁", -2.0), ("a", -1.5), ("b", -1.7), ("ab", -2.1), ("▁a", -2.4), ("ba", -2.2), ("aba", -3.4)]
    data = piece("<unk>", 0.0, sp.UNKNOWN) + b"".join(piece(p, s, sp.NORMAL) for p, s in pieces) + piece("abb", 0.0, sp.USER) + piece("b▁b", 0.0, sp.USER)
    data += message(2, bytes([3 << 3, sp.UNIGRAM])) + message(3, message(1, b"identity"))
    library, machine = sentencepiece.SentencePieceProcessor(model_proto=data), sp.Transducer(sp.Model.read(data))
    rng = random.Random(8)
    for _ in range(500):
        text = "".join(rng.choice("ab bc") for _ in range(rng.randint(1, 12)))
        assert ids(machine, text) == library.encode(text), text


def test_frames_keep_columns_and_nulls(spark):
    rows = [(1, None, "q"), (2, "", "r"), (2, "", "r"), (None, "long " * 50_000, None)]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string, ids string").withColumn("extra", F.lit(5))
    model = sp.model_bytes(PATH)
    found = sp.encode(texts, model)
    assert found.columns == ["doc_id", "text", "extra", "ids"]
    back = sp.decode(found, model, text="text").collect()
    assert sorted((r.doc_id or 0, r.text) for r in back if r.text is not None) == [(0, "long " * 50_000), (2, ""), (2, "")]
    assert [r.ids for r in back if r.doc_id == 1] == [None]
    assert sp.encode(texts.limit(0), model).count() == 0


def test_a_worker_compiles_a_model_once():
    """Tasks of a worker share the machine, and decoding needs none of the encoder's tables."""
    data = sp.model_bytes(PATH)
    assert sp._transducer(data) is sp._transducer(bytes(bytearray(data)))
    decoder = sp._decoder(data)
    assert not hasattr(decoder, "trie") and not hasattr(decoder, "paths")
    text = "Zwei  Wörter\n日本"
    assert decoder.decode(np.frombuffer(sp._transducer(data).encode(text), dtype="<i4").tolist()) == text
