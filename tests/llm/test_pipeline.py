"""The pipeline stage by stage against plain Python, and every stage on odd input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_DIR
from inkfold.llm import line_dedup, mixing, queries
from test_line_dedup import plain_dedup
from test_native import plain_targets
from test_simhash import plain_fingerprint, plain_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows after every stage of one run, each written and read again."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    out["input"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, docs, SF_DIR).write.parquet(folder)
        docs = spark.read.parquet(folder)
        out[name] = docs.collect()
    return out


def test_stages_come_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mix_sources", "encode"]


def test_quality_stage_keeps_what_the_rules_keep(spark, steps):
    kept = {r.doc_id for r in queries.REGISTRY["op7_quality_rules"](spark, SF_DIR).collect() if r.kept}
    assert sorted(map(tuple, steps["quality_rules"])) == sorted(tuple(r) for r in steps["input"] if r.doc_id in kept)


def test_line_stage(steps):
    docs = [(r.doc_id, r.text) for r in steps["quality_rules"]]
    left = {d: t for (d, _), (t, *_) in zip(docs, plain_dedup(docs, line_dedup.MIN_WORDS))}
    assert {r.doc_id: (r.text, r.n_chars) for r in steps["line_dedup"]} == {d: (t, len(t)) for d, t in left.items()}
    assert any(t != r.text for r, t in zip(steps["quality_rules"], (left[r.doc_id] for r in steps["quality_rules"])))


def test_near_stage_keeps_one_of_each_group(steps):
    groups = plain_groups([(r.doc_id, plain_fingerprint(r.text, 3)) for r in steps["line_dedup"]])
    assert sorted(r.doc_id for r in steps["near_dedup"]) == sorted(set(groups.values()))
    assert len(steps["near_dedup"]) < len(steps["line_dedup"])


def test_mix_stage_meets_its_targets(steps):
    before, after = steps["near_dedup"], Counter(r.doc_id for r in steps["mix_sources"])
    size = {r.doc_id: len((r.text or "").encode().split()) for r in before}
    per_source, largest = Counter(), Counter()
    for r in before:
        per_source[r.source] += size[r.doc_id]
        largest[r.source] = max(largest[r.source], size[r.doc_id])
    want, taken = plain_targets(per_source), Counter()
    for r in before:
        assert after[r.doc_id] <= 3
        taken[r.source] += after[r.doc_id] * size[r.doc_id]
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in per_source)


def test_encode_stage(spark, steps):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path(queries.PIECES))
    texts = {r.doc_id: r.text for r in steps["mix_sources"]}
    assert Counter(r.doc_id for r in steps["encode"]) == Counter(r.doc_id for r in steps["mix_sources"])
    assert all(r.ids == library.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids) for r in steps["encode"])


def test_run_gives_the_last_stage(spark, steps):
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids) for r in found) == sorted((r.doc_id, r.n_tokens, r.ids) for r in steps["encode"])


ODD = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a " * 60_000, "en", None, 1),
       (3, "\n".join(" ".join(f"w{i}{c}" for c in "abcdefghijkl") for i in range(2000)), "xx", "t", None), (4, "short", None, "t", 5)]


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_on_odd_rows(spark, tmp_path, name):
    extra = {"kept": F.lit(1), "copies": F.lit(2), "row": F.lit(3), "fp": F.lit("x"), "ids": F.lit("y"), "n_lines": F.lit(4), "key": F.lit(5),
             "place": F.lit(6), "cut": F.lit(7), "copy": F.lit(8), "bound": F.lit(9), "stratum": F.lit("s"), "counts": F.lit("t"), "row_": F.lit(10),
             "__row": F.lit(11), "__key": F.lit(12), "__copy": F.lit(13), "__b": F.lit(14), "__stratum": F.lit(15), "__cut": F.lit(16), "__gone": F.lit(17)}
    docs = spark.createDataFrame(ODD, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumns(extra)
    docs.coalesce(1).write.parquet(str(tmp_path / "odd"))
    docs = spark.read.parquet(str(tmp_path / "odd"))
    found = STAGES[name](spark, docs, SF_DIR)
    rows = found.collect()
    if name == "encode":
        assert len(rows) == 7 and sum(r.ids is None for r in rows) == 2
    else:
        assert found.columns == docs.columns
        given = docs.select(*[c for c in extra if c != "n_lines"]).first()
        assert all(r[c] == given[c] for r in rows for c in given.asDict())
    if name == "quality_rules":
        assert [r.doc_id for r in rows] == [3]
    if name == "line_dedup":
        assert len(rows) == 7
    if name == "near_dedup":
        assert sorted(r.doc_id or 0 for r in rows) == [1, 2, 3, 4]
    empty = STAGES[name](spark, docs.limit(0), SF_DIR)
    assert empty.count() == 0
    assert mixing.ROUNDS and sum(mixing.ROUNDS) == 64
