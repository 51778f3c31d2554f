"""Ranking, similarity, sources, models and plan shapes."""

import os
import random
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from inkfold.functions import text
from inkfold.operators import captions, inference, joins, ocr, pixels, ranking, records, similarity
from inkfold.plans import queries
from inkfold.sources import files


def test_global_row_number(spark):
    keys = [(random.Random(i).choice(["a", "b"]) * (i % 3), i) for i in range(3000)]
    df = spark.createDataFrame(keys, "k string, i int").repartition(13)
    got = ranking.global_row_number(df, ["k", "i"]).collect()
    want = {key: n for n, key in enumerate(sorted(keys), 1)}
    assert {(r["k"], r["i"]): r["idx"] for r in got} == want
    assert ranking.global_row_number(df.where("i < 0"), ["k", "i"]).count() == 0


def test_key_sample_on_many_rows(spark):
    df = spark.range(0, 200_000).withColumn("k", F.xxhash64("id"))
    got = ranking.global_row_number(df, ["k"])
    assert got.agg(F.min("idx"), F.max("idx"), F.count_distinct("idx")).first()[:] == (1, 200_000, 200_000)
    before = got.alias("a").join(got.alias("b"), F.expr("b.idx = a.idx + 1")).where("b.k <= a.k")
    assert before.count() == 0


@pytest.mark.parametrize("n, part", [(1000, 0.1), (37, 0.25), (5, 0.1), (5, 1.0)])
def test_exact_split(spark, n, part):
    df = spark.range(n).toDF("id")
    got = ranking.exact_split(df, "id", part, seed=3)
    assert got.count() == n and got.where("split = 'val'").count() == int(n * part)
    again = ranking.exact_split(df.repartition(5), "id", part, seed=3)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))


def test_shuffled_batches(spark):
    df = spark.range(100).toDF("id")
    got = ranking.batching(df, "id", 8, drop_last=True, shuffle_seed=5)
    sizes = got.groupBy("batch").count().collect()
    assert len(sizes) == 12 and all(r["count"] == 8 for r in sizes)
    plain = ranking.batching(df, "id", 8).where("batch = 0")
    assert sorted(r["id"] for r in plain.collect()) == list(range(8))


def test_first_detection(spark):
    df = spark.createDataFrame([(1, 5, 2, 0), (1, 3, 2, 9), (1, 0, 1, 1), (2, 0, 1, 1)], "img_id int, det_no int, cls int, x1 int")
    assert [tuple(r) for r in ranking.first_detection(df, 2).collect()] == [(1, 2, 3, 9)]


def brute_pairs(rows, threshold=0.3):
    found = {}
    unit = [np.array(r[3]) / (np.linalg.norm(r[3]) or 1.0) for r in rows]
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j and a[0] == b[0]:
                value = float(unit[i] @ unit[j])
                if value > threshold:
                    n, top = found.get((a[0], a[2], b[2]), (0, -1.0))
                    found[a[0], a[2], b[2]] = (n + 1, max(top, value))
    return found


@pytest.mark.parametrize("block", [1024, 3])
def test_similar_tokens_against_all_pairs(spark, block):
    rng = random.Random(4)
    vectors = {w: [rng.gauss(0, 1) for _ in range(4)] for w in "abcdefghij"}
    vectors["z"] = [0.0] * 4
    rows = [(d, p, w, vectors[w]) for d in range(3) for p, w in enumerate(rng.choice("abcdefghijz") for _ in range(40))]
    rows += [(7, 0, "a", vectors["a"]), (7, 1, "n", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, pos int, word string, vec array<double>")
    got = {(r["doc_id"], r["word"], r["similar_word"]): (r["n_pairs"], r["cosine"])
           for r in similarity.similar_token_join(df, block_words=block).collect()}
    want = brute_pairs([r for r in rows if r[3]])
    assert set(got) == set(want)
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)
    words = similarity.similar_words(similarity.similar_token_join(df, block_words=block))
    by_word = {}
    for _, a, b in want:
        by_word.setdefault(a, set()).add(b)
    assert {r["word"]: set(r["similar_words"]) for r in words.collect()} == by_word
    long = similarity.similar_word_pairs(similarity.similar_token_join(df, block_words=block)).collect()
    assert len(long) == sum(map(len, by_word.values())) and all(r["similar_word"] in by_word[r["word"]] for r in long)
    assert all(r["n_pairs"] == sum(n for (_, a, b), (n, _) in want.items() if (a, b) == (r["word"], r["similar_word"])) for r in long)


def test_label_spread_is_pca(spark, fx):
    rows = similarity.label_spread(fx.table("embeddings"), "label", "embedding").collect()
    for label in {r["label"] for r in rows}:
        mine = [r for r in rows if r["label"] == label]
        x = np.array([r["embedding"] for r in mine], dtype=float)
        x = x - x.mean(axis=0)
        left, size, _ = np.linalg.svd(x, full_matrices=False)
        for c, name in enumerate(["px", "py"]):
            own = np.array([r[name] for r in mine])
            assert np.allclose(np.abs(own), np.abs(left[:, c] * size[c]), atol=1e-6)


def test_spread_keeps_vectors_without_label(spark):
    rows = [(i, "a" if i < 3 else None, [float(i), float(i * i), 1.0]) for i in range(5)]
    df = spark.createDataFrame(rows, "id int, label string, vec array<double>")
    got = similarity.label_spread(df).collect()
    assert sorted(r["id"] for r in got) == [0, 1, 2, 3, 4] and sum(r["label"] is None for r in got) == 2
    assert all(r["px"] is not None for r in got) and sorted(got[0].asDict()) == ["id", "label", "px", "py", "vec"]


def test_hot_key_is_dealt_out(spark):
    rows = spark.range(4000).select(F.lit(1).alias("k"), "id")
    facts = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    joined = joins.join_per_key(rows, facts, "k", ["id"])
    assert joined.count() == 4000 and joined.where("v <> 'x'").count() == 0


def test_text_files(spark, tmp_path):
    for name, body in {"12.txt": "eins\nzwei\n", "img_7.txt": "", "0003_b.txt": "drei", "x.jpg": "no"}.items():
        (tmp_path / name).write_text(body)
    got = {r["doc_id"]: r["text"] for r in files.text_scan(spark, str(tmp_path)).collect()}
    assert got == {12: "eins\nzwei\n", 3: "drei"}  # Spark does not list the empty file


def test_empty_result_scores_as_missed(spark):
    truth = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id int, gt string")
    result = spark.createDataFrame([(1, "a b")], "doc_id int, et string")
    pairs = joins.truth_join(truth, result)
    assert {r["doc_id"]: r["wer"] for r in ocr.score_texts(pairs).collect()} == {1: 0.0, 2: 1.0}
    assert joins.truth_join(truth, result, missing_as_empty=False).count() == 1


def test_json_sink_keeps_nulls_and_letters(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "Österreich", "", "x", "y")], "doc_id bigint, Location string, Description string, Date string, Photographer string, Film string")
    out = str(tmp_path / "json")
    files.json_sink(df, out)
    files.json_sink(df, out)  # clears the folder first
    line = "".join(open(os.path.join(out, f), encoding="utf8").read() for f in os.listdir(out) if f.startswith("part"))
    assert '"Location":null' in line and "Österreich" in line and line.count("\n") == 1
    assert files.json_source(spark, out).drop("error").first() == df.first()


def test_csv_any_text(spark, tmp_path):
    df = spark.createDataFrame([('a "q", b', "x\ny"), ("ü", "1,2")], "word string, similar_words string")
    files.csv_sink(df, str(tmp_path / "c"))
    back = files.csv_source(spark, str(tmp_path / "c"), "word string, similar_words string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_overwrite_one_partition(spark, tmp_path):
    out = str(tmp_path / "t")
    files.overwrite_output(spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string"), out, "p")
    files.overwrite_output(spark.createDataFrame([(9, "b")], "n int, p string"), out, "p")
    assert sorted(r["n"] for r in spark.read.parquet(out).collect()) == [1, 9]


def test_work_folder_follows_the_session():
    def session(folder, master):
        context = SimpleNamespace(applicationId="app-1", master=master)
        return SimpleNamespace(conf={"spark.checkpoint.dir": folder}, sparkContext=context)

    assert files.work_folder(session("hdfs://shared/place/", "yarn"), "q").startswith("hdfs://shared/place/app-1/q-")
    assert "inkfold/app-1/q-" in files.work_folder(session(None, "local[2]"), "q")
    with pytest.raises(ValueError):
        files.work_folder(session(None, "yarn"), "q")


def test_work_folders_are_removed(spark):
    folder = files.work_folder(spark, "x")
    spark.range(3).write.parquet(folder)
    assert spark.read.parquet(folder).count() == 3
    files.remove_work_folders(spark)
    assert not os.path.exists(folder) and os.path.exists(os.path.dirname(os.path.dirname(folder)))


def test_batch_infer_settings_are_columns(spark):
    def make():
        return lambda batch: pd.DataFrame({"id": batch["id"], "out": batch["config"] + batch["id"].astype(str)})

    df = spark.range(3).withColumn("config", F.lit("psm 6: "))
    got = inference.batch_infer(df, make, "id bigint, out string").orderBy("id").collect()
    assert [r["out"] for r in got] == ["psm 6: 0", "psm 6: 1", "psm 6: 2"]


def test_stateless_operators_run_on_a_stream(spark, tmp_path):
    """Row-wise operators accept a streaming file source unchanged."""
    for i, body in enumerate(["Wien Mai 1948 Aufn. Lindtaler", "Graz Film 12 ZV"]):
        (tmp_path / f"{i}.txt").write_text(body)
    stream = spark.readStream.schema("value string").option("wholetext", True).text(str(tmp_path))
    found = captions.caption_records(stream.select(F.xxhash64("value").alias("doc_id"), F.col("value").alias("text")))
    run = (found.writeStream.format("memory").queryName("caption_stream").outputMode("append")
           .trigger(availableNow=True).start())
    run.awaitTermination()
    got = {(r["Date"], r["Photographer"], r["Film"]) for r in spark.table("caption_stream").collect()}
    assert got == {("Mai 1948", "Aufn. Lindtaler", None), (None, None, "Film 12 ZV")}


# Plans --------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Work that is per row must not shuffle at all.
ROW_WISE = ["label_to_field", "mask_encode", "mask_decode", "logits_to_mask", "json_repair_parse", "build_messages",
            "text_normalize", "cosine", "batch_infer", "round2", "detection_class_filter"]


@pytest.mark.parametrize("name", ROW_WISE)
def test_row_wise_plans_do_not_shuffle(spark, name):
    text_plan = plan(queries.REGISTRY[name](spark, SF_DIR))
    assert "Exchange hashpartitioning" not in text_plan and "Exchange rangepartitioning" not in text_plan


@pytest.mark.parametrize("name", sorted(queries.REGISTRY))
def test_no_nested_loop_or_cartesian_join(spark, name):
    if name in ("text_scan",):  # writes one file per document
        pytest.skip("covered by its own test")
    text_plan = plan(queries.REGISTRY[name](spark, SF_DIR))
    assert "CartesianProduct" not in text_plan and "BroadcastNestedLoopJoin" not in text_plan


def test_scans_read_only_what_they_need(spark):
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        pushed = plan(queries.REGISTRY["non_empty_flags"](spark, SF_DIR))
        assert "Not(EqualTo(o_orderstatus,P))" in pushed and "GreaterThanOrEqual(c_acctbal,0.0)" in pushed
        words = plan(queries.REGISTRY["word_frequency"](spark, SF_DIR))
        assert "ReadSchema: struct<text:string>" in words
        # Match rates need no word error rate: no Python step is left in the plan.
        assert "ArrowEvalPython" not in plan(queries.REGISTRY["match_rates"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)


def test_comparison_deals_records_once(spark):
    text_plan = plan(queries.REGISTRY["match_rates"](spark, SF_DIR))
    assert "RoundRobin" not in text_plan


def test_entity_tokens_add_no_shuffle(spark, fx):
    def shuffles(df):
        return plan(df).count("Exchange hashpartitioning") + plan(df).count("Exchange SinglePartition")

    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        assert shuffles(queries.REGISTRY["entity_tokens"](spark, SF_DIR)) == shuffles(fx.captions())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)


def test_normalized_rates_score_once(spark):
    # What is read twice are stored scores: no scoring step is left in the plan.
    text_plan = plan(queries.REGISTRY["l2_normalized_rates"](spark, SF_DIR))
    assert "ArrowEvalPython" not in text_plan and "levenshtein" not in text_plan


def test_long_tables_are_not_dealt_again(spark, fx, monkeypatch):
    docs = fx.documents()
    assert "RoundRobin" in plan(queries.dealt(fx, docs))
    # A table of as many splits as cores is left as it is.
    many = SimpleNamespace(spark=spark, table=lambda name: spark.range(100).repartition(64))
    assert queries.dealt(many, docs) is docs


def test_binarize_shuffles_pixels_once(spark, fx):
    """Both window steps and the level join live on the tile partitioning."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        text_plan = plan(pixels.su_binarize(fx.pixels(), 3, 3))
        main = [line for line in text_plan.split("\n") if "Exchange hashpartitioning" in line]
        # tiles for the decision, tiles for the histogram (reused at run time), histogram, levels, level rows
        assert len(main) <= 5, "\n".join(main)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", True)


def test_scored_rows_are_dealt_by_their_number(spark, fx, monkeypatch):
    """Tasks grow with the rows: a table of one row group, or the few parts behind a join, are not the tasks of the scoring."""
    monkeypatch.setattr(queries, "partitions", lambda spark: 2)
    monkeypatch.setattr(queries, "SCORED_DOCUMENTS", 50)
    monkeypatch.setattr(queries, "SCORED_CAPTIONS", 100)
    for frame, table, rows in ((queries._known(fx, queries.SCORED_DOCUMENTS), "documents", 50), (queries._caption_sweep(fx), "orders", 100)):
        assert frame.rdd.getNumPartitions() == -(-fx.table(table).count() // rows) > 2
        sizes = [r["n"] for r in frame.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 2 * min(sizes)


def test_appended_tables_are_scored_once(spark):
    # What is appended are stored tables: no scoring step is left in the plan.
    text_plan = plan(queries.REGISTRY["append_results"](spark, SF_DIR))
    assert "ArrowEvalPython" not in text_plan and "levenshtein" not in text_plan


def test_texts_by_key_take_no_folder_each(spark, tmp_path):
    """One file per key in one folder: null and empty texts, keys that come again, null and negative keys, an old file cleared."""
    folder = str(tmp_path / "texts")
    rows = [(1, "a\nb"), (2, ""), (3, None), (-4, "ü"), (5, "x"), (5, "x"), (None, "none")]
    files.text_sink(spark.createDataFrame([(9, "old")], "doc_id bigint, text string"), folder, one_file_per_key=True)
    files.text_sink(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), folder, one_file_per_key=True)
    assert sorted(os.listdir(folder)) == sorted([f"doc_id={n}.txt" for n in (1, 2, 3, -4, 5, "__HIVE_DEFAULT_PARTITION__")])
    got = {r["doc_id"]: r["text"] for r in files.text_scan(spark, folder, key_folder="doc_id").collect()}
    assert got == {1: "a\nb\n", 2: "\n", 3: "\n", -4: "ü\n", 5: "x\nx\n", None: "none\n"}
