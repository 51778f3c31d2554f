"""Files written one per row, tables that grow by runs, streams, models of arrays, answers of any shape."""

import glob
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkfold.operators import captions, inference, records
from inkfold.sources import blobs, files, runs
from inkfold.streaming import files as arriving


def test_images_survive_as_files(spark, tmp_path):
    rng = np.random.default_rng(2)
    shapes = {1: (1, 1), 2: (7, 3), 3: (300, 517), 4: (2, 4000)}
    rows = [(i, h, w, rng.integers(0, 256, h * w, dtype="u1").tobytes()) for i, (h, w) in shapes.items()]
    images = spark.createDataFrame(rows, "img_id bigint, height int, width int, data binary")
    folder = str(tmp_path / "images")
    blobs.image_file_sink(images, folder)
    blobs.blob_sink(spark.createDataFrame([("img_9.png", b"no image"), ("img_10.png", b"")], "name string, content binary"), folder)
    found = {r.img_id: r for r in blobs.image_files(spark, folder).collect()}
    for i, h, w, data in rows:
        assert not found[i].broken
        assert (found[i].image.height, found[i].image.width, found[i].image.nChannels, bytes(found[i].image.data)) == (h, w, 1, data)
    assert found[9].broken and found[9].image is None
    # Spark does not list the empty file.
    assert tuple(blobs.broken_files(blobs.image_files(spark, folder)).first()) == (5, 1)
    assert files.image_scan(spark, folder).count() == 4
    # Written again, the same files stand there.
    blobs.image_file_sink(images, folder)
    assert len(os.listdir(folder)) == 6


def test_a_failed_write_leaves_whole_files_only(spark, tmp_path):
    rows = spark.range(40).repartition(4).select(F.concat(F.lit("f"), "id").alias("name"), F.when(F.col("id") != 33, F.repeat(F.lit("x"), 999).cast("binary")).alias("content"))
    folder = str(tmp_path / "failed")
    with pytest.raises(Exception):
        blobs.blob_sink(rows, folder)
    assert all(os.path.getsize(f) == 999 for f in glob.glob(f"{folder}/f*"))
    blobs.blob_sink(rows.na.fill("").withColumn("content", F.coalesce("content", F.lit("z").cast("binary"))), folder)
    assert sum(os.path.getsize(f) for f in glob.glob(f"{folder}/f*")) == 39 * 999 + 1


def test_runs_count_exactly_once(spark, tmp_path):
    folder = str(tmp_path / "table")
    schema = "config string, wer double"

    def run_of(*rows):
        return spark.createDataFrame(list(rows), schema)
    runs.append_run(run_of(("a", 0.5), ("b", 0.25)), folder, "monday")
    runs.append_run(run_of(("a", 0.75)), folder, "tuesday")
    before = sorted(map(tuple, runs.read_runs(spark, folder, schema).collect()))
    # Cut off before the log: nothing to see. Repeated: in place of the first.
    runs._write_attempt(run_of(("a", 9.0)), folder)
    assert sorted(map(tuple, runs.read_runs(spark, folder, schema).collect())) == before
    runs.append_run(run_of(("a", 0.5), ("b", 0.25)), folder, "monday")
    assert sorted(map(tuple, runs.read_runs(spark, folder, schema).collect())) == before
    runs.append_run(run_of(("a", 0.0)).limit(0), folder, "tuesday")
    assert {(r.run, r.rows) for r in runs.runs(spark, folder).collect()} == {("monday", 2), ("tuesday", 0)}
    assert sorted(map(tuple, runs.read_runs(spark, folder, schema).collect())) == [("a", 0.5, "monday"), ("b", 0.25, "monday")]


def test_stream_takes_late_files_once(spark, tmp_path):
    came, out, checkpoint = (str(tmp_path / n) for n in ("came", "out", "checkpoint"))
    os.makedirs(came)
    texts = {1: "Mai 1938\r\nAufn. Lindner", 2: "Film 12 ZV", 3: "nichts", 4: "1940"}

    def deliver(*numbers):
        for n in numbers:
            with open(f"{came}/img_{n}.txt", "w", newline="") as f:
                f.write(texts[n])

    def run():
        stream = arriving.text_stream(spark, came, files_per_batch=1)
        arriving.run_available(stream, lambda s: captions.caption_records(s), out, checkpoint)
        return sorted(map(str, spark.read.parquet(out).collect()))
    deliver(1, 2)
    assert len(run()) == 2
    assert len(run()) == 2
    deliver(3, 4)
    whole = captions.caption_records(files.text_scan(spark, came))
    assert run() == sorted(map(str, whole.collect()))


def test_one_model_per_worker(spark, tmp_path):
    mark = str(tmp_path)

    def make():
        import os as system
        import uuid

        with open(f"{mark}/{system.getpid()}-{uuid.uuid4().hex}", "w"):
            pass
        return lambda vectors, gain: vectors.sum(axis=1) * gain
    model = inference.array_model(make, T.DoubleType(), batch_size=7, shapes=[[3], []])
    rows = spark.range(400).repartition(40).select("id", F.when(F.col("id") != 5, F.array(*[F.col("id").cast("double")] * 3)).alias("vec"))
    found = inference.infer_sweep(rows, model, ["vec"], {"one": {"gain": 1.0}, "two": {"gain": 2.0}})
    assert found.columns == ["id", "vec", "config", "result"]
    want = {(i, c): None if i == 5 else 3.0 * i * g for i in range(400) for c, g in (("one", 1), ("two", 2))}
    assert {(r.id, r.config): r.result for r in found.collect()} == want
    made = [os.path.basename(f).split("-")[0] for f in glob.glob(f"{mark}/*")]
    # Forty tasks and more, but one model per Python worker.
    assert 0 < len(made) == len(set(made)) < 40


def test_interval_join_by_bins(spark):
    spans = spark.createDataFrame([(1, 0, 100_000, "LONG"), (1, 5, 5, "EMPTY"), (1, 1023, 1025, "EDGE"), (2, 3, 4, "ONE"), (1, 1000, 3000, "IN")],
                                  "doc_id bigint, start int, end int, label string")
    tokens = spark.range(5000).select((F.col("id") % 2 + 1).alias("doc_id"), F.col("id").cast("int").alias("pos"), F.lit("w").alias("word"))
    assert captions.span_bins(spans).where("label = 'LONG'").count() <= 100
    found = captions.entity_token_join(tokens, spans)
    assert found.columns == ["doc_id", "pos", "word", "label"]
    want = [(d, p, "w", label) for d, s, e, label in map(tuple, spans.collect()) for p in range(s, min(e, 5000)) if p % 2 + 1 == d]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_answers_of_any_shape(spark):
    given = ['{"Location": "Wien", "Film": 7, "x": {"y": [1, null]}, "z": "é"}', '{"Date": null}', '[1, {"Film": "a"}]', '"Wien"', "12.50", "null", "{}",
             '{"a": 1', "", None, '{"Location": ["a", "b"],\n}']
    df = spark.createDataFrame(list(enumerate(given)), "doc_id int, raw string")
    found = {r.doc_id: r for r in records.answers_of_any_shape(df).withColumn("answer", F.to_json("answer")).collect()}
    assert (found[0].Location, found[0].Film, found[0].Date, found[0].extra) == ("Wien", "7", None, {"x": '{"y":[1,null]}', "z": '"é"'})
    assert [found[i].kind for i in range(len(given))] == ["object", "object", "array", "other", "other", "other", "object", None, None, None, "object"]
    assert found[1].Date is None and found[1].extra == {} and found[10].Location == '["a","b"]'
    for i, text in enumerate(given):
        if found[i].kind is None:
            assert found[i].error == "Failed to decode response" and found[i].answer is None
        else:
            assert found[i].error is None and json.loads(found[i].answer) == json.loads(text.replace(",\n}", "\n}"))
