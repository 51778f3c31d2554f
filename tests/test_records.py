import json

import pytest
from pyspark.sql import functions as F

from inkfold import schemas
from inkfold.functions.fixed_values import FIELDS
from inkfold.operators import captions, joins, records


def test_json_rules_follow_pythons_parser(spark):
    raw = ['{"Film":"a"}', '{"Film":"a",\n}', '{"Film":"a"} tail', "{'Film':'a'}", '{"Film":"a","Film":"b"}', "",
           '{"Film":"a"}}', '{"Film":"a"}]', '{"Film":"a"},{"Film":"b"}', '{"Film":', '{Film:"a"}', '{"Film":null}',
           '  {"Film":"ü"}\n', '{"Film":"a"\n"Date":"b"}', '{"Film":"a\nb"}', '{"Other":{"x":[1,2]}}', '{"a":1,"b":2}', None]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, raw string")
    got = {r["i"]: r for r in records.json_repair_parse(df).collect()}
    for i, text in enumerate(raw):
        try:
            want = json.loads(text.replace(",\n}", "\n}"))
        except (ValueError, AttributeError):
            assert got[i]["error"] == "Failed to decode response", text
            assert all(got[i][f] is None for f in FIELDS)
        else:
            assert got[i]["error"] is None, text
            assert [got[i][f] for f in FIELDS] == [want.get(f) for f in FIELDS], text


def test_null_counts_as_match_and_error_record_compares_as_null(spark):
    a = spark.createDataFrame([(1, None, "x", "", "p q", None, None)], schemas.KEYED_RECORD)
    b = spark.createDataFrame([(1, None, "x", None, "p", None, "Failed to decode response"),
                               (2, None, "x", None, "p", None, None)], schemas.KEYED_RECORD)
    rows = records.compare_records(a, b).collect()
    assert len(rows) == 1
    row = rows[0].asDict()
    assert row["Location_match"] and row["Description_match"] and not row["Date_match"]
    assert row["Photographer_wer"] == 0.5 and row["Location_wer"] is None and row["Date_wer"] is None
    assert not row["Date_a_not_empty"] and not row["Location_a_not_empty"]
    means = records.field_wer_means(records.compare_records(a, b)).collect()
    assert all(m["mean_wer"] is None for m in means)  # no complete row is left


def test_field_get_default(spark):
    df = spark.sql("select map('a', cast(null as string), 'b', 'x') m")
    get = lambda f, d=None: records.field_get_default(F.col("m"), f, d)
    assert df.select(get("a", ""), get("b", ""), get("c", ""), get("c")).first()[:] == (None, "x", "", None)


def test_entity_record_order_across_stretches(spark, monkeypatch):
    rows = [(1, i, "LOC", f"t{i}") for i in range(50)] + [(1, 3, "MISC", "m"), (2, 0, "FILM", "f")]
    df = spark.createDataFrame(rows, "doc_id bigint, start int, label string, text string").orderBy(F.rand(3))
    monkeypatch.setattr(records, "CHUNK", 7)
    got = {r["doc_id"]: r for r in records.entity_record(df).collect()}
    assert got[1]["Location"] == " ".join(f"t{i}" for i in range(50))
    assert got[1]["Description"] == "m" and got[1]["Date"] is None and got[2]["Film"] == "f"


def test_conversation_is_one_row_at_any_length(spark):
    df = spark.range(5000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    df = df.unionByName(spark.createDataFrame([(2, 1, "user", "b"), (2, 0, "user", "a"), (2, None, "user", None)], df.schema.simpleString()[7:-1].replace(":", " ")))
    rows = {r["conv_id"]: [m["content"] for m in r["messages"]] for r in records.conversation_fold(df).collect()}
    assert rows == {1: [str(i) for i in range(5000)], 2: [None, "a", "b"]}
    small = {r["conv_id"]: [m["content"] for m in r["messages"]] for r in records.conversation_fold(df, chunk=7).collect()}
    assert small == rows


def test_messages(spark):
    m = spark.sql("select 'hi' t").select(records.build_messages(F.col("t"), "Name the film.").alias("m")).first()["m"]
    assert [tuple(x) for x in m] == [("system", "Name the film."), ("user", "hi")]


def spans(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    return sorted(tuple(s) for s in captions.token_pattern_match(df).first()["spans"])


@pytest.mark.parametrize("text, want", [
    ("", []), ("   ", []),
    ("Mai 1948", [(0, 2, "DATE"), (1, 2, "DATE")]),
    ("May 1948", [(0, 2, "DATE"), (1, 2, "DATE")]),
    ("Nov. 1948", [(0, 2, "DATE"), (1, 2, "DATE")]),
    ("mai 194", []), ("Mai 19480", []),
    ("Aufn. Müller", []), ("Aufn. Lindtaler", [(0, 2, "PERSON")]), ("Aufn Lindtaler", []),
    ("Film", []), ("Film Ö 1", []), ("FILM a b Ö c", [(0, 3, "FILM")]),
    ("Rollfilm film x", [(0, 3, "FILM"), (1, 3, "FILM")]),
    ("x\n Film\t12 ", [(1, 3, "FILM")]),
])
def test_caption_rules(spark, text, want):
    assert spans(spark, text) == want


def brute_longest(spans):
    kept = []
    for s in sorted(spans, key=lambda s: (s[0] - s[1], *s)):
        if not any(k[0] < s[1] and s[0] < k[1] for k in kept):
            kept.append(s)
    return sorted(kept)


def test_longest_match_both_forms(spark, monkeypatch):
    import random

    rng = random.Random(5)
    cases = []
    for i in range(40):
        found = set()
        for _ in range(rng.randint(0, 12)):
            start = rng.randint(0, 30)
            found.add((start, start + rng.randint(0, 9), rng.choice(["PERSON", "DATE"])))
        cases.append((i, sorted(found, key=lambda _: rng.random())))
    # Equal spans of two labels and empty spans, on both sides of the limit.
    for i, n in ((40, 61), (41, 62), (42, 70)):
        fill = [(10 + 3 * j, 12 + 3 * j, "FILM") for j in range(n)]
        cases.append((i, [(0, 2, "PERSON"), (0, 2, "DATE"), (2, 2, "X"), (11, 11, "Y"), *fill][:n + 3]))
    df = spark.createDataFrame(cases, f"i int, spans array<{schemas.SPAN}>")
    want = {i: brute_longest(s) for i, s in cases}
    for limit in (64, -1):
        monkeypatch.setattr(captions, "NATIVE_SPANS", limit)
        got = {r["i"]: [tuple(s) for s in r["spans"]] for r in captions.longest_match_resolve(df).collect()}
        assert got == want


def test_pair_files(spark):
    images = spark.createDataFrame([("a.png",), ("b.png",), ("b.jpg",), ("c.png",), (".d.png",)], "name string")
    gts = spark.createDataFrame([("a_gt.tif",), ("b_gt.tif",), ("c.tif",)], "name string")
    got = {r["key"]: (r["n_images"], r["n_masks"], r["valid"]) for r in joins.pair_files(images, gts).collect()}
    assert got == {"a": (1, 1, True), "b": (2, 1, False), "c": (1, 0, False)}


def test_unpaired_keys(spark):
    a, b = spark.range(0, 5).toDF("doc_id"), spark.range(3, 7).toDF("doc_id")
    got = {tuple(r) for r in joins.unpaired_keys(a, b).collect()}
    assert got == {(0, "result"), (1, "result"), (2, "result"), (5, "truth"), (6, "truth")}
