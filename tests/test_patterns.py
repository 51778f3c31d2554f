"""Token patterns as data against a search over all ways to take the steps."""

import random

import pytest
from pyspark.sql import functions as F

from inkfold.operators import captions, patterns

CHECKS = {"a": lambda t: t == "a", "b": lambda t: t == "b", "ab": lambda t: t in "ab", "any": lambda t: True}
STEPS = {"a": {"TEXT": "a"}, "b": {"LOWER": "b"}, "ab": {"TEXT": {"IN": ["a", "b"]}}, "any": {}}


def furthest(tokens, at, steps):
    """The furthest end over all ways, by trying them."""
    if not steps:
        return at
    name, often = steps[0]
    fit = at < len(tokens) and CHECKS[name](tokens[at])
    ways = []
    if often == "!":
        return furthest(tokens, at + 1, steps[1:]) if at < len(tokens) and not fit else -1
    if often in "?*":
        ways.append(furthest(tokens, at, steps[1:]))
    if fit:
        ways.append(furthest(tokens, at + 1, steps[1:]))
        if often in "+*":
            ways.append(furthest(tokens, at + 1, [(name, "*"), *steps[1:]]))
    return max(ways, default=-1)


@pytest.mark.parametrize("native", [0, 64])
def test_quantifiers_match_a_search(spark, monkeypatch, native):
    monkeypatch.setattr(patterns, "NATIVE_TOKENS", native)
    rng = random.Random(3)
    lists = [[(rng.choice(list(STEPS)), rng.choice("1?+*!")) for _ in range(rng.randint(1, 4))] for _ in range(12)]
    lists.append([("a", "+"), ("ab", "*"), ("b", "?"), ("any", "!")])
    given = [{"label": str(i), "pattern": [{**STEPS[n], "OP": o} for n, o in steps]} for i, steps in enumerate(lists)]
    texts = [" ".join(rng.choice("aabbc") for _ in range(rng.randint(0, 9))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in patterns.token_pattern_list(df, given).collect():
        tokens = texts[r.doc_id].split()
        want = {(i, end, str(k)) for k, steps in enumerate(lists) for i in range(len(tokens)) if (end := furthest(tokens, i, steps)) > i}
        assert [tuple(s) for s in r.spans] == sorted(want)


ODD = ["", None, "Mai 1938 Aufn. Lindner Film 12 ZV Übersicht", "1938 Nov. 1940", "FILM", "film ä", "Rollfilm Film film x", "Aufn. Müller Aufn. Maier",
       "März 19384 Feber 1901 " * 40, "film " * 70, "Mai 1938 " * 33 + "1940"]


def test_caption_rules_given_as_a_list(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id int, text string")
    listed = {r.doc_id: r.spans for r in patterns.token_pattern_list(df).collect()}
    rules = {r.doc_id: r.spans for r in captions.token_pattern_match(df).collect()}
    assert {k: v and sorted(map(tuple, v)) for k, v in listed.items()} == {k: v and sorted(map(tuple, v)) for k, v in rules.items()}
    # More than 64 spans, resolved like those of the written rules.
    assert len(listed[len(ODD) - 1]) == 67
    kept = captions.longest_match_resolve(patterns.token_pattern_list(df)).collect()
    assert {r.doc_id: r.spans for r in kept} == {r.doc_id: r.spans for r in captions.longest_match_resolve(captions.token_pattern_match(df)).collect()}


def test_long_caption_costs_its_tokens(spark):
    df = spark.range(1).select(F.lit(1).alias("doc_id"), F.array_join(F.array_repeat(F.lit("film"), 20_000), " ").alias("text"))
    row, = patterns.token_pattern_list(df, [{"label": "F", "pattern": [{"IS_ASCII": True, "OP": "+"}, {"LENGTH": 4, "OP": "*"}]}]).collect()
    assert len(row.spans) == 20_000 and tuple(row.spans[7]) == (7, 20_000, "F")


def test_more_attributes_than_bits_and_phrases(spark):
    given = [{"label": f"w{i}", "pattern": f"w{i} x"} for i in range(70)]
    df = spark.createDataFrame([(1, "w3 x w69 x w69 y w50 x")], "doc_id int, text string")
    row, = patterns.token_pattern_list(df, given).collect()
    assert len(patterns.compile_patterns(given)) == 2
    assert [tuple(s) for s in row.spans] == [(0, 2, "w3"), (2, 4, "w69"), (6, 8, "w50")]
    assert patterns.token_pattern_list(df, []).first().spans == []


@pytest.mark.parametrize("attributes,fitting", [
    ({"IS_DIGIT": True}, ["12"]), ({"IS_UPPER": True}, ["Ä1", "X"]), ({"IS_TITLE": True}, ["Über", "X", "Ä1"]), ({"IS_ASCII": False}, ["Über", "Ä1"]),
    ({"LENGTH": {">=": 2, "<": 4}}, ["12", "Ä1", "abc"]), ({"TEXT": {"NOT_IN": ["12", "X"]}, "IS_LOWER": False}, ["Über", "Ä1"]),
    ({"LOWER": {"REGEX": "^ü"}}, ["Über"]), ({"IS_ALPHA": True, "LENGTH": 1}, ["X"])])
def test_attributes(spark, attributes, fitting):
    df = spark.createDataFrame([(t,) for t in ["12", "Über", "X", "Ä1", "abc"]], "t string")
    assert sorted(r.t for r in df.where(patterns.fits(F.col("t"), attributes)).collect()) == sorted(fitting)


@pytest.mark.parametrize("wrong", [{"IS_BLUE": True}, {"TEXT": {"FUZZY": "x"}}, {"TEXT": "a", "OP": "{2}"}, {"LENGTH": {}}])
def test_unknown_patterns_are_refused(spark, wrong):
    with pytest.raises(ValueError):
        patterns.token_pattern_list(spark.createDataFrame([("a",)], "text string"), [{"label": "x", "pattern": [wrong]}])
