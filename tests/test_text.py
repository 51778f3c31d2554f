import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkfold.functions import text
from inkfold.operators import ocr


def table_distance(a, b):
    """Textbook dynamic program."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abcé ", max_size=40), st.text("abcé ", max_size=40))
def test_edit_distance_equals_table(a, b):
    assert text.edit_distance(a, b) == table_distance(a, b)


def test_edit_distance_long():
    rng = random.Random(1)
    for size in (63, 64, 65, 200, 700):
        for rate in (0.02, 0.3, 0.9):
            a = [rng.choice("abcdefgh") for _ in range(size)]
            b = [rng.choice("abcdefgh") if rng.random() < rate else c for c in a if rng.random() > rate / 3]
            assert text.edit_distance(a, b) == table_distance(a, b)
            assert text.edit_distance(b, a) == table_distance(a, b)
        noise = [rng.choice("abcdefgh") for _ in range(size // 3)]
        assert text.edit_distance(a, noise) == table_distance(a, noise)


def test_band_agrees_with_table():
    rng = random.Random(3)
    for size in (150, 600, 1300):
        for rate in (0.0, 0.01, 0.05, 0.2, 0.5):
            a = "".join(rng.choice("abcdefghijklm") for _ in range(size))
            b = "".join(rng.choice("abcdefghijklm") if rng.random() < rate else c for c in a if rng.random() > rate / 2)
            b = b[rng.randint(0, 9):] + "x" * rng.randint(0, 9)
            long, short = (a, b) if len(a) >= len(b) else (b, a)
            places = {c: [i for i, d in enumerate(long) if c == d] for c in set(long)}
            want = table_distance(a, b)
            gap, cut = len(long) - len(short), text._match_cutter(places, len(long))
            assert text._distance_in_table(cut, len(long), short) == want
            assert text.edit_distance(a, b) == want
            for side in (0, 1, 5, 40, 300):
                found = text._distance_in_band(cut, gap, short, side)
                assert found == (want if want <= gap + 2 * side else None)


def test_items_beyond_the_kept_bits(monkeypatch):
    monkeypatch.setattr(text, "_KEPT_BITS", 0)
    rng = random.Random(6)
    a, b = ([rng.randint(0, 400) for _ in range(n)] for n in (700, 650))
    assert text.edit_distance(a, b) == table_distance(a, b)
    a, b = "".join(rng.choice("abcdef") for _ in range(3000)), "".join(rng.choice("abcdef") for _ in range(40))
    near = a[:900] + b + a[960:]
    assert text.edit_distance(a, near) == table_distance(a, near)  # in the band


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
def test_count_edits(a, b):
    hits, subs, dels, ins = text.count_edits(a, b)
    assert subs + dels + ins == table_distance(a, b)
    assert hits + subs + dels == len(a) and hits + subs + ins == len(b)
    assert min(hits, subs, dels, ins) >= 0


def score(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, gt string, et string")
    return [tuple(r) for r in ocr.score_texts(df).orderBy("i").select("wer", "cer").collect()]


def test_rates_by_hand(spark):
    found = score(spark, [
        ("one two three", "one two three"),   # equal
        ("a b", "a x b y z"),                 # above 1
        ("", "abc"), (" \n", "abc"),          # empty truth
        ("ab cd", ""),                        # empty result
        ("a\nb c", "a b c"),                  # a lone newline stays in its word
        ("  a   b  ", "a b"),                 # runs and ends do not count for words
        ("é", "e"), (None, "a"),
    ])
    assert found[0] == (0.0, 0.0)
    assert found[1][0] == 1.5 and found[1][1] == 2.0
    assert found[2] == (None, None) and found[3] == (None, None)
    assert found[4] == (1.0, 1.0)
    assert found[5][0] == 1.0  # truth has 2 words: "a\nb" substituted, one inserted
    assert found[6] == (0.0, 2 / 5)
    assert found[7] == (1.0, 1.0) and found[8] == (None, None)


def test_short_and_long_forms_agree(spark, monkeypatch):
    rng = random.Random(2)
    pairs = []
    for _ in range(60):
        a = " ".join(rng.choice(["ink", "blot", "folio", "é", "x", "wörter"]) for _ in range(rng.randint(1, 60)))
        pairs.append((a, "".join(c for c in a if rng.random() > 0.1)))
    normal = score(spark, pairs)
    monkeypatch.setattr(text, "NATIVE_CHARS", 0)
    assert score(spark, pairs) == normal
    for (gt, et), (w, c) in zip(pairs, normal):
        truth = [x for x in gt.split(" ") if x]
        assert abs(w - table_distance(truth, [x for x in et.split(" ") if x]) / len(truth)) < 1e-12
        assert abs(c - table_distance(gt.strip(), et.strip()) / len(gt.strip())) < 1e-12


def test_documents_against_table(spark, fx):
    """Whole documents, non-ASCII ones too, against the textbook program."""
    docs = fx.documents().where(F.length("gt") < 700).withColumn("et", F.regexp_replace("gt", "[aeo]", ""))
    rows = ocr.score_texts(docs).collect()
    assert len(rows) > 20 and any(not r["gt"].isascii() for r in rows)
    for r in rows:
        assert abs(r["cer"] - table_distance(r["gt"].strip(), r["et"].strip()) / len(r["gt"].strip())) < 1e-12


def test_longest_documents_agree_with_spark(spark, fx):
    docs = fx.documents().where(F.length("gt").between(2500, 6000)).select(
        "gt", F.regexp_replace("gt", "[aeo]", "").alias("et")).repartition(16)
    bad = docs.where(text.char_edits(F.col("gt"), F.col("et")) != F.levenshtein(
        text.strip_ends(F.col("gt")), text.strip_ends(F.col("et"))))
    assert docs.count() > 0 and bad.count() == 0


def brute_stats(a, b):
    """Fewest edits, then fewest substitutions, by the full table."""
    row = [(j, 0) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        new = [(i, 0)]
        for j, y in enumerate(b, 1):
            e, s = row[j - 1]
            new.append(min((e, s) if x == y else (e + 1, s + 1), (row[j][0] + 1, row[j][1]), (new[j - 1][0] + 1, new[j - 1][1])))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=14), st.lists(st.sampled_from("abcd"), max_size=14))
def test_count_edits_has_fewest_substitutions(a, b):
    hits, subs, dels, ins = text.count_edits(a, b)
    assert (subs + dels + ins, subs) == brute_stats(a, b)


def test_sweep_scores_equal_single_scores(spark, fx):
    from inkfold.plans.fixtures import SETTINGS

    docs = fx.documents().where(F.length("gt") < 3000).unionByName(
        spark.createDataFrame([(-1, None), (-2, ""), (-3, " a  b\n")], "doc_id bigint, gt string"))
    edits = {k: edit(F.col("gt")) for k, edit in SETTINGS.items()} | {"none": F.lit(None).cast("string")}
    def rows(df):
        return sorted((r["doc_id"], r["config"], r["wer"], r["cer"]) for r in df.select("doc_id", "config", "wer", "cer").collect())
    assert str(rows(ocr.sweep_scores(docs, edits))) == str(rows(ocr.score_texts(ocr.config_sweep(docs, edits))))


def test_edit_stats_equals_word_edits(spark, fx):
    docs = fx.documents().withColumn("et", F.regexp_replace("gt", "[aeo]", "")).repartition(16)
    s = text.edit_stats(F.col("gt"), F.col("et"))
    bad = docs.select(s.alias("s"), text.word_edits(F.col("gt"), F.col("et")).alias("w")).where(
        "s.substitutions + s.deletions + s.insertions <> w")
    assert bad.count() == 0


def test_python_white_space(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    df = spark.createDataFrame([(f"{c}a{c}{c}b{c}",) for c in spaces], "t string")
    assert {r[0] for r in df.select(text.text_normalize(F.col("t"))).collect()} == {"a b"}


def test_order_and_partitions_do_not_matter(spark, fx):
    docs = fx.documents().withColumn("et", F.lower("gt")).withColumn("config", F.lit("c"))
    one = ocr.ocr_error_summary(ocr.score_texts(docs.coalesce(1))).collect()
    many = ocr.ocr_error_summary(ocr.score_texts(docs.orderBy(F.rand(1)).repartition(7))).collect()
    assert one == many


@settings(deadline=None, max_examples=300)
@given(st.lists(st.sampled_from("abcd"), max_size=14), st.lists(st.sampled_from("abcd"), max_size=14))
def test_common_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above, row = row, [0]
        for j, y in enumerate(b):
            row.append(max(row[-1], above[j + 1], above[j] + (x == y)))
    assert text.common_length(a, b) == row[-1]


def _pairs_of_all_kinds(rng):
    pairs = []
    for size in (0, 1, 5, 63, 64, 65, 100, 128, 130, 200) * 12:
        letters = rng.choice(["ab", "abcdefgh", "\x00aé一😀"])
        a = "".join(rng.choice(letters) for _ in range(size))
        b = "".join(c if rng.random() > 0.2 else rng.choice(["", c + "x", "b"]) for c in a)
        pairs.append((a, b if rng.random() < 0.7 else "".join(rng.choice(letters) for _ in range(rng.randrange(150)))))
    return pairs


def test_pairs_compared_together_equal_table(monkeypatch):
    pairs = _pairs_of_all_kinds(random.Random(1))
    want = [table_distance(a, b) for a, b in pairs]
    assert text.batch_distances(pairs) == want
    monkeypatch.setattr(text, "BATCH_PAIRS", 7)
    assert text.distances(pairs) == want
    assert text.distances([(list(a), list(b)) for a, b in pairs]) == want
    assert text.distances([]) == [] and text.batch_count_edits([]) == []
    lists = [(list(a)[:64], list(b)[:64]) for a, b in pairs]
    assert text.batch_count_edits(lists) == [text.count_edits(a, b) for a, b in lists]
    # Texts held at once are bounded, whatever the batch.
    assert [len(s) for s in text._stretches([(1,)] * 5 + [(9 << 20,), (1,)], lambda r: r[0])] == [5, 1, 1]


def test_settled_distance_is_the_distance():
    rng, settled = random.Random(2), 0
    for a, b in _pairs_of_all_kinds(rng):
        a, b = (a, b) if len(a) >= len(b) else (b, a)
        found = text.settled_distance(a, b)
        settled += found is not None
        assert found in (None, table_distance(a, b))
    words = [f"w{rng.randrange(80)}" for _ in range(3000)]
    result = ["?" if w in ("w3", "w7") else w for w in words if w != "w5"]
    assert text.settled_distance(words, result) == sum(w in ("w3", "w5", "w7") for w in words)
    assert text.settled_distance("abcab" * 50, "acb" * 60) is None and settled


def test_edits_beside_long_texts_need_no_table(monkeypatch):
    """Letters left out, replaced, put in: a few passes over the text, no column per item."""
    monkeypatch.setattr(text, "_distance_in_table", None)
    monkeypatch.setattr(text, "_distance_in_band", None)
    truth = "and so on. the hour is late. " * 400
    assert text.edit_distance(truth, truth.replace("o", "")) == truth.count("o")
    assert text.edit_distance(truth, truth.replace("o", "?")) == truth.count("o")
    assert text.edit_distance(truth, truth.replace(". ", ". ? ")) == 2 * truth.count(". ")
