"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkfold.functions import text, vectors
from inkfold.functions.fixed_values import FIELDS
from inkfold.operators import captions as C
from inkfold.operators import inference, joins, masks, ocr, pages, patterns, ranking, records, scores, similarity
from inkfold.operators import pixels as P
from inkfold.plans.fixtures import KNOWN_SETTINGS, SETTINGS, Fixtures, drop_words, mask_letters
from inkfold.sources import blobs, files, runs
from inkfold.streaming import files as arriving

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    REGISTRY[fn.__name__] = lambda spark, sf_dir: fn(Fixtures(spark, sf_dir))
    return fn


def r6(column) -> F.Column:
    return F.round(column, 6)


def partitions(spark: SparkSession) -> int:
    """Parts for work that costs far more than its shuffle."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def dealt(fx: Fixtures, df: DataFrame, source: str = "documents") -> DataFrame:
    """Rows dealt out evenly where the scan of ``source`` has too few splits to keep the cores busy.

    A table of many splits is left as it is: its rows are not shuffled.
    """
    if fx.table(source).rdd.getNumPartitions() >= fx.spark.sparkContext.defaultParallelism:
        return df
    return df.repartition(partitions(fx.spark))


# Rows scored in one task: captions under all settings, and whole documents.
SCORED_CAPTIONS, SCORED_DOCUMENTS = 50_000, 500


def dealt_by_rows(fx: Fixtures, df: DataFrame, source: str, rows: int) -> DataFrame:
    """Rows dealt out evenly, about ``rows`` of ``source`` to a task, for work that costs far more than its shuffle.

    The tasks grow with the table. Neither the splits of a scan nor the parts behind a join say
    how the rows lie: splits may hold no row group, and parts are merged by size.
    """
    return df.repartition(max(partitions(fx.spark), -(-fx.table(source).count() // rows)))


def kept(fx: Fixtures, df: DataFrame, name: str) -> DataFrame:
    """Stored once in the shared folder, for results that are dear and read twice."""
    folder = files.work_folder(fx.spark, name)
    df.write.parquet(folder)
    return fx.spark.read.parquet(folder)


# Sources and sinks --------------------------------------------------------


@query
def text_scan(fx):
    folder = files.work_folder(fx.spark, "text_scan")
    files.text_sink(fx.table("documents"), folder, one_file_per_key=True)
    scanned = files.text_scan(fx.spark, folder, key_folder="doc_id")
    # Small files come one per partition: fewer tasks read several each.
    scanned = scanned.coalesce(partitions(fx.spark))
    return scanned.select("doc_id", F.regexp_replace("text", "\n\\z", "").alias("text"))


def _file_names(fx):
    """File names from page addresses; pages with parameters stand for hidden files."""
    number = F.regexp_extract("url", "/([0-9]+)[^/]*$", 1)
    return fx.table("pages").select("page_id", F.concat(
        F.when(F.contains("url", F.lit("?")), ".").otherwise(""), F.lit("img_"), number,
        F.when(F.startswith("url", F.lit("https")), ".jpg").otherwise(".png")).alias("name"))


@query
def file_filter(fx):
    return files.file_filter(_file_names(fx))


@query
def file_key(fx):
    name = F.col("name")
    return _file_names(fx).select("page_id", files.file_key(name).alias("key"), files.file_stem(name).alias("stem"))


@query
def pixel_table(fx):
    return P.image_to_pixels(P.pixels_to_image(fx.pixels()))


@query
def json_sink(fx):
    folder = files.work_folder(fx.spark, "json_sink")
    files.json_sink(fx.records_a(), folder)
    return files.json_source(fx.spark, folder).drop("error")


@query
def json_source(fx):
    folder = files.work_folder(fx.spark, "json_source")
    files.json_sink(fx.records_b(), folder)
    return files.json_source(fx.spark, folder).select("doc_id", *FIELDS)


@query
def csv_sink(fx):
    folder = files.work_folder(fx.spark, "csv_sink")
    words = similarity.similar_words_text(similarity.similar_words(similarity.similar_token_join(fx.token_vectors())))
    files.csv_sink(words, folder)
    return files.csv_source(fx.spark, folder, "word string, similar_words string")


@query
def text_sink(fx):
    folder = files.work_folder(fx.spark, "text_sink")
    files.text_sink(fx.table("documents"), folder)
    return fx.spark.read.parquet(folder)


@query
def image_sink(fx):
    folder = files.work_folder(fx.spark, "image_sink")
    files.image_sink(P.pixels_to_image(fx.pixels()), folder)
    return P.image_to_pixels(fx.spark.read.parquet(folder))


@query
def image_scan(fx):
    """Images written as files, every fiftieth cut off in the middle, read back with the broken ones named."""
    folder = files.work_folder(fx.spark, "image_scan")
    images = P.pixels_to_image(fx.pixels())
    content = blobs.png_content(F.col("height"), F.col("width"), F.col("data"))
    rows = images.select("img_id", F.concat(F.lit("img_"), F.col("img_id"), F.lit(".png")).alias("name"), content.alias("content"))
    cut = F.expr("substring(content, 1, length(content) div 2)")
    blobs.blob_sink(rows.withColumn("content", F.when(F.col("img_id") % 50 == 7, cut).otherwise(F.col("content"))), folder)
    # Small files come one per partition: fewer tasks read several each.
    found = blobs.image_files(fx.spark, folder).coalesce(partitions(fx.spark))
    return found.select("name", "img_id", "broken", "image.height", "image.width", F.hex("image.data").alias("pixels"))


@query
def overwrite_output(fx):
    folder = files.work_folder(fx.spark, "overwrite_output")
    docs = fx.table("documents").select("doc_id", "lang", "n_chars")
    files.overwrite_output(docs, folder, "lang")
    files.overwrite_output(docs, folder, "lang")
    return fx.spark.read.parquet(folder).select("doc_id", "lang", "n_chars")


# Projections and filters --------------------------------------------------


@query
def detection_class_filter(fx):
    return fx.boxes().where(F.col("cls").isin(2))


@query
def has_vector_filter(fx):
    known = fx.token_vectors().withColumn("vec", F.when(F.get("vec", F.lit(0)) > 0, F.col("vec")))
    return similarity.has_vector(known).select("doc_id", "pos", "word")


@query
def field_get_default(fx):
    # A record without its absent fields, as a map.
    as_map = F.from_json(F.to_json(F.struct(*FIELDS)), "map<string,string>")
    found = fx.records_b().withColumn("record", as_map)
    return found.select("doc_id", records.field_get_default(F.col("record"), "Film").alias("film"),
                        records.field_get_default(F.col("record"), "Film", "").alias("film_or_blank"),
                        records.field_get_default(F.col("record"), "Photographer", "").alias("photographer_or_blank"))


def _pairs(fx):
    return joins.record_pair_join(fx.records_a(), fx.records_b(), FIELDS)


@query
def non_empty_flags(fx):
    return _pairs(fx).select("doc_id", *[
        records.non_empty(F.col(f"{f}_{s}")).alias(f"{f}_{s}_not_empty") for f in FIELDS for s in "ab"])


@query
def field_match(fx):
    return _pairs(fx).select("doc_id", *[
        records.field_match(F.col(f"{f}_a"), F.col(f"{f}_b")).alias(f"{f}_match") for f in FIELDS])


@query
def label_to_field(fx):
    return fx.entities().select("doc_id", "start", records.label_to_field(F.col("label")).alias("field"))


@query
def pixel_scale(fx):
    return P.pixel_scale(fx.pixels()).withColumn("value", r6("value"))


@query
def mask_encode(fx):
    raw = F.col("v") - F.col("v") % 32
    return fx.pixels().select("img_id", "y", "x", masks.mask_encode(raw, [0, 64, 96, 128, 160]).alias("cls"))


@query
def mask_decode(fx):
    cls = F.col("cls_gt")
    return fx.masks().select(
        "img_id", "y", "x", masks.mask_decode(cls, [0, 128]).alias("value"), masks.mask_decode(cls, [0, 1]).alias("flag"),
        F.array_join(masks.mask_decode(cls, [[0, 0, 0], [10, 20, 30]]), ",").alias("rgb"))


@query
def logits_to_mask(fx):
    first = F.array(F.get("logits", F.lit(0)))
    return fx.logits().select(
        "img_id", "y", "x", masks.logits_to_mask(F.col("logits"), 3).alias("cls"),
        masks.logits_to_mask(first, 1).alias("ink"), masks.logits_to_mask(first, 1, 0.7).alias("sure_ink"))


@query
def mask_checks(fx):
    # Pixels darker than 60 are missing from the mask.
    image = fx.pixels().select("img_id", "y", "x").withColumn("in_image", F.lit(True))
    mask = fx.masks().join(fx.pixels(), ["img_id", "y", "x"]).where("v >= 60").select(
        "img_id", "y", "x", F.when(F.col("v") > 200, 3).otherwise(F.col("cls_gt")).alias("cls"), F.lit(True).alias("in_mask"))
    pairs = image.join(mask, ["img_id", "y", "x"], "full").na.fill(False, ["in_image", "in_mask"])
    return masks.mask_checks(pairs, "cls", 3)


@query
def mask_resize_nearest(fx):
    classes = fx.masks().select("img_id", "y", "x", F.col("cls_gt").alias("v"))
    return P.mask_resize_nearest(classes, 0.7)


def _colour_images(fx):
    """Image rows as Spark's ``image`` source gives them, three channels from one value."""
    v = F.col("v")
    cell = F.concat(F.char(v), F.char(v * 3 % 256), F.char(255 - v))
    lines = fx.pixels().groupBy("img_id", "y").agg(F.array_sort(F.collect_list(F.struct("x", cell.alias("c")))).alias("cells"))
    rows = lines.groupBy("img_id").agg(F.array_sort(F.collect_list(F.struct(
        "y", F.array_join(F.transform("cells", lambda s: s["c"]), "").alias("line")))).alias("lines"))
    data = F.encode(F.array_join(F.transform("lines", lambda s: s["line"]), ""), "ISO-8859-1")
    size = F.lit(8)
    return rows.select("img_id", F.struct(F.lit("").alias("origin"), size.alias("height"), size.alias("width"), F.lit(3).alias("nChannels"),
                                          F.lit(16).alias("mode"), data.alias("data")).alias("image"))


@query
def gray(fx):
    return P.gray(_colour_images(fx))


@query
def gray_images(fx):
    return P.image_to_pixels(pages.gray_images(_colour_images(fx)))


@query
def pixel_flip(fx):
    coin = F.col("img_id") % 2 == 1
    return P.pixel_flip(fx.pixels(), horizontal=coin, vertical=~coin, augment=F.col("img_id") % 4 < 2)


# Joins --------------------------------------------------------------------


def _labelled_texts(fx):
    """Extracted texts: only labelled documents have one."""
    texts = fx.table("documents").join(fx.table("labels").select("doc_id").distinct(), "doc_id", "left_semi")
    return texts.select("doc_id", SETTINGS["drop vowels"](F.col("text")).alias("et"))


@query
def truth_join(fx):
    return joins.truth_join(fx.documents(), _labelled_texts(fx)).select(
        "doc_id", F.length("gt").alias("gt_chars"), F.length("et").alias("et_chars"))


@query
def unpaired_keys(fx):
    return joins.unpaired_keys(fx.documents(), _labelled_texts(fx))


@query
def image_mask_join(fx):
    return joins.image_mask_join(fx.pixels(), fx.masks().select("img_id", "y", "x", "gt"))


@query
def image_mask_files(fx):
    images = fx.table("embeddings")
    number = F.col("vec_id").cast("string")
    names = images.select(F.concat(F.lit("img"), number, F.lit(".png")).alias("name"))
    gts = images.where("label <> 3").select(
        F.concat(F.lit("img"), number, F.when(F.col("label") == 5, "_other").otherwise("_gt"), F.lit(".tif")).alias("name"))
    return joins.pair_files(names, gts)


@query
def record_pair_join(fx):
    return _pairs(fx)


@query
def similar_token_join(fx):
    return similarity.similar_token_join(fx.token_vectors()).withColumn("cosine", F.round("cosine", 5))


@query
def similar_token_join_by_angle(fx):
    """The same rows from clusters of like vectors, in blocks small enough that documents have several."""
    found = similarity.similar_token_join(fx.token_vectors(), block_words=16, by_angle=True)
    return found.withColumn("cosine", F.round("cosine", 5))


@query
def vector_lookup(fx):
    words = fx.table("benchmark").select(F.explode(F.split("text", " ")).alias("word")).where("word <> ''").distinct()
    vocabulary = words.withColumn("vec", F.array(F.length("word").cast("float"), F.ascii("word").cast("float")))
    found = joins.vector_lookup(fx.tokens(), vocabulary)
    return found.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.sum(F.col("vec")[0]).alias("chars"), F.sum(F.col("vec")[1] * F.col("pos")).alias("weight"))


@query
def crop_boxes(fx):
    return P.crop_boxes(fx.pixels(), fx.boxes())


@query
def crop_boxes_padded(fx):
    return P.crop_boxes(fx.pixels(), fx.boxes(), gain=1.02, pad=2.0)


@query
def pixel_window_join(fx):
    near = P.pixel_window_join(fx.pixels(), 4)
    return near.groupBy("img_id", "y", "x").agg(
        F.count("*").alias("n"), F.sum("nv").alias("total"), F.sum(F.col("ny") * 8 + F.col("nx")).alias("places"))


def sweep(fx, settings):
    """Mean error rates of every setting over all documents, whole texts."""
    docs = dealt_by_rows(fx, fx.documents(), "documents", SCORED_DOCUMENTS)
    return ocr.ocr_error_summary(ocr.sweep_scores(docs, {name: edit(F.col("gt")) for name, edit in settings.items()}))


@query
def config_sweep(fx):
    return sweep(fx, KNOWN_SETTINGS)


@query
def cross_scalar(fx):
    docs = fx.table("documents").select("doc_id", "n_chars")
    return joins.cross_scalar(docs, docs.agg(F.max("n_chars")), "longest")


def _entity_tokens(fx):
    return C.entity_tokens(C.longest_match_resolve(C.token_pattern_match(fx.captions())))


@query
def entity_tokens(fx):
    return _entity_tokens(fx)


@query
def entity_token_join(fx):
    """Tokens from a table of their own, so that they meet the spans in a join."""
    spans = C.span_rows(C.longest_match_resolve(C.token_pattern_match(fx.captions())), "doc_id")
    tokens = fx.captions().select("doc_id", F.posexplode(text.tokens(F.col("text"))).alias("pos", "word"))
    return C.entity_token_join(tokens, spans)


# Aggregations -------------------------------------------------------------


def _caption_settings():
    return dict(SETTINGS, **{"join sentences": lambda t: F.replace(t, F.lit(" Rollfilm"), F.lit("Rollfilm"))})


def _caption_sweep(fx):
    captions = dealt_by_rows(fx, fx.captions(), "orders", SCORED_CAPTIONS).select("doc_id", F.col("text").alias("gt"))
    return ocr.config_sweep(captions, {name: edit(F.col("gt")) for name, edit in _caption_settings().items()})


@query
def ocr_error_summary(fx):
    return ocr.ocr_error_summary(ocr.score_texts(_caption_sweep(fx)))


@query
def binarization_metrics(fx):
    found = scores.binarization_metrics(fx.masks())
    return found.select("img_id", *[r6(c).alias(c) for c in found.columns[1:]])


@query
def drdm(fx):
    return scores.drdm(fx.masks()).withColumn("drdm", r6("drdm"))


def _method_values(fx):
    """Two methods against one truth: the result as it is, and a coarser one."""
    base = fx.masks()
    coarse = base.withColumn("pred", F.when(F.col("cls_pred") == 0, 0).otherwise(255))
    long = []
    for name, table in {"fine": base, "coarse": coarse}.items():
        wide = scores.binarization_metrics(table).join(scores.drdm(table), "img_id")
        long.append(scores.long_metrics(wide, ["img_id"]).withColumn("method", F.lit(name)))
    return ocr.append_results(long)


@query
def metric_means(fx):
    return scores.metric_means(_method_values(fx), ["method"])


@query
def metric_first(fx):
    return scores.metric_means(_method_values(fx), ["method"], mode="first")


@query
def metric_pivot(fx):
    return scores.metric_pivot(scores.metric_means(_method_values(fx), ["method"]), ["fine", "coarse"])


@query
def distinct_mask_values(fx):
    return masks.distinct_mask_values(fx.pixels(), F.col("v"))


@query
def distinct_mask_triples(fx):
    triple = F.array(F.expr("v div 64"), F.expr("v div 32"), F.expr("v div 16"))
    return masks.distinct_mask_values(fx.pixels(), triple).select(F.array_join("value", ",").alias("value"))


@query
def gray_histogram(fx):
    return P.gray_histogram(fx.pixels())


@query
def otsu_threshold(fx):
    return P.otsu_threshold(fx.pixels())


@query
def l2_normalized_rates(fx):
    # Scored once; the norms and the rows read an id and two numbers.
    scored = kept(fx, ocr.score_texts(_caption_sweep(fx)).select("config", "doc_id", "wer", "cer"), "scores")
    found = ocr.l2_normalized_rates(scored, ["wer", "cer"], by="config")
    return found.select("config", "doc_id", r6("wer_norm").alias("wer_norm"), r6("cer_norm").alias("cer_norm"))


@query
def entity_record(fx):
    return records.entity_record(fx.entities())


@query
def similar_words(fx):
    return similarity.similar_words_text(similarity.similar_words(similarity.similar_token_join(fx.token_vectors())))


@query
def similar_word_pairs(fx):
    pairs = similarity.similar_word_pairs(similarity.similar_token_join(fx.token_vectors()))
    return pairs.withColumn("cosine", F.round("cosine", 5))


@query
def vectors_by_label(fx):
    tokens = _entity_tokens(fx).withColumn("vec", F.when(F.length("word") > 2, F.array(F.length("word").cast("float"))))
    return C.label_counts(C.vectors_by_label(tokens))


def _comparison(fx):
    return records.compare_records(fx.records_a(), fx.records_b())


@query
def answer_comparison(fx):
    """Model answers as text, every seventh cut short and every fifth with a comma too many: parsed,
    joined with the records of the rules and compared; a broken answer is a record of nulls."""
    key = F.col("doc_id")
    answer = F.to_json(F.struct(*FIELDS))
    raw = (F.when(key % 7 == 3, F.expr("left(answer, length(answer) - 1)"))
           .when(key % 5 == 2, F.replace(F.col("answer"), F.lit("}"), F.lit(",\n}"))).otherwise(F.col("answer")))
    answers = fx.records_b().select("doc_id", answer.alias("answer")).select("doc_id", raw.alias("raw"))
    parsed = records.json_repair_parse(answers)
    found = kept(fx, records.compare_records(fx.records_a(), parsed.drop("error")), "comparison")
    wers, rates = records.field_wer_means(found), records.non_empty_rates(found)
    table = records.match_rates(found).join(wers, "field").join(rates, "field")
    errors = F.lit(parsed.agg(F.count("error").alias("n")).scalar())
    return table.select("field", *[r6(c).alias(c) for c in ("match_rate", "mean_wer", "rate_a", "rate_b")], errors.alias("n_errors"))


@query
def match_rates(fx):
    return records.match_rates(_comparison(fx)).withColumn("match_rate", r6("match_rate"))


@query
def non_empty_rates(fx):
    return records.non_empty_rates(_comparison(fx)).select("field", r6("rate_a").alias("rate_a"), r6("rate_b").alias("rate_b"))


@query
def field_wer_means(fx):
    return records.field_wer_means(_comparison(fx)).withColumn("mean_wer", r6("mean_wer"))


def _ink(column: str):
    return (F.col(column) == 0).cast("int")


@query
def dice_per_mask(fx):
    return masks.dice_per_mask(fx.masks(), _ink("pred"), _ink("gt")).withColumn("dice", r6("dice"))


@query
def dice_batch(fx):
    return masks.dice_batch(fx.masks(), _ink("pred"), _ink("gt")).withColumn("dice", r6("dice"))


@query
def dice_multiclass(fx):
    return masks.dice_multiclass(fx.masks(), "cls_pred", "cls_gt", 3).withColumn("dice", r6("dice"))


@query
def dice_loss(fx):
    return masks.dice_loss(fx.masks(), _ink("pred"), _ink("gt")).withColumn("loss", r6("loss"))


@query
def dice_loss_multiclass(fx):
    return masks.dice_loss_multiclass(fx.logits(), "logits", "target").withColumn("loss", r6("loss"))


@query
def dice_bce_loss(fx):
    return masks.dice_bce_loss(fx.logits(), F.get("logits", F.lit(0)), F.col("target")).withColumn("loss", r6("loss"))


@query
def batch_mean_dice(fx):
    per_image = masks.dice_per_mask(fx.masks(), _ink("pred"), _ink("gt"))
    return masks.batch_mean_dice(per_image, 7).withColumn("dice", r6("dice"))


@query
def batch_mean_dice_multiclass(fx):
    """Validation Dice of several classes without the background: per image, per batch, over batches."""
    per_class = masks.dice_multiclass(fx.masks(), "cls_pred", "cls_gt", 3)
    return masks.batch_mean_dice(per_class, 7).withColumn("dice", r6("dice"))


@query
def word_frequency(fx):
    return ranking.word_frequency(fx.tokens())


def _spread_facts(spread):
    """What holds of principal components whatever their signs: variances, and both axes apart."""
    facts = spread.select("label", "px", "py", F.posexplode("vec").alias("i", "x"))
    per_cell = facts.groupBy("label", "i").agg(
        F.var_pop(F.col("x").cast("double")).alias("var"), F.count("*").alias("n"), F.var_pop("px").alias("vx"),
        F.var_pop("py").alias("vy"), F.covar_pop("px", "py").alias("cov"), F.avg("px").alias("mx"), F.avg("py").alias("my"))
    near = [F.max(F.abs(c)) < 1e-9 for c in ("cov", "mx", "my")]
    return per_cell.groupBy("label").agg(
        F.max("n").alias("n"), F.round(F.sum("var"), 5).alias("variance"), (near[0] & near[1] & near[2]).alias("centred_and_apart"),
        ((F.max("vx") >= F.max("vy")) & (F.max("vx") + F.max("vy") <= F.sum("var") * (1 + 1e-9))
         & (F.max("vx") >= F.max("var") * (1 - 1e-9))).alias("largest_first"))


@query
def label_spread(fx):
    named = fx.table("embeddings").withColumn("label", F.when(F.col("label") != 4, F.col("label")))
    return _spread_facts(similarity.label_spread(named, "label", "embedding"))


@query
def label_spread_wide(fx):
    """The same facts without a matrix of the vectors' size squared."""
    named = fx.table("embeddings").withColumn("label", F.when(F.col("label") != 4, F.col("label")))
    return _spread_facts(similarity.label_spread_wide(named, "label", "embedding"))


@query
def word_spread(fx):
    """The view of all word vectors together."""
    words = fx.token_vectors().withColumn("label", F.lit("all"))
    return _spread_facts(similarity.label_spread(words, "label", "vec"))


# Windows ------------------------------------------------------------------


@query
def sequence_index(fx):
    paths = fx.table("pages").select("page_id", F.concat("url", F.lit("/"), F.col("page_id")).alias("path"))
    return ranking.sequence_index(paths)


@query
def first_detection(fx):
    return ranking.first_detection(fx.boxes(), 2)


@query
def exact_split(fx):
    return ranking.exact_split(fx.table("documents").select("doc_id"), "doc_id", 0.1)


@query
def batching(fx):
    return ranking.batching(fx.table("documents").select("doc_id"), "doc_id", 7, drop_last=True)


@query
def running_histogram(fx):
    return P.running_histogram(P.gray_histogram(fx.pixels()))


@query
def local_contrast(fx):
    return P.local_contrast(fx.pixels(), 3).select("img_id", "y", "x", F.round(F.col("c").cast("double"), 5).alias("c"))


@query
def token_pattern_match(fx):
    return C.span_rows(C.token_pattern_match(fx.captions()), "doc_id")


@query
def token_pattern_list(fx):
    """The caption rules, given as a list of patterns."""
    return C.span_rows(patterns.token_pattern_list(fx.captions()), "doc_id")


# Quantifiers side by side: words in capitals, then a month or none, then any numbers; a film and what follows.
QUANTIFIED = [
    {"label": "PLACE", "pattern": [{"TEXT": {"REGEX": "^[A-Z]+$"}, "OP": "+"}, {"TEXT": {"IN": ["Januar", "Mai", "Nov."]}, "OP": "?"},
                                   {"TEXT": {"REGEX": "^[0-9]+$"}, "OP": "*"}]},
    {"label": "ROLL", "pattern": [{"LOWER": "rollfilm"}, {"IS_ASCII": True, "OP": "*"}, {"IS_ASCII": False, "OP": "?"}]},
]


@query
def token_pattern_quantifiers(fx):
    return C.span_rows(patterns.token_pattern_list(fx.captions(), QUANTIFIED), "doc_id")


@query
def longest_match_resolve(fx):
    return C.span_rows(C.longest_match_resolve(C.token_pattern_match(fx.captions())), "doc_id")


@query
def caption_records(fx):
    return C.caption_records(dealt(fx, fx.captions(), "orders"))


# Sorts and set operations -------------------------------------------------


@query
def path_sort(fx):
    return ranking.path_sort(fx.table("pages").select("page_id", F.col("url").alias("path")))


@query
def value_sort(fx):
    return ranking.value_sort(fx.pixels(), "v")


@query
def top_words(fx):
    return ranking.top_words(fx.tokens())


@query
def append_results(fx):
    # Captions are joined once and every setting is scored once, also the one that is appended twice.
    captions = kept(fx, dealt_by_rows(fx, fx.captions(), "orders", SCORED_CAPTIONS).select("text"), "captions")
    tables = []
    for name, edit in _caption_settings().items():
        pairs = captions.select(F.lit(name).alias("config"), F.col("text").alias("gt"), edit(F.col("text")).alias("et"))
        tables.append(kept(fx, ocr.ocr_error_summary(ocr.score_texts(pairs)), "summary"))
    return ocr.append_results(tables + tables[:1])


@query
def append_runs(fx):
    """A table that grows by one run per setting: one of them repeated, one cut off before it was finished."""
    folder = files.work_folder(fx.spark, "append_runs")
    swept = kept(fx, wer_rows(fx), "runs")
    for name in (*_caption_settings(), next(iter(_caption_settings()))):
        runs.append_run(swept.where(F.col("config") == name).drop("config"), folder, name)
    runs._write_attempt(swept.drop("config"), folder)
    return runs.read_runs(fx.spark, folder, "doc_id bigint, wer double").select(F.col("run").alias("config"), "doc_id", "wer")


@query
def caption_stream(fx):
    """Captions that arrive in two deliveries, each worked through as a stream."""
    came, out, checkpoint = (files.work_folder(fx.spark, f"caption_stream_{n}") for n in ("in", "out", "checkpoint"))
    captions = fx.captions()
    for delivery in (F.col("doc_id") % 3 == 0, F.col("doc_id") % 3 > 0):
        captions.where(delivery).write.mode("append").json(came)
        stream = arriving.record_stream(fx.spark, came, "doc_id bigint, text string")
        arriving.run_available(stream, C.caption_records, out, checkpoint)
    return fx.spark.read.parquet(out)


@query
def set_union(fx):
    # Two runs over different documents, together all of them.
    tokens = fx.token_vectors()
    halves = [tokens.where("doc_id < 5"), tokens.where("doc_id >= 5")]
    words = [similarity.similar_words(similarity.similar_token_join(half)) for half in halves]
    return similarity.similar_words_text(similarity.set_union(*words))


@query
def concat_unique(fx):
    m = fx.masks()
    return masks.concat_unique([m.select(F.col(c).alias("value")) for c in ("gt", "cls_gt", "cls_pred")])


# Scalar functions ---------------------------------------------------------


def _texts(fx, rows=None):
    """Whole documents, dealt out for scoring before results are made of them, so only the truth is shuffled."""
    return dealt_by_rows(fx, fx.documents(), "documents", rows) if rows else fx.documents()


def _dropped(fx, rows=None):
    return _texts(fx, rows).withColumn("et", SETTINGS["drop vowels"](F.col("gt")))


@query
def cer(fx):
    docs = _dropped(fx, SCORED_DOCUMENTS)
    return docs.select("doc_id", r6(text.cer(F.col("gt"), F.col("et"))).alias("cer"))


def wer_rows(fx):
    rate = text.wer(F.col("gt"), F.col("et"))
    return _caption_sweep(fx).select("config", "doc_id", r6(rate).alias("wer"))


@query
def wer(fx):
    return wer_rows(fx)


def _known(fx, rows=None):
    """Words left out, then letters masked: the word distance is the number of both."""
    return _texts(fx, rows).withColumn("et", mask_letters(drop_words(F.col("gt"))))


def word_rates(fx, docs):
    return docs.select("doc_id", r6(text.wer(F.col("gt"), F.col("et"))).alias("wer"))


@query
def wer_documents(fx):
    return word_rates(fx, _known(fx, SCORED_DOCUMENTS))


@query
def field_wer(fx):
    return _pairs(fx).select("doc_id", *[
        r6(records.field_wer(F.col(f"{f}_a"), F.col(f"{f}_b"))).alias(f"{f}_wer") for f in FIELDS])


@query
def text_normalize(fx):
    padded = F.concat(F.lit(" \n"), F.replace("text", F.lit("."), F.lit(". \t ")), F.lit("\n"))
    return fx.table("documents").select("doc_id", text.text_normalize(padded).alias("text"))


def _caption_token_rules(fx, flag):
    cells = fx.captions().select("doc_id", text.tokens(F.col("text")).alias("t")).select(
        "doc_id", "t", F.posexplode("t").alias("pos", "word"))
    return cells.withColumn("following", F.get("t", F.col("pos") + 1)).where(flag).select("doc_id", "pos", "word")


@query
def date_pattern(fx):
    return _caption_token_rules(fx, C.month_year(F.col("word"), F.col("following")) | C.year(F.col("word")))


@query
def person_pattern(fx):
    return _caption_token_rules(fx, C.credited_person(F.col("word"), F.col("following")))


@query
def film_pattern(fx):
    return C.span_rows(C.token_pattern_match(fx.captions()), "doc_id").where("label = 'FILM'")


@query
def json_repair_parse(fx):
    schema = T.StructType([T.StructField("k", T.LongType())])
    return records.json_repair_parse(fx.raw_json(), schema)


@query
def json_strict_parse(fx):
    schema = T.StructType([T.StructField("k", T.LongType())])
    return records.json_repair_parse(fx.raw_json(), schema, repair=False)


@query
def build_messages(fx):
    messages = records.build_messages(F.col("text"), "Answer with the five fields.")
    return fx.table("conversations").select("conv_id", "turn", F.posexplode(messages).alias("place", "m")).select(
        "conv_id", "turn", "place", "m.role", "m.content")


@query
def conversation_fold(fx):
    folded = records.conversation_fold(fx.table("conversations"))
    return folded.select("conv_id", F.size("messages").alias("n"), F.array_join(F.transform(
        "messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), " | ").alias("messages"))


def _lists(fx):
    """Contrast mask by Otsu on the gray value, as input of the ink decision."""
    return P.otsu_threshold(fx.pixels())


@query
def su_threshold(fx):
    return P.su_threshold(_lists(fx), 3, 3).select("img_id", "y", "x", "b")


@query
def su_threshold_paper(fx):
    return P.su_threshold(_lists(fx), 3, 3, mode="paper").select("img_id", "y", "x", "b")


@query
def su_binarize(fx):
    return P.su_binarize(fx.pixels(), 3, 3)


@query
def su_binarize_paper(fx):
    return P.su_binarize(fx.pixels(), 3, 3, mode="paper").select("img_id", "y", "x", "b")


@query
def su_binarize_images(fx):
    binary = pages.su_binarize_images(P.pixels_to_image(fx.pixels()), 3, 3)
    return P.image_to_pixels(binary).withColumnRenamed("v", "b")


@query
def su_binarize_images_paper(fx):
    binary = pages.su_binarize_images(P.pixels_to_image(fx.pixels()), 5, 3, mode="paper")
    return P.image_to_pixels(binary).withColumnRenamed("v", "b")


@query
def display_names(fx):
    means = scores.metric_means(_method_values(fx), ["method"])
    return means.select("method", scores.display_names(F.col("metric")).alias("metric"), "value")


@query
def round2(fx):
    return fx.table("orders").select("o_orderkey", text.round2(F.col("o_totalprice") / 7).alias("value"))


@query
def cosine(fx):
    # Each vector against its mirror image.
    return fx.table("embeddings").select(
        "vec_id", F.round(vectors.cosine(F.col("embedding"), F.reverse("embedding")), 5).alias("cosine"))


# Image rows instead of pixel tables ---------------------------------------


def _page_binarized(fx, mode):
    binary = pages.su_binarize_images(fx.image_rows(pixels=fx.page_pixels()), 3, 3, mode, strip_pixels=5000)
    return P.image_to_pixels(binary).withColumnRenamed("v", "b")


@query
def su_binarize_pages(fx):
    return P.su_binarize(fx.page_pixels(), 3, 3).select("img_id", "y", "x", "b")


@query
def su_binarize_page_images(fx):
    return _page_binarized(fx, "reference")


@query
def pixel_scale_images(fx):
    scaled = pages.scale_images(fx.image_rows())
    cells = P.image_to_pixels(scaled).join(scaled.select("img_id", "scale"), "img_id")
    return cells.select("img_id", "y", "x", r6(F.col("v") * F.col("scale")).alias("value"))


@query
def pixel_flip_images(fx):
    coin, augment = F.col("img_id") % 2 == 1, F.col("img_id") % 4 < 2
    return P.image_to_pixels(pages.flip_images(fx.image_rows(), augment & coin, augment & ~coin))


@query
def mask_resize_images(fx):
    return P.image_to_pixels(pages.resize_images_nearest(fx.image_rows("cls_gt", fx.masks()), 0.7))


@query
def otsu_images(fx):
    return P.image_to_pixels(pages.otsu_images(fx.image_rows())).withColumnRenamed("v", "e")


@query
def image_mask_pairs(fx):
    pairs = pages.pair_images(fx.image_rows(), fx.image_rows("gt", fx.masks()))
    hexes = [F.hex(c).alias(c) for c in ("data", "mask")]
    return pairs.select("img_id", "height", "width", *hexes)


@query
def mask_checks_images(fx):
    cls = fx.masks().join(fx.pixels(), ["img_id", "y", "x"]).where("y < 7 or img_id % 5 <> 0").withColumn(
        "cls", F.when(F.col("v") > 200, 3).otherwise(F.col("cls_gt")))
    return pages.mask_checks_images(pages.pair_images(fx.image_rows(), fx.image_rows("cls", cls)), 3)


def _mask_pairs(fx, truth, result):
    return pages.pair_images(fx.image_rows(truth, fx.masks()), fx.image_rows(result, fx.masks()))


@query
def binarization_metrics_images(fx):
    found = pages.binarization_metrics_images(_mask_pairs(fx, "gt", "pred"))
    return found.select("img_id", *[r6(c).alias(c) for c in found.columns[1:]])


@query
def drdm_images(fx):
    return pages.drdm_images(_mask_pairs(fx, "gt", "pred")).withColumn("drdm", r6("drdm"))


@query
def dice_images(fx):
    return pages.dice_images(_mask_pairs(fx, "cls_gt", "cls_pred"), 3).withColumn("dice", r6("dice"))


# Caller-supplied models ---------------------------------------------------


def _loudest_eighth():
    """Stand-in model: which eighth of a vector has the largest sum."""
    def model(batch: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(batch["embedding"].to_numpy()).astype(np.float64)
        sums = x.reshape(len(x), 8, -1).sum(axis=2)
        return pd.DataFrame({"vec_id": batch["vec_id"], "eighth": sums.argmax(axis=1), "score": sums.max(axis=1)})

    return model


@query
def batch_infer(fx):
    found = inference.batch_infer(fx.table("embeddings").select("vec_id", "embedding"), _loudest_eighth,
                                  "vec_id bigint, eighth bigint, score double")
    return found.withColumn("score", F.round("score", 5))


def _above():
    """A model of arrays: how many numbers of a row, times a gain, lie above a level."""
    def predict(vectors: np.ndarray, gain: np.ndarray, level: np.ndarray) -> np.ndarray:
        return (vectors.astype("float64") * gain[:, None] > level[:, None]).sum(axis=1).astype("float64")
    return predict


@query
def infer_sweep(fx):
    """One model of arrays under several settings."""
    rows = fx.table("embeddings").select("vec_id", "embedding")
    # Vectors of one width, so that a batch is a matrix.
    model = inference.array_model(_above, T.DoubleType(), shapes=[[64], [], []])
    settings = {"plain": {"gain": 1.0, "level": 0.125}, "loud": {"gain": 2.0, "level": 0.125}, "none": {"gain": 0.0, "level": 0.5}}
    return inference.infer_sweep(rows, model, ["embedding"], settings, "n_above").select("config", "vec_id", "n_above")


@query
def json_any_shape(fx):
    """Answers with keys outside the five fields, lists, texts and broken ones."""
    raw = (F.when(F.col("event_id") % 5 == 1, F.replace("props", F.lit("}"), F.lit(', "Film": "F 1", "Date": 1938, "more": {"a": [1, "ü"]}, "k2": null}')))
           .when(F.col("event_id") % 5 == 2, F.expr("left(props, length(props) - 1)"))
           .when(F.col("event_id") % 5 == 3, F.concat(F.lit("["), "props", F.lit(', "x"]')))
           .when(F.col("event_id") % 5 == 4, F.lit('"no record"')).otherwise(F.col("props")))
    found = records.answers_of_any_shape(fx.table("events").select("event_id", raw.alias("raw")))
    return found.select("event_id", "kind", "Film", "Date", F.array_join(F.transform(F.array_sort(F.map_entries("extra")), lambda e: F.concat(
        e["key"], F.lit("="), e["value"])), ";").alias("extra"), F.to_json("answer").alias("answer"), "error")


@query
def edit_stats(fx):
    """Edits, truth words and growth in words of every caption under every setting."""
    found = _caption_sweep(fx).select("config", "doc_id", text.edit_stats(F.col("gt"), F.col("et")).alias("s"))
    return found.select(
        "config", "doc_id", F.expr("s.substitutions + s.deletions + s.insertions").alias("edits"),
        F.expr("s.hits + s.substitutions + s.deletions").alias("truth_words"),
        F.expr("s.insertions - s.deletions").alias("growth"))


def word_edit_stats(fx, docs):
    return docs.select("doc_id", text.edit_stats(F.col("gt"), F.col("et")).alias("s")).select("doc_id", "s.*")


@query
def edit_stats_documents(fx):
    return word_edit_stats(fx, _known(fx, SCORED_DOCUMENTS))


# The forms timed by bench.py: settings with many edits in every text, where no closed form holds.
TIMED: dict[str, Query] = {
    "config_sweep": lambda spark, sf_dir: sweep(Fixtures(spark, sf_dir), SETTINGS),
    "wer_documents": lambda spark, sf_dir: word_rates(Fixtures(spark, sf_dir), _dropped(Fixtures(spark, sf_dir), SCORED_DOCUMENTS)),
    "edit_stats_documents": lambda spark, sf_dir: word_edit_stats(Fixtures(spark, sf_dir), _dropped(Fixtures(spark, sf_dir), SCORED_DOCUMENTS)),
}
