"""Stand-in inputs built from the whole base tables.

Images are the 64 numbers of an embedding laid out 8 x 8, captions and records
come from orders with their customer and nation, texts are the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.functions.fixed_values import FIELDS
from inkfold.operators.pixels import pixels_to_image

# Simulated settings of a text extractor: what each does to the true text.
SETTINGS = {
    "drop vowels": lambda t: F.regexp_replace(t, "[aeo]", ""),
    "lower case": lambda t: F.lower(t),
    "join sentences": lambda t: F.replace(t, F.lit(". "), F.lit(".")),
}

# Stands for what an extractor could not read; no document holds it.
UNREAD = "\ue000"


def drop_words(t):
    return F.regexp_replace(t, " th[^ ]*", "")


def mask_letters(t):
    return F.translate(t, "ou", UNREAD * 2)


# Settings whose distance from the truth is known in closed form: words left
# out, letters replaced by one found nowhere, words put in.
KNOWN_SETTINGS = {
    "drop words": drop_words,
    "mask letters": mask_letters,
    "insert marks": lambda t: F.replace(t, F.lit(". "), F.lit(f". {UNREAD} ")),
}


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def pixels(self) -> DataFrame:
        cells = self.table("embeddings").select(F.col("vec_id").alias("img_id"), F.posexplode("embedding").alias("pos", "e"))
        value = F.floor((F.col("e").cast("double") + 0.6) * 210).cast("int")
        return cells.select(
            "img_id", F.expr("cast(pos div 8 as int)").alias("y"), (F.col("pos") % 8).alias("x"),
            F.least(F.lit(255), F.greatest(F.lit(0), value)).alias("v"))

    def masks(self) -> DataFrame:
        v = F.col("v")
        step = lambda low, high: F.when(v < low, 0).when(v < high, 1).otherwise(2)
        return self.pixels().select(
            "img_id", "y", "x",
            F.when(v > 127, 255).otherwise(0).alias("gt"),
            F.when(v > 120 + F.col("img_id") % 15, 255).otherwise(0).alias("pred"),
            step(110, 140).alias("cls_gt"), step(108, 143).alias("cls_pred"))

    def page_pixels(self) -> DataFrame:
        """Pages of up to 300 lines, each line an embedding: larger than a tile, of several strips."""
        cells = self.table("embeddings").select("vec_id", F.posexplode("embedding").alias("x", "e"))
        value = F.floor((F.col("e").cast("double") + 0.6) * 210).cast("int")
        return cells.select(F.expr("vec_id div 300").alias("img_id"), (F.col("vec_id") % 300).cast("int").alias("y"), "x",
                            F.least(F.lit(255), F.greatest(F.lit(0), value)).alias("v"))

    def image_rows(self, column: str = "v", pixels: DataFrame | None = None) -> DataFrame:
        """Image rows of one column of a pixel table."""
        source = self.pixels() if pixels is None else pixels
        return pixels_to_image(source.select("img_id", "y", "x", F.col(column).alias("v")))

    def logits(self) -> DataFrame:
        v = F.col("v")
        return self.pixels().select(
            "img_id", "y", "x",
            F.array((v - 100).cast("double") / 50, (130 - v).cast("double") / 50,
                    (F.col("x") - F.col("y")).cast("double") / 8).alias("logits"),
            F.when(v > 127, 1).otherwise(0).alias("target"))

    def boxes(self) -> DataFrame:
        """Four boxes per image; class 2 occurs twice, once or not at all."""
        det = F.col("det_no")
        return (self.table("embeddings").select(F.col("vec_id").alias("img_id"), "label",
                                                F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("det_no"))
                .select("img_id", "det_no", ((F.col("label") + det % 3) % 5).cast("int").alias("cls"),
                        ((F.col("img_id") + det) % 4).cast("int").alias("x1"),
                        ((F.col("img_id") * 3 + det) % 4).cast("int").alias("y1"),
                        ((F.col("img_id") + det) % 4 + 3).cast("int").alias("x2"),
                        ((F.col("img_id") * 3 + det) % 4 + 2).cast("int").alias("y2")))

    def documents(self) -> DataFrame:
        return self.table("documents").select("doc_id", F.col("text").alias("gt"))

    def tokens(self) -> DataFrame:
        cells = self.table("documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("pos", "word"))
        return cells.where("word <> ''")

    def token_vectors(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("label").cast("bigint").alias("doc_id"), F.col("vec_id").cast("int").alias("pos"),
            F.concat(F.lit("w"), F.col("vec_id") % 97).alias("word"), F.col("embedding").alias("vec"))

    def orders(self) -> DataFrame:
        t = self.table
        return (t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
                .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
                .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")))

    def captions(self) -> DataFrame:
        key = F.col("o_orderkey")
        months = F.array(*[F.lit(m) for m in ["Januar", "Februar", "April", "Mai", "Juni", "Oktober", "Nov.", "Feber"]])
        text = F.concat(
            "n_name", F.lit(" "), "c_mktsegment", F.lit(" "), F.get(months, (key % 8).cast("int")), F.lit(" "),
            F.year("o_orderdate").cast("string"), F.lit(" Aufn. Lindtaler"),
            F.when(key % 5 == 0, " Ö1").otherwise(""), F.lit(" Rollfilm "), key.cast("string"), F.lit(" ZV"),
            F.when(key % 3 == 0, " Übersicht Nord").otherwise(""))
        return self.orders().select(key.alias("doc_id"), text.alias("text"))

    def entities(self) -> DataFrame:
        """Up to six entities per order; what the data does not support is missing."""
        found = [
            (F.col("o_orderstatus") != "P", "LOC", F.col("n_name")),
            (F.col("c_acctbal") > 0, "GPE", F.col("r_name")),
            (F.col("o_totalprice") > 100000, "DATE", F.year("o_orderdate").cast("string")),
            (F.col("o_orderpriority") != "5-LOW", "PER", F.col("c_name")),
            (F.col("c_mktsegment") != "BUILDING", "FILM", F.col("o_orderkey").cast("string")),
            (F.col("o_orderstatus") != "F", "MISC", F.col("o_orderpriority")),
        ]
        rows = F.array(*[
            F.struct(F.lit(i).alias("start"), F.lit(label).alias("label"), F.when(ok, text).alias("text"))
            for i, (ok, label, text) in enumerate(found)])
        return (self.orders().select(F.col("o_orderkey").alias("doc_id"), F.inline(rows))
                .where("text is not null").select("doc_id", "start", "label", "text"))

    def records_a(self) -> DataFrame:
        """Records of one method; it found nothing for pending orders."""
        return self.orders().where("o_orderstatus <> 'P'").select(
            F.col("o_orderkey").alias("doc_id"),
            F.concat("n_name", F.lit(" "), "r_name").alias("Location"),
            F.concat(F.lit("order of "), "c_mktsegment", F.lit(" with priority "), "o_orderpriority").alias("Description"),
            F.concat(F.lit("April "), F.year("o_orderdate")).alias("Date"),
            F.col("c_name").alias("Photographer"),
            F.when(F.col("o_totalprice") > 250000, F.concat(F.lit("Film "), "o_orderkey")).alias("Film"))

    def records_b(self) -> DataFrame:
        """Records of another method; it found nothing for customers in debt."""
        return self.orders().where("c_acctbal >= 0").select(
            F.col("o_orderkey").alias("doc_id"),
            F.when(F.col("r_name") == "ASIA", F.col("n_name"))
            .otherwise(F.concat("n_name", F.lit(" "), "r_name")).alias("Location"),
            F.concat("c_mktsegment", F.lit(" order with priority "), "o_orderpriority").alias("Description"),
            F.concat(F.when(F.col("o_orderstatus") == "F", "April ").otherwise("Mai "), F.year("o_orderdate")).alias("Date"),
            F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name")).alias("Photographer"),
            F.when(F.col("o_totalprice") < 50000, "")
            .when(F.col("o_orderpriority") != "1-URGENT", F.concat(F.lit("Film "), F.col("o_orderkey") + 1)).alias("Film"))

    def raw_json(self) -> DataFrame:
        kind = F.col("event_id") % 4
        return self.table("events").select(
            "event_id",
            F.when(kind == 1, F.replace("props", F.lit("}"), F.lit(",\n}")))
            .when(kind == 2, F.expr("left(props, length(props) - 1)"))
            .otherwise(F.col("props")).alias("raw"))
