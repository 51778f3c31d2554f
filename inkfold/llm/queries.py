"""Registered queries: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.llm import (
    chat, conversation_repair, html_text, line_dedup, mixing, packing, pitman_yor, quality, sentencepiece, simhash, spelling, token_counts, topk,
)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


# Vocabulary files of public tokenizers.
PIECES, WORDS, RANKS = "piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.tiktoken"
# The first id behind the ranks closes a document.
END = 50256


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sentencepiece(spark, sf_dir):
    """Encoded, decoded again and compared: ``round_trip`` is whether the text came back."""
    model = sentencepiece.model_bytes(tokenizer_path(PIECES))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = sentencepiece.decode(sentencepiece.encode(docs, model), model)
    return rows.select("doc_id", "ids", F.size("ids").alias("n_tokens"), F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"))


@query
def op2_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3)
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op3_token_counts(spark, sf_dir):
    tokenizer = token_counts.Tokenizer.read(tokenizer_path(WORDS), white_separates=True)
    found = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer)
    return found.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op4_token_packing(spark, sf_dir):
    """Packed rows; ``ids`` and ``positions`` are rows of the two matrices."""
    import public_tokenizers

    with open(tokenizer_path(RANKS), "rb") as f:
        ranks = f.read()
    return packing.pack_texts(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, END)


@query
def op5_lm_scores(spark, sf_dir):
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return pitman_yor.score(table(spark, sf_dir, "documents"), held)


@query
def op6_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


@query
def op7_quality_rules(spark, sf_dir):
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_chat_formatting(spark, sf_dir):
    return chat.maximal_conversations(table(spark, sf_dir, "conversations"))


@query
def op9_mix_sources(spark, sf_dir):
    mixed = mixing.mix(mixing.size_table(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query
def op10_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


@query
def op11_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op12_html_extraction(spark, sf_dir):
    found = html_text.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


@query
def op13_conversation_repair(spark, sf_dir):
    """Every conversation, damaged and repaired; one that lost all its rows counts nothing."""
    turns = table(spark, sf_dir, "conversations")
    found = conversation_repair.repair(conversation_repair.damaged(turns))
    every = found.unionByName(turns.select("conv_id").distinct(), allowMissingColumns=True)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    # One row of a conversation at most is not bare.
    whole = every.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in [*counts, "audit", "repaired"]], F.count("cost").alias("n"))
    return whole.select("conv_id", *[F.when(F.col("n") == 0, F.lit(0)).otherwise(F.col(c)).cast("bigint").alias(c) for c in counts],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.sha2(F.coalesce("repaired", F.lit("")), 256).alias("repaired_sha256"))
