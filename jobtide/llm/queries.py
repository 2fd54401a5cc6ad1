"""The corpus operators on the driver's tables, with oracle SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import language, toxicity
from jobtide.llm.common import read
from jobtide.llm.conversations import damaged_and_repaired
from jobtide.llm.decontaminate import contamination
from jobtide.llm.divergence import source_divergence
from jobtide.llm.minhash import minhash_classes
from jobtide.llm.mixing import mixed_sizes
from jobtide.llm.oracle import ORACLE  # noqa: F401
from jobtide.llm.repeats import remove_repeats
from jobtide.llm.secrets import BASE, find_secrets, span_text
from jobtide.llm.simhash import simhash_classes
from jobtide.llm.tokens import tokenized
from jobtide.llm.topk import nearest
from jobtide.llm.warc import archived

TOKENIZER = "word_bpe_49k.json"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), n=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(read(spark, sf_dir, "documents"), k=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A shard is the work of one task; 16 MB of payload keep many at work on tables of this size.
    records = archived(read(spark, sf_dir, "pages"), shard_bytes=16 << 20, roll_bytes=4 << 20)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_sizes(read(spark, sf_dir, "documents"), weights=(1, 2, 3), most=3.0).drop("source")


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenized(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=1)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("found", lambda f: f["kind"] == kind)).cast("bigint")
    base = F.filter("found", lambda f: f["kind"].isin(*BASE))
    return found.select("doc_id", *[count(kind).alias(f"n_{kind}") for kind in BASE],
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), every=50, k=5)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash_classes(read(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.fit(read(spark, sf_dir, "documents"))
    pages = language.page_evidence(read(spark, sf_dir, "pages"))
    found = language.identify(pages, model, ["page_id"], "_body", "_said", "_end", "_site", "_zone")
    return found.select("page_id", "language", F.round("score", 6).alias("score"), "text_language", "trigrams")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_and_repaired(read(spark, sf_dir, "conversations"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = minhash_classes(read(spark, sf_dir, "documents"), shingle=5, percent=85)
    return classes.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                          F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read(spark, sf_dir, "documents"), least_docs=30, top=50)


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_warc": op3_warc,
    "op4_mixing": op4_mixing,
    "op5_token_output": op5_token_output,
    "op6_secrets": op6_secrets,
    "op7_exact_topk": op7_exact_topk,
    "op8_simhash": op8_simhash,
    "op9_toxicity": op9_toxicity,
    "op10_language_id": op10_language_id,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_minhash": op12_minhash,
    "op13_source_divergence": op13_source_divergence,
}
