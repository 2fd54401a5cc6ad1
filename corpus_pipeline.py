"""From documents to token files: five corpus operators in a row, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobtide.llm import language
from jobtide.llm.common import read, saved
from jobtide.llm.decontaminate import drop_contaminated
from jobtide.llm.mixing import mix
from jobtide.llm.queries import TOKENIZER
from jobtide.llm.simhash import drop_near_duplicates
from jobtide.llm.tokens import tokenized


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language stay; texts without letters, or like none of the languages, go.

    Documents have no markup and no address: the declared language is their lang, the host their source.
    """
    return language.keep_known(docs, language.fit(docs), declared="lang", host="source")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: fingerprints of 3-word shingles linked at 3 differing bits or fewer."""
    return drop_near_duplicates(docs, shingle=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any 10-word window of a benchmark item go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights: documents of some are drawn, those of others repeat up to 3 times."""
    return mix(docs, weights=(1, 2, 3), most=3.0)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what they hold per document, read back: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers

    return tokenized(docs, public_tokenizers.path(TOKENIZER), end_id=1)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixing),
    ("token-ID output", token_output),
]

# Trained likelihoods, drawn mixes and a tokenizer are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each stage's result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = saved(docs, f"stage{number + 1}")
    return docs
