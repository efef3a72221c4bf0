"""Corpus pipeline: each stage takes (spark, docs, sf_dir) and returns the next stage's documents.

All stages but the last return the columns of the documents they were given. Null ids and texts, repeated
rows and empty tables have the results that the operators' modules define.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaloom.llm import decontamination, langid, minhash, pii, sentencepiece_bpe
from taxaloom.llm.arrow import beside
from taxaloom.llm.queries import model_file, table
from taxaloom.session import stage

#: columns that the stages read; the others pass beside them
OWN = ["doc_id", "text"]
#: similarity from which documents are near-duplicates
NEAR_PERCENT = 80


def known_languages(
    spark: SparkSession, docs: DataFrame, sf_dir: str, keep: Collection[str] | None = None, least_score: float = 0.0
) -> DataFrame:
    """Keep the documents in one of the languages ``keep`` (default: all that are learned), and write the language found
    into ``lang`` where that is null.

    Documents without text or letters have no language and go, as do those whose language is less than ``least_score``
    ahead of the others. Where no row has a known language, all documents with letters stay as they are.
    """
    samples = langid.labelled_sample(docs)
    if not langid.has_languages(samples):
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = F.col("lang_pred")
    known = (found != langid.UNKNOWN) & (F.col("score") >= least_score)
    if keep is not None:
        known = known & found.isin(*keep)

    def work(d: DataFrame) -> DataFrame:
        at = d.columns[docs.columns.index("lang")]
        return langid.identify(d, samples).where(known).withColumn(at, F.coalesce(at, "lang_pred"))

    return beside(docs, OWN, work)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return beside(docs, OWN, lambda d: minhash.keep_one(d, percent=NEAR_PERCENT))


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents of which a twentieth or more stands in benchmark windows."""
    benchmark = table(spark, sf_dir, "benchmark")
    return beside(docs, OWN, lambda d: decontamination.scan(d, benchmark).where(~decontamination.contaminated()))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the kind of personal data in its place."""
    return beside(docs, OWN, lambda d: pii.redact(d, pii.fit(d)))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text decoded from them."""
    return sentencepiece_bpe.encode_decode(docs, model_file()).select("doc_id", "n_tokens", "ids", "decoded")


STAGES = [
    ("language", known_languages),
    ("near_duplicates", near_duplicates),
    ("contamination", contamination),
    ("private_data", private_data),
    ("sentencepiece", tokens),
]

#: language models, trees and byte-pair merges can't be expressed in SQL; tests/llm holds run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
