"""From raw documents to token ids: filters, one of each group of copies, no benchmarks.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns rows with the columns of ``docs``, except the last, which returns tokens.
``run`` writes what each stage returns and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewlens.llm import decontaminate, language, neardup, pieces, quality_classifier
from viewlens.llm.queries import piece_model, table
from viewlens.session import scratch_dir


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels not held out."""
    labels = table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, labels, scratch_dir(spark, "quality-sample"))
    return quality_classifier.accepted(docs, model)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the rows not held out teach."""
    return language.identified(docs, language.learn(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a similarity of 0.8 or more in 5-word shingles."""
    return neardup.one_of_each(docs, scratch_dir(spark, "neardup"), neardup.Settings())


def no_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, their number and the digest of the text they decode to."""
    return pieces.tokens_and_digests(docs, piece_model(), keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality_classifier", good_quality),
    ("language_id", known_language),
    ("minhash_neardup", one_of_each_group),
    ("decontamination", no_benchmarks),
    ("sentencepiece", tokens),
]

#: Trained models and fingerprints are not SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    root = scratch_dir(spark, "pipeline")
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        result.write.mode("overwrite").parquet(f"{root}/{name}")
        docs = spark.read.schema(result.schema).parquet(f"{root}/{name}")
    return docs
