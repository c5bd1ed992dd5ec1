"""The registered queries of this subpackage: one for each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import (
    chat,
    decontaminate,
    extract,
    language,
    licences,
    manifest,
    neardup,
    negatives,
    pieces,
    quality_classifier,
    quality_rules,
    urls,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), benchmark)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), keep=["page_id"])


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = scratch_dir(spark, "warc")
    warc.write_archives(warc.chunk_table(pages, scratch_dir(spark, "warc-first")), path)
    chunks = warc.read_archives(spark, path)
    return warc.payload_digests(chunks, scratch_dir(spark, "warc-read"))


def op4_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    settings = neardup.Settings(words=3, percent=85)
    return neardup.link_documents(documents, scratch_dir(spark, "neardup"), settings)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return pieces.token_digests(documents, piece_model(), keep=("doc_id",))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality_rules.judge_quality(documents, scratch_dir(spark, "quality-rules"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    model = quality_classifier.fit(documents, labels, scratch_dir(spark, "quality-sample"))
    return quality_classifier.score_quality(documents, model)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    added = spark.range(2).selectExpr(
        "-1L as conv_id", "id as turn", "if(id = 0, 'user', 'assistant') as role", f"'{text}' as text"
    )
    path = scratch_dir(spark, "chat")
    windows = chat.format_windows(conversations.unionByName(added))
    windows.write.mode("overwrite").parquet(path)
    return chat.conversation_digests(spark.read.schema(windows.schema).parquet(path))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = embeddings.select("vec_id", moved.alias("label"), "embedding")
    path = scratch_dir(spark, "negatives")
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0, path)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    return manifest.verify_rows(documents, scratch_dir(spark, "manifest"), even, changed)


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    texts = extract.extract_text(pages, scratch_dir(spark, "html-paths"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def piece_model(path: str | None = None) -> bytes:
    """Content of a SentencePiece model file, by default the public one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return Path(path).read_bytes()


def queries() -> dict[str, Query]:
    return {
        name: function
        for name, function in sorted(globals().items())
        if name.startswith("op") and callable(function)
    }
