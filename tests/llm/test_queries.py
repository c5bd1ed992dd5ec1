"""Registered queries against their SQL, and what the driver relies on."""

import duckdb
import pytest
from helpers import frame, table

import __spark_entry__ as entry
import corpus_pipeline
from viewlens.llm import oracle, queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    result = duck.execute(oracle.oracle_sql()[name])
    expected = table([c[0] for c in result.description], result.fetchall())
    assert frame(queries.queries()[name](spark, SMALL)) == expected


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.queries())
    assert numbers == list(range(1, 14))
    assert set(queries.queries()) | {"pipeline"} <= set(entry.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "language_id", "minhash_neardup", "decontamination", "sentencepiece",
    ]


def test_rows_are_whole(spark):
    sources = {"op3_url_filter": "pages", "op7_quality_rules": "documents",
               "op8_language_id": "documents", "op10_quality_classifier": "documents",
               "op4_minhash_neardup": "documents", "op5_sentencepiece": "documents",
               "op12_merkle_manifest": "documents", "op13_html_extraction": "pages"}
    for name, source in sources.items():
        rows = queries.queries()[name](spark, SMALL).count()
        assert rows == spark.read.parquet(f"{SMALL}/{source}.parquet").count(), name
