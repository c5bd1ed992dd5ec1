import pytest

from viewlens.session import scratch_dir

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def scratch(spark):
    return scratch_dir(spark, "test")


@pytest.fixture
def documents(spark):
    """Builds documents from (doc_id, text[, lang]) with columns that clash with made ones."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None, 1, "x", 2, 3) for r in rows]
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, score int, "
            "kept string, node int, digest int"
        )
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture(scope="session")
def small_documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
