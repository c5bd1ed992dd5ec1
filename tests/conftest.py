import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from viewlens.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "viewlens-tests",
        "local[4]",
        spark__sql__shuffle__partitions=4,
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    """Builds enriched events from (user, movie, seconds, type, device, time, processed) rows."""
    from viewlens.operators import enrich_events
    from viewlens.schemas import VIEW_EVENT

    def build(rows):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in VIEW_EVENT.fields)
        raw = spark.createDataFrame(rows, f"{schema}, processed string")
        return enrich_events(
            raw, processing_time=raw["processed"].cast("timestamp")
        ).drop("processed")

    return build
