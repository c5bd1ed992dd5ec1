"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keeps large state on executor disk instead of in the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Without this, every column call in Python records its call site.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "viewlens", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators expect.

    ``conf`` keys use ``__`` for dots, e.g. ``spark__ui__enabled="false"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder named by ``spark.checkpoint.dir``.

    Without that setting it lies in the warehouse folder; a local session has it
    below the working folder. On a cluster that must not be a folder of one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        of_machine = warehouse.startswith("file:") or ":" not in warehouse
        if of_machine and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir; executors do not share {warehouse}")
        base = warehouse.rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
