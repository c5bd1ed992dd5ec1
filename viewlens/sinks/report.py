"""The daily report file."""

from __future__ import annotations

from pyspark.sql import DataFrame


def save_report(document: DataFrame, path: str) -> None:
    """Writes the one-row report text as a single file."""
    document.coalesce(1).write.mode("overwrite").text(path)
