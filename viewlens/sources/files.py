"""JSON-lines files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import SIMPLE_EVENT

RAW_RECORD = "raw_record"
LINE = "line"


def read_json_lines(
    spark: SparkSession, path: str, schema: StructType = SIMPLE_EVENT, *, keep_bad: bool = False
) -> DataFrame:
    """One event per line.

    With ``keep_bad`` there are two more columns: ``line`` has every line as it
    stands in the file, and ``raw_record`` the text of a line that does not fit
    the schema, NULL for good ones. Blank lines are no events.
    """
    if not keep_bad:
        return spark.read.schema(schema).json(path)
    full = StructType([*schema.fields, StructField(RAW_RECORD, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW_RECORD}
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = F.from_json("value", full, options)
    return lines.select(F.col("value").alias(LINE), parsed.alias("event")).select(LINE, "event.*")


def stream_json_lines(
    spark: SparkSession,
    path: str,
    schema: StructType = SIMPLE_EVENT,
    *,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same for files that arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def sample_json_lines(
    spark: SparkSession, path: str, n: int = 100, schema: StructType = SIMPLE_EVENT
) -> DataFrame:
    """The first n events; reads no further than that."""
    return read_json_lines(spark, path, schema).limit(n)
