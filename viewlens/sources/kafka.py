"""Kafka source and the JSON message codec."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import VIEW_EVENT

TOPIC = "user_views_topic"


def kafka_options(
    servers: str,
    *,
    topic: str = TOPIC,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_stream(spark: SparkSession, servers: str, **options) -> DataFrame:
    """Messages of a topic as a stream; takes the keywords of ``kafka_options``.

    Needs the spark-sql-kafka package on the session. Read positions are kept in
    the checkpoint of the query that uses the stream.
    """
    return spark.readStream.format("kafka").options(**kafka_options(servers, **options)).load()


def decode_events(messages: DataFrame, schema: StructType = VIEW_EVENT) -> DataFrame:
    """Columns of the JSON object in ``value``.

    Text that is not JSON gives a row of NULLs, a field of the wrong type gives
    NULL in that field only.
    """
    event = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(event.alias("data")).select("data.*")


def encode_events(events: DataFrame) -> DataFrame:
    """Each row as one JSON object in ``value``."""
    return events.select(F.to_json(F.struct("*")).alias("value"))


def consumed_events(messages: DataFrame) -> DataFrame:
    """The three fields a plain consumer of the topic shows; others are not parsed."""
    shown = ("user_id", "event_type", "movie_id")
    return decode_events(messages, StructType([VIEW_EVENT[name] for name in shown]))
