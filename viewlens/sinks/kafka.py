"""Publishing events as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.kafka import TOPIC, encode_events


def producer_options(servers: str, *, topic: str = TOPIC, acks: str = "all", retries: int = 3):
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": acks,
        "kafka.retries": str(retries),
    }


def publish(events: DataFrame, servers: str, **options) -> None:
    """Sends every row; takes the keywords of ``producer_options``."""
    encode_events(events).write.format("kafka").options(
        **producer_options(servers, **options)
    ).save()
