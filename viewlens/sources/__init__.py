from .files import read_json_lines, sample_json_lines, stream_json_lines
from .jdbc import jdbc_options, jdbc_table, partition_options, recent_processed_views
from .kafka import consumed_events, decode_events, encode_events, kafka_options, kafka_stream

__all__ = [
    "consumed_events",
    "decode_events",
    "encode_events",
    "jdbc_options",
    "jdbc_table",
    "kafka_options",
    "kafka_stream",
    "partition_options",
    "read_json_lines",
    "recent_processed_views",
    "sample_json_lines",
    "stream_json_lines",
]
