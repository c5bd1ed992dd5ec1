import json

from pyspark.sql import functions as F

from viewlens import sources
from viewlens.schemas import VIEW_EVENT_EXT
from viewlens.sinks import producer_options

EVENT = {"user_id": "u", "movie_id": "m", "duration_seconds": 5, "event_type": "start",
         "device": "tablet", "timestamp": "2024-01-01T00:00:00"}


def messages(spark, *texts):
    rows = [(t.encode() if t is not None else None,) for t in texts]
    return spark.createDataFrame(rows, "value binary")


def decode(spark, *texts, **options):
    return [r.asDict() for r in sources.decode_events(messages(spark, *texts), **options).collect()]


def test_decode_good_and_bad_messages(spark):
    empty = dict.fromkeys(EVENT)
    assert decode(spark, json.dumps(EVENT), "not json", "", None) == [EVENT, empty, empty, empty]


def test_decode_wrong_extra_and_missing_fields(spark):
    wrong = EVENT | {"duration_seconds": "many", "extra": 1}
    assert decode(spark, json.dumps(wrong)) == [EVENT | {"duration_seconds": None}]
    missing = {k: v for k, v in EVENT.items() if k != "device"}
    assert decode(spark, json.dumps(missing)) == [EVENT | {"device": None}]


def test_extended_schema(spark):
    extended = EVENT | {"user_region": "eu", "content_type": "movie", "bitrate": 4000}
    assert decode(spark, json.dumps(extended), schema=VIEW_EVENT_EXT) == [extended]


def test_encode_then_decode(spark):
    events = sources.decode_events(messages(spark, json.dumps(EVENT), "bad"))
    again = sources.decode_events(sources.encode_events(events))
    assert again.collect() == events.collect()


def test_consumed_fields(spark):
    row = sources.consumed_events(messages(spark, json.dumps(EVENT))).first()
    assert row.asDict() == {"user_id": "u", "event_type": "start", "movie_id": "m"}


def test_kafka_options():
    assert sources.kafka_options("h:1") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "user_views_topic",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    options = sources.kafka_options(
        "h:1", starting_offsets="earliest", fail_on_data_loss=True, max_offsets_per_trigger=9
    )
    assert options["startingOffsets"] == "earliest"
    assert (options["failOnDataLoss"], options["maxOffsetsPerTrigger"]) == ("true", "9")
    assert producer_options("h:1")["kafka.acks"] == "all"
    assert producer_options("h:1")["kafka.retries"] == "3"


def test_jdbc_options():
    connection = sources.jdbc_options("jdbc:x", "t", user="a", password="b")
    assert connection == {"url": "jdbc:x", "dbtable": "t", "user": "a", "password": "b"}
    assert sources.partition_options("id", "0", "9", 4) == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "4",
    }


def test_recent_processed_views_has_nine_columns(events):
    row = ("u", "m", 5, "start", "tablet", "2024-01-01T00:00:00", "2024-01-01 00:00:00")
    recent = sources.recent_processed_views(events([row]), as_of="2024-01-02")
    assert len(recent.columns) == 9 and recent.count() == 1
    late = sources.recent_processed_views(events([row]), as_of="2024-01-02 00:00:01")
    assert late.count() == 0


def test_json_lines(spark, tmp_path):
    path = tmp_path / "views.json"
    lines = [{"user_id": f"u{i}", "movie_id": "m", "duration": i, "event_type": "stop",
              "timestamp": "2024-01-01T00:00:00"} for i in range(150)]
    path.write_text("\n".join(json.dumps(line) for line in lines))
    assert sources.read_json_lines(spark, str(path)).count() == 150
    sample = sources.sample_json_lines(spark, str(path))
    assert sample.agg(F.count("*"), F.max("duration")).first() == (100, 99)
