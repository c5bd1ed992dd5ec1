"""Layered tables: folding under readers, pruning, replays."""

import random
import re
from datetime import date, timedelta

import pytest
from helpers import explain, frame
from pyspark.sql import functions as F

from viewlens.schemas import schema_of
from viewlens.sinks import LayeredTable

SCHEMA = schema_of(day="date", name="string", n="long", mean="double")


def latest(path):
    return LayeredTable(path, SCHEMA, ("day", "name"), "day")


def summed(path):
    schema = schema_of(day="date", name="string", n="long", least="long", users="binary")
    merge = {"n": "sum", "least": "min", "users": "hll"}
    return LayeredTable(path, schema, ("day", "name"), "day", merge)


def rows(spark, values):
    return spark.createDataFrame(values, SCHEMA)


def days(n):
    return [date(2024, 1, 1) + timedelta(i) for i in range(n)]


def test_fifty_batches_are_folded_while_a_reader_runs(spark, tmp_path):
    table, random_ = latest(str(tmp_path)), random.Random(1)
    expected, batches = {}, 50
    for batch in range(batches):
        keys = {(random_.choice(days(4)), random_.choice(["a", "b", None])) for _ in range(5)}
        made = [(d, n, batch, None if batch % 3 else batch / 2) for d, n in keys]
        expected |= {(d, n): (d, n, v, m) for d, n, v, m in made}
        table.append(rows(spark, made), batch)
    wanted = frame(rows(spark, list(expected.values())))
    assert table.updates(spark).count() > len(expected)
    before = table.read(spark)
    assert frame(before) == wanted
    assert table.compact(spark)
    assert frame(before) == wanted
    after = table.read(spark)
    assert frame(after) == wanted
    assert not table.compact(spark)
    # What is read is bounded by days, not by batches.
    assert len([f for f in after.inputFiles() if "/manifest/" not in f]) <= 4 < batches
    assert len(before.inputFiles()) >= batches
    assert table.vacuum(spark, keep=1) == batches
    assert frame(table.read(spark)) == wanted


def test_only_touched_days_are_written_again(spark, tmp_path):
    table = latest(str(tmp_path))
    table.append(rows(spark, [(d, "a", 1, 1.0) for d in days(5)]), 0)
    table.compact(spark)
    table.append(rows(spark, [(days(5)[2], "a", 2, None), (days(6)[5], "a", 3, None)]), 1)
    old = table.read(spark)
    table.compact(spark)
    named = spark.read.parquet(f"{tmp_path}/manifest/{table.snapshot(spark).manifest}")
    runs = {r["day"]: r["run"] for r in named.collect()}
    assert runs[days(5)[2]] == runs[days(6)[5]] != runs[days(1)[0]] and len(set(runs.values())) == 2
    # What an older reader needs outlives one more compaction.
    table.vacuum(spark, keep=2)
    assert old.count() == 6
    values = {r["day"]: (r["n"], r["mean"]) for r in table.read(spark).collect()}
    assert values[days(5)[2]] == (2, None) and values[days(1)[0]] == (1, 1.0)


def test_values_are_merged(spark, tmp_path):
    table, random_ = summed(str(tmp_path)), random.Random(2)
    raw = [
        (random_.choice(days(3)), random_.choice(["a", None]), random_.randrange(50), f"u{random_.randrange(20)}")
        for _ in range(300)
    ]
    schema = "day date, name string, n long, user string"
    for batch in range(6):
        part = spark.createDataFrame(raw[batch::6], schema)
        made = part.groupBy("day", "name").agg(
            F.sum("n").alias("n"), F.min("n").alias("least"), F.hll_sketch_agg("user").alias("users")
        )
        table.append(made, batch)
        if batch % 2:
            table.compact(spark)
            table.vacuum(spark)
    found = table.read(spark).withColumn("users", F.hll_sketch_estimate("users"))
    expected = spark.createDataFrame(raw, schema).groupBy("day", "name").agg(
        F.sum("n").alias("n"), F.min("n").alias("least"), F.count_distinct("user").alias("users")
    )
    assert frame(found) == frame(expected)


def test_replays_and_unfinished_batches(spark, tmp_path):
    table = latest(str(tmp_path))
    one = rows(spark, [(days(1)[0], "a", 1, 1.0)])
    table.append(one, 0)
    table.append(one, 0)
    assert table.read(spark).count() == 1
    table.append(rows(spark, [(days(1)[0], "a", 2, 2.0)]), 1)
    (tmp_path / "tail" / "batch_id=1" / "_SUCCESS").unlink()
    assert table.read(spark).first()["n"] == 1
    assert table.compact(spark) and table.snapshot(spark).through == 0
    table.append(rows(spark, [(days(1)[0], "a", 9, 9.0)]), 0)  # folded already
    table.append(rows(spark, [(days(1)[0], "a", 2, 2.0)]), 1)
    assert table.read(spark).first()["n"] == 2
    assert not table.compact(spark, before=1)
    assert table.read_partitions(spark, one, before=1).first()["n"] == 1
    assert table.compact(spark)
    with pytest.raises(ValueError, match="folded"):
        table.read_partitions(spark, one, before=1)


def test_empty_table(spark, tmp_path):
    table = latest(str(tmp_path / "none"))
    assert table.read(spark).count() == 0 and not table.compact(spark) and table.vacuum(spark) == 0
    table.append(rows(spark, []), 0)
    assert table.read(spark).count() == 0


def test_conditions_prune_both_parts(spark, tmp_path):
    table = latest(str(tmp_path))
    for batch in range(2):
        table.append(rows(spark, [(d, "a", batch, 1.0) for d in days(5)]), batch)
        if not batch:
            table.compact(spark)
    plan = explain(table.read(spark, F.col("day") == days(2)[1]))
    scans = re.findall(r"PartitionFilters: \[.*?day#\d+ = 2024-01-02", plan)
    assert len(scans) >= 2
    read = table.read_partitions(spark, rows(spark, [(days(2)[1], "x", 1, 1.0)]).where("n > 0"))
    assert [r["n"] for r in read.collect()] == [1]
    assert "dynamicpruning" in explain(read)


def test_mistakes_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="not a key"):
        LayeredTable(str(tmp_path), SCHEMA, ("name",), "day")
    with pytest.raises(ValueError, match="merge"):
        LayeredTable(str(tmp_path), SCHEMA, ("day", "name"), "day", {"n": "sum"})
    with pytest.raises(ValueError, match="keep"):
        latest(str(tmp_path)).vacuum(spark, keep=0)
    with pytest.raises(Exception, match="day is NULL"):
        latest(str(tmp_path)).append(rows(spark, [(None, "a", 1, 1.0)]), 0)
