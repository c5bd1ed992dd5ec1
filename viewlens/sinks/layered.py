"""Tables that take small appends for ever and stay cheap to read.

A layered table holds one row per key, or plain events when it has no key. Batches
are appended to a tail; a compaction folds the tail into a base, of which it
rewrites only the partitions that the tail touches. Events are not rewritten; their
partitions get one more run. A manifest names what is valid:

tail/batch_id=N/PART=x      rows of batch N; the same batch again replaces its own
base/run=R/PART=x           rows folded by run R
manifest/V-T                version V: (PART, run) of the base; batches up to T are in it

A reader takes the newest manifest, the runs it names and the complete batches
after T. A compaction adds folders and then its manifest, so readers see the
table before or after it, and none is disturbed: folders that are out of date
stay until ``vacuum``, which keeps those of the last manifests. One
compaction runs at a time; a second one fails when it adds the same version.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.spread import join_on
from .storage import complete_numbers, folders, remove, values

BATCH, RUN = "batch_id", "run"
#: Rows of one key become one: these aggregates give the same whatever the order and grouping.
MERGES = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "hll": F.hll_union_agg,
}


@dataclass(frozen=True)
class Snapshot:
    """What was valid at one moment. Version 0 has no base; ``through`` is then -1."""

    version: int
    through: int
    manifest: str | None
    batches: tuple[int, ...]


@dataclass(frozen=True)
class LayeredTable:
    """One row per key; keys may be NULL, but not ``partition``, which is one of them.

    Without keys every row counts.

    ``merge`` names the aggregate of each value column. Without it the row of the
    latest batch counts, and a batch must have one row per key.
    """

    path: str
    schema: StructType
    keys: Sequence[str]
    partition: str
    merge: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.keys and self.partition not in self.keys:
            raise ValueError(f"{self.partition} is not a key")
        rest = {*self.schema.fieldNames()} - {*self.keys}
        if self.merge and rest != {*self.merge}:
            raise ValueError(f"merge must name {sorted(rest)}")

    # -- writing --------------------------------------------------------------

    def append(self, rows: DataFrame, batch_id: int, files: int | None = None) -> None:
        """Adds a batch, or replaces it; a batch that was folded already stays as it was.

        Each partition gets one file, more where it is large. Where adaptive
        execution is off, as in stateful streams, ``files`` spreads the rows instead.
        """
        if batch_id <= self.snapshot(rows.sparkSession).through:
            return
        missing = F.raise_error(F.lit(f"{self.path}: {self.partition} is NULL"))
        part = F.when(F.col(self.partition).isNull(), missing).otherwise(F.col(self.partition))
        rows = rows.select(*self.schema.fieldNames()).withColumn(self.partition, part)
        rows = rows.repartition(files) if files else rows.hint("rebalance", self.partition)
        path = f"{self.path}/tail/{BATCH}={batch_id}"
        rows.write.mode("overwrite").partitionBy(self.partition).parquet(path)

    def compact(self, spark: SparkSession, before: int | None = None) -> bool:
        """Folds the complete batches, those below ``before``, into the base; False when none is.

        Leave the last batch of a running stream out where a replay of it must
        find the table as it was.
        """
        now = self.snapshot(spark)
        batches = [n for n in now.batches if before is None or n < before]
        if not batches:
            return False
        tail = self._tail(spark, batches)
        touched = self._partitions(tail)
        named, folded = self._named(spark, now.manifest), tail
        if self.keys:
            before = self._base(spark, now).join(touched, self.partition, "left_semi")
            folded = self._combined(before, tail)
            named = named.join(touched, self.partition, "left_anti")
        run = uuid.uuid4().hex
        (
            folded.hint("rebalance", self.partition)
            .write.partitionBy(self.partition)
            .parquet(f"{self.path}/base/{RUN}={run}")
        )
        named = named.unionByName(touched.withColumn(RUN, F.lit(run)))
        version = f"{now.version + 1:010d}-{batches[-1]}"
        named.coalesce(1).write.mode("error").parquet(f"{self.path}/manifest/{version}")
        return True

    def vacuum(self, spark: SparkSession, keep: int = 2) -> int:
        """Removes what none of the last ``keep`` manifests names; returns the number of folders.

        A reader must end before ``keep`` further compactions have been followed by a vacuum.
        """
        if keep < 1:
            raise ValueError("keep must be 1 or more")
        versions = self._versions(spark)
        if not versions:
            return 0
        kept = versions[-keep:]
        live = {
            row[RUN]
            for version, through, name in kept
            for row in self._named(spark, name).select(RUN).distinct().collect()
        }
        gone = [f"manifest/{name}" for _, _, name in versions[:-keep]]
        gone += [f"base/{RUN}={r}" for r in values(spark, f"{self.path}/base", RUN) if r not in live]
        folded = kept[0][1]
        tail = values(spark, f"{self.path}/tail", BATCH)
        gone += [f"tail/{BATCH}={n}" for n in tail if int(n) <= folded]
        for name in gone:
            remove(spark, f"{self.path}/{name}")
        return len(gone)

    # -- reading --------------------------------------------------------------

    def read(self, spark: SparkSession, where: Column | str | None = None) -> DataFrame:
        """One row per key, with the schema of the table.

        ``where`` is a condition on the keys; one on the partition column keeps other
        partitions of base and tail from being read.
        """
        now = self.snapshot(spark)
        base, tail = self._base(spark, now), self._tail(spark, now.batches)
        if where is not None:
            base, tail = base.where(where), tail.where(where)
        return self._combined(base, tail).select(*self.schema.fieldNames())

    def read_partitions(
        self, spark: SparkSession, wanted: DataFrame, before: int | None = None
    ) -> DataFrame:
        """The rows in the partitions that occur in ``wanted``; the scans skip the others.

        With ``before`` as the batches below that number have left them.
        """
        now = self.snapshot(spark)
        if before is not None and now.through >= before:
            raise ValueError(f"{self.path}: batch {before} is folded")
        tail = self._tail(spark, [n for n in now.batches if before is None or n < before])
        wanted = self._partitions(wanted)
        parts = [
            rows.join(wanted, self.partition, "left_semi")
            for rows in (self._base(spark, now), tail)
        ]
        return self._combined(*parts).select(*self.schema.fieldNames())

    def updates(self, spark: SparkSession) -> DataFrame:
        """The rows of the tail that are not folded yet, with their batch_id."""
        return self._tail(spark, self.snapshot(spark).batches)

    def snapshot(self, spark: SparkSession) -> Snapshot:
        versions = self._versions(spark)
        version, through, name = versions[-1] if versions else (0, -1, None)
        batches = complete_numbers(spark, f"{self.path}/tail", BATCH)
        return Snapshot(version, through, name, tuple(n for n in batches if n > through))

    # -- parts ----------------------------------------------------------------

    def _versions(self, spark: SparkSession) -> list[tuple[int, int, str]]:
        names = folders(spark, f"{self.path}/manifest", complete=True)
        found = [re.fullmatch(r"(\d+)-(\d+)", name) for name in names]
        return sorted((int(m[1]), int(m[2]), m[0]) for m in found if m)

    def _named(self, spark: SparkSession, name: str | None) -> DataFrame:
        """(PART, run) of a manifest."""
        schema = StructType([self.schema[self.partition]]).add(RUN, "string")
        if name is None:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.path}/manifest/{name}")

    def _stored(self, spark: SparkSession, folder: str, key: str, chosen: Sequence) -> DataFrame:
        """Rows of base or tail under the given values of ``key``; other folders are not listed."""
        schema = self._with_batch()
        if key == RUN:
            schema = schema.add(RUN, "string")
        if not chosen:
            return spark.createDataFrame([], schema)
        root = f"{self.path}/{folder}"
        return (
            spark.read.schema(schema)
            .option("basePath", root)
            .parquet(*[f"{root}/{key}={v}" for v in chosen])
        )

    def _with_batch(self) -> StructType:
        return StructType([*self.schema.fields]).add(BATCH, "long")

    def _tail(self, spark: SparkSession, batches: Sequence[int]) -> DataFrame:
        return self._stored(spark, "tail", BATCH, batches)

    def _base(self, spark: SparkSession, now: Snapshot) -> DataFrame:
        """Rows of the runs and partitions that the manifest pairs."""
        manifest = self._named(spark, now.manifest)
        # No more than partitions, and few, as each run folds many.
        runs = sorted(r[RUN] for r in manifest.select(RUN).distinct().collect())
        rows = self._stored(spark, "base", RUN, runs)
        return rows.join(manifest, [RUN, self.partition], "left_semi").drop(RUN)

    def _partitions(self, rows: DataFrame) -> DataFrame:
        """The partitions that occur in rows; the condition lets Spark prune scans by them."""
        part = F.col(self.partition)
        known = part.isNotNull() & (F.hash(part) > F.lit(-(1 << 32)))
        return rows.where(known).select(self.partition).distinct()

    def _combined(self, base: DataFrame, tail: DataFrame) -> DataFrame:
        """Base and tail as one row per key.

        Rows of the tail are later than all of the base, so where the latest counts
        the base is only looked up by the keys of the tail, not grouped.
        """
        if not self.keys:
            return base.unionByName(tail)
        if self.merge:
            return self._merged(base.unionByName(tail))
        rest = [c for c in tail.columns if c not in {*self.keys, BATCH}]
        latest = tail.groupBy(*self.keys).agg(
            *[F.max_by(c, BATCH).alias(c) for c in rest], F.max(BATCH).alias(BATCH)
        )
        kept = join_on(base, latest, self.keys, "left_anti")
        return kept.unionByName(latest)

    def _merged(self, rows: DataFrame) -> DataFrame:
        merged = [MERGES[how](c).alias(c) for c, how in self.merge.items()]
        if BATCH in rows.columns:
            merged.append(F.max(BATCH).alias(BATCH))
        return rows.groupBy(*self.keys).agg(*merged)


def event_table(spark: SparkSession, path: str, partition: str) -> LayeredTable:
    """The table of events at a path, with the columns of its last complete batch."""
    batches = complete_numbers(spark, f"{path}/tail", BATCH)
    folder = f"tail/{BATCH}={batches[-1]}" if batches else None
    if folder is None:
        runs = values(spark, f"{path}/base", RUN, complete=True)
        if not runs:
            raise FileNotFoundError(f"{path} has no batch yet")
        folder = f"base/{RUN}={runs[-1]}"
    found = spark.read.parquet(f"{path}/{folder}").schema
    fields = [f for f in found.fields if f.name not in (BATCH, RUN)]
    return LayeredTable(path, StructType(fields), (), partition)
