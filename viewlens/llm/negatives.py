"""Hard negatives by angular triangle filtering.

Every row stores its angles to a few reference directions. For two rows with angles
s and t to one reference, the angle between them is at least |s - t| and at most
s + t or 2 pi - s - t. The narrowest bounds over all references give an interval of the cosine,
times both norms an interval of the score, widened by more than rounding can
amount to. Only pairs whose interval meets a window of scores that is asked for
are scored, in integers.

Anchors that lie near each other form chunks, rows are dealt to blocks by a hash of
their id. A row goes to the chunks whose joint window its interval can meet, so a
pair of chunk and block is one bounded piece of work, whatever label, direction or
copy the rows crowd in. The first block, a sample of all rows, is searched before the others:
its results raise the lower ends of the windows without losing a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .places import places, written

#: Rows from which references are chosen; they decide how much is filtered, not what is found.
SAMPLE = 512
#: Error of a stored angle, and of a bound relative to the product of norms.
ANGLE_ERROR, SCORE_ERROR = 4e-6, 1e-9
#: Longer vectors take no part: 100 times their scores would not fit 64 bits.
NORM_BITS = 28
#: Chunks whose bounds every task holds.
MOST_CHUNKS = 16_384
EVERYTHING = 1 << 62
ROW = "vec_id long, label long, vector array<long>, norm double, angles array<double>"
FOUND = "anchor_id long, window int, vec_id long, score long"


@dataclass(frozen=True)
class Settings:
    """``scale`` makes components integers; ``low`` and ``high`` are percent of a positive's score."""

    scale: int = 256
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    references: int = 8
    block_rows: int = 4096
    chunk_anchors: int = 1024


def mine(
    vectors: DataFrame, anchors: Column, scratch: str, settings: Settings = Settings()
) -> DataFrame:
    """Hard negatives of every anchor: (anchor_id, positive_id, rank, negative_id, and both scores).

    ``vectors`` holds vec_id, label and embedding; ``anchors`` is a predicate on
    vec_id. Positives are the rows of the anchor's label with the highest scores,
    negatives the rows of other labels with the highest scores between ``low`` and ``high``
    percent of the positive's; ties go to the smaller vec_id. A positive of negative
    score has no negatives. Rows with a null id, label, vector or component, a
    component that is not finite, or a length beyond 2^28 after scaling take no
    part. Rows that repeat a vec_id are one row, that with the least label and
    vector. Where vectors differ in length, missing components are 0; an empty
    vector scores 0 with all. Other columns are not read. An empty table, or one
    without anchors, gives no rows.
    """
    rows = stored_rows(vectors, scratch, settings)
    near = Window.partitionBy("anchor_id", "window").orderBy(F.col("score").desc(), "vec_id")
    n = rows.count()
    n_blocks = max(1, -(-n // settings.block_rows))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int"))
    chunked = _chunks(rows.drop("block").where(anchors), scratch, settings)

    def search(name: str, wanted: DataFrame, same: bool, k: int) -> DataFrame:
        """The first k rows of each window: anchor_id, window, vec_id, score, rank."""
        first = written(_search(rows, chunked, wanted, 0, 1, same, k), f"{scratch}/{name}-first")
        found = first
        if n_blocks > 1:
            least = first.groupBy("anchor_id", "window").agg(
                F.when(F.count("*") >= k, F.min("score")).alias("least")
            )
            raised = wanted.join(least, ["anchor_id", "window"], "left").select(
                "anchor_id", "window", F.greatest("low", "least").alias("low"), "high"
            )
            rest = _search(rows, chunked, raised, 1, n_blocks, same, k)
            found = first.unionByName(rest)
        ranked = found.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)
        return written(ranked, f"{scratch}/{name}")

    every = chunked.select(
        F.col("vec_id").alias("anchor_id"),
        F.lit(0).alias("window"),
        F.lit(-EVERYTHING).alias("low"),
        F.lit(EVERYTHING).alias("high"),
    )
    positives = search("positives", every, True, settings.positives).select(
        "anchor_id",
        F.col("rank").alias("window"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    score = "positive_score"
    windows = positives.where(f"{score} >= 0").select(
        "anchor_id",
        "window",
        F.expr(f"({settings.low} * {score} + 99) div 100").alias("low"),
        F.expr(f"({settings.high} * {score}) div 100").alias("high"),
    )
    negatives = search("negatives", windows, False, settings.negatives)
    return negatives.join(positives, ["anchor_id", "window"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def stored_rows(vectors: DataFrame, scratch: str, settings: Settings) -> DataFrame:
    """The rows that take part, with integer components, norm and angles, as a written table."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * settings.scale)
    # The root of this sum is above the norm after rounding down.
    size = F.aggregate("scaled", F.lit(0.0), lambda a, x: a + (F.abs(x) + 1) * (F.abs(x) + 1))
    whole = F.forall("scaled", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    valid = (
        vectors.select(
            F.col("vec_id").cast("long"), F.col("label").cast("long"), scaled.alias("scaled")
        )
        .where(known & F.col("scaled").isNotNull() & whole & (size < float(1 << 2 * NORM_BITS)))
        .select("vec_id", "label", F.transform("scaled", lambda x: F.floor(x)).alias("vector"))
    )
    references = choose_references(valid, settings.references)
    single = valid.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    single = single.select("vec_id", "row.label", "row.vector")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = as_matrix(batch.column("vector"))
            norms, angles = directions(vectors, references)
            fields = {
                "vec_id": batch.column("vec_id"),
                "label": batch.column("label"),
                "vector": batch.column("vector"),
                "norm": pa.array(norms),
                "angles": as_lists(angles),
            }
            yield pa.RecordBatch.from_pydict(fields)

    return written(single.mapInArrow(place, ROW), f"{scratch}/rows")


def choose_references(rows: DataFrame, n: int) -> np.ndarray:
    """Up to n unit vectors far from each other, among rows chosen by a hash of their id."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "label", "vector").limit(SAMPLE).collect()
    vectors = as_matrix(pa.array([r["vector"] for r in sample], pa.list_(pa.int64())))
    norms = np.linalg.norm(vectors, axis=1)
    units = vectors[norms > 0] / norms[norms > 0, None]
    chosen: list[int] = []
    nearest = np.full(len(units), -2.0)
    while len(chosen) < n and len(units) and nearest.min() < 1 - 1e-9:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
    return units[chosen]


def as_matrix(lists: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of float64, filled up with 0 to the longest one or to ``width``.

    Components are below 2^28, so the numbers are exact.
    """
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    longest = int(lengths.max()) if len(lengths) else 0
    width = max(longest, width or 0)
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width)
    matrix = np.zeros((len(lengths), width))
    matrix[np.arange(width) < lengths[:, None]] = values
    return matrix


def as_lists(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(offsets, matrix.ravel())


def directions(vectors: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the references; a vector of norm 0 is at a right angle to all."""
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    width = min(vectors.shape[1], references.shape[1])
    dots = vectors[:, :width] @ references[:, :width].T
    cosines = dots / np.where(norms > 0, norms, 1)[:, None]
    return norms, np.arccos(np.clip(cosines, -1, 1))


def angle_bounds(least: np.ndarray, most: np.ndarray, angles: np.ndarray):
    """Least and greatest angle between each row and anything with angles in [least, most]."""
    low = np.zeros(len(angles))
    high = np.full(len(angles), np.pi)
    for j in range(angles.shape[1]):
        t = angles[:, j]
        np.maximum(low, np.maximum(t - most[j], least[j] - t), out=low)
        a, b = t + least[j], t + most[j]
        around = np.where((a <= np.pi) & (b >= np.pi), np.pi, 0)
        wide = np.maximum(np.minimum(a, 2 * np.pi - a), np.minimum(b, 2 * np.pi - b))
        np.minimum(high, np.maximum(around, wide), out=high)
    return np.clip(low - ANGLE_ERROR, 0, np.pi), np.clip(high + ANGLE_ERROR, 0, np.pi)


def score_bounds(least, most, norm_least, norm_most, angles, norms):
    """An interval that holds the integer score of each row with anything so bounded."""
    low, high = angle_bounds(least, most, angles)
    top, bottom = np.cos(low), np.cos(high)
    upper = top * norms * np.where(top > 0, norm_most, norm_least)
    lower = bottom * norms * np.where(bottom > 0, norm_least, norm_most)
    error = SCORE_ERROR * norms * norm_most + 1
    return lower - error, upper + error


def _chunks(anchors: DataFrame, scratch: str, settings: Settings) -> DataFrame:
    """The anchors with their chunk: neighbours by nearest reference and the angle to it."""
    closest = F.array_min("angles")
    order = [F.array_position("angles", closest), closest, F.col("vec_id")]
    placed = places(anchors, order, f"{scratch}/anchors-sorted", "place")
    size = max(settings.chunk_anchors, -(-anchors.count() // MOST_CHUNKS))
    chunk = F.expr(f"cast(place div {size} as int)")
    return written(placed.withColumn("chunk", chunk).drop("place"), f"{scratch}/anchors")


def _bounds(anchors: DataFrame, n_references: int) -> list:
    """One row for each chunk: the ranges of angles, norms and windows."""
    angle = [F.get("angles", F.lit(j)) for j in range(n_references)]
    return (
        anchors.groupBy("chunk")
        .agg(
            F.min("norm").alias("norm_least"),
            F.max("norm").alias("norm_most"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.array(*[F.min(a) for a in angle]).alias("least"),
            F.array(*[F.max(a) for a in angle]).alias("most"),
        )
        .orderBy("chunk")
        .collect()
    )


def _search(rows, chunked, wanted, start: int, end: int, same: bool, k: int) -> DataFrame:
    """The first k rows of each window within each block from start up to end."""
    wanted = wanted.withColumnRenamed("anchor_id", "vec_id")
    windowed = wanted.join(chunked, "vec_id")
    first = chunked.select(F.size("angles")).first()
    bounds = [
        (r["chunk"], np.array(r["least"]), np.array(r["most"]), r["norm_least"], r["norm_most"],
         r["low"], r["high"])
        for r in _bounds(windowed, first[0] if first else 0)
    ]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angles = as_matrix(batch.column("angles"))
            norms = batch.column("norm").to_numpy(zero_copy_only=False)
            for chunk, least, most, norm_least, norm_most, low, high in bounds:
                lower, upper = score_bounds(least, most, norm_least, norm_most, angles, norms)
                part = batch.filter(pa.array((upper >= low) & (lower <= high)))
                if part.num_rows:
                    yield part.append_column("chunk", pa.array([chunk] * part.num_rows, pa.int32()))

    dealt = rows.where(F.col("block").between(start, end - 1)).mapInArrow(
        deal, f"{ROW}, block int, chunk int"
    )
    window = F.struct("window", "low", "high")
    at_anchor = windowed.groupBy("vec_id").agg(F.sort_array(F.collect_list(window)).alias("windows"))
    copies = (
        chunked.join(at_anchor, "vec_id")
        .withColumn("block", F.explode(F.sequence(F.lit(start), F.lit(end - 1))))
        .select("chunk", "block", "vec_id", "label", "vector", "norm", "angles", "windows")
    )

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        return first_in_windows(left, right, same, k)

    return dealt.groupBy("chunk", "block").cogroup(copies.groupBy("chunk", "block")).applyInArrow(
        score, FOUND
    )


def first_in_windows(rows: pa.Table, anchors: pa.Table, same: bool, k: int) -> pa.Table:
    """For each window of each anchor the first k rows, of its label or of others."""
    found: dict[str, list] = {"anchor_id": [], "window": [], "vec_id": [], "score": []}
    if rows.num_rows and anchors.num_rows:
        ids, labels = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
        norms, angles = rows.column("norm").to_numpy(), as_matrix(rows.column("angles"))
        width = max(max(_lengths(t)) for t in (rows, anchors))
        vectors = as_matrix(rows.column("vector"), width)
        queries = as_matrix(anchors.column("vector"), width)
        for i, a in enumerate(anchors.drop_columns(["vector", "chunk", "block"]).to_pylist()):
            here = np.nonzero((labels == a["label"]) == same)[0]
            here = here[ids[here] != a["vec_id"]]
            t, norm = np.array(a["angles"]), a["norm"]
            lower, upper = score_bounds(t, t, norm, norm, angles[here], norms[here])
            meets = np.zeros(len(here), bool)
            for w in a["windows"]:
                meets |= (upper >= w["low"]) & (lower <= w["high"])
            here = here[meets]
            scores = integer_scores(vectors[here], queries[i], norms[here].max(initial=0) * norm)
            for w in a["windows"]:
                inside = np.nonzero((scores >= w["low"]) & (scores <= w["high"]))[0]
                inside = inside[np.lexsort((ids[here[inside]], -scores[inside]))[:k]]
                found["anchor_id"] += [a["vec_id"]] * len(inside)
                found["window"] += [w["window"]] * len(inside)
                found["vec_id"] += ids[here[inside]].tolist()
                found["score"] += scores[inside].tolist()
    schema = [("anchor_id", pa.int64()), ("window", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())]
    return pa.table(found, schema=pa.schema(schema))


def _lengths(table: pa.Table) -> list[int]:
    return table.column("vector").combine_chunks().value_lengths().to_pylist()


def integer_scores(vectors: np.ndarray, query: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products; in float64 where no partial sum can pass 2^53."""
    if most < 1 << 52:
        return (vectors @ query).astype(np.int64)
    return vectors.astype(np.int64) @ query.astype(np.int64)
