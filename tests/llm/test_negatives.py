"""Hard negatives against all pairs, and the bounds that spare the scoring."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewlens.llm import negatives
from viewlens.llm.negatives import Settings

SCHEMA = "vec_id long, embedding array<float>, label int, score int, rank string, block int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def plain(rows, settings, every=10):
    """All pairs, in whole numbers."""
    kept = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        q = [math.floor(settings.scale * float(np.float32(x))) for x in vector]
        kept[vec_id] = min(kept.get(vec_id, (label, q)), (label, q))
    found = set()
    for a, (label, q) in kept.items():
        if a % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(q, p, strict=False)), b, other)
            for b, (other, p) in kept.items() if b != a
        )
        for score, positive, _ in [s for s in scored if s[2] == label][: settings.positives]:
            fits = [
                s for s in scored
                if s[2] != label and settings.low * -score <= 100 * -s[0] <= settings.high * -score
            ]
            for rank, s in enumerate(fits[: settings.negatives], 1):
                found.add((a, positive, rank, s[1], -score, -s[0]))
    return found


def clustered(n, seed=3, width=16, spread=0.25):
    random = np.random.default_rng(seed)
    centers = random.normal(size=(6, width))
    labels = random.integers(0, 4, n)
    vectors = centers[random.integers(0, 6, n)] + spread * random.normal(size=(n, width))
    return [(i, v.astype(np.float32).tolist(), int(c)) for i, (v, c) in enumerate(zip(vectors, labels, strict=True))]


@pytest.mark.parametrize("settings", [
    Settings(block_rows=40, chunk_anchors=5),
    Settings(block_rows=70, chunk_anchors=1000, references=0),
    Settings(positives=2, negatives=3, low=10, high=60, references=2),
])
def test_equals_all_pairs(spark, scratch, settings):
    rows = clustered(260)
    rows += [(i, rows[0][1], i % 3) for i in range(300, 330)]  # many copies of one vector
    rows += [(i, [-x for x in rows[10][1]], 1) for i in range(330, 334)]
    result = negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0, scratch, settings)
    found = [tuple(r) for r in result.collect()]
    assert len(found) == len(set(found)) and set(found) == plain(rows, settings) != set()


def test_odd_rows(spark, scratch):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.5], 1), (1, [1.0, 0.4], 1), (1, [1.0, 0.4], 1), (1, [2.0, 0.4], 3),
        (2, [0.5, 0.25], 2), (3, [0.5, 0.25], 3), (3, [0.5, 0.25], 3), (4, [0.6], 2), (5, [], 2),
        (6, [0.0, 0.0], 2), (7, None, 2), (8, [None, 1.0], 2), (9, [nan, 1.0], 2),
        (11, [inf, 1.0], 2), (None, [1.0, 1.0], 2), (12, [1.0, 1.0], None), (10, [], 2),
        (13, [-1.0, -1.0], 1), (20, [-1.0, -1.0], 1), (30, [1.0] * 300, 1), (31, [0.9] * 300, 1),
        (32, [0.1] * 200, 2),
    ]
    settings = Settings(block_rows=6, chunk_anchors=2)
    result = negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0, scratch, settings)
    assert {tuple(r) for r in result.collect()} == plain(rows, settings) != set()
    beyond = [*rows, (40, [3e38, 1.0], 1), (41, [1e30] * 3, 1)]
    again = negatives.mine(frame(spark, beyond), F.col("vec_id") % 10 == 0, f"{scratch}2", settings)
    assert {tuple(r) for r in again.collect()} == plain(rows, settings)


def test_empty_tables(spark, scratch):
    assert negatives.mine(frame(spark, []), F.col("vec_id") % 10 == 0, scratch).count() == 0
    rows = frame(spark, clustered(5))
    assert negatives.mine(rows, F.col("vec_id") > 99, f"{scratch}2").count() == 0


def _bounds(vectors, references):
    norms, angles = negatives.directions(vectors, references)
    for i in range(len(vectors)):
        t, n = angles[i], norms[i]
        yield i, negatives.score_bounds(t, t, n, n, angles, norms)


def test_bounds_hold_the_scores_and_spare_most_of_clustered_rows():
    rows = [np.array(v) for _, v, _ in clustered(300, spread=0.1)]
    vectors = np.floor(256 * np.array(rows))
    vectors[5], vectors[6], vectors[7] = 0, vectors[8], -vectors[8]
    units = vectors[20:28] / np.linalg.norm(vectors[20:28], axis=1)[:, None]
    spared = []
    for i, (lower, upper) in _bounds(vectors, units):
        scores = vectors @ vectors[i]
        assert (lower <= scores).all() and (scores <= upper).all()
        if i > 8:
            spared.append((upper < 0.9 * scores[i]).mean())
    assert np.mean(spared) > 0.5


def test_joint_bounds_hold_all_members():
    random = np.random.default_rng(5)
    vectors = np.floor(256 * random.normal(size=(200, 5)))
    references = np.eye(5)[:3]
    norms, angles = negatives.directions(vectors, references)
    group = slice(0, 20)
    lower, upper = negatives.score_bounds(
        angles[group].min(axis=0), angles[group].max(axis=0), norms[group].min(),
        norms[group].max(), angles, norms,
    )
    scores = vectors[group] @ vectors.T
    assert (lower <= scores.min(axis=0)).all() and (scores.max(axis=0) <= upper).all()


def test_scores_beyond_float_precision_are_exact():
    big = (1 << 28) - 3
    vectors = np.array([[big, big, 1.0], [big, -big, 1.0]])
    query = np.array([big, big - 1, 1.0])
    scores = negatives.integer_scores(vectors, query, float(big) ** 2 * 2)
    assert scores.tolist() == [big * big + big * (big - 1) + 1, big + 1]
