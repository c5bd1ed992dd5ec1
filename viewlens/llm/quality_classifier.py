"""Quality classifier: random-indexing word vectors, pooled, into a two-layer network."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import add_columns
from .language import held_out
from .wordsums import WordSums, ragged_sums

#: Labelled rows that the model is fitted on, chosen by a hash of the id.
SAMPLE = 6000
#: Width of the vectors, words told apart by hash, neighbours on either side of a word.
WIDTH, SLOTS, REACH = 48, 1 << 14, 2
HIDDEN, ROUNDS, RATE, PENALTY = 24, 300, 0.02, 1e-3
ACCEPTED = 0.3
#: Tasks that gather word vectors; each sends SLOTS * WIDTH numbers to the driver.
GATHERERS = 6

SHAPES = ("lower", "title", "upper", "mixed", "number", "none")
MARKS = 256
PARTS = re.compile(r"^(\W*)(.*?)(\W*)$", re.S)


def index_vectors(rows: int, seed: int) -> np.ndarray:
    """Sparse random vectors: four places of each row are 1 or -1."""
    random = np.random.default_rng(seed)
    vectors = np.zeros((rows, WIDTH), np.float32)
    places = np.argsort(random.random((rows, WIDTH)), axis=1)[:, :4]
    vectors[np.arange(rows)[:, None], places] = random.choice([-1.0, 1.0], (rows, 4))
    return vectors


def slot(word: str) -> int:
    return zlib.crc32(word.encode()) % SLOTS


def shape(core: str) -> int:
    if not core:
        return 5
    if core.islower():
        return 0
    if core.isupper():
        return 2 if len(core) > 1 else 1
    if core[0].isupper() and core[1:].islower():
        return 1
    return 4 if core.isdigit() else 3


def parts(word: str) -> tuple[str, list[int]]:
    """The word within its marks in lower case, and rows of its shape and marks.

    Rows count from 0: shapes first, then marks by hash.
    """
    before, core, after = PARTS.match(word).groups()
    rows = [shape(core)]
    rows += [len(SHAPES) + zlib.crc32(m.encode()) % MARKS for m in (before, after) if m]
    return core.lower(), rows


def context_vectors(texts) -> np.ndarray:
    """For each word slot the summed index vectors of the words near it."""
    index = index_vectors(SLOTS, 1)
    sums = np.zeros((SLOTS, WIDTH), np.float32)
    for text in texts:
        slots = np.array([slot(parts(w)[0]) for w in (text or "").split()], np.int64)
        for reach in range(1, min(REACH, len(slots) - 1) + 1):
            np.add.at(sums, slots[:-reach], index[slots[reach:]])
            np.add.at(sums, slots[reach:], index[slots[:-reach]])
    return sums


@dataclass
class Model:
    """Word vectors, input scaling, network weights and temperature."""

    words: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float]
    temperature: float

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        logit = forward((pooled - self.center) / self.scale, self.layers)[1]
        # Rounded, as sums may differ in their last digits with the order of words.
        return np.round(1 / (1 + np.exp(-np.clip(logit / self.temperature, -40, 40))), 9)


class Pooling:
    """Mean of the vectors of a text's words, of their shapes and of repetitions."""

    width = 3 * WIDTH + 2

    def __init__(self, words: np.ndarray):
        forms = index_vectors(len(SHAPES) + MARKS, 2)

        def vectors(of: list[str]) -> np.ndarray:
            cut = [parts(w) for w in of]
            cores = words[[slot(core) for core, _ in cut]]
            return np.hstack([cores, ragged_sums(forms, [rows for _, rows in cut])])

        self.sums = WordSums(2 * WIDTH, vectors)

    def pool(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        total, numbers = self.sums.add(words)
        n = max(1, len(words))
        again = float((numbers[1:] == numbers[:-1]).sum()) / n
        # Words that differ, out of all: repeated passages show even at a distance.
        new = len(np.unique(numbers)) / n
        spread = np.abs(total[:WIDTH]) / n
        return np.concatenate([total / n, spread, [again, new / (1 + 0.1 * np.log1p(n))]])

    def pool_all(self, texts) -> np.ndarray:
        return np.array([self.pool(t) for t in texts]).reshape(len(texts), self.width)


def forward(x: np.ndarray, layers) -> tuple[np.ndarray, np.ndarray]:
    first, bias, second, offset = layers
    hidden = np.tanh(x @ first + bias)
    return hidden, hidden @ second + offset


def train_network(x: np.ndarray, y: np.ndarray):
    """Weights by Adam over the whole sample; a constant if only one label occurs."""
    random = np.random.default_rng(3)
    layers = [
        random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        np.zeros(()),
    ]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in layers]
    for step in range(1, ROUNDS + 1):
        hidden, logit = forward(x, layers)
        error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y) / len(y)
        back = np.outer(error, layers[2]) * (1 - hidden**2)
        slopes = [
            x.T @ back + PENALTY * layers[0],
            back.sum(axis=0),
            hidden.T @ error + PENALTY * layers[2],
            error.sum(),
        ]
        for i, slope in enumerate(slopes):
            mean, square = moments[i]
            mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
            moments[i] = (mean, square)
            steady = mean / (1 - 0.9**step), square / (1 - 0.999**step)
            layers[i] = layers[i] - RATE * steady[0] / (np.sqrt(steady[1]) + 1e-8)
    return tuple(layers)


def calibrate(logit: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on rows the network was not fitted on."""
    if not len(y):
        return 1.0

    def loss(t):
        return np.logaddexp(0, np.where(y == 1, -logit, logit) / t).mean()

    return float(min(np.geomspace(0.25, 8, 61), key=loss))


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """At most ``size`` labelled texts that are not held out: doc_id, label, text.

    Ids are ranked by hash. Of several labels of one id the larger counts.
    """
    known = (
        labels.where(
            F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))
        )
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("label"))
    )
    # The limit is a constant, so these rows may be broadcast.
    chosen = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size))
    return docs.select("doc_id", "text").join(chosen, "doc_id")


def fit(docs: DataFrame, labels: DataFrame, scratch: str, size: int = SAMPLE) -> Model:
    """The model from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality).

    The sampled texts stay in Spark: word vectors are gathered by GATHERERS tasks
    and added up, then the driver gets the pooled vectors, ``size`` rows.
    """
    spark = docs.sparkSession
    labelled_sample(docs, labels, size).write.mode("overwrite").parquet(scratch)
    sample = spark.read.schema("doc_id long, label int, text string").parquet(scratch)
    # By rows, not by key: the number of tasks bounds what the driver gets. The sums
    # are of ones, so they do not depend on which rows meet.
    sample = sample.repartition(GATHERERS)

    def gather(batches):
        import pyarrow as pa

        sums = context_vectors(t for b in batches for t in b.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])

    words = np.zeros((SLOTS, WIDTH), np.float64)
    for row in sample.select("text").mapInArrow(gather, "sums binary").collect():
        words += np.frombuffer(row["sums"], np.float32).reshape(SLOTS, WIDTH)
    words /= np.maximum(1, np.linalg.norm(words, axis=1, keepdims=True))
    words = words.astype(np.float32)

    def factory():
        pooling = Pooling(words)
        return lambda texts: [pooling.pool_all(texts).tolist()]

    pooled = add_columns(sample, "text", "pooled array<double>", factory, ("doc_id", "label"))
    rows = sorted(pooled.collect(), key=lambda r: zlib.crc32(str(r["doc_id"]).encode()))
    if not rows:
        nothing = (np.zeros((Pooling.width, 1)), np.zeros(1), np.zeros(1), 0.0)
        return Model(words, np.zeros(Pooling.width), np.ones(Pooling.width), nothing, 1.0)
    x, y = np.array([r["pooled"] for r in rows]), np.array([r["label"] for r in rows], float)
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - center) / scale
    apart = len(y) // 5
    layers = train_network(z[apart:], y[apart:])
    return Model(
        words, center, scale, layers, calibrate(forward(z[:apart], layers)[1], y[:apart])
    )


def scorer(model: Model):
    """A function from texts to scores and predicted labels."""
    pooling = Pooling(model.words)

    def run(texts):
        scores = model.probability(pooling.pool_all(texts)) if texts else np.zeros(0)
        return [scores, (scores >= ACCEPTED).astype(np.int32)]

    return run


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """Score of every row: doc_id, held_out, score (label 1 likelier), predicted.

    predicted is 1 from a score of ACCEPTED on. Null and empty texts are scored
    as a text without words. Equal texts get equal scores; nothing but the text
    is used. Without labels every score is the same. Extra columns are ignored.
    Rows are scored without a shuffle; the model has a fixed size.
    """
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return add_columns(
        rows, "text", "score double, predicted int", lambda: scorer(model), ("doc_id", "held_out")
    )


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose predicted label is 1."""

    def factory():
        score = scorer(model)
        return lambda texts: [[bool(p) for p in score(texts)[1]]]

    return add_columns(docs, text, "_accepted_ boolean", factory, where="_accepted_")
