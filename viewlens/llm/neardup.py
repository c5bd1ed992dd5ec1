"""Near-duplicate documents: MinHash bands and odd sketches, confirmed on full sets.

Documents with equal shingle sets are one node. The MinHash values of a node are
cut into bands; nodes that agree in a band share a bucket. The values also fold
into an odd sketch, a bitmap in which each value flips one bit: the bits that
differ between two sketches tell how many values do, and are sharpest for high
similarities. Pairs of a bucket whose sketches are near enough are candidates,
and each candidate is confirmed on the full sets.

Not all pairs of a bucket are made. First each node is compared with one center
of the bucket, the node that shares most buckets with others, near which copies
of one text lie. Linked pairs give components, and pairs within a component could
add nothing. Two nodes of other components that share a center c can only be
similar enough if the shingles in which they differ from c overlap: with x ^ c
for these, |x ^ y| = |x ^ c| + |y ^ c| - 2 |(x ^ c) & (y ^ c)| must be small, while
|x ^ c| is large for an x that is not linked to c. So the first shingles of x ^ c,
those that c lacks before those that x lacks, must hold a common one, at a place
that leaves room for the overlap. Pairs that pass are compared by sketch and then
confirmed. No candidate is left out, and copies of one text, which differ from
their center in shingles of their own, meet no other.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import add_columns
from .components import connected_components

#: Values in a band, and the share of pairs at the threshold that no band may catch.
BAND = 5
MISSED = 1e-7
SKETCH_WORDS = 8
MASK = (1 << 64) - 1


@dataclass(frozen=True)
class Settings:
    """Shingles of ``words`` words; pairs of similarity ``percent`` / 100 or more are linked."""

    words: int = 5
    percent: int = 80

    @property
    def bands(self) -> int:
        agree = (self.percent / 100) ** BAND
        return 1 if agree >= 1 else max(1, math.ceil(math.log(MISSED) / math.log(1 - agree)))

    @property
    def hashes(self) -> int:
        return self.bands * BAND

    @property
    def sketch_distance(self) -> int:
        """Bits that may differ: those of a pair at the threshold and five deviations more."""
        k, t, n = self.hashes, self.percent / 100, 64 * SKETCH_WORDS
        differ = k * (1 - t) + 5 * math.sqrt(k * t * (1 - t))
        return min(n, math.ceil(n / 2 * (1 - math.exp(-4 * differ / n)) + 0.25 * math.sqrt(n)))


def multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(11)
    odd = random.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, random.integers(0, 1 << 63, n, dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles of a text.

    A-Z are lower-cased and words are runs of anything but blank, tab to return.
    A text of fewer words is one shingle, one without words none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(n, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total = mixed(total + hashes[i : len(words) - n + 1 + i])
    return np.unique(total)


class Signatures:
    """Band hashes, odd sketch and digest of a shingle set."""

    def __init__(self, settings: Settings):
        self.settings = settings
        self.odd, self.add = multipliers(settings.hashes)

    def minhash(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.odd), MASK, np.uint64)
        for start in range(0, len(shingles), 1024):
            part = shingles[start : start + 1024, None] * self.odd + self.add
            np.minimum(least, part.min(axis=0), out=least)
        return mixed(least + np.arange(len(least), dtype=np.uint64))

    def of(self, text: str | None) -> tuple[int, bytes | None, list | None, list | None]:
        shingles = shingle_set(text, self.settings.words)
        if not len(shingles):
            return 0, None, None, None
        values = self.minhash(shingles)
        bits = np.zeros(64 * SKETCH_WORDS, np.uint8)
        np.bitwise_xor.at(bits, values % np.uint64(len(bits)), 1)
        sketch = np.packbits(bits).view(np.int64)
        rows = values.reshape(self.settings.bands, BAND)
        bands = np.arange(len(rows), dtype=np.uint64)
        for i in range(BAND):
            bands = mixed(bands * np.uint64(31) + rows[:, i])
        digest = xxhash.xxh3_128_digest(shingles.tobytes())
        return len(shingles), digest, bands.view(np.int64).tolist(), sketch.tolist()


SIGNATURE = "n_shingles long, digest binary, bands array<long>, sketch array<long>"


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id and the signature of every row."""

    def factory():
        made = Signatures(settings)
        return lambda texts: list(zip(*(made.of(t) for t in texts), strict=True))

    return add_columns(docs, "text", SIGNATURE, factory, ("doc_id",))


def sketch_gap(one: str, other: str) -> Column:
    """Number of bits that differ between two sketch columns."""
    return sum(
        (F.bit_count(F.col(one)[i].bitwiseXOR(F.col(other)[i])) for i in range(SKETCH_WORDS)),
        F.lit(0),
    )


def near_enough(a: str, b: str, settings: Settings) -> Column:
    """Sketches and set sizes allow the similarity; a and b prefix sketch and n columns."""
    low = F.least(F.col(f"{a}_n"), F.col(f"{b}_n")) * 100
    high = F.greatest(F.col(f"{a}_n"), F.col(f"{b}_n")) * settings.percent
    return (low >= high) & (sketch_gap(f"{a}_sketch", f"{b}_sketch") <= settings.sketch_distance)


def stored(df: DataFrame, path: str) -> DataFrame:
    """The rows as a written table, read again: cuts the lineage at a shared folder."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    return (
        pairs.join(texts.selectExpr("node as a", "text as a_text"), "a")
        .join(texts.selectExpr("node as b", "text as b_text"), "b")
        .select("a", "b", "a_text", "b_text")
    )


def compared(batches, settings: Settings):
    """(a, b, set of a, set of b) of each row; the set of b is kept while b stays."""
    held: tuple = (None, None)
    for batch in batches:
        for i in range(batch.num_rows):
            a, b = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            if held[0] != b:
                held = (b, shingle_set(batch.column(3)[i].as_py(), settings.words))
            yield a, b, shingle_set(batch.column(2)[i].as_py(), settings.words), held[1]


def in_batches(rows, schema: pa.Schema, size: int = 2048):
    rows = iter(rows)
    while part := list(itertools.islice(rows, size)):
        columns = [pa.array(c, t) for c, t in zip(zip(*part, strict=True), schema.types, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


STAR = "a long, b long, linked boolean, n long, differ long, first array<long>"


def compare_with_centers(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """STAR rows of the pairs (node a, center b).

    ``differ`` is the number of shingles that only one of them has, and ``first``
    are as many of these, in a common order for the center, as a similar node must
    share one of: those the center lacks, then those the node lacks, by hash.
    """
    schema = pa.schema(
        [("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_()), ("n", pa.int64()),
         ("differ", pa.int64()), ("first", pa.list_(pa.int64()))]
    )
    percent = settings.percent

    def rows(batches):
        for a, b, left, right in compared(batches, settings):
            own = np.setdiff1d(left, right, assume_unique=True)
            lacking = np.setdiff1d(right, left, assume_unique=True)
            both = len(left) - len(own)
            linked = 100 * both >= percent * (len(left) + len(lacking))
            # The other node has at most 100 / percent as many shingles.
            most = len(left) * (100 - percent) // percent
            first = np.concatenate([own[: most + 1], lacking[: max(0, most + 1 - len(own))]])
            yield a, b, linked, len(left), len(own) + len(lacking), first.view(np.int64)

    return with_texts(pairs, texts).mapInArrow(lambda b: in_batches(rows(b), schema), STAR)


def confirm(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; ``texts`` is (node, text)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def rows(batches):
        for a, b, left, right in compared(batches, settings):
            both = len(np.intersect1d(left, right, assume_unique=True))
            if 100 * both >= settings.percent * (len(left) + len(right) - both):
                yield a, b

    return with_texts(pairs, texts).mapInArrow(lambda b: in_batches(rows(b), schema), "a long, b long")


def across_components(stars: DataFrame, roots: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) of other components that share a center and may be similar enough."""
    placed = stars.join(roots.selectExpr("node as a", "root"), "a", "left").select(
        "a", "b", "n", "differ", "first", F.coalesce("root", "a").alias("root")
    )
    several = (
        placed.groupBy("b").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low < high").select("b")
    )
    parts = placed.join(several, "b").select(
        F.col("b").alias("center"), "root", F.col("a").alias("node"), "n", "differ",
        F.posexplode("first").alias("place", "shingle"),
    )
    one = parts.selectExpr("center", "shingle", *(f"{c} as a_{c}" for c in PART))
    two = parts.selectExpr("center", "shingle", *(f"{c} as b_{c}" for c in PART))
    # With places counted from 0, this one and all later ones may be common.
    room = F.least(F.col("a_differ") - F.col("a_place"), F.col("b_differ") - F.col("b_place"))
    whole, rest = 100 + settings.percent, 100 - settings.percent
    enough = 2 * whole * room >= whole * (F.col("a_differ") + F.col("b_differ")) - rest * (
        F.col("a_n") + F.col("b_n")
    )
    low, high = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    return (
        one.join(
            two,
            (one["center"] == two["center"])
            & (one["shingle"] == two["shingle"])
            & (F.col("a_root") < F.col("b_root"))
            & (100 * low >= settings.percent * high)
            & enough,
        )
        .select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
        .distinct()
    )


PART = ("root", "node", "n", "differ", "place")


def link_documents(
    docs: DataFrame,
    scratch: str,
    settings: Settings | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Class of every row: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id reachable over links, its own included,
    and kept says that it is the row's own. Null and empty texts and those
    without words have no shingles and are linked with nothing. Rows with equal
    sets are always linked, whatever their ids. Rows with a null id count as links
    between others; in a class without any id, component_id is null and all rows
    are kept. Rows that repeat an id are each judged by their text.
    Extra columns are ignored.
    """
    settings = settings or Settings()
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    made = stored(signatures(docs, settings), f"{scratch}/signatures")
    full = made.where(F.col("digest").isNotNull())
    # Equal sets fall together before the shuffle; a node is numbered once it is written.
    nodes = stored(
        full.groupBy("digest")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        f"{scratch}/nodes",
    )
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(banded.join(shared, "bucket"), f"{scratch}/members")
    facts = nodes.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", "n", "sketch", "least_id", "digest"
    )
    facts = stored(facts, f"{scratch}/facts")
    texts = stored(node_texts(docs, facts, settings), f"{scratch}/texts")

    mass = members.groupBy("node").agg(F.sum("size").alias("mass"))
    centers = (
        members.join(mass, "node")
        .groupBy("bucket")
        .agg(F.max(F.struct("mass", (-F.col("node")).alias("last"))).alias("best"))
        .select("bucket", (-F.col("best.last")).alias("b"))
    )
    pairs = (
        members.join(centers, "bucket").where("node <> b")
        .select(F.col("node").alias("a"), "b").distinct()
    )
    stars = stored(compare_with_centers(pairs, texts, settings), f"{scratch}/stars")
    links = stars.where("linked").select("a", "b")
    first = connected_components(links, f"{scratch}/first")

    near = facts.selectExpr("node as a", "n as a_n", "sketch as a_sketch")
    other = facts.selectExpr("node as b", "n as b_n", "sketch as b_sketch")
    across = (
        across_components(stars, first, settings)
        .join(near, "a").join(other, "b")
        .where(near_enough("a", "b", settings))
        .select("a", "b")
    )
    more = stored(confirm(across, texts, settings), f"{scratch}/cross-links")
    roots = connected_components(links.unionByName(more), f"{scratch}/all")

    classes = nodes.join(roots, "node", "left").select(
        "digest", "least_id", F.coalesce("root", "node").alias("root")
    )
    least = classes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = classes.join(least, "root").select("digest", "component_id")
    return (
        full.select("doc_id", "n_shingles", "digest")
        .join(named, "digest")
        .select("doc_id", "n_shingles", "component_id")
        .unionByName(
            made.where(F.col("digest").isNull()).select(
                "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
            )
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def node_texts(docs: DataFrame, facts: DataFrame, settings: Settings) -> DataFrame:
    """(node, text) of the nodes in ``facts``, from the row with the least id.

    Ids may repeat with other texts, so the digest of a text decides.
    """
    wanted = facts.select("node", F.col("least_id").alias("_id"), "digest")
    found = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id"))).select(
        "node", "digest", "text"
    )

    def factory():
        made = settings.words

        def digests(texts: Sequence):
            return [[xxhash.xxh3_128_digest(shingle_set(t, made).tobytes()) for t in texts]]

        return digests

    checked = add_columns(found, "text", "found binary", factory, ("node", "digest", "text"))
    return checked.where("digest = found").groupBy("node").agg(F.min("text").alias("text"))


def one_of_each(
    docs: DataFrame, scratch: str, settings: Settings | None = None, text: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when each class keeps one document.

    The document with the smallest id stays, as do documents without words, each
    for itself. Rows that repeat an id are one document and stay if any of them
    does, and so do the rows without an id, of which one stays if its class has no
    id at all.
    """
    linked = link_documents(docs, scratch, settings, text=text)
    kept = linked.where("kept").select(F.col("doc_id").alias("_kept_")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(F.col("_kept_")), "left_semi")
