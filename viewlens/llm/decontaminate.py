"""Benchmark decontamination: SimHash of item-sized windows, confirmed by shingle weights.

For each item, every window of as many words is compared with it. A window's
SimHash is looked up in a multi-index: of BLOCKS blocks of a fingerprint at
least one differs in at most RADIUS // BLOCKS bits if the whole differs in at most
RADIUS, so entries for all such variants of each block find every fingerprint
within the radius. The similarity of a pair found is then computed exactly: the
shared weight of 5-word shingles over their total weight, where a shingle weighs
as often as it occurs.

Windows that cannot be similar enough are passed over without a fingerprint.
That loses nothing: a window of similarity s shares at least s of the item's
shingles, and moving it right until it begins with a shingle of some item only
raises the similarity.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import add_columns
from .neardup import mixed

SHINGLE = 5
SIMILARITY = 0.8
BITS, BLOCKS, RADIUS = 64, 8, 23
#: Items and characters of a block of the benchmark, which travels with the tasks.
BLOCK_ITEMS, BLOCK_CHARS = 5_000, 4 << 20
#: Words of a text whose bits are summed at once.
STRETCH = 20_000

MARKS = bytes.maketrans(
    bytes(c for c in range(128) if not chr(c).isalnum()),
    b" " * sum(not chr(c).isalnum() for c in range(128)),
)


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words of a text: lower case, cut at ASCII marks and blanks."""
    words = (text or "").lower().encode().translate(MARKS).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    size = len(words) - SHINGLE + 1
    total = np.zeros(max(0, size), np.uint64)
    for i in range(SHINGLE if size > 0 else 0):
        total = mixed(total * np.uint64(3) + words[i : size + i])
    return total


def signs(words: np.ndarray) -> np.ndarray:
    """A row of 64 numbers 1 or -1 for each word, from the bits of its hash."""
    bits = np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1).view(np.uint64).ravel()


def simhash(words: np.ndarray) -> int:
    return int(fingerprints(signs(words).sum(axis=0, keepdims=True))[0])


def similarity(item: Counter, window: np.ndarray) -> float:
    other = Counter(window.tolist())
    shared = sum(min(n, other[s]) for s, n in item.items() if s in other)
    return shared / max(1, item.total() + other.total() - shared)


class Items:
    """The items of a block: shingles, and a multi-index of fingerprints by item size.

    Items of fewer than SHINGLE words are no more than a phrase and are left out.
    """

    def __init__(self, texts: Sequence[str | None]):
        self.by_size: dict[int, list[int]] = {}
        self.shingles: dict[int, Counter] = {}
        self.prints: dict[int, int] = {}
        for number, text in enumerate(texts):
            words = word_hashes(text)
            if len(words) >= SHINGLE:
                self.by_size.setdefault(len(words), []).append(number)
                self.shingles[number] = Counter(shingle_hashes(words).tolist())
                self.prints[number] = simhash(words)
        distinct = {s for c in self.shingles.values() for s in c}
        self.known = np.sort(np.fromiter(distinct, np.uint64, len(distinct)))
        self.mask = np.uint64((1 << max(16, (len(distinct) * 32).bit_length())) - 1)
        self.present = np.zeros(int(self.mask) + 1, bool)
        self.present[self.known & self.mask] = True
        self.least = math.ceil(SIMILARITY * (min(self.by_size, default=0) - SHINGLE + 1) - 1e-9)
        width = BITS // BLOCKS
        flips = [
            sum(1 << i for i in chosen)
            for r in range(RADIUS // BLOCKS + 1)
            for chosen in itertools.combinations(range(width), r)
        ]
        self.index: dict[int, list[dict[int, list[int]]]] = {}
        for size, numbers in self.by_size.items():
            tables: list[dict[int, list[int]]] = [{} for _ in range(BLOCKS)]
            for number, (block, table) in itertools.product(numbers, enumerate(tables)):
                value = self.block(self.prints[number], block)
                for flip in flips:
                    table.setdefault(value ^ flip, []).append(number)
            self.index[size] = tables

    @staticmethod
    def block(fingerprint: int, block: int) -> int:
        width = BITS // BLOCKS
        return fingerprint >> (block * width) & ((1 << width) - 1)

    def within(self, size: int, fingerprint: int) -> list[tuple[int, int]]:
        """(number, distance) of all items of a size whose fingerprint is within RADIUS."""
        found = set()
        for block, table in enumerate(self.index[size]):
            found.update(table.get(self.block(fingerprint, block), ()))
        near = ((n, (self.prints[n] ^ fingerprint).bit_count()) for n in sorted(found))
        return [(n, d) for n, d in near if d <= RADIUS]

    def matches(self, text: str | None) -> dict[int, tuple[int, int, int, float]]:
        """For each item found: first word, words and distance of the best window, similarity."""
        words = word_hashes(text)
        shingles = shingle_hashes(words)
        hits = self.present[shingles & self.mask]
        maybe = np.flatnonzero(hits)
        if len(maybe):
            at = np.searchsorted(self.known, shingles[maybe]).clip(max=len(self.known) - 1)
            hits[maybe] = self.known[at] == shingles[maybe]
        if np.count_nonzero(hits) < max(1, self.least):
            return {}
        before = np.concatenate(([0], np.cumsum(hits)))
        starts = np.flatnonzero(hits)
        best: dict[int, tuple[int, int, int, float]] = {}
        for size in self.by_size:
            count = size - SHINGLE + 1
            ends = np.minimum(starts + count, len(shingles))
            dense = starts[before[ends] - before[starts] >= math.ceil(SIMILARITY * count - 1e-9)]
            if len(dense):
                for group in np.split(dense, np.flatnonzero(np.diff(dense // STRETCH)) + 1):
                    self.compare(words, shingles, group, size, best)
        return best

    def compare(self, words, shingles, starts, size, best) -> None:
        first, last = int(starts[0]), min(int(starts[-1]) + size, len(words))
        sums = np.vstack([np.zeros((1, BITS), np.int32), signs(words[first:last])]).cumsum(axis=0)
        ends = np.minimum(starts + size, len(words))
        prints = fingerprints(sums[ends - first] - sums[starts - first])
        for start, end, fingerprint in zip(starts.tolist(), ends.tolist(), prints, strict=True):
            for number, distance in self.within(size, int(fingerprint)):
                window = shingles[start : end - SHINGLE + 1]
                found = similarity(self.shingles[number], window)
                if found >= SIMILARITY and found > best.get(number, (0, 0, 0, 0.0))[3]:
                    best[number] = (start, end - start, distance, found)


def blocks(benchmark: DataFrame):
    """(ids, Items) of one block of the benchmark after the other.

    Rows are dealt by hash to as many blocks as keep each within the limits on
    average; only one block at a time is on the driver.
    """
    size = benchmark.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")
    ).first()
    number = max(1, math.ceil(size["n"] / BLOCK_ITEMS), math.ceil(size["chars"] / BLOCK_CHARS))
    for block in range(number):
        dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == block
        rows = benchmark.select("item_id", "text").where(dealt).collect()
        rows.sort(key=lambda r: (r["item_id"] is not None, r["item_id"]))
        if rows:
            yield [r["item_id"] for r in rows], Items([r["text"] for r in rows])


LEAKS = "doc_id long, item_id long, start_word long, n_words long, distance int, similarity double"


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The benchmark items that each row's text holds: LEAKS, one row for each pair.

    start_word and n_words give the best window (the first of equals), in words of
    the text in lower case and cut at marks. A window may be shorter than the item
    at the end of a text. Null and empty texts, texts and items under SHINGLE
    words have no leaks; equal items are all found; an empty benchmark finds none.
    Rows that repeat are searched each for itself. Extra columns are ignored.

    Each block of the benchmark is one pass over the texts without a shuffle, so
    a passage that many texts share costs no more than any other.
    """
    fields = pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int64()),
         ("n_words", pa.int64()), ("distance", pa.int32()), ("similarity", pa.float64())]
    )
    found = docs.sparkSession.createDataFrame([], LEAKS)
    for ids, items in blocks(benchmark):

        def search(batches, ids=ids, items=items):
            for batch in batches:
                for start in range(0, batch.num_rows, 1024):
                    part = batch.slice(start, 1024)
                    rows = [
                        (doc, ids[number], *window)
                        for doc, text in zip(*(c.to_pylist() for c in part.columns), strict=True)
                        for number, window in sorted(items.matches(text).items())
                    ]
                    columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)],
                        schema=fields,
                    )

        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        found = found.unionByName(texts.mapInArrow(search, LEAKS))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no item of the benchmark."""
    for _, items in blocks(benchmark):

        def factory(items=items):
            return lambda texts: [[not items.matches(t) for t in texts]]

        docs = add_columns(docs, text, "_clean_ boolean", factory, where="_clean_")
    return docs
