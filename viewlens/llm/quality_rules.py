"""Quality rules: repetition counts, then the distance of histograms to language references."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import add_columns

# Common words of the languages that have a reference.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "en": "the of and to in is that it for was on as with be by are this from or an at",
    "es": "de la que el en y a los del se las por un para con no una su al es",
    "fr": "de la le les et des en un une du est que qui dans pour par sur au avec ce",
}
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\v\f"
#: Character classes: lower, upper, digit, space, symbol, other ASCII, beyond ASCII.
CLASSES = 7

LEAST_WORDS = 50
#: Allowed distance: a constant, and a part that shrinks with the root of the words.
CLASS_DISTANCE = (0.16, 0.9)
WORD_DISTANCE = (0.16, 1.9)

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def class_table() -> np.ndarray:
    """Class of each byte of UTF-8; bytes that continue a character have none (CLASSES)."""
    classes = np.full(256, 6, np.int64)
    classes[:128] = 5
    for low, high, number in (("a", "z", 0), ("A", "Z", 1), ("0", "9", 2)):
        classes[ord(low) : ord(high) + 1] = number
    classes[[ord(c) for c in SPACES]] = 3
    classes[[ord(c) for c in SYMBOLS]] = 4
    classes[0x80:0xC0] = CLASSES
    return classes


def word_table(common: dict[str, str]) -> tuple[dict[bytes, int], int]:
    """Bin of each common word as it is written in texts, and the number of bins."""
    words = sorted({w for line in common.values() for w in line.split()})
    table = {}
    for number, word in enumerate(words):
        for form in (word, word.capitalize(), word.upper()):
            for mark in ("", ".", ",", ";", ":", "?", "!"):
                table.setdefault(f"{form}{mark}".encode(), number)
    return table, len(words) + 1


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words within 3-word windows that the text has twice or more."""
    if len(ids) < 4:
        return 0
    pairs = ids[:-2] * distinct + ids[1:-1]
    if distinct >= 1 << 21:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs * distinct + ids[2:]
    order = np.argsort(windows, kind="stable")
    equal = windows[order][1:] == windows[order][:-1]
    if not equal.any():
        return 0
    starts = np.union1d(order[1:][equal], order[:-1][equal])
    covered = np.zeros(len(ids), bool)
    for offset in range(3):
        covered[starts + offset] = True
    return int(covered.sum())


def measure(text: str | None, classes: np.ndarray, table: dict[bytes, int], bins: int) -> tuple:
    """The five counts and the histogram of character classes and common words."""
    data = (text or "").encode()
    by_class = np.bincount(classes[np.frombuffer(data, np.uint8)], minlength=CLASSES + 1)[:CLASSES]
    words = data.split()
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    by_word = np.zeros(bins, np.int64)
    occurrences = np.bincount(ids, minlength=len(number))
    for i, word in enumerate(number):
        by_word[table.get(word, -1)] += occurrences[i]
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        int(by_class.sum() - by_class[3]),
        int(by_class[4]),
        len(lines) - len(set(lines)),
        repeated_words(ids, len(number)),
        [*by_class.tolist(), *by_word.tolist()],
    )


def measured(docs: DataFrame, text: str, common: dict[str, str], keep: Sequence[str]) -> DataFrame:
    def factory():
        classes = class_table()
        table, bins = word_table(common)

        def run(texts):
            return list(zip(*(measure(t, classes, table, bins) for t in texts), strict=True))

        return run

    return add_columns(docs, text, f"{COUNTS}, histogram array<long>", factory, keep)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def distances(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances (base 2) of histograms, one a row, to one reference."""
    p = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
    q = reference / max(1, reference.sum())
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / middle), 0).sum(axis=1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


def language_references(features: DataFrame, common: dict[str, str] = COMMON_WORDS) -> dict:
    """Summed histogram of the texts of each language that pass the base rules.

    All rows count, added up in whole numbers. Only languages of ``common`` have a
    reference, so the driver gets that many rows.
    """
    size = CLASSES + word_table(common)[1]
    sums = (
        features.where(F.col("lang").isin(list(common)) & ~base_failed())
        .groupBy("lang")
        .agg(*[F.sum(F.col("histogram")[i]).alias(f"h{i}") for i in range(size)])
    )
    return {row["lang"]: np.array(row[1:], float) for row in sums.collect()}


def judge_quality(
    docs: DataFrame,
    scratch: str,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    common: dict[str, str] = COMMON_WORDS,
) -> DataFrame:
    """Counts, distances and verdict of every row, each for itself.

    Returns doc_id, the counts of ``measure`` (n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words), base_failed, class_distance, word_distance and
    kept. A row is kept if the base rules hold and its nearest reference is near
    enough; shorter texts, whose histograms are noisier, may be further off, and
    under LEAST_WORDS there is no comparison. A text whose ``lang`` is a value
    without reference, or any text if there is no reference at all, is judged by
    the base rules alone (distances null). Null and empty texts have counts of
    zero and fail. Equal rows get equal verdicts; extra columns are ignored.

    One pass measures the texts; the counts are kept in ``scratch``, summed by
    language, and compared. Only sums of a task are shuffled.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("_source_")
    )
    features = measured(source, "_source_", common, ("doc_id", "lang"))
    features.write.mode("overwrite").parquet(scratch)
    features = spark.read.schema(features.schema).parquet(scratch)
    references = language_references(features, common)
    names = sorted(references)

    def factory():
        def run(numbers):
            rows = [[int(v) for v in n.split(",")] for n in numbers]
            counts = np.array(rows, float).reshape(len(numbers), -1)
            if not names or not len(numbers):
                return [[None] * len(numbers)] * 2
            parts = [
                (distances(counts[:, :CLASSES], r[:CLASSES]), distances(counts[:, CLASSES:], r[CLASSES:]))
                for r in (references[n] for n in names)
            ]
            return [np.min([p[i] for p in parts], axis=0) for i in range(2)]

        return run

    compared = add_columns(
        features.withColumn("_numbers_", F.array_join("histogram", ",")).drop("histogram"),
        "_numbers_",
        "class_distance double, word_distance double",
        factory,
        ("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
    )
    judged = (F.col("n_words") >= LEAST_WORDS) & (
        F.col("lang").isNull() | F.col("lang").isin(names)
    )
    root = F.sqrt(F.col("n_words"))
    near = (F.col("class_distance") <= CLASS_DISTANCE[0] + CLASS_DISTANCE[1] / root) & (
        F.col("word_distance") <= WORD_DISTANCE[0] + WORD_DISTANCE[1] / root
    )
    return (
        compared.withColumns({c: F.when(judged, F.col(c)) for c in ("class_distance", "word_distance")})
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(near, F.lit(True)))
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "class_distance", "word_distance", "kept",
        )
    )
