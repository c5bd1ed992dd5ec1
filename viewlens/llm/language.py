"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batches import add_columns
from .wordsums import WordSums, ragged_sums

#: Longest context in bytes.
ORDER = 4
#: Texts of each language that the context trees are made from, chosen by a hash of the id.
SAMPLE = 400
UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text divides by five."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().split()


class ContextTrees:
    """Frozen statistics of all languages: code lengths in bits for every context seen.

    A word is coded as a blank and its bytes, each in the context of up to ORDER
    bytes of the same word before it. With T occurrences of a context, D distinct
    bytes after it and c of byte b, b costs log2((T + D) / c); a byte not seen
    there costs an escape of log2((T + D) / D) and is coded in the context that is
    one byte shorter, a context not seen at all costs nothing, and below the empty
    context all 256 bytes are alike.
    """

    def __init__(self, languages: Sequence[str], words: Iterable[tuple[str, bytes, int]]):
        self.languages = list(languages)
        place = {lang: i for i, lang in enumerate(self.languages)}
        counts = [defaultdict(int) for _ in self.languages]
        for lang, word, n in words:
            unit, of = b" " + word, counts[place[lang]]
            for i in range(len(unit)):
                for k in range(min(i, ORDER) + 1):
                    of[unit[i - k : i + 1]] += n
        totals = [defaultdict(int) for _ in self.languages]
        distinct = [defaultdict(int) for _ in self.languages]
        for of, total, different in zip(counts, totals, distinct, strict=True):
            for gram, n in of.items():
                total[gram[:-1]] += n
                different[gram[:-1]] += 1
        grams = sorted({g for of in counts for g in of}, key=lambda g: (len(g), g))
        contexts = sorted({c for total in totals for c in total})
        # Row 0 is a byte that no language has seen; then contexts' escapes, then grams.
        self.bits = np.zeros((1 + len(contexts) + len(grams), len(self.languages)))
        self.bits[0] = 8
        self.escape = {c: 1 + i for i, c in enumerate(contexts)}
        self.gram = {g: 1 + len(contexts) + i for i, g in enumerate(grams)}
        for lang, (total, different) in enumerate(zip(totals, distinct, strict=True)):
            for context, row in self.escape.items():
                if context in total:
                    t, d = total[context], different[context]
                    self.bits[row, lang] = math.log2((t + d) / d)
        for gram, row in self.gram.items():
            context, shorter = gram[:-1], self.bits[self.gram[gram[1:]]] if len(gram) > 1 else 8.0
            self.bits[row] = self.bits[self.escape[context]] + shorter
            for lang, of in enumerate(counts):
                if gram in of:
                    t, d = totals[lang][context], distinct[lang][context]
                    self.bits[row, lang] = math.log2((t + d) / of[gram])

    def rows(self, word: bytes) -> list[int]:
        """Rows of ``bits`` that add up to the code length of a word."""
        unit, rows = b" " + word, []
        for i in range(len(unit)):
            for k in range(min(i, ORDER), -1, -1):
                found = self.gram.get(unit[i - k : i + 1])
                if found is not None:
                    rows.append(found)
                    break
                escape = self.escape.get(unit[i - k : i])
                if escape is not None:
                    rows.append(escape)
            else:
                rows.append(0)
        return rows

    def code_lengths(self, words: list[bytes]) -> np.ndarray:
        return ragged_sums(self.bits, [self.rows(w) for w in words])


def judge(bits: np.ndarray, n_words: int) -> tuple[int, float]:
    """Number of the language with the shortest code, and its share.

    Differences are divided by the root of the number of words, as bits of one
    text are far from independent.
    """
    gap = (bits - bits.min()) / math.sqrt(max(1, n_words))
    return int(np.round(bits, 6).argmin()), round(float(1 / np.exp2(-gap).sum()), 9)


def sample_ids(docs: DataFrame, size: int = SAMPLE) -> DataFrame:
    """At most ``size`` ids of each language to learn from, (doc_id, lang).

    Ids are ranked by hash, and each task keeps its first ones before the shuffle.
    """
    known = docs.where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    )
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = known.select("doc_id", "lang").withColumn("_rank", F.row_number().over(first))
    return ranked.where(F.col("_rank") <= size).select("doc_id", "lang").distinct()


def learn(docs: DataFrame, size: int = SAMPLE) -> ContextTrees:
    """Context trees from ``docs`` (doc_id, text, lang): words are counted by Spark.

    Only the counts of the sampled texts' words come to the driver.
    """
    # The sample has at most ``size`` rows a language, so it may be broadcast.
    ids = F.broadcast(sample_ids(docs, size))
    texts = docs.join(ids, ["doc_id", "lang"], "left_semi")
    words = F.split(F.lower(F.col("text")), r"[\x20\x09-\x0D]+")
    counted = (
        texts.select("lang", F.explode(words).alias("word"))
        .where("word <> ''")
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
        .toLocalIterator()
    )
    rows = [(r["lang"], r["word"].encode(), r["n"]) for r in counted]
    return ContextTrees(sorted({r[0] for r in rows}), rows)


def predictor(trees: ContextTrees):
    """A function from texts to predicted languages and scores."""
    sums = WordSums(len(trees.languages), trees.code_lengths)

    def run(texts):
        languages, scores = [], []
        for text in texts:
            if not text or not trees.languages or not LETTER.search(text):
                languages.append(UNDETERMINED)
                scores.append(0.0)
                continue
            words = words_of(text)
            best, share = judge(sums.add(words)[0], len(words))
            languages.append(trees.languages[best])
            scores.append(share)
        return languages, scores

    return run


def identify(
    docs: DataFrame,
    trees: ContextTrees | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Predicted language of every row: doc_id, held_out, lang_pred, score.

    A null text, or one without a letter, is ``und`` with score 0; so is every
    text if there is nothing to learn from. Without ``trees`` they are learned
    from the rows of ``docs`` that are not held out and have an id and a language.
    A null id is not held out. Equal texts get equal answers, and of languages
    with equal code lengths the first by name wins. Extra columns are ignored.
    Rows are predicted without a shuffle; the trees are bounded by the sample.
    """
    source = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    )
    trees = trees or learn(source)
    rows = source.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return add_columns(
        rows, "text", "lang_pred string, score double", lambda: predictor(trees),
        ("doc_id", "held_out"),
    )


def identified(
    docs: DataFrame, trees: ContextTrees, text: str = "text", least: float = 0.5
) -> DataFrame:
    """The rows of ``docs``, all columns, in a language that is told with score ``least``.

    If there was nothing to learn from, every text with a letter stays.
    """

    def factory():
        predict = predictor(trees)

        def keep(texts):
            if not trees.languages:
                return [[bool(t and LETTER.search(t)) for t in texts]]
            found, scores = predict(texts)
            return [[p != UNDETERMINED and s >= least for p, s in zip(found, scores, strict=True)]]

        return keep

    return add_columns(docs, text, "_identified_ boolean", factory, where="_identified_")
