import random
from collections import Counter

import numpy as np
import pytest
from odd import ODD
from plain import components

from viewlens.llm import neardup
from viewlens.llm.components import connected_components


def linked(docs, scratch, words, percent):
    rows = neardup.link_documents(docs, scratch, neardup.Settings(words, percent)).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows)


def copies():
    """A text, near copies of it at many distances, copies of copies, and exact copies."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    base = [word() for _ in range(120)]
    rows = []
    for i in range(90):
        text = list(base if i % 3 or not rows else rows[-1][1].split())
        for _ in range(rng.randrange(6)):
            text[rng.randrange(len(text))] = word()
        rows.append((1000 - i, " ".join(text)))
    rows += [(2000 + i, rows[i][1].upper()) for i in range(20)]
    return rows + [(3000 + i, " ".join(word() for _ in range(30))) for i in range(20)]


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_against_all_pairs(documents, scratch, words, percent):
    rows = copies() + [(i, t) for i, t, _ in ODD] + [(5000, "a b"), (5001, "A  b"), (5002, "a b c")]
    assert linked(documents(rows), scratch, words, percent) == Counter(components(rows, words, percent))


def test_small_table(small_documents, scratch):
    rows = [(r["doc_id"], r["text"]) for r in small_documents.collect()]
    assert linked(small_documents, scratch, 3, 85) == Counter(components(rows, 3, 85))


def test_one_of_each(documents, scratch):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, ""), (2, "a b c d e f")]
    kept = neardup.one_of_each(documents(rows), scratch)
    assert kept.columns == documents(rows).columns
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect()) == [
        ("1", "a b c d e f"), ("3", ""), ("4", ""),
    ]
    rows = [(1, "a b c d e f"), (None, "a b c d e f")]
    assert neardup.one_of_each(documents(rows), scratch + "3").count() == 1
    assert neardup.one_of_each(documents(rows[1:] * 2), scratch + "4").count() == 2
    assert neardup.one_of_each(documents([]), scratch + "2").count() == 0


def test_sketch_tells_high_similarities():
    settings, rng = neardup.Settings(), np.random.default_rng(1)
    made = neardup.Signatures(settings)
    for shared in (0.8, 0.9, 0.97):
        words = [f"w{i}" for i in rng.integers(0, 10**9, 2000)]
        cut = round(2000 * (1 - shared) / (1 + shared))
        a, b = " ".join(words[: 2000 - cut]), " ".join(words[cut:])
        sketches = [np.array(made.of(t)[3], np.int64).view(np.uint64) for t in (a, b)]
        gap = int(np.bitwise_count(sketches[0] ^ sketches[1]).sum())
        assert gap <= settings.sketch_distance
    assert settings.bands == 41 and neardup.Settings(3, 85).bands == 28


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, scratch, seed):
    rng = random.Random(seed)
    chain = list(range(40))
    rng.shuffle(chain)
    links = list(zip(chain, chain[1:], strict=False)) + [(100, i) for i in range(101, 160)] + [(300, 300)]
    df = spark.createDataFrame(links, "a long, b long")
    roots = {r["node"]: r["root"] for r in connected_components(df, scratch).collect()}
    assert roots == {i: 0 for i in range(40)} | {i: 100 for i in range(100, 160)} | {300: 300}
    assert connected_components(df.limit(0), scratch + "2").count() == 0
