import random

import numpy as np
import pytest
from odd import ODD
from plain import leaks

from viewlens.llm import decontaminate as dec

ITEM = ("What is the capital of the small country between the two great rivers of the north, "
        "and which of its kings built the old stone bridge that still stands there today")


def test_multi_index_finds_all_within_radius():
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(12)) for _ in range(20)]
    items = dec.Items(texts)
    assert len(items.prints) == 20
    for _ in range(300):
        number = rng.randrange(20)
        flipped = items.prints[number]
        for bit in rng.sample(range(64), rng.randint(0, dec.RADIUS)):
            flipped ^= 1 << bit
        near = dict(items.within(12, flipped))
        assert near[number] <= dec.RADIUS
        assert near == {n: d for n, p in items.prints.items() if (d := (p ^ flipped).bit_count()) <= dec.RADIUS}


def test_against_all_windows(spark, small_documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = benchmark.orderBy("item_id").collect()
    docs = small_documents.where("n_chars < 2500")
    found = dec.find_leaks(docs, benchmark).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found}
    wanted = {
        (d["doc_id"], items[n]["item_id"]): s
        for d in docs.collect()
        for n, s in leaks(d["text"], [i["text"] for i in items]).items()
    }
    assert got == pytest.approx(wanted) and len(got) == len(found)


def test_changed_and_moved_passages(spark, documents):
    rng = random.Random(4)
    noise = lambda n: " ".join(f"n{rng.randrange(10**6)}" for _ in range(n))
    words = ITEM.split()
    texts = [
        ITEM,
        noise(40) + " " + ITEM.upper() + ". " + noise(40),
        " ".join([*words[:-1], "yesterday"]),
        " ".join(words[2:]),
        noise(9) + " " + " ".join(words[:-2]),
        " ".join(words[:10] + ["other"] + words[11:]),
        noise(300),
        " ".join(words[:15]),
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    bench = spark.createDataFrame([(1, ITEM), (1, ITEM), (2, "of the"), (3, None), (None, "")], "item_id long, text string")
    found = dec.find_leaks(documents(rows), bench).collect()
    wanted = {i for i, t in rows if leaks(t, [ITEM])}
    assert {r["doc_id"] for r in found} == wanted == {0, 1, 2, 3, 4}
    assert len(found) == 2 * len(wanted) and {r["item_id"] for r in found} == {1}
    clean = dec.without_leaks(documents(rows), bench)
    assert {r["doc_id"] for r in clean.collect()} == {5, 6, 7}
    assert clean.columns == documents(rows).columns


def test_blocks_give_the_same(spark, documents, monkeypatch):
    bench = spark.createDataFrame([(i, f"{ITEM} {i}") for i in range(9)], "item_id long, text string")
    rows = documents([(i, f"{ITEM} {i}") for i in range(9)] + [(99, "nothing of it")])
    whole = dec.find_leaks(rows, bench).count()
    monkeypatch.setattr(dec, "BLOCK_ITEMS", 2)
    assert len(list(dec.blocks(bench))) > 1
    assert dec.find_leaks(rows, bench).count() == whole > 0
    assert dec.without_leaks(rows, bench).count() == 1


def test_odd_rows(spark, documents):
    bench = spark.createDataFrame([(1, ITEM), (2, "word " * 30)], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in dec.find_leaks(documents(ODD), bench).collect()} == {(5, 2)}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert dec.find_leaks(documents(ODD), empty).count() == 0
    assert dec.without_leaks(documents(ODD), empty).count() == len(ODD)
    assert dec.find_leaks(documents([]), bench).count() == 0


def test_simhash_of_equal_words():
    words = dec.word_hashes("a b c")
    assert dec.simhash(words) == dec.simhash(words[::-1].copy()) and len(dec.shingle_hashes(words)) == 0
    assert dec.simhash(np.zeros(0, np.uint64)) == 0
