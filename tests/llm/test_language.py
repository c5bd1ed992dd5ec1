import math

import numpy as np
from odd import ODD
from pyspark.sql import functions as F

from viewlens.llm import language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 150
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def plain_bits(counts, context, byte):
    """Code length by the definition, for one language's words {word: n}."""
    if context is None:
        return 8.0
    after = {}
    for word, n in counts.items():
        unit = b" " + word
        for i in range(len(unit)):
            if i >= len(context) and unit[i - len(context) : i] == context:
                after[unit[i]] = after.get(unit[i], 0) + n
    shorter = context[1:] if context else None
    if not after:
        return plain_bits(counts, shorter, byte)
    total, distinct = sum(after.values()), len(after)
    if byte in after:
        return math.log2((total + distinct) / after[byte])
    return math.log2((total + distinct) / distinct) + plain_bits(counts, shorter, byte)


def test_code_lengths_are_exact():
    counts = {"a": {b"banana": 2, b"band": 1, b"an": 3}, "b": {b"nana": 1, b"abba": 4}}
    trees = language.ContextTrees(["a", "b"], [(k, w, n) for k, c in counts.items() for w, n in c.items()])
    for word in (b"banana", b"bandana", b"xyz", b"", b"abandon"):
        unit = b" " + word
        wanted = [
            sum(plain_bits(counts[k], unit[max(0, i - language.ORDER) : i], unit[i]) for i in range(len(unit)))
            for k in ("a", "b")
        ]
        assert np.allclose(trees.code_lengths([word])[0], wanted)


def test_odd_rows(documents):
    rows = language.identify(documents(ODD)).collect()
    assert len(rows) == len(ODD)
    by_id = {r["doc_id"]: r for r in rows}
    for i in (1, 2, 3):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert not by_id[None]["held_out"]
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (5, 6, 7)} <= {"en", "xx"}
    assert language.identify(documents([])).count() == 0


def test_nothing_to_learn_from(documents):
    rows = language.identify(documents([(1, "abc", None), (None, "abc", "en")])).collect()
    assert [r["lang_pred"] for r in rows] == ["und", "und"]
    trees = language.learn(documents([]).select("doc_id", "text", "lang"))
    assert [r["doc_id"] for r in language.identified(documents([(1, "abc"), (2, "1")]), trees).collect()] == [1]


def test_learns_only_from_rows_not_held_out(spark, documents):
    df = documents([(i, "abc def" if i % 2 else "xyz uvw", "aa" if i % 2 else "bb") for i in range(40)])
    ids = [r["doc_id"] for r in language.sample_ids(df, 100).collect()]
    held = {r["doc_id"] for r in df.where(language.held_out(F.col("doc_id"))).collect()}
    assert held and not held & set(ids) and len(ids) == 40 - len(held)
    assert language.sample_ids(df, 3).count() == 6
