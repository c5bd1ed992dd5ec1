"""The manifest against a plain one, and what proofs find."""

import hashlib

import pytest
from pyspark.sql import functions as F

from viewlens.llm import manifest


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes, fanout):
    """The root over digests, and for each the digests before and after it, by level."""
    paths, places = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        made, members = [], []
        for start in range(0, len(nodes), fanout):
            run = nodes[start : start + fanout]
            for i in range(len(run)):
                for leaf in places[start + i]:
                    paths[leaf].append(("".join(run[:i]), "".join(run[i + 1 :])))
            made.append(h(*run))
            members.append([leaf for i in range(len(run)) for leaf in places[start + i]])
        nodes, places = made, members
    return nodes[0], paths


def plain(rows, fanout=3):
    """(doc_id, leaf, subroot, root, proof) of rows (doc_id, source, lang, n_chars, text)."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    found, subroots = [], []
    for source in sources:
        own = sorted(((r[0] is not None, r[0] or 0, leaf_of(r)), r[0]) for r in rows if r[1] == source)
        leaves = [key[2] for key, _ in own]
        subroot, paths = climb(leaves, fanout)
        subroots.append(subroot)
        found += [(len(subroots) - 1, i, leaf, p) for (_, i), leaf, p in zip(own, leaves, paths, strict=True)]
    root, above = climb(subroots, fanout)
    return [
        (i, leaf, subroots[s], root, h(*[a + b for a, b in p + above[s]])) for s, i, leaf, p in found
    ]


def order(row):
    return tuple((v is not None, v) for v in row)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree int, size int, pos int, hash int"


def verified(spark, scratch, rows):
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA)
    changed = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    return manifest.verify_rows(docs, scratch, F.col("doc_id") % 2 == 0, changed)


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [10], [1, 1], [28, 1, 9], [1, 2, 3, 5]])
def test_equals_plain_manifest(spark, scratch, sizes):
    rows = [(i * 7 % 31, f"s{s}", "en", i, f"t{i}") for s, n in enumerate(sizes) for i in range(n)]
    found = verified(spark, scratch, rows).collect()
    wanted = sorted(plain(rows), key=order)
    assert sorted((tuple(r)[:5] for r in found), key=order) == wanted
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in found)


def test_odd_rows(spark, scratch):
    rows = [
        (1, None, None, None, None), (2, None, "en", 0, ""), (None, "z", "en", 1, "a\nb"),
        (4, "z", "en", 3, "a\nb"), (4, "z", "en", 3, "a\nb"), (4, "z", "en", 3, "other"),
        (6, "", "fr", 5, "no break"), (8, "ä", "de", 1, "x" * 200_000 + "\n"), (7, "\U0001f600", "", -1, "\n"),
        (None, None, "en", 1, "y"), (None, None, "en", 1, "y"), (10, "ﬀ", "en", 1, "\n\n"),
    ]
    found = verified(spark, scratch, rows).collect()
    assert sorted((tuple(r)[:5] for r in found), key=order) == sorted(plain(rows), key=order)
    broken = {i for i, *_, text in rows if i is not None and i % 2 == 0 and "\n" in (text or "")}
    assert {r["doc_id"] for r in found if not r["verified"]} == broken
    whole = [r for r in found if r["doc_id"] == 4]
    assert sorted(r["verified"] for r in whole) == [False, False, True]


def test_empty_table(spark, scratch):
    assert verified(spark, scratch, []).collect() == []


@pytest.mark.parametrize("fanout", [2, 5])
def test_other_fanouts(spark, scratch, fanout):
    rows = [(i, "ab"[i % 2], None, None, str(i)) for i in range(23)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    leaf = manifest.leaf_digest([F.col(c) for c in manifest.FIELDS])
    docs = docs.select("source", F.col("doc_id").alias("key"), leaf.alias("leaf"), leaf.alias("claim"))
    made = manifest.build(docs, scratch, fanout)
    found = manifest.proofs(made, scratch).select(
        "key", "leaf", "subroot", F.lit(made.root), manifest.proof_digest(F.col("path"))
    )
    assert sorted(tuple(r) for r in found.collect()) == sorted(plain(rows, fanout))
    with pytest.raises(ValueError):
        manifest.build(docs, scratch, 1)


def test_a_changed_sibling_breaks_only_its_own_proof(spark, scratch):
    rows = [(i, "s", "en", i, "a\nb" if i == 4 else "ab") for i in range(9)]
    found = {r["doc_id"]: r["verified"] for r in verified(spark, scratch, rows).collect()}
    assert found == {i: i != 4 for i in range(9)}
