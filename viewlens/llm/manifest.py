"""A Merkle manifest of a table: a digest for each row, a tree for each source, one root.

The leaves of a source ascend by key. While a level has several nodes, each run of
``fanout`` consecutive ones becomes one node of the next. The slots of a run are
spread into columns by conditional aggregates: all columns concatenated are hashed
to the node above, all but its own column are the siblings of a child. Runs of
each level are a written table, a third of the level before. Going down, every
run adds its slots to the path it gets from above, so a proof is made without
joining a leaf with each of its ancestors.

A run holds ``fanout`` rows whatever the size of its source, so a source with most
of all rows is spread like any other. Places come from one range sort: each
sorted part counts its rows by source, and the counts before a part are added.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .places import places, sorted_parts, written

FANOUT = 3
#: Levels in one plan on the way down; a longer plan costs memory of the driver.
PLANNED = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"


@dataclass(frozen=True)
class Manifest:
    """The written tables of a manifest. ``root`` is None for an empty table.

    subroots  tree (number of the source), source, size (leaves), subroot
    runs      for each level tree, size (nodes of the level), pos, c0, c1, ... (digests);
              on the first also k0, k1, ... with what belongs to each leaf
    top_runs  the same for the tree over the subroots
    """

    root: str | None
    subroots: DataFrame
    runs: list[DataFrame]
    top_runs: list[DataFrame]
    fanout: int


def digest(*texts: Column) -> Column:
    """Lower-case hex SHA-256 of the texts one after the other."""
    return F.sha2(F.concat(*texts), 256)


def field_text(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return digest(*[field_text(f) for f in fields])


def build(rows: DataFrame, scratch: str, fanout: int = FANOUT) -> Manifest:
    """The manifest of (source, key, leaf, claim): the digest of a row, and one to be checked.

    Null sources come first, then by UTF-8 bytes; within a source null keys first,
    rows that repeat a key by leaf and claim. Repeated rows are leaves of their own.
    A source with one leaf has that as its subroot.
    """
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    rows = rows.select("source", "key", "leaf", "claim")
    order = [F.col(c) for c in ("source", "key", "leaf", "claim")]
    ranges = [*order[:2], F.substring("leaf", 1, 8)]
    leaves = sorted_parts(rows, order, f"{scratch}/leaves", ranges)
    parts = leaves.groupBy("source", "part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    parts = written(parts, f"{scratch}/parts")
    subtrees = _numbered_sources(parts, scratch)
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        parts.join(subtrees, parts["source"].eqNullSafe(subtrees["of_source"]))
        .withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first"))
        .select(F.col("source").alias("of_source"), F.col("part").alias("of_part"), "tree", "size", "start")
    )
    here = leaves["source"].eqNullSafe(starts["of_source"]) & (leaves["part"] == starts["of_part"])
    nodes = leaves.join(starts, here).select(
        "tree",
        "size",
        (F.col("start") + F.col("row")).alias("pos"),
        F.col("leaf").alias("hash"),
        F.struct("key", "claim").alias("kept"),
    )
    largest = subtrees.agg(F.max("size")).first()[0] or 0
    runs, subroots = _raise(nodes, f"{scratch}/runs", largest, fanout)
    subroots = subroots.join(subtrees, "tree").select(
        "tree", F.col("of_source").alias("source"), "size", F.col("hash").alias("subroot")
    )
    subroots = written(subroots, f"{scratch}/subroots")
    n = subroots.count()
    tops = subroots.select(
        F.lit(0).cast("long").alias("tree"),
        F.lit(n).cast("long").alias("size"),
        F.col("tree").alias("pos"),
        F.col("subroot").alias("hash"),
    )
    top_runs, root = _raise(tops, f"{scratch}/top", n, fanout)
    found = root.first()
    return Manifest(found and found["hash"], subroots, runs, top_runs, fanout)


def proofs(manifest: Manifest, scratch: str) -> DataFrame:
    """Each leaf's key, leaf, claim, subroot and path.

    The path holds, from the leaf to the root, the digests before and after the
    own one in its run. It is empty for the only row of a table.
    """
    spark = manifest.subroots.sparkSession
    base = spark.createDataFrame([(0, 0, [])], f"tree long, pos long, path {PATH}")
    for runs in reversed(manifest.top_runs):
        base = _handed_down(runs, base, manifest.fanout).select("tree", "pos", "path")
    base = manifest.subroots.select("tree", "subroot").join(
        base.select(F.col("pos").alias("tree"), "path"), "tree"
    )
    # Nodes below the roots; the root of each tree begins with the path of its subroot.
    paths = None
    for level in range(len(manifest.runs) - 1, -1, -1):
        runs = manifest.runs[level]
        last = F.col("size") <= manifest.fanout
        above = base.withColumn("pos", F.lit(0).cast("long"))
        done = _handed_down(runs.where(last), above, manifest.fanout)
        if paths is not None:
            done = done.unionByName(_handed_down(runs.where(~last), paths, manifest.fanout))
        paths = done if level == 0 else done.select("tree", "pos", "subroot", "path")
        if level and level % PLANNED == 0:
            paths = written(paths, f"{scratch}/paths-{level}")
    if paths is None:
        schema = f"key long, leaf string, claim string, subroot string, path {PATH}"
        return spark.createDataFrame([], schema)
    return paths.select(
        F.col("kept.key").alias("key"),
        F.col("hash").alias("leaf"),
        F.col("kept.claim").alias("claim"),
        "subroot",
        "path",
    )


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, one after the other."""
    steps = F.transform(path, lambda s: F.concat(s["before"], s["after"]))
    return F.sha2(F.array_join(steps, ""), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a digest and the siblings of a path lead to."""
    return F.aggregate(path, start, lambda made, s: digest(s["before"], made, s["after"]))


def verify_rows(docs: DataFrame, scratch: str, tampered: Column, changed: dict[str, Column]) -> DataFrame:
    """Every document's leaf, subroot, root, proof, and whether its present state fits them.

    The manifest is that of ``docs``. Where ``tampered`` is true the columns in
    ``changed`` are replaced before the leaf is made again and folded with the
    original siblings; where it is null or false the leaf stays. Only the five
    columns of ``FIELDS`` are read. Null values are fields of their own, empty texts
    are not null; texts are hashed whole. Rows that repeat a doc_id, or are equal,
    are leaves each. An empty table gives no rows.
    """
    before = leaf_digest([F.col(f"`{f}`") for f in FIELDS])
    after = leaf_digest([changed.get(f, F.col(f"`{f}`")) for f in FIELDS])
    rows = docs.select(
        "source",
        F.col("doc_id").alias("key"),
        before.alias("leaf"),
        F.when(tampered, after).alias("claim"),
    )
    rows = rows.withColumn("claim", F.coalesce("claim", "leaf"))
    manifest = build(rows, scratch)
    root = F.lit(manifest.root).cast("string")
    found = proofs(manifest, scratch).withColumn("folded_root", folded(F.col("claim"), F.col("path")))
    return found.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        root.alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def _numbered_sources(parts: DataFrame, scratch: str) -> DataFrame:
    """(tree, of_source, size): sources in order, numbered from 0."""
    sizes = parts.groupBy(F.col("source").alias("of_source")).agg(F.sum("n").alias("size"))
    return places(sizes, ["of_source"], f"{scratch}/sources", "tree")


def _raise(nodes: DataFrame, path: str, largest: int, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """Run tables of all levels, and (tree, hash) of the roots.

    ``nodes`` holds tree, size, pos, hash and perhaps kept; ``largest`` is the
    greatest size. Runs of trees with one node, which are roots already, are kept
    on the first level alone, where their leaf is looked up.
    """
    slots = range(fanout)
    slot = F.col("pos") % fanout
    levels, roots = [], []
    while largest > 0:
        spread = [F.max(F.when(slot == i, F.col("hash"))).alias(f"c{i}") for i in slots]
        if "kept" in nodes.columns:
            spread += [F.max(F.when(slot == i, F.col("kept"))).alias(f"k{i}") for i in slots]
        runs = nodes.groupBy("tree", F.expr(f"pos div {fanout}").alias("pos")).agg(
            F.max("size").alias("size"), *spread
        )
        runs = written(runs, f"{path}-{len(levels)}")
        levels.append(runs)
        joined = F.sha2(F.concat_ws("", *[f"c{i}" for i in slots]), 256)
        raised = runs.select(
            "tree",
            F.expr(f"(size + {fanout - 1}) div {fanout}").alias("size"),
            "pos",
            F.when(F.col("size") == 1, F.col("c0")).otherwise(joined).alias("hash"),
        )
        roots.append(raised.where("size = 1").select("tree", "hash"))
        nodes = raised.where("size > 1")
        largest = -(-largest // fanout)
        if largest == 1:
            break
    if not roots:
        return [], nodes.select("tree", "hash")
    return levels, reduce(DataFrame.unionByName, roots)


def _handed_down(runs: DataFrame, above: DataFrame, fanout: int) -> DataFrame:
    """The children of each run with their path, from (tree, pos, path, ...) of the runs."""
    kept = "k0" in runs.columns
    children = []
    for i in range(fanout):
        before = F.concat_ws("", *[f"c{j}" for j in range(i)])
        after = F.concat_ws("", *[f"c{j}" for j in range(i + 1, fanout)])
        step = F.array(F.struct(before.alias("before"), after.alias("after")))
        own = F.when(F.col("size") > 1, step).otherwise(F.lit([]).cast(PATH))
        fields = [
            (F.col("pos") * fanout + i).alias("pos"),
            F.col(f"c{i}").alias("hash"),
            own.alias("own"),
        ]
        fields += [F.col(f"k{i}").alias("kept")] if kept else []
        children.append(F.struct(*fields))
    # The lower levels are as large as the table; none is to be built on the driver.
    joined = runs.join(above.hint("merge"), ["tree", "pos"])
    spread = joined.select("*", F.explode(F.array(*children)).alias("child"))
    carried = [c for c in above.columns if c not in ("tree", "pos", "path")]
    return spread.where("child.hash is not null").select(
        "tree",
        "child.pos",
        "child.hash",
        *(["child.kept"] if kept else []),
        *carried,
        F.concat("child.own", "path").alias("path"),
    )
