"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(links: DataFrame, scratch: str) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node reachable.

    In each round every node takes the least root among its neighbours, hands it
    to its own root, and skips to the root of its root, so long chains shorten by
    half. Minima are taken before rows are shuffled, and joins on popular nodes
    are left to the adaptive skew handling. Each round is a written table in
    ``scratch``, which cuts the lineage; it ends when no root changes.
    """
    spark = links.sparkSession
    both = links.select("a", "b").unionByName(links.selectExpr("b as a", "a as b")).distinct()
    both.write.mode("overwrite").parquet(f"{scratch}/links")
    both = spark.read.schema(both.schema).parquet(f"{scratch}/links")
    roots = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
        "node", F.least("node", "b").alias("root")
    )
    step = 0
    while True:
        path = f"{scratch}/roots-{step}"
        roots.write.mode("overwrite").parquet(path)
        schema = roots.schema
        roots = spark.read.schema(schema).parquet(path)
        if step and not roots.where("changed").limit(1).count():
            return roots.select("node", "root")
        old = roots.select("node", "root")
        near = (
            both.join(old.selectExpr("node as b", "root as near"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("near").alias("near"))
        )
        grand = old.join(old.selectExpr("node as root", "root as grand"), "root")
        offered = grand.join(near, "node").select(
            "node", "root", F.least("grand", "near").alias("offer")
        )
        offers = (
            offered.select("node", "offer")
            .unionByName(offered.select(F.col("root").alias("node"), "offer"))
            .groupBy("node")
            .agg(F.min("offer").alias("offer"))
        )
        roots = old.join(offers, "node").select(
            "node",
            F.least("root", "offer").alias("root"),
            (F.col("offer") < F.col("root")).alias("changed"),
        )
        step += 1
