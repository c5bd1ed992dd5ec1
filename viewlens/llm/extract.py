"""Main text of web pages by consensus of each host's pages.

Every container of a page is scored by the text within it. Each page votes for the
generalised path of its best one, made of the tags and classes from the page down to
it. The votes order the paths of a host, and each page is read again by the first of
these that it has. A page that looks odd by itself, with a short article beside a
long notice, so follows the others of its host.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .markup import Page, read_page
from .urls import host_column

#: A path of a host is among its first this many, or the page is read by its own best container.
PATHS = 8
#: What marks a container as the article counts for more than its amount of text.
MARKED = {"article": 6, "main": 4}
#: Characters that a block must have, less those in links, to speak for its container.
PLAIN, LINKED = 20, 3
#: A host's paths are copied this often, so its pages spread over as many tasks when joined.
SALTS = 16


def scores(page: Page) -> tuple[list[int], list[int]]:
    """For each container its score, at least 0, and the characters of all text within it.

    Where nothing marks a container, short lines and links count against it. Characters
    in links are left out.
    """
    worth, plain = [0] * len(page.tags), [0] * len(page.tags)
    for container, text, linked, heading in page.blocks:
        own = len(text) - LINKED * linked
        worth[container] += max(0, own) if heading else own - PLAIN
        plain[container] += max(0, len(text) - linked)
    for i in range(len(worth) - 1, 0, -1):
        worth[page.parents[i]] += worth[i]
        plain[page.parents[i]] += plain[i]
    found = [
        MARKED[tag] * plain[i] if tag in MARKED else max(0, worth[i])
        for i, tag in enumerate(page.tags)
    ]
    return found, plain


def best_container(page: Page, path: str | None = None) -> int:
    """The container of this path, or of any, with the best score.

    Among equals the one with more text counts, then the deepest, then the first.
    """
    found, plain = scores(page)
    return max(
        (i for i, p in enumerate(page.paths) if path is None or p == path),
        key=lambda i: (found[i], plain[i], page.paths[i].count("/"), -i),
    )


def main_text(page: Page, paths: Sequence[str]) -> str:
    """Text of the best container that has the first known path; else of the best one."""
    known = set(page.paths)
    chosen = best_container(page, next((p for p in paths if p in known), None))
    inside = [False] * len(page.tags)
    for i, parent in enumerate(page.parents):
        inside[i] = i == chosen or parent >= 0 and inside[parent]
    return "\n\n".join(text for container, text, _, _ in page.blocks if inside[container])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, paths): the paths of each host with most votes, best first.

    Ties go to the deeper path, then to the lesser one. Pages without text do not
    vote, nor do those without a host, which have nothing in common.
    """

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[str, str], int] = defaultdict(int)
            for host, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page = read_page(html)
                if page.blocks:
                    sums[host, page.paths[best_container(page)]] += 1
            hosts, paths = zip(*sums, strict=True) if sums else ((), ())
            columns = [pa.array(hosts, pa.string()), pa.array(paths, pa.string())]
            columns.append(pa.array(list(sums.values()), pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=["host", "path", "votes"])

    cast = pages.select(host_column(F.col("url")).alias("host"), F.col("html").cast("string"))
    summed = (
        cast.where("host <> ''")
        .mapInArrow(vote, "host string, path string, votes long")
        .groupBy("host", "path")
        .agg(F.sum("votes").alias("votes"))
        .withColumn("depth", F.size(F.split("path", "/")))
    )
    order = [F.col("votes").desc(), F.col("depth").desc(), F.col("path")]
    ranked = summed.withColumn("rank", F.row_number().over(Window.partitionBy("host").orderBy(*order)))
    best = ranked.where(F.col("rank") <= PATHS).groupBy("host")
    best = best.agg(F.sort_array(F.collect_list(F.struct("rank", "path"))).alias("ranked"))
    return best.select("host", F.col("ranked.path").alias("paths"))


def extract_text(pages: DataFrame, scratch: str, keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """Columns ``keep`` and text: the article of every page, its blocks joined by two newlines.

    Null or empty html has an empty text, as has a page without text outside
    menus and the like. Pages are read whole and only linearly, whatever their
    length. A null url, or one without a host, makes a page stand for itself. Repeated pages are
    read alike, each for itself. Other columns may have any name. An empty table
    gives no rows.
    """
    spark = pages.sparkSession
    winners = host_paths(pages)
    winners.write.mode("overwrite").parquet(f"{scratch}/paths")
    winners = spark.read.schema(winners.schema).parquet(f"{scratch}/paths")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    winners = winners.select(F.col("host").alias("_of_host_"), "paths", salts.alias("_of_salt_"))
    kept = [F.col(f"`{c}`").alias(f"_{i}_") for i, c in enumerate(keep)]
    source = pages.select(
        *kept, host_column(F.col("url")).alias("_host_"), F.col("html").cast("string").alias("_html_")
    ).withColumn("_salt_", F.pmod(F.xxhash64("_html_"), F.lit(SALTS)).cast("int"))
    same = (F.col("_host_") == F.col("_of_host_")) & (F.col("_salt_") == F.col("_of_salt_"))
    names = [f"_{i}_" for i in range(len(keep))]
    joined = source.join(winners, same, "left").select(*names, "paths", "_html_")
    fields = joined.select(*names).schema.fields
    result = StructType(fields).add("text", "string")
    schema = to_arrow_schema(result, prefers_large_types=False)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, htmls = batch.column(len(names)), batch.column(len(names) + 1)
            texts = [
                main_text(read_page(h.as_py()), p.as_py() or ())
                for p, h in zip(paths, htmls, strict=True)
            ]
            columns = batch.columns[: len(names)] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    extracted = joined.mapInArrow(read, result)
    return extracted.withColumnsRenamed(dict(zip(names, keep, strict=True)))
