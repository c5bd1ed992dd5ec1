"""WARC archives written from and read into a table of payload chunks.

A payload larger than a chunk becomes several rows (record, chunk number), which
are WARC segments: a first record and its continuations. Each row carries the
SHA-256 of the payload up to its end, so the last one has the digest of the
payload and no step holds a whole payload beside the row it came from.

Files are written and read by Spark's own sources, so any folder that Spark can
open will do. They are gzip files of uncompressed WARC records.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHUNK_BYTES = 256 << 10
#: Records are written in blocks of about this size, BLOCKS_PER_FILE to a file.
BLOCK_BYTES = 4 << 20
BLOCKS_PER_FILE = 8
#: Payloads below this size are never written as a revisit.
LEAST_SHARED = 100

HEADER_ENDS = b"\r\n\r\n"
VERSION = b"WARC/1.1\r\n"

CHUNKS = (
    "row string, page_id long, url string, record_type string, refers_to long, chunk_no int, "
    "total_bytes long, running_digest string, last boolean, chunk binary"
)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(ddl), prefers_large_types=False)


def batches_of(rows: Iterator[tuple[tuple, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about BLOCK_BYTES from (row, size) pairs."""
    held, size = [], 0
    for row, n in rows:
        held.append(row)
        size += n + 200
        if size >= BLOCK_BYTES:
            yield as_batch(held, schema)
            held, size = [], 0
    if held:
        yield as_batch(held, schema)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema
    )


def first_of_equal(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """(digest, first_id, n): payloads of ``least`` bytes that several rows have."""
    return (
        pages.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
    )


def page_payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (the html in UTF-8; null is empty) and its digest."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )


def chunk_table(pages: DataFrame, scratch: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The rows (record, chunk number) of the records of ``pages``.

    Of rows with equal payloads of at least LEAST_SHARED bytes the one with the
    smallest page_id is the response, the others revisit it without a payload.
    Rows that repeat this page_id too are responses all. A null page_id revisits
    one that is not null. A null html or url is empty. Extra columns are ignored.

    The first pass only shuffles digests. Its result, the digests that occur
    twice or more, is written to ``scratch``, so Spark knows its size when it
    picks a broadcast or a shuffled join, whose hot keys it splits.
    """
    spark = pages.sparkSession
    payloads = page_payloads(pages)
    first_of_equal(payloads).select("digest", "first_id").write.mode("overwrite").parquet(scratch)
    first = spark.read.schema("digest string, first_id long").parquet(scratch)
    # Short payloads are not in ``first``, so the digest alone decides.
    records = payloads.join(first, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(F.col("first_id").isNull() | F.col("page_id").eqNullSafe(F.col("first_id")), "response")
        .otherwise("revisit")
        .alias("record_type"),
        "first_id",
    )
    schema = arrow_schema(CHUNKS)

    def chunks(batches) -> Iterator[tuple[tuple, int]]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, digest, kind, first_id = (batch.column(c)[i] for c in range(6))
                page, url, kind = page.as_py(), url.as_py(), kind.as_py()
                body = memoryview(payload.as_buffer())
                row, size = f"{task}-{number}", len(body)
                number += 1
                if kind == "revisit":
                    yield (row, page, url, kind, first_id.as_py(), 1, size, digest.as_py(), True, b""), 0
                    continue
                running = hashlib.sha256()
                for no, start in enumerate(range(0, max(1, size), chunk_bytes), 1):
                    part = body[start : start + chunk_bytes]
                    running.update(part)
                    last = start + chunk_bytes >= size
                    yield (
                        (row, page, url, kind, None, no, size, running.hexdigest(), last, bytes(part)),
                        len(part),
                    )

    return records.mapInArrow(lambda batches: batches_of(chunks(batches), schema), CHUNKS)


def record_head(values: dict) -> bytes:
    """The header lines of one chunk row; the record ends with two line ends."""
    page = values["page_id"]
    kind = values["record_type"]
    origin = uuid.uuid5(uuid.NAMESPACE_OID, f"{page} {values['row']}")
    no, whole = values["chunk_no"], values["chunk_no"] == 1 and values["last"]
    fields = [
        ("WARC-Type", kind if no == 1 else "continuation"),
        ("WARC-Record-ID", f"<urn:uuid:{origin if no == 1 else uuid.uuid5(origin, str(no))}>"),
        ("WARC-Date", "2024-01-01T00:00:00Z"),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(len(values["chunk"]))),
        ("Source-Row", values["row"]),
        ("Payload-Length", str(values["total_bytes"])),
    ]
    if values["url"]:
        fields.append(("WARC-Target-URI", quote(values["url"], safe="!#$%&'()*+,/:;=?@[]~")))
    if page is not None:
        fields.append(("Source-Page", str(page)))
    if whole:
        fields.append(("WARC-Payload-Digest", f"sha256:{values['running_digest']}"))
    else:
        fields.append(("WARC-Segment-Number", str(no)))
        fields.append(("Payload-Digest-So-Far", f"sha256:{values['running_digest']}"))
        if no > 1:
            fields.append(("WARC-Segment-Origin-ID", f"<urn:uuid:{origin}>"))
        if values["last"]:
            fields.append(("WARC-Segment-Total-Length", str(values["total_bytes"])))
    if kind == "revisit":
        fields.append(
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        )
        fields.append(("Refers-To-Page", str(values["refers_to"])))
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"


def write_archives(chunks: DataFrame, path: str) -> None:
    """Writes chunk rows as WARC files of at most some 40 MB before compression.

    Rows are taken in the order of their partition, so the chunks of a record
    follow each other. Files appear when Spark commits the job; a lost task is
    run again and leaves nothing twice.
    """
    schema = arrow_schema("value binary")

    def blocks(batches) -> Iterator[tuple[tuple, int]]:
        held, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                for values in batch.slice(start, 64).to_pylist():
                    record = record_head(values) + values["chunk"]
                    if held and size + len(record) > BLOCK_BYTES:
                        yield (HEADER_ENDS.join(held),), size
                        held, size = [], 0
                    held.append(record)
                    size += len(record)
        if held:
            yield (HEADER_ENDS.join(held),), size

    # The separator that ends a block is the end of its last record.
    written = chunks.mapInArrow(lambda b: batches_of(blocks(b), schema), "value binary")
    written.select(F.col("value").cast("string")).write.option("lineSep", "\r\n\r\n").option(
        "compression", "gzip"
    ).option("maxRecordsPerFile", BLOCKS_PER_FILE).mode("overwrite").text(path)


class _Records:
    """Records of one gzip file, decompressed a piece at a time."""

    def __init__(self, data):
        self.data, self.at = memoryview(data), 0
        self.inflate = zlib.decompressobj(31)
        self.held = bytearray()

    def more(self) -> bool:
        while self.at < len(self.data):
            piece = self.inflate.unconsumed_tail or self.data[self.at : self.at + (64 << 10)]
            if not self.inflate.unconsumed_tail:
                self.at += len(piece)
            out = self.inflate.decompress(piece, 1 << 20)
            if self.inflate.eof:
                left = self.inflate.unused_data
                self.inflate = zlib.decompressobj(31)
                self.at -= len(left)
            if out:
                self.held += out
                return True
        tail = self.inflate.unconsumed_tail
        out = self.inflate.decompress(tail, 1 << 20) if tail else b""
        self.held += out
        return bool(out)

    def __iter__(self) -> Iterator[tuple[dict, bytes]]:
        while True:
            while (end := self.held.find(HEADER_ENDS)) < 0:
                if not self.more():
                    if self.held:
                        raise ValueError("the archive ends within a header")
                    return
            lines = bytes(self.held[:end]).decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            start, size = end + 4, int(fields["Content-Length"])
            while len(self.held) < start + size + 4:
                if not self.more():
                    raise ValueError("the archive ends within a record")
            body = bytes(self.held[start : start + size])
            del self.held[: start + size + 4]
            yield fields, body


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The chunk rows of all files in ``path``, with columns as in CHUNKS.

    total_bytes and running_digest are what the headers say; ``payload_digests``
    computes them anew from the chunks.
    """
    schema = arrow_schema(CHUNKS)

    def rows(batches) -> Iterator[tuple[tuple, int]]:
        for batch in batches:
            for i in range(batch.num_rows):
                for f, body in _Records(batch.column(0)[i].as_buffer()):
                    no = int(f.get("WARC-Segment-Number", 1))
                    whole = f.get("WARC-Payload-Digest")
                    page, refers = f.get("Source-Page"), f.get("Refers-To-Page")
                    total = int(f["Payload-Length"])
                    kind = "revisit" if f["WARC-Type"] == "revisit" else "response"
                    yield (
                        (
                            f["Source-Row"],
                            int(page) if page else None,
                            f.get("WARC-Target-URI"),
                            kind,
                            int(refers) if refers else None,
                            no,
                            total,
                            (whole or f["Payload-Digest-So-Far"]).removeprefix("sha256:"),
                            whole is not None or "WARC-Segment-Total-Length" in f,
                            body,
                        ),
                        len(body),
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(lambda b: batches_of(rows(b), schema), CHUNKS)


RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "chunk_no int, running_digest string, row string, last boolean, chunk binary"
)


def payload_digests(chunks: DataFrame, scratch: str) -> DataFrame:
    """Length and digest of every record, computed from its chunks.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to. A
    record in one chunk is done where it was read. The chunks of larger ones are
    sorted by record and number and folded in a stream, one chunk at a time; a
    running digest that differs from its chunks fails the job. A revisit reports
    the length and digest it was written with.
    """
    spark = chunks.sparkSession
    schema = arrow_schema(RECORDS)

    def singles(batches) -> Iterator[tuple[tuple, int]]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                for v in batch.slice(start, 64).to_pylist():
                    body = v["chunk"]
                    head = (v["page_id"],)
                    if v["record_type"] == "revisit":
                        done = (v["total_bytes"], v["running_digest"], "revisit", v["refers_to"])
                        yield (*head, *done, *[None] * 5), 0
                    elif v["chunk_no"] == 1 and v["last"]:
                        found = hashlib.sha256(body).hexdigest()
                        if found != v["running_digest"]:
                            raise ValueError(f"record {v['row']} has another payload")
                        yield (*head, len(body), found, "response", None, *[None] * 5), 0
                    else:
                        part = (v["chunk_no"], v["running_digest"], v["row"], v["last"], body)
                        yield (*head, None, None, "response", None, *part), len(body)

    chunks.mapInArrow(lambda b: batches_of(singles(b), schema), RECORDS).write.mode(
        "overwrite"
    ).parquet(scratch)
    read = spark.read.schema(RECORDS).parquet(scratch)
    result = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    ddl = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    folded = arrow_schema(ddl)

    def fold(batches) -> Iterator[tuple[tuple, int]]:
        record, size, running = None, 0, hashlib.sha256()
        for batch in batches:
            for i in range(batch.num_rows):
                row, page, no, said, last, chunk = (batch.column(c)[i] for c in range(6))
                if row.as_py() != record:
                    record, size, running = row.as_py(), 0, hashlib.sha256()
                size += len(chunk.as_buffer())
                running.update(chunk.as_buffer())
                if running.hexdigest() != said.as_py():
                    raise ValueError(f"chunk {no} of record {record} is missing or another")
                if last.as_py():
                    yield (page.as_py(), size, said.as_py(), "response", None), 0

    parts = (
        read.where("chunk_no is not null")
        .select("row", "page_id", "chunk_no", "running_digest", "last", "chunk")
        .repartition("row")
        .sortWithinPartitions("row", "chunk_no")
    )
    large = parts.mapInArrow(lambda b: batches_of(fold(b), folded), ddl)
    return read.where("chunk_no is null").select(*result).unionByName(large)
