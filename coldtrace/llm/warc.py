"""WARC archives in chunks.

Chunks have a bounded size and carry the digest of everything up to them. Each becomes one WARC
record: a payload of several chunks is written as a first segment and its continuations. Up to the
writer a payload travels whole, as one row, and the writer holds whole copies of it; the reader holds
a chunk. `chunk_table` gives the chunks as rows; the writer does not go through it.
Archives are written and read by Spark's text source, whose line separators are the marks between
WARC records; they are compressed as whole files and so read by one task each, in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldtrace.llm.common import extended, salted_join, small_side

CHUNK = 1 << 20
#: Payloads of fewer bytes are always stored.
REVISIT_FROM = 100
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the format.
MARK = b"WARC/1.0\r\n"
CLOSE = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


@dataclass
class Chunk:
    number: int
    data: memoryview
    digest: str
    is_last: bool


def chunks(payload: bytes, size: int = CHUNK) -> Iterator[Chunk]:
    """Chunks of a payload with the SHA-256 of all bytes up to each; an empty one has one chunk."""
    view, running, at, number = memoryview(payload), hashlib.sha256(), 0, 1
    while True:
        part = view[at : at + size]
        running.update(part)
        at += len(part)
        yield Chunk(number, part, running.hexdigest(), at >= len(view))
        if at >= len(view):
            return
        number += 1


def chunk_table(records: DataFrame, size: int = CHUNK) -> DataFrame:
    """(record_id, payload) as (record_id, chunk_no, data, digest, is_last); NULL payloads are empty.

    Chunks of a record follow each other in the order of their numbers.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for record, payload in zip(batch.column(0), batch.column(1)):
                for c in chunks(payload.as_buffer() or b"", size):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([record.as_py()], record.type),
                            pa.array([c.number], pa.int64()),
                            pa.array([bytes(c.data)], pa.binary()),
                            pa.array([c.digest], pa.string()),
                            pa.array([c.is_last], pa.bool_()),
                        ],
                        names=["record_id", "chunk_no", "data", "digest", "is_last"],
                    )

    kind = records.schema["record_id"].dataType.simpleString()
    schema = f"record_id {kind}, chunk_no long, data binary, digest string, is_last boolean"
    return records.select("record_id", F.col("payload").cast("binary")).mapInArrow(cut, schema)


def with_digests(records: DataFrame, size: int = CHUNK) -> DataFrame:
    """Adds `payload_bytes` and `payload_digest`, taken chunk by chunk. `payload` comes last."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            found, sizes = [], []
            for payload in batch.column(last):
                data = payload.as_buffer() or b""
                sizes.append(len(data))
                *_, end = chunks(data, size)
                found.append(end.digest)
            added = [pa.array(sizes, pa.int64()), pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added],
                names=[*batch.schema.names, "payload_bytes", "payload_digest"],
            )

    schema = extended(records.schema, payload_bytes="long", payload_digest="string")
    return records.mapInArrow(digested, schema)


def judge_revisits(records: DataFrame, small: int = REVISIT_FROM) -> DataFrame:
    """Adds `refers_to`: the smallest record id with the same payload, NULL for that one itself.

    Records without an id are never referred to; payloads under `small` bytes refer to nothing.
    """
    payloads = with_digests(records.select("record_id", "payload"))
    repeated = (
        payloads.filter(F.col("payload_bytes") >= small)
        .groupBy("payload_digest")
        .agg(F.min("record_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("payload_digest", "first")
    )
    marked = salted_join(
        with_digests(records),
        small_side(repeated),
        ["payload_digest"],
        [F.col("record_id"), F.monotonically_increasing_id()],
    )
    again = F.col("record_id").isNull() | (F.col("record_id") != F.col("first"))
    return marked.withColumn("refers_to", F.when(again, F.col("first"))).drop("first")


def _urn(record: int | None) -> str:
    return f"<urn:x-page:{'' if record is None else record}>"


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"".join([MARK, head.encode(), b"Content-Length: %d\r\n\r\n" % len(block), block])


def _written(row: dict, size: int) -> Iterator[bytes]:
    """WARC records of one page: a revisit, a response, or a response in segments."""
    record, total = _urn(row["record_id"]), row["payload_bytes"]
    about = [
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        ("X-Payload-Length", str(total)),
    ]
    if row["url"]:
        about.append(("WARC-Target-URI", "".join(row["url"].split())))
    head = [("WARC-Record-ID", record), *about]
    if row["refers_to"] is not None:
        refers = [("WARC-Refers-To", _urn(row["refers_to"])), ("WARC-Profile", PROFILE)]
        yield _record([("WARC-Type", "revisit"), *head, *refers], b"")
        return
    http = ("Content-Type", "application/http; msgtype=response")
    for c in chunks(row["payload"], size):
        fields = [("WARC-Type", "response" if c.number == 1 else "continuation")]
        if c.number == 1:
            fields += [*head, http]
        else:
            fields += [
                ("WARC-Record-ID", f"{record[:-1]}:{c.number}>"),
                ("WARC-Segment-Origin-ID", record),
                ("WARC-Date", DATE),
            ]
        if not (c.number == 1 and c.is_last):
            fields.append(("WARC-Segment-Number", str(c.number)))
            if c.is_last:
                fields.append(("WARC-Segment-Total-Length", str(total + len(HTTP))))
        # What has gone before is bound to this chunk by the digest up to here.
        fields.append(("X-Running-Digest", f"sha256:{c.digest}"))
        yield _record(fields, (HTTP if c.number == 1 else b"") + bytes(c.data))


def write_archives(pages: DataFrame, path: str, size: int = CHUNK) -> None:
    """Writes pages (record_id, url, payload) as WARC files in the folder `path`.

    NULL payloads are empty. Rows that repeat an id are records of their own under the same id.
    """
    rows = pages.select(
        F.col("record_id").cast("long"),
        "url",
        F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload"),
    )
    judged = judge_revisits(rows)

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, held = [], 0
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                for value in _written(row, size):
                    values.append(value)
                    held += len(value)
                    if held > 4 * size:
                        yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], ["value"])
                        values, held = [], 0
            if values:
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], ["value"])

    lines = judged.mapInArrow(formatted, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", CLOSE).option("compression", "gzip").text(path)


class _Reader:
    """Follows the WARC records of one file; yields a row when a page is complete."""

    def __init__(self):
        self.page = None
        self.waiting = b""

    def feed(self, value: bytes):
        """One stretch between two marks. A mark inside a payload is put back."""
        if self.waiting:
            value = self.waiting + MARK + value
            self.waiting = b""
        elif not value:
            return None
        head, _, block = value.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
        length = int(fields["Content-Length"])
        if len(block) < length:
            self.waiting = value
            return None
        return self._segment(fields, memoryview(block)[:length])

    def _segment(self, fields: dict[str, str], block: memoryview):
        kind, number = fields["WARC-Type"], int(fields.get("WARC-Segment-Number", 1))
        if kind != "continuation":
            self.end()
            self.page = fields | {"running": hashlib.sha256(), "bytes": 0, "at": 0}
        page = self.page
        if page is None or number != page["at"] + 1:
            raise ValueError("a segment is missing or out of order")
        page["at"] = number
        if kind == "revisit":
            return self._row(page, int(page["X-Payload-Length"]), page["WARC-Payload-Digest"][7:])
        payload = block[len(HTTP) :] if number == 1 else block
        page["running"].update(payload)
        page["bytes"] += len(payload)
        digest = page["running"].hexdigest()
        if fields["X-Running-Digest"] != f"sha256:{digest}":
            raise ValueError("a chunk does not match its digest")
        if "WARC-Segment-Number" in fields and "WARC-Segment-Total-Length" not in fields:
            return None
        if f"sha256:{digest}" != page["WARC-Payload-Digest"]:
            raise ValueError("a payload does not match its digest")
        return self._row(page, page["bytes"], digest)

    def _row(self, page: dict, size: int, digest: str) -> tuple:
        self.page = None
        number = lambda urn: int(n) if (n := urn[12:-1]) else None
        refers = page.get("WARC-Refers-To")
        return (
            number(page["WARC-Record-ID"]),
            page.get("WARC-Target-URI"),
            size,
            digest,
            page["WARC-Type"],
            number(refers) if refers else None,
        )

    def end(self) -> None:
        if self.page is not None or self.waiting:
            raise ValueError("an archive ends within a record")


FIELDS = [
    ("record_id", pa.int64()),
    ("url", pa.string()),
    ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()),
    ("record_type", pa.string()),
    ("refers_to", pa.int64()),
]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page of the archives, digests taken anew from the payloads and compared."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader()
        for batch in batches:
            rows = [r for v in batch.column(0) if (r := reader.feed(v.as_py())) is not None]
            if rows:
                columns = [pa.array(c, kind) for c, (_, kind) in zip(zip(*rows), FIELDS)]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(FIELDS))
        reader.end()

    lines = spark.read.option("lineSep", MARK.decode()).text(path)
    schema = (
        "record_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long"
    )
    return lines.select(F.col("value").cast("binary")).mapInArrow(parsed, schema)
