"""WARC archives as a table of chunks, so that no record has to fit in memory.

A record is a run of rows (record, chunk number, bytes); its bytes laid end to end are a WARC
record. Every chunk carries the SHA-1 of the record up to its end, so a reader checks as it
goes and notices a lost or altered chunk at once. Records of one chunk are read where they
lie; the chunks of longer ones are brought together by record and streamed in order.

Of records with equal payloads of at least ``REVISIT_BYTES``, the one with the largest id is
the response and the others revisit it. A null id counts as the smallest; rows that repeat
the largest id are responses, too, as are all rows of a group without ids. A null payload is
empty. An empty table makes an empty archive. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from crmflow.operators.skew import DEFAULT_POLICY, SkewPolicy, fits_broadcast
from crmflow.storage import materialize

REVISIT_BYTES = 1000
#: Words of 64 bits in the bitmap of repeated digests, sent to every executor.
FILTER_WORDS = 1 << 19
CHUNK_BYTES = 64 << 10
#: Bytes of rows handed on at once.
_BATCH_BYTES = 4 << 20
_DATE = "1970-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNKS = "record bigint, chunk int, last boolean, data binary, digest binary"
RECORDS = (
    "page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, uri string"
)


def _attach_responses(rows: DataFrame, copied: DataFrame, policy: SkewPolicy) -> DataFrame:
    """The rows with the response of their digest, payloads staying where they lie as far as possible.

    A list of repeated digests that is measured to be small is broadcast. Beyond that a bitmap of
    ``FILTER_WORDS`` words at most is, and only large rows whose bit is set are shuffled: those of
    repeated digests, and a few others.
    """
    same = F.col("digest") == F.col("copied")
    if fits_broadcast(copied, policy):
        return rows.join(F.broadcast(copied), same, "left")

    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(FILTER_WORDS * 64))

    def shifted(function: str, value: Column, column: str) -> Column:
        return F.call_function(function, value, (place(column) % 64).cast("int"))

    one = shifted("shiftleft", F.lit(1).cast("bigint"), "copied")
    words = copied.groupBy(F.shiftright(place("copied"), 6).alias("_word")).agg(F.bit_or(one).alias("_bits"))
    word = F.when(F.col("size") >= REVISIT_BYTES, F.shiftright(place("digest"), 6))
    known = rows.join(F.broadcast(words), word == F.col("_word"), "left")
    marked = F.coalesce(shifted("shiftright", F.col("_bits"), "digest").bitwiseAND(1) == 1, F.lit(False))
    asked = known.where(marked).drop("_word", "_bits").join(copied, same, "left")
    alone = known.where(~marked).drop("_word", "_bits")
    return asked.unionByName(alone, allowMissingColumns=True)


def decide_revisits(
    pages: DataFrame, id_column: str, url_column: str, payload_column: str, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Per page: id, uri, payload, its size and SHA-1, and the id of the response it revisits, if any.

    Runs a job that stores the digests of repeated payloads.
    """
    payload = F.coalesce(pages[payload_column], F.lit("")).cast("binary")
    rows = pages.select(
        pages[id_column].alias("id"),
        pages[url_column].alias("uri"),
        payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("size"),
        F.sha1(payload).alias("digest"),
    )
    copied = (
        rows.filter(F.col("size") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("id").alias("response"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND response IS NOT NULL")
        .select(F.col("digest").alias("copied"), "response")
    )
    revisits = F.col("id").isNull() | (F.col("id") < F.col("response"))
    return _attach_responses(rows, materialize(copied, "copied"), policy).select(
        F.col("id").cast("string").alias("id"),
        "uri",
        "payload",
        "size",
        "digest",
        F.when(F.col("response").isNotNull() & revisits, F.col("response")).cast("string").alias("refers_to"),
    )


def _record_urn(page_id: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{digest}')}>"


def _head(page_id, uri, size: int, digest: str, refers_to) -> bytes:
    body = len(_HTTP) + (0 if refers_to is not None else size)
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_urn(page_id, digest)),
        ("WARC-Date", _DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Payload-Length", size),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", body),
    ]
    if page_id is not None:
        fields.append(("WARC-Page-ID", page_id))
    if uri is not None:
        # Line ends would end the field.
        fields.append(("WARC-Target-URI", uri.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        fields.append(("WARC-Profile", _PROFILE))
        fields.append(("WARC-Refers-To", _record_urn(refers_to, digest)))
        fields.append(("WARC-Refers-To-Page-ID", refers_to))
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + _HTTP


def _pieces(head: bytes, payload: memoryview, chunk_bytes: int) -> Iterator[list]:
    """The parts of a record that make up each chunk."""
    chunk, room = [], chunk_bytes
    for part in (memoryview(head), payload, memoryview(_END)):
        at = 0
        while at < len(part):
            taken = part[at : at + room]
            chunk.append(taken)
            at, room = at + len(taken), room - len(taken)
            if not room:
                yield chunk
                chunk, room = [], chunk_bytes
    if chunk:
        yield chunk


def to_chunks(decided: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk rows of the records of ``decide_revisits``."""
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
    names = ["record", "chunk", "last", "data", "digest"]

    def flush(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Numbers are unique in what is written, as the commit keeps one attempt of each task.
        record, held, rows = TaskContext.get().partitionId() << 33, 0, []
        for batch in batches:
            columns = [batch.column(i) for i in range(6)]
            for i in range(batch.num_rows):
                page_id, uri, _, size, digest, refers_to = (
                    None if k == 2 else columns[k][i].as_py() for k in range(6)
                )
                empty = refers_to is not None
                payload = memoryview(b"" if empty else columns[2][i].as_buffer())
                number, running = 0, hashlib.sha1()
                last = None
                for parts in _pieces(_head(page_id, uri, size, digest, refers_to), payload, chunk_bytes):
                    if last is not None:
                        rows.append(last)
                    data = b"".join(parts)
                    running.update(data)
                    last = (record, number, False, data, running.digest())
                    number, held = number + 1, held + len(data)
                    if held >= _BATCH_BYTES and rows:
                        yield flush(rows)
                        held, rows = len(data), []
                rows.append((*last[:2], True, *last[3:]))
                record += 1
        if rows:
            yield flush(rows)

    return decided.mapInArrow(run, CHUNKS)


class _Reader:
    """Reads one record from its chunks, keeping a hash instead of the payload."""

    def __init__(self, record: int):
        self.record, self.chunk = record, 0
        self.running, self.payload = hashlib.sha1(), hashlib.sha1()
        self.head: bytes | None = b""
        self.fields: dict[str, str] = {}
        self.left = self.size = 0

    def feed(self, chunk: int, data: bytes, digest: bytes) -> None:
        self.running.update(data)
        if chunk != self.chunk or self.running.digest() != digest:
            raise ValueError(f"record {self.record}: chunk {self.chunk} is missing or damaged")
        self.chunk += 1
        if self.head is not None:
            self.head += data
            end = self.head.find(_END)
            skip = end + len(_END) + len(_HTTP)
            if end < 0 or len(self.head) < skip:
                return
            lines = self.head[:end].decode().split("\r\n")[1:]
            self.fields = dict(line.split(": ", 1) for line in lines)
            self.left = int(self.fields["Content-Length"]) - len(_HTTP)
            data, self.head = self.head[skip:], None
        body = data[: self.left]
        self.payload.update(body)
        self.left, self.size = self.left - len(body), self.size + len(body)

    def row(self) -> tuple:
        if self.head is not None or self.left:
            raise ValueError(f"record {self.record} is cut short")
        fields, kind = self.fields, self.fields["WARC-Type"]
        stated = int(fields["WARC-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
        size, digest = (self.size, self.payload.hexdigest()) if kind == "response" else stated
        if (size, digest) != stated:
            raise ValueError(f"record {self.record}: the payload does not have its digest")
        uri = fields.get("WARC-Target-URI")
        if uri is not None:
            uri = uri.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
        return fields.get("WARC-Page-ID"), size, digest, kind, fields.get("WARC-Refers-To-Page-ID"), uri


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of records; the chunks of a record come one after the other, in order."""
    names = [field.split()[0] for field in RECORDS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
    reader = None
    for batch in batches:
        rows = []
        for record, chunk, last, data, digest in zip(*(column.to_pylist() for column in batch.columns)):
            if reader is None:
                reader = _Reader(record)
            elif reader.record != record:
                raise ValueError(f"record {reader.record} is cut short")
            reader.feed(chunk, data, digest)
            if last:
                rows.append(reader.row())
                reader = None
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    if reader is not None:
        raise ValueError(f"record {reader.record} is cut short")


def read_records(chunks: DataFrame) -> DataFrame:
    """One row per record of a chunk table; fails on a damaged one."""
    chunks = chunks.select("record", "chunk", "last", "data", "digest")
    alone = F.col("last") & (F.col("chunk") == 0)
    whole = chunks.filter(alone).mapInArrow(_read, RECORDS)
    parts = chunks.filter(~alone).repartition("record").sortWithinPartitions("record", "chunk")
    return whole.unionAll(parts.mapInArrow(_read, RECORDS))


def write_archive(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    chunk_bytes: int = CHUNK_BYTES,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> None:
    """Writes the chunk table of all pages to ``path``."""
    decided = decide_revisits(pages, id_column, url_column, payload_column, policy)
    to_chunks(decided, chunk_bytes).write.option("compression", "zstd").parquet(path)
