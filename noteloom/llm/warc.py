"""WARC archives in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each with some whole WARC records, and a closing seek table in a
skippable frame: the sizes of every frame.  An index maps a record's identifier to the bundle, the frame, and
the record's place in the frame, so one record costs one seek and one frame.  Payloads that were
archived before are written as revisits without the payload.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteloom.llm.scratch import fresh, opened_store, written

LEAST = 100  # payload bytes from which equal payloads are revisits
FRAME_BYTES = 1 << 20  # records are added to a frame until it holds so many
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the seekable format: a skippable frame with a table and a footer
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
HEAD, ENTRY, TAIL = "<II", "<II", "<IBI"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "record_id string, page_id bigint, bundle string, frame int, frame_start bigint, frame_bytes bigint, start bigint, length bigint"
RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _line(value: str | None) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value or "")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC/1.1 response with its payload, or a revisit with the digest and size of the payload it stands for."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join([*lines, "", ""]).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """Headers, HTTP length and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
    block = rest[: int(headers["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":", 1)[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return {"headers": headers, "payload_bytes": size, "payload": payload}


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame with compressed and full size of every frame."""
    body = b"".join(struct.pack(ENTRY, *f) for f in frames) + struct.pack(TAIL, len(frames), 0, SEEKABLE)
    return struct.pack(HEAD, SKIPPABLE, len(body)) + body


class Bundle:
    """A bundle opened for reading by frame; ``source`` is an open file that can seek."""

    def __init__(self, source: pa.NativeFile):
        self.source = source
        size, tail = source.size(), struct.calcsize(TAIL)
        source.seek(size - tail)
        count, flags, magic = struct.unpack(TAIL, source.read(tail))
        if magic != SEEKABLE or flags:
            raise ValueError("no seek table of the kind written here")
        width = struct.calcsize(ENTRY)
        source.seek(size - tail - count * width)
        table = np.frombuffer(source.read(count * width), "<u4").reshape(-1, 2).astype(np.int64)
        self.sizes, self.full = table[:, 0], table[:, 1]
        self.starts = np.cumsum(self.sizes) - self.sizes

    def frame(self, number: int) -> bytes:
        self.source.seek(int(self.starts[number]))
        data = self.source.read(int(self.sizes[number]))
        return zstandard.ZstdDecompressor().decompress(data, max_output_size=int(self.full[number]))

    def record(self, frame: int, start: int, length: int) -> dict:
        return parsed(self.frame(frame)[start : start + length])


def marked(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``(page_id, url, payload, digest, refers_to, revisit)`` of every ``(page_id, url, html)`` row.

    The first of equal payloads of ``least`` bytes or more is the one with the smallest ``page_id``; rows that repeat that
    id with that payload are responses too.  Where all of a payload's rows have a null id, all are responses.
    A null html is an empty payload.

    Only digests are grouped; digests met once drop out before the pages are joined with the rest.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long = rows.filter(F.octet_length("payload") >= least)
    firsts = long.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # written, so that the join can split a digest that very many pages share
    firsts = written(firsts.withColumnRenamed("digest", "first_digest"), "repeated-payloads")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    joined = rows.join(firsts, (F.col("digest") == F.col("first_digest")) & (F.octet_length("payload") >= least), "left")
    return joined.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("first_id")).alias("refers_to"), revisit.alias("revisit"))


def write_bundles(pages: DataFrame, folder: str, least: int = LEAST, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write ``(page_id, url, html)`` as WARC bundles to ``folder``; returns the written index, one row a record.

    Every attempt of a task writes a bundle of its own; the index names those that counted.  A record longer than a frame
    has a frame to itself.  Other columns are ignored; an empty table has no bundles and no index rows.
    ``folder`` is a URI that executors reach.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened_store(folder)
        name, sink, packer = f"{uuid.uuid4().hex}.warc.zst", None, zstandard.ZstdCompressor(level=LEVEL)
        frames: list[tuple[int, int]] = []
        held, ids, pages_, places, begin = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal held, ids, pages_, places, begin
            full = b"".join(held)
            data = packer.compress(full)
            sink.write(data)
            n = len(ids)
            row = [ids, pages_, [f"{folder}/{name}"] * n, [len(frames)] * n, [begin] * n, [len(data)] * n, [p for p, _ in places], [s for _, s in places]]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 4]
            frames.append((len(data), len(full)))
            begin += len(data)
            held, ids, pages_, places = [], [], [], []
            names = ["record_id", "page_id", "bundle", "frame", "frame_start", "frame_bytes", "start", "length"]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names)

        size = 0
        for batch in batches:
            for at in range(batch.num_rows):
                if sink is None:
                    store.create_dir(root, recursive=True)
                    sink = store.open_output_stream(f"{root}/{name}", compression=None)
                page_id, url, payload, digest, refers_to, revisit = (batch.column(c)[at].as_py() for c in range(6))
                data = record(page_id, url, payload, digest, refers_to, revisit)
                if held and size + len(data) > frame_bytes:
                    yield flush()
                    size = 0
                held.append(data)
                ids.append(record_id(page_id))
                pages_.append(page_id)
                places.append((size, len(data)))
                size += len(data)
        if held:
            yield flush()
        if sink is not None:
            sink.write(seek_table(frames))
            sink.close()

    return written(marked(pages, least).mapInArrow(run, INDEX), "warc-index")


def read_bundles(index: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of every record, read back by the index.

    Index rows are dealt out by bundle and frame, so that a frame is read once, for all its records.  A response's
    digest and size are taken from its payload, and must be those in its headers; a revisit has them in its headers.
    """

    def page_of(value: str | None) -> int | None:
        return None if value in (None, record_id(None)) else int(value[len("<urn:page:") : -1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, bundle, data, at_frame = None, None, b"", None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["bundle"] != opened:
                    store, path = opened_store(row["bundle"])
                    if bundle is not None:
                        bundle.source.close()
                    opened, bundle, at_frame = row["bundle"], Bundle(store.open_input_file(path)), None
                if row["frame"] != at_frame:
                    at_frame, data = row["frame"], bundle.frame(row["frame"])
                one = parsed(data[row["start"] : row["start"] + row["length"]])
                headers = one["headers"]
                if headers["warc-record-id"] != row["record_id"]:
                    raise ValueError(f"the index leads to another record than {row['record_id']}")
                size, digest = one["payload_bytes"], headers["warc-payload-digest"].removeprefix("sha256:")
                if headers["warc-type"] == "response" and (len(one["payload"]), hashlib.sha256(one["payload"]).hexdigest()) != (size, digest):
                    raise ValueError(f"the payload of {row['record_id']} was damaged")
                out.append((page_of(headers["warc-record-id"]), size, digest, headers["warc-type"], page_of(headers.get("warc-refers-to"))))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            columns = [pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        if bundle is not None:
            bundle.source.close()

    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.select("record_id", "bundle", "frame", "start", "length").repartition(tasks, "bundle", "frame")
    return dealt.sortWithinPartitions("bundle", "frame", "start").mapInArrow(run, RECORDS)


def archive(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Write ``pages`` to bundles in a new shared folder and read them back; one row for each row given."""
    return read_bundles(write_bundles(pages, fresh(pages.sparkSession, "warc"), least))
