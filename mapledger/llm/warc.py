"""Web archives with a two-level capture index.

Each page becomes a WARC record, compressed by itself, in a file that its task writes to the shared folder.
Captures are sorted by reversed-host URL key into shards of the index. A shard holds blocks of capture lines,
compressed, and at its end a sparse directory: first and last key, place and length of each block. A look-up
takes a key to the shards that may hold it, by the shards' first and last keys; binary search in a shard's
directory gives the blocks; and blocks and records are read by range. Nothing is scanned.

Files go through pyarrow's file systems, so any shared folder they know will do. A task that is run again
writes files of a new name; only files that a finished task names in its rows are ever read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.operators.joins import split_join
from mapledger.session import fresh_path, written

from .common import utf8

# Captures of a shard and of a block of it, and bytes after which a task begins another archive.
SHARD_LINES, BLOCK_LINES, ARCHIVE_BYTES = 50_000, 500, 1 << 30
# Tasks that read records, for each shard there is.
TASKS_PER_SHARD = 16

CAPTURE = "key string, page_id {kind}, file string, offset long, length long"


def url_key(url: Column) -> Column:
    """The sort key of a URL: host labels from the top domain down, then path and query. Null: empty."""
    parts = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)([^#]*)", 1)
    rest = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)([^#]*)", 2)
    key = F.concat(F.array_join(F.reverse(F.split(F.lower(parts), r"\.")), ","), F.lit(")"), rest)
    return F.coalesce(F.when(F.length(parts) > 0, key).otherwise(url), F.lit(""))


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: object, url: str | None, payload: bytes, kind: str, refers_to: object) -> bytes:
    """One WARC record. A revisit has the response's HTTP header alone, with the full payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Target-URI: {json.dumps(url) if url is None or not url.isprintable() else url}",
        "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
    ]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_record(data: bytes) -> dict[str, object]:
    """Header fields, and of a response its payload, checked against the stated lengths and digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
    found = {
        "type": fields["WARC-Type"], "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "size": size,
        "refers_to": fields["WARC-Refers-To"][10:-1] if "WARC-Refers-To" in fields else None, "payload": None,
    }
    if found["type"] == "response":
        if len(payload) != size or digest(payload) != found["digest"]:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        found["payload"] = payload
    return found


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    system, base = fs.FileSystem.from_uri(path)
    return system, base.rstrip("/")


def write_archives(pages: DataFrame, least_bytes: int = 0) -> tuple[str, DataFrame]:
    """The folder of the archives, and a row (key, page_id, file, offset, length) for each record.

    Of pages with equal payloads of ``least_bytes`` or more, that with the largest page_id is the response
    and others revisit it; all others are responses. Null html is the empty payload. Rows that share the
    largest page_id are responses all; pages of null page_id revisit one with an id if there is one and are
    responses otherwise. Other columns are not looked at.
    """
    path = fresh_path(pages.sparkSession, "archives")
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", "url", utf8("html").alias("payload")).withColumn("hash", F.sha1("payload"))
    first = rows.where(F.octet_length("payload") >= least_bytes).groupBy("hash").agg(F.max("page_id").alias("response"))
    rows = split_join(rows, first, ["hash"], "left")
    repeat = F.col("response").isNotNull() & (F.octet_length("payload") >= least_bytes)
    repeat = repeat & ~F.col("page_id").eqNullSafe(F.col("response"))
    rows = rows.select(
        url_key(F.col("url")).alias("key"), "page_id", "url", "payload", F.when(repeat, F.col("response")).alias("refers_to"),
        repeat.alias("revisit"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _folder(path)
        system.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                places = []
                for page_id, url, payload, refers_to, revisit in zip(*(batch.column(i).to_pylist() for i in range(1, 6)), strict=True):
                    if out is None or at > ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{base}/{name}", compression=None)
                    data = gzip.compress(
                        record(page_id, url, payload, "revisit" if revisit else "response", refers_to), 6, mtime=0
                    )
                    out.write(data)
                    places.append((name, at, len(data)))
                    at += len(data)
                files, offsets, lengths = list(zip(*places, strict=True)) or [()] * 3
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    ["key", "page_id", "file", "offset", "length"],
                )
        finally:
            if out is not None:
                out.close()

    return path, written(rows.mapInArrow(write, CAPTURE.format(kind=kind)), "captures")


def write_index(path: str, captures: DataFrame) -> DataFrame:
    """Write the shards of the index beside the archives; a row (shard, first, last) for each."""
    shards = max(1, -(-captures.count() // SHARD_LINES))
    ordered = captures.repartitionByRange(shards, "key", "page_id", "file", "offset")
    ordered = ordered.sortWithinPartitions("key", "page_id", "file", "offset")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _folder(path)
        name = f"{uuid.uuid4().hex}.index"
        directory: list[tuple[str, str, int, int]] = []
        lines: list[tuple] = []
        at = 0
        with system.open_output_stream(f"{base}/{name}", compression=None) as out:
            def block() -> None:
                nonlocal at, lines
                data = zlib.compress("\n".join(json.dumps(line) for line in lines).encode())
                out.write(data)
                directory.append((lines[0][0], lines[-1][0], at, len(data)))
                at, lines = at + len(data), []

            for batch in batches:
                for line in zip(batch.column(0).to_pylist(), *(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                    lines.append(line)
                    if len(lines) == BLOCK_LINES:
                        block()
            if lines:
                block()
            data = zlib.compress(json.dumps(directory).encode())
            out.write(data)
            out.write(len(data).to_bytes(8, "big"))
        if directory:
            yield pa.RecordBatch.from_pydict({"shard": [name], "first": [directory[0][0]], "last": [directory[-1][1]]})

    return written(ordered.mapInArrow(write, "shard string, first string, last string"), "shards")


def look_up(path: str, shards: DataFrame, keys: DataFrame) -> DataFrame:
    """(page_id as text, type, digest, size, refers_to as text, payload) of every capture of some URL keys.

    ``keys`` has a column key. A key that is asked twice is answered once; null keys and keys that have no
    capture give no rows. What every task gets whole is a first and a last key per shard of 50,000 captures.
    """
    tops = sorted((r["first"], r["last"], r["shard"]) for r in shards.collect())
    firsts, lasts = [t[0] for t in tops], [t[1] for t in tops]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, names = [], []
            for key in batch.column(0).to_pylist():
                for at in range(bisect_left(lasts, key), bisect_right(firsts, key)):
                    keys.append(key)
                    names.append(tops[at][2])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(keys, pa.string())], ["shard", "key"])

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _folder(path)

        @lru_cache(maxsize=4)
        def directory(name: str) -> list[list]:
            with system.open_input_file(f"{base}/{name}") as file:
                end = file.size() - 8
                size = int.from_bytes(file.read_at(8, end), "big")
                return json.loads(zlib.decompress(file.read_at(size, end - size)))

        for batch in batches:
            rows = []
            for name, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                blocks = directory(name)
                low = bisect_left(blocks, key, key=lambda b: b[1])
                high = bisect_right(blocks, key, key=lambda b: b[0])
                rows += [(name, at, size, key) for _, _, at, size in blocks[low:high]]
            names, places, sizes, keys = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(places, pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.string())],
                ["shard", "at", "size", "key"],
            )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _folder(path)

        @lru_cache(maxsize=8)
        def opened(name: str) -> pa.NativeFile:
            return system.open_input_file(f"{base}/{name}")

        @lru_cache(maxsize=2)
        def lines(name: str, at: int, size: int) -> dict[str, list[list]]:
            text = zlib.decompress(opened(name).read_at(size, at)).decode()
            return {k: list(v) for k, v in groupby(map(json.loads, text.split("\n")), key=lambda line: line[0])}

        def out(records: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                name: pa.array([r[name] for r in records], kind) for name, kind in (
                    ("page_id", pa.string()), ("type", pa.string()), ("digest", pa.string()), ("size", pa.int64()),
                    ("refers_to", pa.string()), ("payload", pa.binary()),
                )
            })

        found, held = [], 0
        for batch in batches:
            for name, at, size, key in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                for _, file, offset, length in lines(name, at, size).get(key, ()):
                    data = gzip.decompress(opened(file).read_at(length, offset))
                    page_id = data.split(b"<urn:page:", 1)[1].split(b">", 1)[0].decode()
                    found.append({"page_id": page_id} | read_record(data))
                    held += len(data)
                    if held > 1 << 24:
                        yield out(found)
                        found, held = [], 0
        yield out(found)

    asked = keys.select("key").where("key is not null").distinct()
    routed = asked.mapInArrow(route, "shard string, key string")
    places = routed.repartition("shard").sortWithinPartitions("shard", "key").mapInArrow(
        locate, "shard string, at long, size long, key string"
    )
    # The rows that name blocks are tiny next to the records behind them: tasks are counted by blocks, not by bytes.
    near = places.repartition(max(1, TASKS_PER_SHARD * len(tops)), "shard", "at").sortWithinPartitions("shard", "at", "key")
    return near.mapInArrow(
        fetch, "page_id string, type string, digest string, size long, refers_to string, payload binary"
    )


def capture_report(pages: DataFrame) -> DataFrame:
    """Archive all ``pages`` and read every record back through the index, by the URL keys of all pages."""
    kind = pages.schema["page_id"].dataType.simpleString()
    path, captures = write_archives(pages)
    shards = write_index(path, captures)
    read = look_up(path, shards, captures)

    def number(column: str) -> Column:
        return F.when(F.col(column) != "None", F.col(column).cast(kind))

    return read.select(
        number("page_id").alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), number("refers_to").alias("refers_to"),
    )
