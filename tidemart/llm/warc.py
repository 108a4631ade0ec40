"""WARC archives with a two-level capture index.

``write_archives`` writes one record per row, each a gzip member of its own, into archive files of
bounded size. Of rows with equal payloads of ``LEAST_REVISIT`` bytes or more, that of the least id is
a ``response``; the others are ``revisit`` records that refer to it and carry no payload.

``build_index`` sorts the captures by key (reversed host, path, id) in a range shuffle. Each partition
writes an index file: compressed blocks of ``BLOCK_CAPTURES`` sorted lines, then a directory of the
blocks' first keys. The root has a row per index file. ``lookup`` finds keys by binary search in the
root, in one file's directory and in one block, which it gets by a range read; sorted keys meet each
block once. ``fetch`` sorts captures by file and offset and reads neighbours in one range.

A worker holds one directory (a row per block), one block and one range. Files get names of their
own in every attempt, and readers follow the names that finished attempts reported. Hot hosts and
hot payloads are no keys of a shuffle by themselves: keys end in the id, and repeated payloads are
reduced to one row each before the join.

Defined results: a null payload is empty. A null id sorts last, is never the id that a revisit gives
unless all are null, and reads back as null. Rows that repeat the id of a response are responses too.
A null or blank address leaves out the target header; control characters and spaces in addresses
are percent-coded in keys and headers. Repeated rows give a record each. Empty tables give no files.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import Workspace, small_side
from tidemart.llm.shared_files import fresh, opened

LEAST_REVISIT = 100
FILE_BYTES = 256_000_000
BLOCK_CAPTURES = 3_000
READ_BYTES = 4_000_000
# Bytes of records that one task reads.
TASK_BYTES = 64 * 1024 * 1024
_LEVEL = 4
_NO_ID = 2**63 - 1

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """An address with the names of its host in reverse: ``com,example,www)/path?query``."""
    clean = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), r"[\x00-\x20\x7f]", "%20")
    parts = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/?#]*)(.*)$"
    host = F.array_join(F.reverse(F.split(F.lower(F.regexp_extract(clean, parts, 1)), r"\.")), ",")
    return F.when(clean.rlike(parts), F.concat(host, F.lit(")"), F.regexp_extract(clean, parts, 2))).otherwise(
        F.concat(F.lit("-)"), clean))


def capture_key(url: Column, ident: Column) -> Column:
    """The key of one capture; ids of one address sort as numbers."""
    shown = F.lpad((F.coalesce(ident, F.lit(_NO_ID)).cast("decimal(20,0)") + F.lit(Decimal(2**63)))
                   .cast("decimal(20,0)").cast("string"), 20, "0")
    return F.concat_ws(" ", url_key(url), shown)


def typed(pages: DataFrame, work: Workspace, ident: str = "page_id", url: str = "url",
          payload: str = "html") -> DataFrame:
    """Rows as they are to be written: key, id, url, digest, bytes, payload and what they refer to."""
    body = F.coalesce(F.col(f"`{payload}`"), F.lit(""))
    rows = pages.select(capture_key(F.col(f"`{url}`"), F.col(f"`{ident}`")).alias("key"),
                        F.coalesce(F.col(f"`{ident}`"), F.lit(_NO_ID)).alias("id"), F.col(f"`{url}`").alias("url"),
                        F.unhex(F.sha2(body, 256)).alias("digest"), F.octet_length(body).cast("long").alias("bytes"),
                        body.alias("payload"))
    first = work.save(rows.where(F.col("bytes") >= LEAST_REVISIT).groupBy("digest")
                      .agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "repeated")
    # 40 bytes a row; beyond this bound both sides are shuffled, and a hot payload is split.
    refers = F.when(F.col("first") != F.col("id"), F.col("first"))
    return (rows.join(small_side(first, 300_000), "digest", "left").withColumn("refers_to", refers)
            .withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload"))).drop("first"))


def _shown(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url.strip())


def _name(ident: int) -> str:
    return f"<urn:capture:{'none' if ident == _NO_ID else ident}>"


def _record(row: dict) -> bytes:
    refers, url = row["refers_to"], _shown(row["url"] or "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    block = http + (row["payload"] or "").encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}",
            f"WARC-Record-ID: {_name(row['id'])}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha256:{row['digest'].hex()}", "Content-Type: application/http;msgtype=response",
            f"Content-Length: {len(block)}"]
    if url:
        head.append(f"WARC-Target-URI: {url}")
    if refers is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_name(refers)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _write(batches: Iterator[pa.RecordBatch], folder: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    out, name, at = None, None, 0
    try:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                rows = batch.slice(start, 200).to_pylist()
                made = []
                for row in rows:
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        uri, out = fresh(folder, "capture", ".warc.gz")
                        name, at = uri.rsplit("/", 1)[1], 0
                    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
                    data = packer.compress(_record(row)) + packer.flush()
                    out.write(data)
                    made.append((row["key"], name, at, len(data)))
                    at += len(data)
                yield pa.record_batch([pa.array(c) for c in zip(*made, strict=True)], names=["key", "file", "offset", "length"])
    finally:
        if out is not None:
            out.close()


_CAPTURE = "key string, file string, offset long, length long"


def write_archives(pages: DataFrame, work: Workspace, ident: str = "page_id", url: str = "url", payload: str = "html",
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all rows to archives below ``work``; returns the captures: key, file, offset, length."""
    folder = work.path("warc")
    rows = typed(pages, work, ident, url, payload)
    return work.save(rows.mapInArrow(lambda x: _write(x, folder, file_bytes), _CAPTURE), "captures")


def _write_index(batches: Iterator[pa.RecordBatch], folder: str, captures: int) -> Iterator[pa.RecordBatch]:
    """One index file of the sorted lines of a partition."""
    lines: list[str] = []
    directory: list[str] = []
    at, out, uri, first = 0, None, None, None

    def block() -> None:
        nonlocal at
        data = zlib.compress("\n".join(lines).encode(), _LEVEL)
        out.write(data)
        directory.append(f"{lines[0].split(chr(9), 1)[0]}\t{at}\t{len(data)}")
        at += len(data)
        lines.clear()

    for batch in batches:
        for key, file, offset, length in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if out is None:
                first = key
                uri, out = fresh(folder, "index", ".cdx")
            lines.append(f"{key}\t{file}\t{offset}\t{length}")
            if len(lines) == captures:
                block()
    if out is not None:
        if lines:
            block()
        data = zlib.compress("\n".join(directory).encode(), _LEVEL)
        out.write(data)
        out.close()
        yield pa.record_batch([[first], [uri], [at], [len(data)]], names=["first", "file", "offset", "length"])


class Root(NamedTuple):
    """The sorted first keys of the index files, and where each file's directory lies."""

    first: list[str]
    files: list[tuple[str, int, int]]


def build_index(captures: DataFrame, work: Workspace, block_captures: int = BLOCK_CAPTURES) -> Root:
    folder = work.path("cdx")
    dealt = captures.select("key", "file", "offset", "length").repartitionByRange("key").sortWithinPartitions("key")
    built = dealt.mapInArrow(lambda x: _write_index(x, folder, block_captures),
                             "first string, file string, offset long, length long")
    # A row per partition of the range shuffle.
    rows = sorted(work.save(built, "root").collect())
    return Root([r.first for r in rows], [(r.file, r.offset, r.length) for r in rows])


class _Ranges:
    """Range reads; keeps the file read last open."""

    def __init__(self):
        self.uri, self.source = None, None

    def read(self, uri: str, offset: int, length: int) -> bytes:
        if uri != self.uri:
            system, path = opened(uri)
            self.uri, self.source = uri, system.open_input_file(path)
        self.source.seek(offset)
        return self.source.read(length)


class _Index:
    def __init__(self, root: Root):
        self.root, self.ranges = root, _Ranges()
        self.file, self.directory, self.at, self.block = None, [], None, []

    def _open(self, number: int) -> None:
        if number != self.file:
            text = zlib.decompress(self.ranges.read(*self.root.files[number])).decode()
            self.directory = [(key, int(a), int(b)) for key, a, b in (x.split("\t") for x in text.split("\n"))]
            self.file, self.at = number, None

    def _load(self, at: int) -> None:
        if at != self.at:
            _, offset, length = self.directory[at]
            data = zlib.decompress(self.ranges.read(self.root.files[self.file][0], offset, length)).decode()
            self.block, self.at = [x.split("\t") for x in data.split("\n")], at

    def find(self, wanted: str, prefix: bool) -> Iterator[list[str]]:
        """Lines whose key is, or begins with, what is wanted."""
        number = max(bisect_left(self.root.first, wanted) - 1, 0)
        while number < len(self.root.first):
            if self.root.first[number] > wanted and not self.root.first[number].startswith(wanted):
                return
            self._open(number)
            at = max(bisect_left(self.directory, wanted, key=lambda x: x[0]) - 1, 0)
            while at < len(self.directory):
                key = self.directory[at][0]
                if key > wanted and not (prefix and key.startswith(wanted)):
                    return
                self._load(at)
                for line in self.block[bisect_left(self.block, wanted, key=lambda x: x[0]):]:
                    if line[0] != wanted and not (prefix and line[0].startswith(wanted)):
                        return
                    yield line
                at += 1
            number += 1


def lookup(keys: DataFrame, root: Root, key: str = "key", prefix: bool = False) -> DataFrame:
    """Captures of the distinct keys asked for: wanted, key, file, offset, length.

    With ``prefix``, all captures whose key begins so: ``url_key`` and a space for an address, ``com,example`` for a domain.
    """
    def run(batches):
        index = _Index(root)
        for batch in batches:
            found = []
            for wanted in batch.column(0).to_pylist():
                for line in index.find(wanted, prefix):
                    found.append((wanted, line[0], line[1], int(line[2]), int(line[3])))
                    if len(found) == 10_000:
                        yield _rows(found)
                        found = []
            yield _rows(found)

    def _rows(found):
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        columns = list(zip(*found, strict=True)) or [()] * 5
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                               names=["wanted", "key", "file", "offset", "length"])

    if not root.first:
        return keys.select(F.col(key).alias("wanted")).where("false").selectExpr(
            "wanted", "'' AS key", "'' AS file", "0L AS offset", "0L AS length")
    asked = keys.select(F.col(key).cast("string").alias("wanted")).where("wanted IS NOT NULL").distinct()
    return (asked.repartitionByRange("wanted").sortWithinPartitions("wanted")
            .mapInArrow(run, f"wanted string, {_CAPTURE}"))


def parse_record(data: bytes) -> dict:
    """Fields of one record: id, url, record type, reference, digest, and the payload of a response."""
    text = zlib.decompress(data, 31)
    head, rest = text.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])

    def number(name: str) -> int | None:
        shown = fields[name][len("<urn:capture:"):-1] if name in fields else "none"
        return None if shown == "none" else int(shown)

    kept = fields["WARC-Type"] == "response"
    if kept and len(payload) != size:
        raise ValueError(f"{fields['WARC-Record-ID']}: {len(payload)} of {size} bytes")
    return {"id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
            "refers_to": number("WARC-Refers-To"), "payload_bytes": size, "payload": payload if kept else None,
            "payload_digest": hashlib.sha256(payload).hexdigest() if kept else
            fields["WARC-Payload-Digest"].removeprefix("sha256:")}


_RECORD = {"id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
           "payload_bytes": pa.int64(), "payload": pa.binary(), "payload_digest": pa.string()}
_RECORD_DDL = ("id long, url string, record_type string, refers_to long, payload_bytes long, payload binary, "
               "payload_digest string")


def fetch(captures: DataFrame, work: Workspace, payloads: bool = True) -> DataFrame:
    """The records of captures; digests of responses are computed from what was read.

    References are small and records are not: the number of tasks follows from the records' bytes.
    """
    folder = work.path("warc")
    wanted = work.save(captures.select("file", "offset", "length"), f"wanted-{uuid.uuid4().hex}")
    size = wanted.agg(F.sum("length")).first()[0] or 0
    tasks = max(-(-size // TASK_BYTES), min(work.spark.sparkContext.defaultParallelism, -(-size // READ_BYTES)), 1)

    def read(spans):
        ranges = _Ranges()
        for group in _ranges_of(spans):
            file, start = group[0][0], group[0][1]
            data = ranges.read(f"{folder}/{file}", start, group[-1][1] + group[-1][2] - start)
            for _, offset, length in group:
                yield parse_record(data[offset - start:offset - start + length])

    def run(batches):
        for batch in batches:
            rows, size = [], 0
            for record in read(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)):
                if not payloads:
                    record["payload"] = None
                rows.append(record)
                size += len(record["payload"] or b"") + 200
                if size >= READ_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema(_RECORD))
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, pa.schema(_RECORD))

    return (wanted.repartitionByRange(tasks, "file", "offset")
            .sortWithinPartitions("file", "offset").mapInArrow(run, _RECORD_DDL))


def _ranges_of(spans) -> Iterator[list[tuple[str, int, int]]]:
    """Groups of spans that follow one another in a file, up to ``READ_BYTES`` each."""
    group: list[tuple[str, int, int]] = []
    for file, offset, length in spans:
        if group and (file != group[0][0] or offset > group[-1][1] + group[-1][2]
                      or offset + length - group[0][1] > READ_BYTES):
            yield group
            group = []
        group.append((file, offset, length))
    if group:
        yield group
