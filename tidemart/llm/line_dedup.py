"""Line dedup: sharded minimal perfect hashes over line hashes, probed by the documents.

A line's key is the line without white space at its ends, in lower case (A-Z only). A key found in
several documents keeps its lines in the smallest document id that holds it and loses them in all
others. Line hashes (128 bits) are reduced to one row per key, within each task first, so that a
line of every document costs a row per task. Keys of several documents go to shards by hash, of
even size whatever the lines are. A shard is a minimal perfect hash, whose slot leads into an array
of fingerprints (the other half of the hash), of first documents and of counts. Keys of one
document need no slot: their probes meet a foreign fingerprint.

An index of at most ``HELD_BYTES`` comes to the documents: they are read again in blocks of
``BLOCK_CHARS``, a worker opens each shard once and keeps it, and nothing is shuffled. Beyond that the
hashes go to the index: documents are written with a number for each row, a row of five numbers for
every line goes to its line's shard, each shard is opened once and says which lines go, and a row's
verdicts meet its text again by number. A shard asked for more than ``PROBES`` lines, as a frequent
line makes it, is opened by so many tasks more. Both ways give the same results.

Defined results: a null text is one empty line and comes back empty; ``\\n`` alone parts lines. A
null id counts as one document, after all others. Rows that repeat an id are the same document. All
other columns pass through; ``n_lines`` and ``n_dropped`` replace columns of those names. Empty
tables give empty tables.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import Workspace, small_side
from tidemart.llm.perfect_hash import PerfectHash
from tidemart.llm.shared_files import get, put

LEAST_CHARS = 10
SHARD_KEYS = 500_000
BLOCK_CHARS = 16_000_000
HELD_BYTES = 64_000_000
PROBES = 4_000_000

_WHITE = b" \t\n\x0b\x0c\r"
_NO_ID = np.iinfo(np.int64).max
_FOUND = "lo long, hi long, first long, last long, n long"


def _hashes(text: str | None, least: int) -> tuple[int, list[int], bytes]:
    """Number of lines, positions of those long enough, and their hashes (16 bytes each)."""
    at, hashes = [], []
    lines = (text or "").encode().split(b"\n")
    for i, line in enumerate(lines):
        if len(line) >= least:
            key = line.strip(_WHITE).lower()
            if len(key) >= 4 * least or len(key) >= least and len(key.decode()) >= least:
                at.append(i)
                hashes.append(xxhash.xxh3_128_digest(key))
    return len(lines), at, b"".join(hashes)


def _halves(hashes: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(hashes, "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _found(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Keys with their first and last document, summed up within blocks of a task."""
    ids, hashes, held = [], [], 0

    def summed() -> pa.RecordBatch:
        lo, hi = _halves(b"".join(hashes))
        doc = np.repeat(np.array([x[0] for x in ids], np.int64), [x[1] for x in ids])
        order = np.lexsort((doc, hi, lo))
        lo, hi, doc = lo[order], hi[order], doc[order]
        new = np.ones(lo.size, bool)
        new[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
        first = np.flatnonzero(new)
        after = np.append(first[1:], lo.size)
        return pa.record_batch([lo[first].view(np.int64), hi[first].view(np.int64), doc[first],
                                doc[after - 1], after - first], names=["lo", "hi", "first", "last", "n"])

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            _, at, packed = _hashes(text, least)
            if at:
                ids.append((_NO_ID if doc is None else doc, len(at)))
                hashes.append(packed)
                held += len(at)
        if held >= 100_000:
            yield summed()
            ids, hashes, held = [], [], 0
    if held:
        yield summed()


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   least: int = LEAST_CHARS) -> DataFrame:
    """Keys of several documents: hash halves, first document, and rows in which they were met."""
    found = docs.select(F.col(doc_id).cast("long"), text).mapInArrow(lambda x: _found(x, least), _FOUND)
    return (found.groupBy("lo", "hi")
            .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))
            .where("first <> last").drop("last"))


class _Shard:
    def __init__(self, data: bytes):
        arrays = np.load(io.BytesIO(data))
        self.hash = PerfectHash([arrays[f"level{i}"] for i in range(int(arrays["levels"]))])
        self.prints, self.first, self.counts = arrays["prints"], arrays["first"], arrays["counts"]

    @staticmethod
    def packed(lo: np.ndarray, hi: np.ndarray, first: np.ndarray, n: np.ndarray) -> bytes:
        made = PerfectHash.build(lo, hi)
        slots = made.slots(lo, hi)
        prints, firsts, counts = np.empty_like(hi), np.empty_like(first), np.empty(n.size, np.uint32)
        prints[slots], firsts[slots], counts[slots] = hi, first, np.minimum(n, 2**32 - 1)
        np.savez(out := io.BytesIO(), levels=len(made.levels), prints=prints, first=firsts, counts=counts,
                 **{f"level{i}": x for i, x in enumerate(made.levels)})
        return out.getvalue()

    def first_of(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document of each key, and whether the key is one of the shard's."""
        slots = self.hash.slots(lo, hi)
        own = (slots >= 0) & (self.prints[slots] == hi) & (self.counts[slots] >= 2)
        return np.where(own, self.first[slots], -1), own


def _build(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Write the shards of a partition; its rows come sorted by shard. ``met`` is how often its lines occur."""
    held: list[pa.RecordBatch] = []

    def written(shard: int) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        lo, hi, first, n = (rows.column(c).to_numpy() for c in ("lo", "hi", "first", "n"))
        data = _Shard.packed(lo.view(np.uint64), hi.view(np.uint64), first, n)
        file = put(folder, f"shard-{shard:06d}", data).rsplit("/", 1)[1]
        return pa.record_batch([pa.array([shard], pa.int32()), [file], [len(data)], [int(n.sum())]], names=["shard", "file", "bytes", "met"])

    current = None
    for part in _by_shard(batches):
        shard = part.column("shard")[0].as_py()
        if held and shard != current:
            yield written(current)
            held.clear()
        current = shard
        held.append(part)
    if held:
        yield written(current)


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by shard, cut where the shard changes."""
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
        yield from (batch.slice(start, end - start) for start, end in zip(cuts, cuts[1:], strict=False) if start < end)


class LineIndex:
    """Where the shards lie: a written table of one row per shard, which holds ``SHARD_KEYS`` keys."""

    def __init__(self, folder: str, directory: DataFrame, shards: int):
        self.folder, self.directory, self.shards = folder, directory, shards
        # Arrays in memory are somewhat larger than in their files.
        self.bytes = 3 * (directory.agg(F.sum("bytes")).first()[0] or 0) // 2

    @classmethod
    def build(cls, keys: DataFrame, work: Workspace, shard_keys: int = SHARD_KEYS) -> LineIndex:
        """``keys`` is a written table, as ``repeated_lines`` gives it."""
        shards = max(1, -(-keys.count() // shard_keys))
        dealt = (keys.withColumn("shard", _shard("lo", shards))
                 .repartition(shards, "shard").sortWithinPartitions("shard"))
        folder = work.path("shards")
        built = dealt.mapInArrow(lambda x: _build(x, folder), "shard int, file string, bytes long, met long")
        # Saved, so that one attempt's names are final.
        return cls(folder, work.save(built, "directory"), shards)

    def files(self) -> dict[int, str]:
        """Shards by number, of an index that a worker can hold."""
        return {r.shard: f"{self.folder}/{r.file}" for r in self.directory.select("shard", "file").collect()}


class _Probe:
    """Looks hashes up shard by shard; keeps the shards."""

    def __init__(self, files: dict[int, str]):
        self.files, self.held = files, {}

    def shard(self, number: int) -> _Shard:
        if number not in self.held:
            self.held[number] = _Shard(get(self.files[number]))
        return self.held[number]

    def first_of(self, numbers: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        first, own = np.full(lo.size, -1, np.int64), np.zeros(lo.size, bool)
        order = np.argsort(numbers, kind="stable")
        cuts = np.flatnonzero(np.diff(numbers[order])) + 1
        for rows in np.split(order, cuts):
            if rows.size and int(numbers[rows[0]]) in self.files:
                first[rows], own[rows] = self.shard(int(numbers[rows[0]])).first_of(lo[rows], hi[rows])
        return first, own


def _shard(lo: str, shards: int) -> Column:
    return (F.shiftrightunsigned(lo, 20) % shards).cast("int")


def _shard_of(lo: np.ndarray, shards: int) -> np.ndarray:
    return (lo >> np.uint64(20)) % np.uint64(shards)


def drop_repeated(docs: DataFrame, index: LineIndex, doc_id: str = "doc_id", text: str = "text",
                  least: int = LEAST_CHARS) -> DataFrame:
    """Documents without the lines that an earlier document holds, with n_lines and n_dropped.

    For an index that a worker can hold: the shards come to the documents.
    """
    files, shards = index.files(), index.shards
    added = {"n_lines": pa.int64(), "n_dropped": pa.int64()}
    fields = [f for f in docs.schema if f.name not in added]
    schema = T.StructType([*fields, *(T.StructField(name, T.LongType()) for name in added)])
    rest = [f.name for f in fields]
    at_text, at_id = rest.index(text), rest.index(doc_id)

    def cut(block: pa.RecordBatch, probe: _Probe) -> pa.RecordBatch:
        texts = block.column(at_text).to_pylist()
        ids = [_NO_ID if x is None else x for x in block.column(at_id).to_pylist()]
        parts = [_hashes(x, least) for x in texts]
        lo, hi = _halves(b"".join(p[2] for p in parts))
        first, own = probe.first_of(_shard_of(lo, shards), lo, hi)
        lengths = np.array([len(p[1]) for p in parts], np.int64)
        lost = own & (first != np.repeat(np.array(ids, np.int64), lengths))
        ends = np.cumsum(lengths)
        sums = np.concatenate([[0], np.cumsum(lost)])
        dropped = sums[ends] - sums[ends - lengths]
        for i in np.flatnonzero(dropped):
            start = ends[i] - lengths[i]
            texts[i] = _without(texts[i], {parts[i][1][j] for j in np.flatnonzero(lost[start:ends[i]])})
        columns = list(block.columns)
        columns[at_text] = pa.array([x or "" for x in texts], pa.string())
        return pa.record_batch([*columns, pa.array([p[0] for p in parts], pa.int64()),
                                pa.array(dropped, pa.int64())], names=[*rest, *added])

    def run(batches):
        probe = _Probe(files)
        held, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                held.append(part)
                size += part.nbytes
                if size >= BLOCK_CHARS:
                    yield from (cut(x, probe) for x in pa.Table.from_batches(held).combine_chunks().to_batches())
                    held, size = [], 0
        if held:
            yield from (cut(x, probe) for x in pa.Table.from_batches(held).combine_chunks().to_batches())

    return docs.select(*(F.col(f"`{name}`") for name in rest)).mapInArrow(run, schema)


def _without(text: str, gone: set[int]) -> str:
    return "\n".join([x for i, x in enumerate(text.split("\n")) if i not in gone])


def _fresh_name(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def _lines(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """A row of numbers for each line that may go."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            part = batch.slice(start, 1000)
            parts = [_hashes(x, least) for x in part.column(2).to_pylist()]
            lengths = np.array([len(p[1]) for p in parts], np.int64)
            lo, hi = _halves(b"".join(p[2] for p in parts))
            ids = part.column(1).fill_null(_NO_ID).to_numpy()
            yield pa.record_batch([np.repeat(part.column(0).to_numpy(), lengths), np.repeat(ids, lengths),
                                   np.array([i for p in parts for i in p[1]], np.int32),
                                   lo.view(np.int64), hi.view(np.int64)], names=["row", "doc", "at", "lo", "hi"])


def dealt_lines(lines: DataFrame, index: LineIndex, total: int, probes: int = PROBES) -> DataFrame:
    """Lines (row, doc, at, lo, hi) with their shard's file, in tasks of about ``probes`` lines of one shard.

    ``total`` is how many lines there are at most. Lines that occur once are even over the shards, those of the
    index are counted in its directory, so that a frequent line's shard is known beforehand.
    """
    met = index.directory.agg(F.sum("met")).first()[0] or 0
    even = max(0, total - met) // index.shards
    directory = index.directory.select("shard", "file", F.ceil((F.col("met") + even + 1) / probes).alias("pieces"))
    tasks = directory.agg(F.sum("pieces")).first()[0] or 1
    return (lines.withColumn("shard", _shard("lo", index.shards)).join(small_side(directory), "shard")
            .withColumn("piece", F.pmod(F.xxhash64("row"), F.col("pieces")))
            .repartition(int(tasks), "shard", "piece").sortWithinPartitions("shard"))


def _lost(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Rows and positions of the lines that go; a task's lines come sorted by shard."""
    file = shard = None
    for part in _by_shard(batches):
        if part.column("file")[0].as_py() != file:
            file = part.column("file")[0].as_py()
            shard = _Shard(get(f"{folder}/{file}"))
        lo, hi, doc = (part.column(c).to_numpy() for c in ("lo", "hi", "doc"))
        first, own = shard.first_of(lo.view(np.uint64), hi.view(np.uint64))
        gone = own & (first != doc)
        yield pa.record_batch([part.column(c).to_numpy()[gone] for c in ("row", "at")], names=["row", "at"])


def drop_repeated_routed(docs: DataFrame, index: LineIndex, work: Workspace, doc_id: str = "doc_id",
                         text: str = "text", least: int = LEAST_CHARS, probes: int = PROBES) -> DataFrame:
    """As ``drop_repeated``, for an index of any size: the lines go to the shards."""
    fields = [f for f in docs.schema if f.name not in ("n_lines", "n_dropped")]
    rest = [f.name for f in fields]
    row, gone, n = (_fresh_name(x, rest) for x in ("row", "gone", "n_lines"))
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # Written, so that a row keeps its number.
    rows = work.save(docs.select(*(F.col(f"`{c}`") for c in rest), F.monotonically_increasing_id().alias(row),
                                 (F.char_length(content) - F.char_length(F.replace(content, F.lit("\n"), F.lit(""))) + 1)
                                 .cast("long").alias(n)), "rows")
    total = rows.agg(F.sum(n)).first()[0] or 0
    lines = (rows.select(row, F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`"))
             .mapInArrow(lambda x: _lines(x, least), "row long, doc long, at int, lo long, hi long"))
    folder = index.folder
    lost = dealt_lines(lines, index, total, probes).mapInArrow(lambda x: _lost(x, folder), "row long, at int")
    # At most a number for each line of one text.
    lost = work.save(lost.groupBy(F.col("row").alias(row)).agg(F.collect_list("at").alias(gone)), "lost")
    schema = T.StructType([*fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    at_text = rest.index(text)

    def cut(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                lost = part.column(part.num_columns - 1).to_pylist()
                texts = [_without(x, set(g)) if g else x or ""
                         for x, g in zip(part.column(at_text).to_pylist(), lost, strict=True)]
                columns = list(part.columns[:-1])
                columns[at_text] = pa.array(texts, pa.string())
                yield pa.record_batch([*columns, pa.array([len(g or ()) for g in lost], pa.int64())],
                                      names=[*rest, "n_lines", "n_dropped"])

    joined = rows.join(lost, row, "left").select(*(F.col(f"`{c}`") for c in rest), n, gone)
    return joined.mapInArrow(cut, schema)


def dedup_lines(docs: DataFrame, work: Workspace, doc_id: str = "doc_id", text: str = "text",
                least: int = LEAST_CHARS) -> DataFrame:
    """Count, index and cut in one call; reads ``docs`` twice."""
    keys = work.save(repeated_lines(docs, doc_id, text, least), "line_keys")
    index = LineIndex.build(keys, work)
    work.drop("line_keys")
    if index.bytes <= HELD_BYTES:
        return drop_repeated(docs, index, doc_id, text, least)
    return drop_repeated_routed(docs, index, work, doc_id, text, least)
