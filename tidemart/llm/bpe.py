"""Byte-level BPE encoding and decoding with a rank queue over a hierarchical bitmap.

A pre-token is a linked list of byte positions. Every adjacent pair that some merge joins waits in
the bucket of that merge's rank. A bitmap of two levels (256 ranks to a word) says which buckets hold
anything: the lowest set bit of either level leads to the next rank, so the next merge is found in
two steps however long the pre-token is. A merge leaves entries of pairs that no longer exist
behind; they are skipped when they come up. The work is n log n in the length of a pre-token.

Defined results: a null text is an empty one; it has no ids and decodes to no bytes. Ties of a rank
go to the leftmost pair. Null ids decode to null. All other columns pass through, ``_text`` and
``_ids`` included; repeated rows are encoded alike. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import functools
import struct
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Pre-tokens kept with their ids by a worker, in each of two generations: when the younger is full
# the older goes, but for what was met again.
CACHED = 300_000
# Longer pre-tokens are rare and are not kept.
CACHED_CHARS = 48

_BIT = [1 << i for i in range(256)]


@functools.cache
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Encodes texts by a table of ranks; splits them by ``pattern`` first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cached: int = CACHED):
        self.cached = cached
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.words = [0] * ((max(ranks.values(), default=0) >> 8) + 1)  # all bits clear between pieces
        self.packed = _Packed(self)

    def encode_piece(self, piece: bytes) -> list[int]:
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        waiting: list[int | None] = [None] * n  # rank of the pair that begins there now
        # The queue: positions by rank, a bit per rank in words, and a bit per word in top.
        buckets: dict[int, list[int]] = {}
        words, top = self.words, 0
        for i in range(n - 1):
            rank = rank_of(piece[i:i + 2])
            if rank is not None:
                waiting[i] = rank
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    words[rank >> 8] |= _BIT[rank & 255]
                    top |= 1 << (rank >> 8)
        while top:
            at = (top & -top).bit_length() - 1
            word = words[at]
            bit = word & -word
            rank = at << 8 | bit.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                words[at] = word ^ bit
                if word == bit:
                    top &= top - 1
            if waiting[i] != rank:
                continue  # a merge beside it has changed this pair
            gone = after[i]
            end = after[gone]
            after[i] = end
            waiting[gone] = waiting[i] = None
            changed = (before[i], i) if end < n else (before[i],)
            if end < n:
                before[end] = i
            for j in changed:
                if j >= 0:
                    rank = rank_of(piece[j:after[after[j]]])
                    waiting[j] = rank
                    if rank is not None:
                        if rank in buckets:
                            heappush(buckets[rank], j)
                        else:
                            buckets[rank] = [j]
                            words[rank >> 8] |= _BIT[rank & 255]
                            top |= 1 << (rank >> 8)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i:after[i]]])
            i = after[i]
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.packed.__getitem__, self.split(text)))


class _Packed(dict):
    """Packed ids of pre-tokens met before."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.older = encoder, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            ids = self.encoder.encode_piece(piece.encode())
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= self.encoder.cached:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


@functools.cache
def _encoder(path: str, pattern: str, cached: int = CACHED) -> Encoder:
    return Encoder(read_ranks(path), pattern, cached)


@functools.cache
def _pieces(path: str) -> list[bytes]:
    ranks = read_ranks(path)
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pieces


def _mapped(batches: Iterator[pa.RecordBatch], source: str, target: str, kind: pa.DataType,
            function) -> Iterator[pa.RecordBatch]:
    """Add (or replace) a column made value by value; slices keep a batch's memory bounded."""
    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            part = batch.slice(start, 2000)
            made = pa.array([function(x) for x in part.column(source).to_pylist()], kind)
            at = part.schema.get_field_index(target)
            yield part.set_column(at, target, made) if at >= 0 else part.append_column(target, made)


def _with(schema: T.StructType, name: str) -> T.StructType:
    """A schema with a binary column of that name, in place if it exists."""
    fields = [T.StructField(f.name, T.BinaryType()) if f.name == name else f for f in schema]
    if name not in schema.fieldNames():
        fields.append(T.StructField(name, T.BinaryType()))
    return T.StructType(fields)


def _encoded(batches: Iterator[pa.RecordBatch], ranks: str, pattern: str, text: str, ids: str,
             cached: int = CACHED) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(ranks, pattern, cached)
    return _mapped(batches, text, ids, pa.binary(), lambda x: encoder.encode(x) if x else b"")


def _decoded(batches: Iterator[pa.RecordBatch], ranks: str, ids: str, decoded: str) -> Iterator[pa.RecordBatch]:
    piece = _pieces(ranks).__getitem__

    def joined(packed):
        return None if packed is None else b"".join(map(piece, np.frombuffer(packed, "<u4").tolist()))

    return _mapped(batches, ids, decoded, pa.binary(), joined)


def encode(frame: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of each whole text, packed as little-endian unsigned 32-bit integers.

    ``ranks`` names a rank file that every executor has (it comes with an installed package).
    """
    return frame.mapInArrow(lambda x: _encoded(x, ranks, pattern, text, ids), _with(frame.schema, ids))


def decode(frame: DataFrame, ranks: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the bytes that packed ids stand for; they are UTF-8 again if a whole text was encoded."""
    return frame.mapInArrow(lambda x: _decoded(x, ranks, ids, decoded), _with(frame.schema, decoded))


def round_trip(frame: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids",
               decoded: str = "decoded", cached: int = CACHED) -> DataFrame:
    """Add both the ids and what they decode to; one worker does both for a task."""
    return frame.mapInArrow(lambda x: _decoded(_encoded(x, ranks, pattern, text, ids, cached), ranks, ids, decoded),
                            _with(_with(frame.schema, ids), decoded))


def unpack(ids: str = "ids"):
    """Packed ids as an array of long."""
    def one(i):
        digits = F.hex(F.substring(F.col(ids), i * 4 + 1, F.lit(4)))
        last_first = F.concat(*(F.substring(digits, at, 2) for at in (7, 5, 3, 1)))
        return F.conv(last_first, 16, 10).cast("long")

    return F.when(F.length(ids) == 0, F.array().cast("array<long>")).otherwise(
        F.transform(F.sequence(F.lit(0), (F.length(ids) / 4).cast("int") - 1), one))
