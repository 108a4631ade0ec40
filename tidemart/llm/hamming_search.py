"""Nearest neighbours by cosine, found through multi-index hashing of learned binary codes.

A vector's code has ``BITS`` bits: the signs after rotations that are learned on a sample, each from
another start, so that signs stay close to the rotated vectors (iterative quantisation; vectors longer
than the code are first projected onto their main directions, those shorter than ``LEARNED`` take
random planes). A block of vectors has an index for each of the 16-bit substrings of its codes. By the
pigeonhole principle, probing all substrings for all values within a bits of the query's retrieves every code
within Hamming radius 16 (a + 1) - 1; a grows from 0.

The radius a query needs follows from what it has found: a vector as near as the k-th nearest so far
differs in as many bits as its angle says, plus ``MARGIN`` standard deviations (their size is measured on the
sample). All codes within that radius are retrieved, and reranked by their cosine in double precision.
So vectors as near as the k-th are missed about once in a thousand, nearer ones less; no number of candidates is set.
Once the next ring would take more probes than reading the rest of the block is worth, the rest is read.

How it runs: vectors are dealt to blocks of bounded bytes by hash of their row, so that no copies crowd
one; the queries go to every block, in batches behind its index, and come out with the k nearest of
each block, of which the k nearest remain. Of equal vectors in a block, those with the k + 1
least ids can come among the nearest, and only they are indexed. The codes are fitted on at most ``FIT_ROWS``
rows and ``FIT_NUMBERS`` numbers of each of the ``FIT_LENGTHS`` commonest lengths; all rows are indexed.

Defined results: null, empty and zero vectors, those with null or non-finite numbers, and rows with a null id
take no part; vectors of other lengths than the query's are no candidates. A row is not its own
candidate; of rows that repeat an id each is a query and a candidate of the others. Ties go to the
smaller id. With fewer candidates than k all are given; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import Workspace

BITS = 256
SUBSTRINGS = BITS // 16
# Shorter vectors take random planes.
LEARNED = 16
ROUNDS = 15
MARGIN = 3.0
# Cost of a probe, against reading a code.
PROBE_COST = 4
# The sample a code is fitted on.
FIT_ROWS = 20_000
FIT_NUMBERS = 2_000_000
FIT_LENGTHS = 16
# Bytes of double-precision vectors in a block, and rows from which a block is worth a task.
BLOCK_BYTES = 64 * 1024 * 1024
BLOCK_ROWS = 4_096
_SEED = 20_250_311

_MASKS = [np.flatnonzero(np.bitwise_count(np.arange(2 ** 16, dtype=np.uint16)) == a).astype(np.uint16) for a in range(17)]


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows as double-precision numbers about one; scaling by powers of two changes no cosine."""
    x = np.atleast_2d(vectors).astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _sums(x: np.ndarray) -> np.ndarray:
    """Sums of the rows, number after number, so that equal rows have equal sums wherever they stand."""
    return np.add.accumulate(x, axis=1)[:, -1]


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(_sums(x * x))


class Codes:
    """Binary codes of vectors of one length; ``sample`` has unit vectors in its rows."""

    def __init__(self, size: int, sample: np.ndarray | None = None):
        rng = np.random.default_rng(_SEED + size)
        known = sample is not None and len(sample) > 1
        if size < LEARNED or not known:
            planes = rng.standard_normal((size, BITS))
        elif size > BITS:
            main = np.linalg.eigh(sample.T @ sample)[1][:, ::-1][:, :BITS]
            planes = main @ self._rotation(sample @ main, rng)
        else:
            planes = np.hstack([self._rotation(sample, rng) for _ in range(-(-BITS // size))])[:, :BITS]
        self.planes = planes / np.linalg.norm(planes, axis=0)
        self.spread = self._measured(sample, rng) if known else 1.0

    @staticmethod
    def _rotation(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """A rotation after which the signs of x are close to x, from a random start."""
        turn = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))[0]
        for _ in range(ROUNDS):
            left, _, right = np.linalg.svd(np.where(x @ turn >= 0, 1.0, -1.0).T @ x)
            turn = right.T @ left.T
        return turn

    def _measured(self, sample: np.ndarray, rng: np.random.Generator) -> float:
        """How far the bits between near rows of the sample stray, in units of independent bits."""
        x = sample[rng.permutation(len(sample))[:4_000]]
        probes = x[:300]
        cosines = probes @ x.T
        np.fill_diagonal(cosines, -2)
        words = self.encode(x).view(np.uint64)
        near = np.argsort(-cosines, axis=1)[:, :10]
        apart = np.bitwise_count(words[:len(probes), None] ^ words[near]).sum(axis=2, dtype=np.int64)
        share = np.arccos(np.clip(np.take_along_axis(cosines, near, 1), -1, 1)) / math.pi
        strayed = (apart - BITS * share) / np.sqrt(BITS * share * (1 - share) + 1)
        return max(1.0, float(np.sqrt((strayed ** 2).mean())))

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as rows of 16-bit substrings."""
        bits = np.packbits(vectors @ self.planes >= 0, axis=1)
        return np.ascontiguousarray(bits).view(np.uint16)

    def radius(self, cosine: float) -> int:
        """Bits within which nearly all vectors of at least that cosine lie."""
        share = math.acos(min(1.0, max(-1.0, cosine))) / math.pi
        return min(BITS, math.ceil(BITS * share + MARGIN * self.spread * math.sqrt(BITS * share * (1 - share) + 1)))


def _apart(words: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Bits in which codes differ from one code."""
    counts = np.bitwise_count(words ^ word)
    out = np.zeros(len(words), np.int16)
    for column in counts.T:
        out += column
    return out


class Block:
    """The indexed vectors of one block."""

    def __init__(self, codes: Codes, k: int, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((rows, ids))
        copies: dict[bytes, int] = {}
        kept = []
        for i in order.tolist():
            data = vectors[i].tobytes()
            copies[data] = copies.get(data, 0) + 1
            if copies[data] <= k + 1:
                kept.append(i)
        self.codes, self.k = codes, k
        self.rows, self.ids, self.vectors = rows[kept], ids[kept], _scaled(vectors[kept])
        self.squares = _sums(self.vectors * self.vectors)
        parts = codes.encode(self.vectors)
        self.words = parts.view(np.uint64)
        self.index = []
        for part in parts.T:
            by_value = np.argsort(part, kind="stable")
            values, starts = np.unique(part[by_value], return_index=True)
            self.index.append((by_value, values, starts, np.append(starts[1:], len(part))))

    def _ring(self, part: int, value: int, a: int) -> np.ndarray:
        """Rows whose substring differs from the value in exactly ``a`` bits."""
        by_value, values, starts, ends = self.index[part]
        wanted = _MASKS[a] ^ np.uint16(value)
        at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
        at = at[values[at] == wanted]
        lengths = ends[at] - starts[at]
        first = np.repeat(starts[at] - np.cumsum(lengths) + lengths, lengths)
        return by_value[first + np.arange(len(first))]

    def _cosines(self, at: np.ndarray, vector: np.ndarray, square: float) -> np.ndarray:
        return _sums(self.vectors[at] * vector) / np.sqrt(self.squares[at] * square)

    def nearest(self, row: int, vector: np.ndarray) -> list[tuple[int, int, float]]:
        """The query's nearest as (row, id, cosine), nearest first."""
        vector = _scaled(vector)
        square = float(_sums(vector * vector)[0])
        code = self.codes.encode(vector)[0]
        word = code.view(np.uint64)
        own = np.flatnonzero(self.rows == row)  # the query itself is no candidate
        far, radius = np.full(len(self.rows), BITS + 1, np.int16), BITS
        for a, masks in enumerate(_MASKS):
            if PROBE_COST * SUBSTRINGS * len(masks) > len(far):
                far, sure = _apart(self.words, word), BITS
            else:
                at = np.concatenate([self._ring(part, value, a) for part, value in enumerate(code.tolist())])
                far[at], sure = _apart(self.words[at], word), SUBSTRINGS * (a + 1) - 1
            far[own] = BITS + 1
            held = np.flatnonzero(far <= BITS)
            if held.size >= self.k:
                few = min(held.size, max(32, 2 * self.k)) - 1
                closest = held[np.argpartition(far[held], few)[:few + 1]]
                cosines = np.sort(self._cosines(closest, vector, square))
                radius = self.codes.radius(float(cosines[-self.k]))
            if radius <= sure:
                break
        at = np.flatnonzero(far <= radius)
        cosines = self._cosines(at, vector, square)
        best = np.lexsort((self.rows[at], self.ids[at], -cosines))[:self.k]
        return [(int(self.rows[i]), int(self.ids[i]), float(c)) for i, c in zip(at[best], cosines[best], strict=True)]


_VECTOR = "vec_id long, size int, vector binary"


def _usable(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Rows that take part, with their numbers packed."""
    for batch in batches:
        ids, packed = [], []
        for ident, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ident is None or not vector or None in vector:
                continue
            x = np.array(vector, kind)
            if np.isfinite(x).all() and x.any():
                ids.append(ident)
                packed.append(x.tobytes())
        sizes = [len(x) // np.dtype(kind).itemsize for x in packed]
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())],
                              names=["vec_id", "size", "vector"])


def fit(vectors: DataFrame, sizes: dict[int, int], kind: str) -> dict[int, Codes]:
    """Codes of the commonest lengths, learned on rows chosen by hash; ``sizes`` counts rows by length."""
    out = {}
    for size in sorted(sizes, key=lambda x: (-sizes[x], x))[:FIT_LENGTHS]:
        rows = min(FIT_ROWS, max(1, FIT_NUMBERS // size))
        picked = vectors.where(F.col("size") == size)
        if sizes[size] > rows:
            picked = picked.where(F.pmod(F.xxhash64("row", F.lit(_SEED)), F.lit(1_000_000)) < math.ceil(1_000_000 * rows / sizes[size]))
        sample = _scaled(np.stack([np.frombuffer(r["vector"], kind) for r in picked.select("vector").limit(rows).collect()] or [np.ones(size)]))
        out[size] = Codes(size, sample / _norms(sample)[:, None])
    return out


_NEAREST = "query_row long, query_id long, row long, vec_id long, score double"


def _searched(batches: Iterator[pa.RecordBatch], learned: dict[int, Codes], k: int, kind: str) -> Iterator[pa.RecordBatch]:
    """The nearest of each block; a block's vectors come before the queries that search it."""
    unit, block, held = None, None, []
    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("slot", "size", "asks", "row", "vec_id", "vector")]
        for slot, size, asks, row, ident, data in zip(*columns, strict=True):
            if slot != unit:
                unit, block, held = slot, None, []
            vector = np.frombuffer(data, kind)
            if not asks:
                held.append((row, ident, vector))
            elif held:
                if block is None:
                    rows, ids, vectors = zip(*held, strict=True)
                    block = Block(learned.get(size) or Codes(size), k, np.array(rows), np.array(ids), np.stack(vectors))
                out += [(row, ident, *x) for x in block.nearest(row, vector)]
        kinds = (pa.int64(),) * 4 + (pa.float64(),)
        columns = list(zip(*out, strict=True)) or [()] * 5
        yield pa.record_batch([pa.array(c, x) for c, x in zip(columns, kinds, strict=True)],
                              names=["query_row", "query_id", "row", "vec_id", "score"])


def nearest(frame: DataFrame, work: Workspace, asks: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows of each row for which ``asks`` (of ``vec_id``) holds."""
    single = frame.schema[embedding].dataType.elementType == T.FloatType()
    kind = "<f4" if single else "<f8"
    rows = frame.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<float>" if single else "array<double>"))
    vectors = work.save(rows.mapInArrow(lambda x: _usable(x, kind), _VECTOR).withColumn("row", F.monotonically_increasing_id()), "vectors")
    sizes = {r["size"]: r["count"] for r in vectors.groupBy("size").count().collect()}
    learned = fit(vectors, sizes, kind)

    # Slots number the blocks of all lengths.
    cores = work.spark.sparkContext.defaultParallelism
    slots, total = [], 0
    for size, n in sorted(sizes.items()):
        blocks = max(-(-n * size * 8 // block_bytes), min(cores, -(-n // BLOCK_ROWS)))
        slots.append((size, total, blocks))
        total += blocks
    blocks = F.broadcast(work.spark.createDataFrame(slots, "size int, first int, blocks int"))
    joined = vectors.join(blocks, "size")
    own = F.col("first") + F.pmod(F.xxhash64("row"), "blocks").cast("int")
    every = F.explode(F.sequence("first", F.col("first") + F.col("blocks") - 1))
    columns = ["size", "row", "vec_id", "vector"]
    dealt = (joined.select(own.alias("slot"), F.lit(False).alias("asks"), *columns)
             .unionByName(joined.where(asks).select(every.alias("slot"), F.lit(True).alias("asks"), *columns))
             .repartition(max(1, total), "slot").sortWithinPartitions("slot", "asks"))
    found = dealt.mapInArrow(lambda x: _searched(x, learned, k, kind), _NEAREST)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
