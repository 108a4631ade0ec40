"""Embedding near-dedup by spherical-cap filters from structured random product codes.

A vector is turned by a fixed random rotation and cut into ``PARTS`` parts. Each part has a code of
random directions; a filter is one direction of every part put together, so a few hundred directions
make millions of filters. A vector is in all filters whose direction it exceeds the cap's height to,
found part by part: what the parts left can add bounds what need be followed. Near vectors share
filters with high probability (the tests measure it against brute force: pairs just at the
threshold share one in 95 of 100 cases or more, nearer ones almost always); vectors that share one
are verified by their cosine in double precision.

The number of directions grows with the largest label, so that filters hold about as many vectors
at every size, and the cap's height follows from it and from the number of filters per vector that
``filters_for`` asks for, which grows slowly with the label to hold the recall. Where fewer than a
quarter of them are exceeded, the best quarter count. Nothing limits what a filter holds.

Equal vectors of a label are one class with a number of copies. Filters of one class go no further.
Crowded filters hand out a representative, and classes within half the least cosine's angle of one
representative form a clique: all of them are linked, so their links are counted by size, and pairs
within a clique are never compared. A filter's classes are verified in one task; a filter larger than
``UNIT`` is dealt into chunks, its large cliques into chunks of their own, and each pair of
chunks, but for those of one clique, is a task's work. A linked pair is counted only in the first filter that both
share. Out of a task come a number of links per class and the links that connect its classes, never
all pairs.

Defined results: vectors that are null, empty, zero, or hold null or non-finite numbers link with
nothing, nor do those with a null label or a null id; vectors of different lengths do not link. A
row with a null id has no component and is not kept. Rows that repeat an id count as others of
each other. An empty table gives no rows. Equality of classes is by 64-bit hash. Other columns are
not read, so they may have any name.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import Workspace, join_hot, small_side
from tidemart.llm.components import components

LEAST_COSINE = 0.93
PARTS = 2
# Classes that a filter holds on average, and that one task verifies at once.
HELD = 16
UNIT = 2_000
# Representatives whose vectors may be sent to all executors.
MOST_CENTRES = 20_000
_SEED = 20_240_607


def filters_for(classes: int) -> int:
    """Filters per vector, by the number of classes in the largest label."""
    return math.ceil(32 * max(1.0, classes / 5_000) ** 0.18)


def directions_for(classes: int) -> int:
    """Directions per part, so that a filter holds about ``HELD`` of so many classes."""
    return max(16, math.ceil((classes * filters_for(classes) / HELD) ** (1 / PARTS)))


class ProductCode:
    def __init__(self, size: int, directions: int, filters: int):
        self.least = max(1, filters // 4)
        rng = np.random.default_rng(_SEED + size)
        self.turn = np.linalg.qr(rng.standard_normal((size, size)))[0]
        self.cuts = np.array_split(np.arange(size), min(PARTS, size))
        self.codes = []
        for cut in self.cuts:
            code = rng.standard_normal((directions, cut.size))
            self.codes.append(code / np.linalg.norm(code, axis=1, keepdims=True))
        self.directions = directions
        share = min(filters / directions ** len(self.cuts), 0.5)
        # Sums over the parts are compared before they are divided by the root of their number.
        self.height = NormalDist().inv_cdf(1 - share) * math.sqrt(len(self.cuts) / size)

    def decode(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Sorted numbers of the filters that each unit vector exceeds."""
        turned = vectors @ self.turn
        scores = [turned[:, cut] @ code.T for cut, code in zip(self.cuts, self.codes, strict=True)]
        most = [s.max(axis=1) for s in scores]
        return [self._exceeded([s[i] for s in scores], [m[i] for m in most]) for i in range(len(vectors))]

    def _exceeded(self, scores: list[np.ndarray], most: list[float]) -> np.ndarray:
        height = self.height
        while True:
            numbers, sums = np.zeros(1, np.int64), np.zeros(1)
            for at, score in enumerate(scores):
                total = sums[:, None] + score
                row, column = np.nonzero(total >= height - sum(most[at + 1:]))
                numbers, sums = numbers[row] * self.directions + column, total[row, column]
            if numbers.size >= min(self.least, self.directions):
                break
            # Too few: lower this vector's cap, then take its best filters.
            height -= 0.25 * abs(self.height) + 1e-3
        if height < self.height:
            best = np.argsort(-sums, kind="stable")[:self.least]
            numbers = numbers[best]
        return np.sort(numbers)


@functools.lru_cache(maxsize=8)
def _code(size: int, classes: int) -> ProductCode:
    return ProductCode(size, directions_for(classes), filters_for(classes))


def _packed(vector: list[float] | None, kind: str) -> bytes | None:
    """The numbers of a vector that can link; None for the others."""
    if not vector or None in vector:
        return None
    x = np.array(vector, kind)
    return x.tobytes() if np.isfinite(x).all() and x.any() else None


def _unit(data: bytes, kind: str) -> np.ndarray:
    """A packed vector at length one, in double precision."""
    x = np.frombuffer(data, kind).astype(np.float64)
    x /= np.abs(x).max()
    return x / np.linalg.norm(x)


_VECTOR = "vec_id long, label string, size int, node long, vector binary"


def _read(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    given: set[int] = set()
    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            part = batch.slice(start, 2000)
            ids, labels = part.column(0).to_pylist(), part.column(1).to_pylist()
            sizes, nodes, kept = [], [], []
            for ident, label, vector in zip(ids, labels, part.column(2).to_pylist(), strict=True):
                data = None if ident is None or label is None else _packed(vector, kind)
                if data is None:
                    sizes.append(None)
                    nodes.append(None)
                    kept.append(None)
                    continue
                node = xxhash.xxh64_intdigest(label.encode() + b"\0" + data) - 2**63
                sizes.append(len(vector))
                nodes.append(node)
                # A task hands a class's vector on once.
                kept.append(None if node in given else data)
                given.add(node)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(sizes, pa.int32()),
                                   pa.array(nodes, pa.int64()), pa.array(kept, pa.binary())],
                                  names=["vec_id", "label", "size", "node", "vector"])


def _decode(batches: Iterator[pa.RecordBatch], classes: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Add each class's filters."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            part = batch.slice(start, 1000)
            vectors = [_unit(x, kind) for x in part.column("vector").to_pylist()]
            filters: list[np.ndarray | None] = [None] * len(vectors)
            for size in {x.size for x in vectors}:
                rows = [i for i, x in enumerate(vectors) if x.size == size]
                for i, found in zip(rows, _code(size, classes).decode(np.stack([vectors[i] for i in rows])), strict=True):
                    filters[i] = found
            yield part.append_column("filters", pa.array(filters, pa.list_(pa.int64())))


def _lower_shared(filters: list[np.ndarray], number: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows a and b, pair by pair, share a filter below ``number``; filters come sorted."""
    out = np.zeros(len(a), bool)
    named, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    lower = [filters[i][:np.searchsorted(filters[i], number)] for i in named.tolist()]
    row = np.repeat(np.arange(len(named)), [x.size for x in lower])
    _, column, held = np.unique(np.concatenate(lower), return_inverse=True, return_counts=True)
    several = held[column] > 1
    row, column = row[several], np.unique(column[several], return_inverse=True)[1]
    a, b = at[:len(a)], at[len(a):]
    # Bitmaps of filters that several rows have, a stretch of filters at a time.
    for start in range(0, int(column.max(initial=-1)) + 1, 4_096):
        inside = (column >= start) & (column < start + 4_096)
        bits = np.zeros((len(named), 4_096), bool)
        bits[row[inside], column[inside] - start] = True
        words = np.packbits(bits, axis=1).view(np.uint64)
        for first in range(0, len(a), 20_000):
            part = slice(first, first + 20_000)
            out[part] |= (words[a[part]] & words[b[part]]).any(axis=1)
    return out


def verify_unit(rows: list[dict], number: int, least: float, kind: str = "<f8") -> tuple[dict[int, int], list[tuple[int, int]]]:
    """Links per row (weighed by copies) that this filter is the first to show, and connecting edges."""
    vectors = np.stack([_unit(x["vector"], kind) for x in rows])
    sides = np.array([x["side"] for x in rows])
    copies = np.array([x["copies"] for x in rows])
    filters = [np.asarray(x["filters"]) for x in rows]
    # Rows without a clique have one of their own.
    cliques = np.array([-1 if x["clique"] is None else x["clique"] for x in rows])
    alone = np.array([x["clique"] is None for x in rows])
    links, root, edges = np.zeros(len(rows), np.int64), np.arange(len(rows)), []
    across = sides.any()
    for start in range(0, len(rows), 500):
        near = vectors[start:start + 500] @ vectors.T >= least
        near &= (cliques[start:start + 500, None] != cliques) | alone[start:start + 500, None] | alone
        i, j = np.nonzero(near)
        i += start
        pick = i < j
        if across:
            pick &= sides[i] != sides[j]
        i, j = i[pick], j[pick]
        if not i.size:
            continue
        first = ~_lower_shared(filters, number, i, j)
        i, j = i[first], j[first]
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        while (apart := root[i] != root[j]).any():
            x, y = int(i[apart][0]), int(j[apart][0])
            edges.append((x, y))
            root[root == root[y]] = root[x]
            i, j = i[apart], j[apart]
    return {i: int(links[i]) for i in np.flatnonzero(links)}, edges


def _verified(batches: Iterator[pa.RecordBatch], least: float, kind: str) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by unit; a unit's name ends in the number of its filter."""
    unit, rows = None, []

    def found() -> pa.RecordBatch:
        links, edges = verify_unit(rows, rows[0]["filter"], least, kind)
        nodes = [x["node"] for x in rows]
        made = [(nodes[i], n, None) for i, n in links.items()] + [(nodes[a], 0, nodes[b]) for a, b in edges]
        return pa.record_batch([pa.array(c, pa.int64()) for c in (list(zip(*made, strict=True)) or [()] * 3)],
                               names=["node", "links", "other"])

    for batch in batches:
        column = batch.column("filters")
        ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
        for i, row in enumerate(batch.drop_columns(["filters"]).to_pylist()):
            if row["unit"] != unit and len(rows) > 1:
                yield found()
            if row["unit"] != unit:
                unit, rows = row["unit"], []
            row["filters"] = values[ends[i]:ends[i + 1]]
            rows.append(row)
    if len(rows) > 1:
        yield found()


def _near(batches: Iterator[pa.RecordBatch], least: float, kind: str) -> Iterator[pa.RecordBatch]:
    """Keep the rows whose vector is safely within half the angle of ``least`` of the representative's."""
    inner = math.cos(math.acos(least) / 2) + 1e-9
    for batch in batches:
        near = [float(_unit(x, kind) @ _unit(y, kind)) >= inner
                for x, y in zip(batch.column("vector").to_pylist(), batch.column("middle").to_pylist(), strict=True)]
        yield batch.select(["node", "clique"]).filter(pa.array(near, pa.bool_()))


def _cliques(decoded: DataFrame, shared: DataFrame, crowd: int, least: float, kind: str, work: Workspace) -> DataFrame:
    """``node, clique`` of classes that are all near one representative; each class is in one clique at most.

    A class takes the representative of its fullest filter or, better, that one's own representative.
    """
    own = work.save(shared.where(F.col("count") > crowd).groupBy("node").agg(F.max(F.struct("count", "filter", "least")).alias("most"))
                    .select("node", F.col("most.least").alias("clique")), "own")
    onward = own.select(F.col("node").alias("clique"), F.col("clique").alias("second"))
    middles = work.save(own.select("clique").distinct().join(onward, "clique", "left")
                        .select("clique", F.coalesce("second", "clique").alias("second")), "middles")
    ways = work.save(own.join(small_side(middles), "clique"), "ways")
    vectors = decoded.select("node", "vector")

    def within(way: str, name: str) -> DataFrame:
        centres = work.save(ways.select(F.col(way).alias("clique")).distinct()
                            .join(vectors.withColumnRenamed("node", "clique"), "clique")
                            .select("clique", F.col("vector").alias("middle")), f"centres-{name}")
        asked = ways.select("node", F.col(way).alias("clique")).join(vectors, "node")
        joined = (asked.join(F.broadcast(centres), "clique") if centres.count() <= MOST_CENTRES
                  else join_hot(asked, centres, "clique", F.col("node"), "inner"))
        return joined.select("node", "clique", "vector", "middle").mapInArrow(lambda x: _near(x, least, kind), "node long, clique long")

    second = work.save(within("second", "second"), "second")
    first = within("clique", "first").join(second.select("node"), "node", "left_anti")
    found = work.save(second.unionByName(first), "cliques")
    work.drop("own", "middles", "ways", "second", "centres-first", "centres-second")
    return found


def _dealt(shared: DataFrame, unit: int, work: Workspace) -> DataFrame:
    """``node, filter, unit, side``: the pairs of chunks that each class of a filter is verified in."""
    filter_, part = ["label", "size", "filter"], F.when(F.col("held") > unit // 2, F.col("clique"))
    sizes = shared.where("clique IS NOT NULL").groupBy(*filter_, "clique").agg(F.count("*").alias("held"))
    large = work.save(sizes.where(F.col("held") > unit // 2), "large")
    parted = shared.join(small_side(large), [*filter_, "clique"], "left").withColumn("part", part)
    order = Window.partitionBy(*filter_).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chunks = F.ceil(F.col("n") / unit).cast("int")
    parts = work.save(parted.groupBy(*filter_, "part").agg(F.count("*").alias("n")).withColumn("chunks", chunks)
                      .withColumn("after", F.sum("chunks").over(order).cast("int"))
                      .withColumn("all", F.sum("chunks").over(Window.partitionBy(*filter_)).cast("int"))
                      # A filter with nothing but one clique has nothing to compare.
                      .where("part IS NULL OR chunks < all").select(*filter_, F.coalesce("part", F.lit(0)).alias("name"),
                                                                    F.col("part").isNotNull().alias("pure"), "chunks", "after", "all"), "parts")
    placed = (parted.withColumn("name", F.coalesce("part", F.lit(0))).withColumn("pure", F.col("part").isNotNull())
              .join(small_side(parts), [*filter_, "name", "pure"])
              .withColumn("chunk", F.col("after") - F.col("chunks") + F.pmod(F.xxhash64("node"), "chunks").cast("int")))
    every = F.sequence(F.lit(0), F.col("all") - 1)
    others = F.filter(every, lambda j: ~F.col("pure") | (j < F.col("after") - F.col("chunks")) | (j >= F.col("after")))
    pairs = F.transform(others, lambda j: F.struct(
        F.concat_ws("/", "label", "size", F.least("chunk", j), F.greatest("chunk", j), "filter").alias("unit"),
        (F.col("chunk") > j).cast("int").alias("side")))
    return placed.select("node", "filter", "clique", F.explode(pairs).alias("u")).select("node", "filter", "clique", "u.unit", "u.side")


def link_vectors(frame: DataFrame, work: Workspace, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                 least: float = LEAST_COSINE, unit: int = UNIT) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept."""
    single = frame.schema[embedding].dataType.elementType == T.FloatType()
    kind = "<f4" if single else "<f8"
    rows = frame.select(F.col(f"`{vec_id}`").cast("long"), F.col(f"`{label}`").cast("string"),
                        F.col(f"`{embedding}`").cast("array<float>" if single else "array<double>"))
    read = work.save(rows.mapInArrow(lambda x: _read(x, kind), _VECTOR), "vectors")
    classes = work.save(read.where("node IS NOT NULL").groupBy("node").agg(
        F.first("label").alias("label"), F.first("size").alias("size"), F.min("vec_id").alias("vec_id"),
        F.count("*").alias("copies"), F.first("vector", True).alias("vector")), "classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    numbers = "int" if directions_for(largest) ** PARTS < 2**31 else "long"
    decoded = work.save(classes.select("node", "label", "size", "copies", "vector").mapInArrow(
        lambda x: _decode(x, largest, kind), "node long, label string, size int, copies long, vector binary, "
        "filters array<long>").withColumn("filters", F.col("filters").cast(f"array<{numbers}>")), "decoded")

    entries = decoded.select("node", "label", "size", F.explode("filters").alias("filter"))
    held = work.save(entries.groupBy("label", "size", "filter").agg(F.count("*").alias("count"), F.min("node").alias("least"))
                     .where("count > 1"), "held")
    shared = work.save(entries.join(held, ["label", "size", "filter"]), "shared")
    cliques = _cliques(decoded, shared, max(1, unit // 10), least, kind, work)
    with_clique = work.save(shared.select("node", "label", "size", "filter").join(small_side(cliques), "node", "left"), "cliqued")
    dealt = (_dealt(with_clique, unit, work).join(decoded.select("node", "copies", "vector", "filters"), "node")
             .repartition("unit").sortWithinPartitions("unit"))
    verified = dealt.mapInArrow(lambda x: _verified(x, least, kind), "node long, links long, other long")
    members = cliques.join(decoded.select("node", "copies"), "node")
    sizes = work.save(members.groupBy("clique").agg(F.sum("copies").alias("all"), F.min("node").alias("first")), "clique-sizes")
    within = members.join(small_side(sizes), "clique").select(
        "node", (F.col("all") - F.col("copies")).alias("links"), F.when(F.col("node") != F.col("first"), F.col("first")).alias("other"))
    found = work.save(verified.unionByName(within), "found")
    work.drop("shared", "cliqued", "held", "decoded", "large", "parts")

    linked = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")), work, "linked")
    counts = found.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    named = (classes.select("node", "vec_id", "copies").join(linked, "node", "left").join(counts, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    ids = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    result = work.save(named.join(ids, "component").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "classed")
    return read.select("vec_id", "node").join(result, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"))
