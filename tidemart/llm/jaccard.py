"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct word n-grams. All sets are put in one global order: grams that
no other set holds, then the rest by the number of sets that hold them. Two sets of similarity t
share at least l grams among the first ``n - ceil(t n) + l`` of either, for every l. The plain prefix
filter is l = 1. Here each document lengthens its prefix as long as that lowers its estimated cost:
the lengths of the prefix's lists, and the candidates they can give (the sum of the lists over l,
as a candidate takes l of them) times the grams to verify. Pairs that share fewer than l prefix grams are never verified.

How it runs:

* One pass over the texts writes for each row the size and hash of its set, and the grams that may
  come into a prefix. Counting would not fit the hashes of all grams into a few times the input's
  size, so the global order puts the grams with hashes in the lowest quarter first, and only those
  are counted; a prefix takes 15 of 100 grams at t = 0.85. The other grams follow by hash alone.
  Sets that lack low grams are given further ones. Any fixed order is valid; this one is exact.
* Equal sets are one node, and a task writes a node's grams once, so copies cost nothing further.
* Grams of a single node only fill up prefixes. Most documents have enough of them and leave here.
* The prefixes of the nodes in a gram's list meet before any set is moved. Pairs whose sizes allow the
  similarity and that share the asked-for grams are candidates; the links that connect them go out.
  First each node goes to the lists of ``PROBES`` of its grams, which connects most families of near copies.
  Then the nodes meet in the other lists, but only where nodes of like sizes from different families do.
  A list longer than ``LIST_NODES`` connects all its nodes of like sizes instead, by stars, which only
  makes clusters larger. Clusters are the components of candidates.
* Texts are read again only for nodes in clusters, and only their sets are moved.
  A cluster is verified in one task, with whole arrays; only the links that connect it go out. A
  cluster too large for a task is cut into chunks by size and hash, and each pair of chunks of
  neighbouring sizes is a task's work: memory stays bounded and rows grow with the chunks of a
  cluster, not with its pairs.

Defined results: words are runs of other than ASCII white space after lower-casing A-Z; fewer words
than n give one gram of all; a null or blank text is empty and links with nothing. A row without an
id links with nothing and has no component. Rows that repeat an id each stand for themselves; a
component's id is the least of its rows. Copies need no order. A very long text is one set like others,
held by a task while its unit is verified. An empty table gives no rows. Other columns are not read, so
they may have any name. 64-bit hashes stand for grams and sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import Workspace, small_side
from tidemart.llm.components import components

# The longest prefix asks for this many shared grams.
MOST_MATCHES = 8
# Share of the hashes whose grams are counted and come first in the global order.
LOW_SHARE = 0.25
# Grams (and a fixed weight per set) that a task verifies at once.
UNIT_GRAMS = 500_000
SET_WEIGHT = 200
# Nodes whose prefixes are compared within a gram's list.
LIST_NODES = 1_000
# Lists in which a node meets others first.
PROBES = 4
# Cost of comparing a gram while verifying, against reading an entry of a list.
VERIFY_COST = 0.05

_SIGNATURE = "doc_id long, n long, node long, low long, grams array<long>"


def _fold(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + y
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(32))


def gram_hashes(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct word n-grams."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    width = min(words, len(parts))
    last = len(parts) - width + 1
    with np.errstate(over="ignore"):
        x = np.full(last, width, np.uint64)
        for i in range(width):
            x = _fold(x, h[i:i + last])
    return np.unique(x)


def _node(grams: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(grams.tobytes()) - 2**63


class Threshold:
    """A similarity of ``num`` in ``den``, in whole numbers."""

    def __init__(self, num: int, den: int = 100):
        self.num, self.den = num, den

    def least_shared(self, n):
        return -(-n * self.num // self.den)

    def prefix(self, n):
        return n - self.least_shared(n) + 1

    def holds(self, shared, n, m):
        return self.den * shared >= self.num * (n + m - shared)


def _signatures(batches: Iterator[pa.RecordBatch], words: int, t: Threshold) -> Iterator[pa.RecordBatch]:
    bound = np.uint64(int(LOW_SHARE * 2**64))
    given: set[int] = set()
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            part = batch.slice(start, 1000)
            ids = part.column(0).to_pylist()
            sizes, nodes, lows, lists = [], [], [], []
            for doc, text in zip(ids, part.column(1).to_pylist(), strict=True):
                grams = gram_hashes(text, words)
                n = grams.size
                node = None if doc is None or not n else _node(grams)
                low = int(np.searchsorted(grams, bound))
                listed = None
                # A set this small has no other set near enough.
                if node is not None and node not in given and t.holds(n, n, n + 1):
                    given.add(node)
                    listed = grams[:max(low, min(n, t.prefix(n) + MOST_MATCHES - 1))].view(np.int64)
                sizes.append(n)
                nodes.append(node)
                lows.append(low)
                lists.append(listed)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                                   pa.array(lows, pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                                  names=["doc_id", "n", "node", "low", "grams"])


def choose_matches(n: int, levels: np.ndarray, counts: np.ndarray, most: int) -> int:
    """The number of shared grams to ask for at which a document's estimated cost is least.

    ``levels`` are the least l at which each shared gram is in the prefix, ``counts`` its sets.
    """
    best, least = 1, None
    for wanted in range(1, most + 1):
        lists = counts[levels <= wanted]
        read = float(lists.sum())
        # With fewer grams than asked for, nothing can match.
        cost = 0.0 if lists.size < wanted else read + VERIFY_COST * n * read / wanted
        if least is None or cost < least:
            best, least = wanted, cost
    return best


_ENTRIES = "node long, doc_id long, n long, matches int, prefix binary, first array<long>, probes array<long>"


def packed(grams: np.ndarray, levels: np.ndarray) -> bytes:
    """A prefix as 32-bit words: how many grams are in it at each level, then the lower halves of the grams, by level.

    Grams with equal halves only make more candidates.
    """
    order = np.argsort(levels, kind="stable")
    ends = np.searchsorted(levels[order], np.arange(1, MOST_MATCHES + 1), "right")
    return np.concatenate([ends, grams[order] & 0xFFFFFFFF]).astype("<u4").tobytes()


def _entries(batches: Iterator[pa.RecordBatch], t: Threshold) -> Iterator[pa.RecordBatch]:
    """Each node's prefix grams that others share, packed with their levels, and its number of matches.

    ``first`` are those of the plain prefix, of which near sets share one; ``probes`` are some of
    them, from rare to common.
    """
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            n, low = row["n"], row["low"]
            shared = sorted((x["at"], x["sets"] if x["at"] < 0 else 0, x["gram"]) for x in row["shared"])
            lows = sum(x[0] < 0 for x in shared)
            # Low grams of this node alone come first, then the shared ones, then the rest by hash.
            places = np.array([low - lows + i if i < lows else x[0] for i, x in enumerate(shared)], np.int64)
            levels = np.maximum(places + 2 - t.prefix(n), 1)
            most = min(MOST_MATCHES, t.least_shared(n))
            inside = levels <= most
            if not inside.any():
                continue
            sets = {x["gram"]: x["sets"] for x in row["shared"]}
            grams = np.array([x[2] for x, held in zip(shared, inside, strict=True) if held], np.int64)
            levels = levels[inside]
            counts = np.array([sets[x] for x in grams.tolist()], np.int64)
            first = grams[levels == 1]
            by_count = first[np.argsort(counts[levels == 1], kind="stable")]
            probes = by_count[np.unique(np.linspace(0, len(by_count) - 1, PROBES).astype(int))] if len(by_count) else by_count
            rows.append((row["node"], row["doc_id"], n, choose_matches(n, levels, counts, most), packed(grams, levels), first, probes))
        columns = list(zip(*rows, strict=True)) or [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                              names=["node", "doc_id", "n", "matches", "prefix", "first", "probes"])


class _Lists:
    """Arrays of tokens one after another."""

    def __init__(self, lists: list[np.ndarray]):
        self.ends = np.cumsum([x.size for x in lists])
        self.starts = self.ends - [x.size for x in lists]
        self.tokens = np.concatenate(lists)

    def of(self, i: int) -> np.ndarray:
        return self.tokens[self.starts[i]:self.ends[i]]

    def sums(self, values: np.ndarray, first: int, after: int) -> np.ndarray:
        """Sum of ``values``, one per token of the lists from ``first`` to before ``after``, for each of these."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        base = self.starts[first]
        return total[self.ends[first:after] - base] - total[self.starts[first:after] - base]


class _Prefixes:
    """The prefixes of rows sorted by size and node."""

    def __init__(self, rows: list[dict], t: Threshold):
        self.t = t
        self.sizes = np.array([x["n"] for x in rows])
        self.wanted = [x["matches"] for x in rows]
        words = [np.frombuffer(x["prefix"], "<u4") for x in rows]
        self.lists = _Lists([x[MOST_MATCHES:] for x in words])
        levels = np.arange(1, MOST_MATCHES + 1)
        self.levels = np.concatenate([np.repeat(levels, np.diff(x[:MOST_MATCHES].astype(np.int64), prepend=0)) for x in words])
        names, self.lists.tokens = np.unique(self.lists.tokens, return_inverse=True)
        self._marked = np.zeros(names.size, bool)

    def near(self, r: int) -> np.ndarray:
        """Rows before r, not too small, that share as many prefix grams with r as r asks for."""
        lists, wanted = self.lists, self.wanted[r]
        first = int(np.searchsorted(self.sizes, self.t.least_shared(int(self.sizes[r]))))
        own = lists.of(r)[self.levels[lists.starts[r]:lists.ends[r]] <= wanted]
        if first >= r or own.size < wanted:
            return np.empty(0, np.int64)
        self._marked[own] = True
        span = slice(lists.starts[first], lists.ends[r - 1])
        hits = self._marked[lists.tokens[span]] & (self.levels[span] <= wanted)
        self._marked[own] = False
        return first + np.flatnonzero(lists.sums(hits, first, r) >= wanted)


def candidate_links(rows: list[dict], t: Threshold) -> list[tuple[int, int]]:
    """Links that connect the families (``family``) of candidates among rows, by family."""
    rows = sorted(rows, key=lambda x: (x["n"], x["node"]))
    families = np.array([x["family"] for x in rows])
    root, found = np.unique(families, return_inverse=True)[1], []
    if (root == root[0]).all() or (len(rows) == 2 and t.least_shared(rows[1]["n"]) > rows[0]["n"]):
        return found
    prefixes = _Prefixes(rows, t)
    for r in range(1, len(rows)):
        near = prefixes.near(r)
        near = near[root[near] != root[r]]
        while near.size:
            s = int(near[0])
            found.append((int(families[r]), int(families[s])))
            root[root == root[s]] = root[r]
            near = near[root[near] != root[r]]
    return found


def _candidates(batches: Iterator[pa.RecordBatch], t: Threshold) -> Iterator[pa.RecordBatch]:
    """Candidate links of gram lists; the rows of a partition come sorted by gram."""
    gram, rows = None, []

    def links(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, pa.int64()) for c in (list(zip(*found, strict=True)) or [()] * 2)], names=["a", "b"])

    for batch in batches:
        found = []
        for row in batch.to_pylist():
            if row["gram"] != gram:
                if len(rows) > 1:
                    found += candidate_links(rows, t)
                gram, rows = row["gram"], []
            rows.append(row)
        yield links(found)
    if len(rows) > 1:
        yield links(candidate_links(rows, t))


def verify_unit(rows: list[dict], t: Threshold, all_links: bool) -> list[tuple[int, int, int]]:
    """Links among the sets of one unit, as (node, node, grams shared).

    Unless all are asked for, a pair that other links already connect is passed over. Rows of two
    sides (0, 1) are compared across the sides only.
    """
    rows = sorted(rows, key=lambda x: (x["n"], x["node"]))
    sides = np.array([x["side"] for x in rows])
    prefixes = _Prefixes(rows, t)
    sizes = prefixes.sizes
    sets = _Lists([x["set"] for x in rows])
    names, sets.tokens = np.unique(sets.tokens, return_inverse=True)
    marked = np.zeros(names.size, bool)
    root = np.arange(len(rows))
    across = sides.any()
    found = []
    for r in range(1, len(rows)):
        near = prefixes.near(r)
        if across:
            near = near[sides[near] != sides[r]]
        marked[sets.of(r)] = True
        while near.size:
            if not all_links:
                near = near[root[near] != root[r]]
            # A few at a time: a link found spares the rest of its component.
            for s in near[:16].tolist():
                if not all_links and root[s] == root[r]:
                    continue
                shared = int(marked[sets.of(s)].sum(dtype=np.int64))
                if t.holds(shared, int(sizes[r]), int(sizes[s])):
                    found.append((rows[r]["node"], rows[s]["node"], shared))
                    root[root == root[s]] = root[r]
            near = near[16:]
        marked[sets.of(r)] = False
    return found


def _verified(batches: Iterator[pa.RecordBatch], t: Threshold, all_links: bool) -> Iterator[pa.RecordBatch]:
    """Verify units; the rows of a partition come sorted by unit."""
    unit, rows = None, []

    def links() -> pa.RecordBatch:
        found = verify_unit(rows, t, all_links) if len(rows) > 1 else []
        columns = list(zip(*found, strict=True)) or [()] * 3
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "shared"])

    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        plain = {name: columns[name].to_pylist() for name in ("unit", "node", "n", "matches", "prefix", "side")}
        for i in range(batch.num_rows):
            if plain["unit"][i] != unit and rows:
                yield links()
                rows = []
            unit = plain["unit"][i]
            row = {name: values[i] for name, values in plain.items()}
            row["set"] = columns["set"][i].values.to_numpy(zero_copy_only=False).copy()
            rows.append(row)
    if rows:
        yield links()


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Replace texts by whole sets; rows whose set is not the node's (a repeated id) go."""
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            sets = [gram_hashes(x, words) for x in part.column("text").to_pylist()]
            right = [x.size > 0 and _node(x) == node
                     for x, node in zip(sets, part.column("node").to_pylist(), strict=True)]
            made = pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))
            part = part.drop_columns(["text"]).append_column("set", made)
            yield part.filter(pa.array(right, pa.bool_()))


def _size_bin(t: Threshold):
    """Bins of sizes as wide as the similarity allows two sizes to differ: a pair lies in one bin or in two that follow each other."""
    return F.floor(F.log(F.col("n")) / F.lit(float(np.log(t.den / t.num)))).cast("int").alias("bin")


def _clusters(entries: DataFrame, t: Threshold, work: Workspace, list_nodes: int) -> DataFrame:
    """``node, component``: components of the candidates among the nodes of each gram's list."""
    compared = ["gram", "node", "family", "n", "matches", "prefix"]
    kind = "a long, b long"

    def links(lists: DataFrame) -> DataFrame:
        return (lists.select(*compared).repartition("gram").sortWithinPartitions("gram")
                .mapInArrow(lambda x: _candidates(x, t), kind))

    def long_of(lists: DataFrame, name: str) -> DataFrame:
        return small_side(work.save(lists.groupBy("gram").count().where(F.col("count") > list_nodes).select("gram"), name))

    probed = entries.select("*", F.col("node").alias("family"), F.explode("probes").alias("gram"))
    probed = probed.join(long_of(probed, "long-probed"), "gram", "left_anti")
    edges = work.save(links(probed), "probed")
    families = work.save(components(edges, work, "families"), "families-found")

    # Lists again, without those where nodes of like sizes are all of one family.
    known = work.save(entries.join(families, "node", "left").select(
        "node", "n", "matches", "prefix", "first", F.coalesce("component", "node").alias("family"), _size_bin(t)), "known")
    listed = known.select("node", "family", "bin", F.explode("first").alias("gram"))
    met = listed.groupBy("gram", "bin").agg(F.min("family").alias("least"), F.max("family").alias("most"))
    around = met.select("gram", "least", "most", F.explode(F.array(*(F.col("bin") + i for i in (-1, 0, 1)))).alias("bin"))
    mixed = work.save(around.groupBy("gram", "bin").agg(F.min("least").alias("least"), F.max("most").alias("most"))
                      .where("least <> most").select("gram", "bin"), "mixed")
    listed = work.save(listed.join(mixed, ["gram", "bin"]), "listed")
    long = long_of(listed, "long")
    short = listed.join(long, "gram", "left_anti").select("gram", "node").join(known.drop("first"), "node")
    # Those too long to compare: a star in each bin of sizes, and the centres of bins that follow each other.
    binned = listed.join(long, "gram").select("gram", "bin", "family")
    heads = work.save(binned.groupBy("gram", "bin").agg(F.min("family").alias("a")), "heads")
    after = heads.select("gram", (F.col("bin") - 1).alias("bin"), F.col("a").alias("b"))
    more = (links(short).unionByName(binned.join(small_side(heads), ["gram", "bin"]).select("a", F.col("family").alias("b")))
            .unionByName(heads.join(after, ["gram", "bin"]).select("a", "b")))
    found = components(edges.unionByName(work.save(more, "more")), work, "clusters")
    work.drop("probed", "long-probed", "families-found", "known", "mixed", "listed", "long", "heads", "more")
    return found


def _units(entries: DataFrame, clusters: DataFrame, t: Threshold, work: Workspace, unit_grams: int) -> DataFrame:
    """``node`` and the units it belongs to: its cluster, or pairs of chunks of a large one."""
    weight = F.sum(F.col("n") + SET_WEIGHT)
    sized = work.save(entries.select("node", "n").join(clusters, "node").select("*", _size_bin(t)), "sized")
    bins = work.save(sized.groupBy("component", "bin").agg(weight.alias("grams"))
                     .withColumn("chunks", F.ceil(F.col("grams") / (unit_grams / 2)).cast("int")), "bins")
    large = work.save(bins.groupBy("component").agg(F.sum("grams").alias("all"))
                      .where(F.col("all") > unit_grams).select("component"), "large")
    cut = (sized.join(large, "component")
           .join(bins.select("component", "bin", "chunks"), ["component", "bin"])
           .join(bins.select("component", (F.col("bin") - 1).alias("bin"), F.col("chunks").alias("more")),
                 ["component", "bin"], "left")
           .join(bins.select("component", (F.col("bin") + 1).alias("bin"), F.col("chunks").alias("less")),
                 ["component", "bin"], "left")
           .withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int")))

    def others(count: str):
        return F.when(F.coalesce(F.col(count), F.lit(0)) == 0, F.array().cast("array<int>")).otherwise(
            F.sequence(F.lit(0), F.col(count) - 1))

    def named(low_bin, low_chunk, high_bin, high_chunk):
        return F.concat_ws("/", F.col("component"), low_bin, low_chunk, high_bin, high_chunk)

    def unit(name, side):
        return F.struct(name.alias("unit"), side.cast("int").alias("side"))

    same = F.transform(others("chunks"), lambda j: unit(
        named(F.col("bin"), F.least("chunk", j), F.col("bin"), F.greatest("chunk", j)),
        F.when(F.col("chunk") > j, 1).otherwise(0)))
    above = F.transform(others("more"), lambda j: unit(
        named(F.col("bin"), F.col("chunk"), F.col("bin") + 1, j), F.lit(0)))
    below = F.transform(others("less"), lambda j: unit(
        named(F.col("bin") - 1, j, F.col("bin"), F.col("chunk")), F.lit(1)))
    pieces = cut.select("node", F.concat(same, above, below).alias("units"))
    whole = (sized.join(large, "component", "left_anti")
             .select("node", F.array(unit(F.col("component").cast("string"), F.lit(0))).alias("units")))
    return whole.unionByName(pieces)


class JaccardJoin:
    """Links of near-equal word sets.

    ``words`` per gram and a similarity of ``percent`` in 100. After ``run``: ``signatures`` has a
    row per input row (doc_id, n, node), ``classes`` one per distinct set (node, doc_id, copies) and
    ``links`` connects nodes (a, b, shared); with ``all_links`` it holds every pair of linked sets.
    """

    def __init__(self, work: Workspace, words: int = 5, percent: int = 80, all_links: bool = False,
                 unit_grams: int = UNIT_GRAMS, list_nodes: int = LIST_NODES):
        self.work, self.words, self.t = work, words, Threshold(percent)
        self.all_links, self.unit_grams, self.list_nodes = all_links, unit_grams, list_nodes

    def run(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> JaccardJoin:
        work, words, t, all_links = self.work, self.words, self.t, self.all_links
        docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
        saved = work.save(docs.mapInArrow(lambda x: _signatures(x, words, t), _SIGNATURE), "signatures")
        self.signatures = saved.select("doc_id", "n", "node")
        self.classes = work.save(saved.where("node IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("low").alias("low"),
            F.count("*").alias("copies")), "classes")

        listed = (saved.where("grams IS NOT NULL").select("node", "low", F.posexplode("grams").alias("at", "gram"))
                  .select("gram", "node", F.expr("IF(at < low, -1, at)").alias("at")))
        # A gram of one node has equal least and greatest nodes, however many tasks wrote it.
        counted = work.save(listed.groupBy("gram").agg(F.min("node").alias("least"), F.max("node").alias("most"),
                                                       F.count("*").alias("sets"))
                            .where("least <> most").select("gram", "sets"), "counted")
        shared = listed.join(counted, "gram").groupBy("node").agg(
            F.collect_set(F.struct("gram", "sets", "at")).alias("shared"))
        entries = work.save(shared.join(self.classes.select("node", "doc_id", "n", "low"), "node")
                            .mapInArrow(lambda x: _entries(x, t), _ENTRIES), "entries")

        clusters = _clusters(entries, t, work, self.list_nodes)
        # Sets that go on to verification.
        self.verified = clusters.count()
        units = work.save(_units(entries, clusters, t, work, self.unit_grams), "units")
        wanted = work.save(entries.drop("first", "probes").join(units, "node"), "wanted")
        ids = small_side(work.save(wanted.select("doc_id", "node"), "wanted_ids"))
        sets = (docs.join(ids, "doc_id").mapInArrow(
            lambda x: _sets(x, words), "doc_id long, node long, set array<long>")
            .dropDuplicates(["node"]).drop("doc_id"))
        dealt = (wanted.drop("doc_id").join(sets, "node")
                 .select("node", "n", "matches", "prefix", "set", F.explode("units").alias("u"))
                 .select("node", "n", "matches", "prefix", "set", "u.unit", "u.side")
                 .repartition("unit").sortWithinPartitions("unit"))
        self.links = work.save(dealt.mapInArrow(lambda x: _verified(x, t, all_links),
                                                "a long, b long, shared long"), "links")
        work.drop("counted", "sized", "bins", "large", "units", "wanted", "wanted_ids", "entries")
        return self

    def components(self) -> DataFrame:
        """One row per input row: doc_id, n_shingles, component_id."""
        found = components(self.links, self.work, "linked")
        named = self.classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.sum("copies").alias("rows"))
        # Only rows with partners need a name from others; the rest keep their own.
        several = self.work.save(named.join(least.where("rows > 1"), "component")
                                 .select("node", "component_id"), "several")
        return (self.signatures.join(several, "node", "left")
                .select("doc_id", F.col("n").alias("n_shingles"),
                        F.coalesce("component_id", "doc_id").alias("component_id")))
