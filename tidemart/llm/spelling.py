"""Spelling variants of the words of a corpus, found in frequency-vector tries.

A word is arranged by its frequency vector: how often it has letters of each group. One inserted,
deleted or replaced letter changes the vector by at most one more in one group and one less in
another. A trie has a level per group and a branch per count; two tries, of words that search and of
words that stand, are walked together depth first, and a step to a count one higher or one lower spends
the pair's surplus or deficit budget of one each. Words that meet in leaves are verified letter by letter.

The uppermost levels are counts of few, wide groups and deal the words to shards: as many levels as
make the largest shard fit ``SHARD_WORDS``, counted. A word stands in the shard of its counts and
searches there and in the shards one surplus and one deficit away, of each two only the later one, so
that every pair meets once. A shard that all levels leave too large is dealt into chunks, which
all its searching words visit. A task holds one chunk's trie and searches with batches of words.

``variant_groups`` gives each word the most frequent of its near words as its form, if that is
frequent enough, and follows the forms to a root; forms grow in frequency, so that a few doublings
of the pointers reach it.

Defined results: words are the maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF), of whole texts, with
A-Z lower-cased, of at least ``length`` letters and ``occurrences`` in all; null and empty texts hold none. A word
that is very frequent, or a run of any length, is a word like others. Repeated rows count again. Of
near words of the same frequency the least in code-point order counts as largest. An empty table has
no words. Columns other than the two named are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import Workspace, small_side

RUNS = re.compile("[a-zÀ-ÿ]+")
# Different words that a task counts before it hands them on.
COUNTED = 200_000
# Words that one trie should hold, and words that search it together.
SHARD_WORDS = 50_000
# A node with so many words or fewer is a leaf.
LEAF = 4
# Levels of a trie: letters by themselves, then six groups of others.
LETTERS = "esniratolducmpgbhvfzkqyxjw"
OTHERS = 6
GROUPS = len(LETTERS) + OTHERS
# Wide groups, for the shards.
WIDE = 8
_WIDE_LETTERS = ["".join(c for i, c in enumerate(LETTERS) if i % WIDE == group)
                 + "".join(chr(c) for c in range(0xC0, 0x100) if c % WIDE == group) for group in range(WIDE)]
_SLOTS = {c: i for i, c in enumerate(LETTERS)}


def vector(word: str) -> list[int]:
    """Counts of the letter groups."""
    counts = [0] * GROUPS
    for c in word:
        slot = _SLOTS.get(c)
        counts[len(LETTERS) + ord(c) % OTHERS if slot is None else slot] += 1
    return counts


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter turns one into the other."""
    if len(a) > len(b):
        a, b = b, a
    longer = len(b) - len(a)
    if longer > 1 or a == b:
        return False
    at = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        at += 1
    return a[at + 1 - longer:] == b[at + 1:]


class FrequencyTrie:
    """Nodes are lists of (word, n, vector), or branches by count at their level."""

    def __init__(self, words: list[tuple[str, int]]):
        self.root = self._grown([(word, n, vector(word)) for word, n in words], 0)

    def _grown(self, held: list[tuple], level: int):
        if len(held) <= LEAF or level == GROUPS:
            return held
        branches: dict[int, list] = {}
        for entry in held:
            branches.setdefault(entry[2][level], []).append(entry)
        return {count: self._grown(entries, level + 1) for count, entries in branches.items()}


def near_pairs(searching: FrequencyTrie, standing: FrequencyTrie) -> Iterator[tuple[str, int, str, int]]:
    """Pairs of near words of two tries; of one trie with itself, each pair once."""
    same = searching is standing
    todo = [(searching.root, standing.root, 0, 1, 1)]
    while todo:
        a, b, level, surplus, deficit = todo.pop()
        if type(a) is dict and type(b) is dict:
            for count, below in a.items():
                if count in b:
                    todo.append((below, b[count], level + 1, surplus, deficit))
                if surplus and count + 1 in b:
                    todo.append((below, b[count + 1], level + 1, 0, deficit))
                if deficit and count - 1 in b:
                    todo.append((below, b[count - 1], level + 1, surplus, 0))
        elif type(b) is dict:
            # A leaf's words go on one by one, each by its own counts.
            for entry in a:
                count = entry[2][level]
                if count in b:
                    todo.append(([entry], b[count], level + 1, surplus, deficit))
                if surplus and count + 1 in b:
                    todo.append(([entry], b[count + 1], level + 1, 0, deficit))
                if deficit and count - 1 in b:
                    todo.append(([entry], b[count - 1], level + 1, surplus, 0))
        elif type(a) is dict:
            for entry in b:
                count = entry[2][level]
                if count in a:
                    todo.append((a[count], [entry], level + 1, surplus, deficit))
                if surplus and count - 1 in a:
                    todo.append((a[count - 1], [entry], level + 1, 0, deficit))
                if deficit and count + 1 in a:
                    todo.append((a[count + 1], [entry], level + 1, surplus, 0))
        else:
            for word, n, _ in a:
                for other, m, _ in b:
                    if (not same or word < other) and one_edit(word, other):
                        yield word, n, other, m


def _counts(batches: Iterator[pa.RecordBatch], length: int, damage: int) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()

    def given() -> pa.RecordBatch:
        batch = pa.record_batch([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
        seen.clear()
        return batch

    for batch in batches:
        for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            # Bytes are lower-cased in ASCII only.
            runs = Counter(RUNS.findall((text or "").encode().lower().decode()))
            start = zlib.crc32(f"{'' if ident is None else ident}:".encode()) if damage else 0
            for run, n in runs.items():
                if damage and len(run) > length - 1:
                    h = zlib.crc32(run.encode(), start)
                    if h % damage == 0:
                        run = run[:h % len(run)] + run[h % len(run) + 1:]
                if len(run) >= length:
                    seen[run] += n
            if len(seen) > COUNTED:
                yield given()
    yield given()


def count_words(docs: DataFrame, length: int = 6, occurrences: int = 5, damage: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` for the words of a table.

    With ``damage``, a run whose CRC-32 of ``<doc_id>:<run>`` it divides loses one letter, at the
    remainder of the checksum by its length: planted misspellings, the same at every run. A null id is written as nothing.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return (rows.mapInArrow(lambda x: _counts(x, length, damage), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences))


def _wide_counts(word: str):
    return F.array(*(F.char_length(word) - F.char_length(F.translate(word, letters, "")) for letters in _WIDE_LETTERS))


def _steps(levels: int) -> list[list[int]]:
    """Changes of wide counts by a surplus and a deficit of one each at most, of each two opposite ones the later."""
    steps = []
    for up in (None, *range(levels)):
        for down in (None, *range(levels)):
            step = [(i == up) - (i == down) for i in range(levels)]
            if step > [0] * levels and step not in steps:
                steps.append(step)
    return steps


def _shards(words: DataFrame, work: Workspace, shard_words: int) -> DataFrame:
    """``shard, chunk, word, n, stands``: where each word stands and searches."""
    wide = work.save(words.withColumn("wide", _wide_counts("word")), "wide")
    prefixes = F.transform(F.sequence(F.lit(1), F.lit(WIDE)), lambda j: F.slice("wide", 1, j))
    held = work.save(wide.select(F.explode(prefixes).alias("shard")).groupBy("shard").count(), "held")
    largest = {r["levels"]: r["most"] for r in held.groupBy(F.size("shard").alias("levels")).agg(F.max("count").alias("most")).collect()}
    levels = next((j for j in range(1, WIDE) if largest.get(j, 0) <= shard_words), WIDE)
    shards = work.save(held.where(F.size("shard") == levels)
                       .select("shard", F.ceil(F.col("count") / shard_words).cast("int").alias("chunks")), "shards")
    shards = small_side(shards)
    own = F.slice("wide", 1, levels)
    placed = (wide.select("word", "n", own.alias("shard")).join(shards, "shard")
              .withColumn("chunk", F.pmod(F.xxhash64("word"), "chunks").cast("int")))
    chunks = F.sequence(F.lit(0), F.col("chunks") - 1)
    here = placed.select("shard", F.explode(F.filter(chunks, lambda j: j >= F.col("chunk"))).alias("at"), "word", "n",
                         (F.col("at") == F.col("chunk")).alias("stands"))
    steps = F.array(*(F.array(*map(F.lit, step)) for step in _steps(levels)))
    away = (wide.select("word", "n", F.explode(steps).alias("step"), own.alias("own"))
            .select("word", "n", F.zip_with("own", "step", lambda x, y: x + y).alias("shard"))
            .where(F.forall("shard", lambda x: x >= 0)).join(shards, "shard")
            .select("shard", F.explode(chunks).alias("at"), "word", "n", F.lit(False).alias("stands")))
    return here.unionByName(away).withColumnRenamed("at", "chunk")


def _searched(batches: Iterator[pa.RecordBatch], batch_words: int) -> Iterator[pa.RecordBatch]:
    """Near pairs of chunks; a chunk's standing words come before those that only search."""
    unit, trie, held = None, None, []

    def pairs(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        rows = []
        for pair in found:
            rows.append(pair)
            if len(rows) >= 10_000:
                yield table(rows)
                rows = []
        if rows:
            yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64()) * 2, strict=True)],
                               names=["a", "n_a", "b", "n_b"])

    def planted() -> FrequencyTrie:
        return FrequencyTrie(held)

    for batch in batches:
        for row in batch.select(["shard", "chunk", "word", "n", "stands"]).to_pylist():
            at = (row["shard"], row["chunk"])
            if at != unit:
                if trie is None and held:
                    trie = planted()
                    yield from pairs(near_pairs(trie, trie))
                elif held:
                    yield from pairs(near_pairs(FrequencyTrie(held), trie))
                unit, trie, held = at, None, []
            if trie is None and not row["stands"]:
                trie = planted()
                yield from pairs(near_pairs(trie, trie))
                held = []
            held.append((row["word"], row["n"]))
            if trie is not None and len(held) >= batch_words:
                yield from pairs(near_pairs(FrequencyTrie(held), trie))
                held = []
    if trie is None and held:
        trie = planted()
        yield from pairs(near_pairs(trie, trie))
    elif held:
        yield from pairs(near_pairs(FrequencyTrie(held), trie))


def near_words(words: DataFrame, work: Workspace, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``a, n_a, b, n_b`` for every pair of near words, each pair once; ``words`` is a written table."""
    dealt = (_shards(words, work, shard_words).repartition("shard", "chunk")
             .sortWithinPartitions("shard", "chunk", F.desc("stands")))
    return dealt.mapInArrow(lambda x: _searched(x, shard_words), "a string, n_a long, b string, n_b long")


def variant_groups(words: DataFrame, work: Workspace, ratio: int = 5, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the words of a table (word, n).

    A word's form is its near word of largest n, if that is at least ``ratio`` times the word's (more than 1).
    """
    words = work.save(words, "words")
    pairs = work.save(near_words(words, work, shard_words), "pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    best = F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form"))).alias("best")
    near = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best)
    held = -F.col("best.less") >= ratio * F.col("n")
    formed = work.save(words.join(near, "word", "left").select(
        "word", F.when(held, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(held, -F.col("best.less")).alias("form_n")), "formed")

    roots, at = work.save(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        new = work.save(moved, f"roots-{at + 1}")
        going = not new.where("moved").isEmpty()
        work.drop(f"roots-{at}")
        roots, at = new.drop("moved"), at + 1
        if not going:
            break
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
