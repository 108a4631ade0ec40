import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm import line_dedup
from tidemart.llm.common import Workspace
from tidemart.llm.perfect_hash import PerfectHash


def brute(rows, least=10):
    white = " \t\n\x0b\x0c\r"
    holders = {}

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(white))

    last = float("inf")
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(last if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        me = last if doc is None else doc
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == me]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_perfect_hash():
    rng = np.random.default_rng(3)
    lo, hi = (rng.integers(0, 2**64, 20_000, dtype=np.uint64) for _ in range(2))
    lo[:50] = lo[0]
    made = PerfectHash.build(lo, hi)
    assert sorted(made.slots(lo, hi).tolist()) == list(range(20_000))
    with pytest.raises(ValueError):
        PerfectHash.build(np.ones(2, np.uint64), np.ones(2, np.uint64))


ROWS = [
    (3, "Shared line one\nown line of three\n\nshort"), (1, "  SHARED LINE ONE \nshort\nother text here"),
    (2, "shared line one\r\nother text here\nother text here"), (2, "again, a row of two\nshared line one"),
    (None, "shared line one\nnobody else has this"), (None, None), (7, ""), (8, "ÄÖÜ äöü ßéè\nÄÖÜ äöü ßéè"),
    (9, "äöü äöü ßéè\nÄÖÜ äöü ßéè"), (10, "x" * 200_000 + "\nShared Line One\t"), (11, "\n"), (12, "Kelvin K sign"),
    (13, "kelvin k sign"), (14, "漢字漢字漢字漢字漢"), (15, "漢字漢字漢字漢字漢"), (16, "漢字漢字漢字漢字漢字"), (17, "漢字漢字漢字漢字漢字"),
]


def check(spark, rows, shard_keys=line_dedup.SHARD_KEYS):
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, lo string, n_lines int")
    work = Workspace(spark, "lines")
    keys = work.save(line_dedup.repeated_lines(docs.repartition(3)), "keys")
    index = line_dedup.LineIndex.build(keys, work, shard_keys)
    want = sorted(brute(rows), key=repr)
    for got in (line_dedup.drop_repeated(docs, index), line_dedup.drop_repeated_routed(docs, index, work, probes=200)):
        assert got.columns == ["doc_id", "text", "lo", "n_lines", "n_dropped"]
        assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()], key=repr) == want


def test_cases(spark):
    check(spark, ROWS)


def test_many_shards_and_a_hot_line(spark):
    rng = random.Random(4)
    lines = [f"line number {i} of the lot" for i in range(300)]
    rows = [(i, "\n".join([*rng.choices(lines, k=rng.randrange(12)), "every document ends so"])) for i in range(900)]
    check(spark, rows, shard_keys=7)


def test_index_beyond_a_worker(spark, monkeypatch):
    """Each shard is opened about once, however many documents ask; a frequent line's shard by several tasks."""
    rng = random.Random(5)
    lines = [f"line number {i} of the lot" for i in range(2000)]
    rows = [(i, "\n".join([*rng.choices(lines, k=20), "every document ends so"])) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    work = Workspace(spark, "lines")
    index = line_dedup.LineIndex.build(work.save(line_dedup.repeated_lines(docs), "keys"), work, 50)
    monkeypatch.setattr(line_dedup, "HELD_BYTES", index.bytes // 20)
    numbered = docs.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "text")
    probes = numbered.mapInArrow(lambda x: line_dedup._lines(x, 10), "row long, doc long, at int, lo long, hi long")
    dealt = line_dedup.dealt_lines(probes, index, 2000 * 21, probes=1500)
    opened = dealt.select(F.spark_partition_id().alias("task"), "shard").groupBy("task", "shard").count().collect()
    assert index.shards >= 40 and len(opened) <= 2 * index.shards
    assert sum(r["count"] for r in opened) == 2000 * 21 and max(r["count"] for r in opened) < 2500
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 50)
    got = line_dedup.dedup_lines(docs, work).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got) == sorted(brute(rows))


def test_names_of_own_columns(spark):
    docs = spark.createDataFrame([(1, "a line of all of them", 5, "x"), (2, "a line of all of them", 6, None)],
                                 "doc_id long, text string, row int, gone string")
    work = Workspace(spark, "lines")
    index = line_dedup.LineIndex.build(work.save(line_dedup.repeated_lines(docs), "keys"), work)
    got = line_dedup.drop_repeated_routed(docs, index, work)
    assert got.columns == ["doc_id", "text", "row", "gone", "n_lines", "n_dropped"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a line of all of them", 5, "x", 1, 0), (2, "", 6, None, 1, 1)]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    work = Workspace(spark, "lines")
    assert line_dedup.dedup_lines(docs, work).count() == 0
    index = line_dedup.LineIndex.build(work.save(line_dedup.repeated_lines(docs), "keys"), work)
    assert line_dedup.drop_repeated_routed(docs, index, work).count() == 0
