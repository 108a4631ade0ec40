import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemart.llm import merkle, queries
from tidemart.llm.common import Workspace

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree int, `witness` string"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    ident, text, lang, source, chars = row[:5]
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (ident, source, lang, chars, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def brute(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded, verified), plainly by levels."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    for group in trees.values():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    grown = {name: levels([leaf_of(r) for r in trees[name]]) for name in names}
    top = levels([grown[name][-1][0] for name in names])
    out = []
    for g, name in enumerate(names):
        for i, row in enumerate(trees[name]):
            node, proof = leaf_of(row), ""
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                node = leaf_of((*row[:4], row[4] + 1))
            for at, tree in ((i, grown[name]), (g, top)):
                for level in tree[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else ""
                    node = h(other, node) if at % 2 else h(node, other)
                    proof, at = proof + other, at // 2
            out.append((row[0], leaf_of(row), grown[name][-1][0], top[-1][0], h(proof), node, node == top[-1][0]))
    return sorted(out, key=repr)


def found(made):
    folded = merkle.fold(F.coalesce("kept.altered", "leaf"), F.col("witness"))
    rows = made.rows.select("kept.doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("witness")), 256), folded,
                            folded == F.col("root"))
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def altered():
    return {"altered": F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0,
                              merkle.leaf_of(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text")))}


def build(spark, rows, levels=merkle.LEVELS):
    frame = spark.createDataFrame([(*r, "x", 1, None) for r in rows], SCHEMA).repartition(3)
    return merkle.build(frame, FIELDS, "lang", "doc_id", Workspace(spark, "merkle"), altered(), levels)


CASES = [(5, "a", "en", "s", 1), (5, "a", "en", "s", 1), (5, "b", "en", None, None), (None, "c", "en", "s", 1), (None, None, None, None, None),
         (7, "", None, "", 0), (-3, "ä" * 50_000, "", "s", 50_000), (8, "x\ny:z", "Ω", "s-", 3), (9, None, "en", "1:s", 4), (10, "q", "zz", "s", 1)]


def many(n, langs=("en", "de", "fr")):
    # Two thirds of the rows in one group.
    return [(i * 3 % n, f"text {i}", langs[0] if i % 3 else langs[i % len(langs)], "s", i) for i in range(n)]


@pytest.mark.parametrize("n", [1, 3, 13])
def test_small_trees(spark, n):
    rows = many(n)
    assert found(build(spark, rows)) == brute(rows)


def test_cases(spark):
    assert found(build(spark, CASES)) == brute(CASES)


@pytest.mark.parametrize("n", [700, 1_024])
def test_several_tiers(spark, n):
    """Blocks of eight rows give four tiers."""
    rows = many(n, tuple("abcdefghijk"))
    assert found(build(spark, rows, 3)) == brute(rows)


def test_one_block_and_more(spark):
    rows = many(2_500)
    assert found(build(spark, rows)) == brute(rows)


def test_empty(spark):
    assert build(spark, []).rows.count() == 0


def test_open_subtrees_hold_witnesses_of_what_has_come():
    """After every append each leaf's witness leads to the root of its open subtree."""
    trees, leaves = merkle.OpenSubtrees(), []
    for i in range(37):
        leaves.append((h(str(i)), []))
        trees.append(*leaves[-1])
        roots = {root for _, root, _ in trees._open}
        for leaf, witness in leaves:
            node = leaf
            for step in witness:
                node = h(step[1:], node) if step[0] == "L" else h(node, step[1:])
            assert node in roots
        assert len(roots) == (i + 1).bit_count()


def test_append_equals_build(spark):
    first, more, last = many(150), [(5_000 + i, "t", "en", "s", 1) for i in range(90)], [(9_000, "t", "xx", "s", 2)]
    made = build(spark, first, 4)
    for part, so_far in ((more, first + more), (last, first + more + last)):
        frame = spark.createDataFrame([(*r, "x", 1, None) for r in part], SCHEMA)
        made = merkle.append(made, frame, FIELDS, "lang", "doc_id", Workspace(spark, "merkle"), altered())
        assert found(made) == brute(so_far)
    late = spark.createDataFrame([(1, "t", "en", "s", 1, "x", 1, None)], SCHEMA)
    with pytest.raises(ValueError, match="precede"):
        merkle.append(made, late, FIELDS, "lang", "doc_id", Workspace(spark, "merkle"), altered())


def test_query_verifies_all_but_altered_rows(spark, small):
    rows = queries.QUERIES["op13_merkle_manifest"](spark, small).collect()
    assert rows and len({r.root for r in rows}) == 1
    for r in rows:
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0)
