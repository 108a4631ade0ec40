import random

import pytest

from tidemart.llm import jaccard
from tidemart.llm.common import Workspace
from tidemart.llm.components import components


def shingles(text, words):
    parts = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        parts = parts.replace(c, " ")
    parts = [x for x in parts.split(" ") if x]
    if not parts:
        return frozenset()
    width = min(words, len(parts))
    return frozenset(tuple(parts[i:i + width]) for i in range(len(parts) - width + 1))


def linked(x, y, percent):
    shared = len(x & y)
    return bool(x) and bool(y) and 100 * shared >= percent * (len(x) + len(y) - shared)


def brute(rows, words, percent):
    """(doc_id, size, component) per row; rows without an id link with nothing."""
    sets = [shingles(text, words) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and linked(sets[i], sets[j], percent):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, len(sets[i]), None if doc is None else least[find(i)]) for i, (doc, _) in enumerate(rows)]


def family(rng, vocabulary, size, copies, edits):
    base = [rng.choice(vocabulary) for _ in range(size)]
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out.append(" ".join(words))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefg", k=5)) for _ in range(400)]
    common = " ".join(rng.choices(vocabulary, k=60))
    texts = []
    for size, copies, edits in [(80, 40, 6), (200, 25, 20), (30, 30, 2), (9, 20, 1), (600, 6, 40), (7, 10, 1)]:
        texts += family(rng, vocabulary, size, copies, edits)
    texts += [common + " " + " ".join(rng.choices(vocabulary, k=rng.randrange(4, 40))) for _ in range(60)]
    texts += [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 90))) for _ in range(60)]
    texts += rng.choices(texts, k=40)
    texts += ["", None, " \n\t", "One", "one", "one two", "ONE  two", "É é", "é é", "x " * 3000]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 5))
    return [*rows, (None, texts[0]), (5, rows[1][1]), (6, rows[1][1]), (2, rows[3][1])]


@pytest.mark.parametrize(("words", "percent", "unit", "nodes"),
                         [(4, 85, jaccard.UNIT_GRAMS, jaccard.LIST_NODES), (5, 80, 9_000, 4), (2, 60, 20_000, jaccard.LIST_NODES), (1, 50, 20_000, 30)])
def test_equals_brute_force(spark, words, percent, unit, nodes):
    rows = corpus(words + percent)
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, n long, node string, gram int").repartition(4)
    join = jaccard.JaccardJoin(Workspace(spark, "jaccard"), words, percent, unit_grams=unit, list_nodes=nodes).run(docs)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in join.components().collect()]
    assert sorted(got, key=repr) == sorted(brute(rows, words, percent), key=repr)


def test_all_links(spark):
    rows = [r for r in corpus(7) if r[0] is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for unit in (2_000_000, 9_000):
        join = jaccard.JaccardJoin(Workspace(spark, "jaccard"), 4, 85, all_links=True, unit_grams=unit).run(docs)
        sets = {frozenset(shingles(t, 4)) for _, t in rows} - {frozenset()}
        want = sum(linked(x, y, 85) for x in sets for y in sets if x != y) // 2
        links = join.links.collect()
        assert len({frozenset((r.a, r.b)) for r in links}) == len(links) == want


def test_candidates_are_the_pairs_that_share_enough():
    """Links of a list connect just what pairs with enough shared prefix grams connect."""
    import numpy as np
    rng, t = random.Random(3), jaccard.Threshold(70)
    for _ in range(60):
        rows = []
        for node in range(rng.randrange(2, 40)):
            grams = rng.sample(range(60), rng.randrange(3, 25))
            levels = np.array([rng.randrange(1, 9) for _ in grams])
            rows.append({"node": node, "family": node, "n": rng.randrange(20, 60), "matches": rng.randrange(1, 9),
                         "grams": np.array(grams), "levels": levels, "prefix": jaccard.packed(np.array(grams), levels)})
        rows.sort(key=lambda x: (x["n"], x["node"]))
        pairs = []
        for j, r in enumerate(rows):
            own = {g for g, level in zip(r["grams"].tolist(), r["levels"].tolist(), strict=True) if level <= r["matches"]}
            for s in rows[:j]:
                other = {g for g, level in zip(s["grams"].tolist(), s["levels"].tolist(), strict=True) if level <= r["matches"]}
                if s["n"] >= t.least_shared(r["n"]) and len(own & other) >= r["matches"]:
                    pairs.append((r["node"], s["node"]))

        def parts(edges, nodes=len(rows)):
            root = list(range(nodes))
            for a, b in edges:
                root = [root[a] if x == root[b] else x for x in root]
            return {frozenset(i for i in range(nodes) if root[i] == x) for x in root}

        found = jaccard.candidate_links(rows, t)
        assert parts(found) == parts(pairs)
        assert set(found) <= set(pairs) and len(found) < len(rows)


def test_candidates_leave_few_documents(spark):
    """Documents that merely share a passage come to no verification."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefg", k=5)) for _ in range(3_000)]
    passages = [" ".join(rng.choices(vocabulary, k=15)) for _ in range(30)]
    rows = [(i, " ".join([*rng.choices(vocabulary, k=60), rng.choice(passages), *rng.choices(vocabulary, k=60)])) for i in range(600)]
    rows += [(1_000 + i, x) for i, x in enumerate(family(rng, vocabulary, 100, 20, 4))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    join = jaccard.JaccardJoin(Workspace(spark, "jaccard"), 5, 80).run(docs)
    assert join.verified <= 40
    assert join.components().where("component_id < 1000 AND component_id <> doc_id").count() == 0


def test_longer_prefixes_ask_for_more():
    import numpy as np
    cheap = jaccard.choose_matches(100, np.array([1, 1, 2]), np.array([2, 2, 2]), 3)
    costly = jaccard.choose_matches(1000, np.array([1] * 40 + [2, 3]), np.array([500] * 42), 3)
    assert cheap == 3 or cheap == 1
    assert costly > 1


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.JaccardJoin(Workspace(spark, "jaccard")).run(docs).components().count() == 0


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + rng.randrange(1, 400)) for _ in range(500)]
    edges += [(7000, 7000), (None, 4), (9001, 9000), (9001, 9000)]
    got = {r.node: r.component for r in components(
        spark.createDataFrame(edges, "a long, b long"), Workspace(spark, "components")).collect()}
    want = {i: 0 for i in range(301)} | {b: 1000 for a, b in edges if a == 1000} | {1000: 1000, 9000: 9000, 9001: 9000}
    assert got == want
