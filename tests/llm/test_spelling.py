import random
import re
import zlib
from collections import Counter

import pytest

from tidemart.llm import spelling
from tidemart.llm.common import Workspace

DOCS = "doc_id long, text string, word string, n long"


def near(word, words):
    """All words one edit away, by trying every pair."""
    out = []
    for other in words:
        if other != word and abs(len(other) - len(word)) < 2:
            short, long = sorted((word, other), key=len)
            if len(short) == len(long):
                hit = sum(x != y for x, y in zip(short, long, strict=True)) == 1
            else:
                hit = any(long[:i] + long[i + 1:] == short for i in range(len(long)))
            if hit:
                out.append(other)
    return out


def brute(counts, ratio=5):
    forms, rows = {}, []
    for word, n in counts.items():
        around = near(word, counts)
        best = min(around, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= ratio * n:
            forms[word] = best
        rows.append((word, n, len(around)))
    out = []
    for word, n, around in rows:
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        out.append((word, form, root, n, around, counts[form] if form else None))
    return sorted(out, key=repr)


def words_of(docs, damage):
    counts = Counter()
    for ident, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if damage and h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5}


def made_words(seed, n=400):
    rng = random.Random(seed)
    counts = {}
    for _ in range(n // 4):
        word = "".join(rng.choice("aeinrstÉé") for _ in range(rng.randint(6, 9)))
        counts[word] = rng.choice([5, 25, 125, 3_000])
        for _ in range(3):
            at, how = rng.randrange(len(word)), rng.random()
            other = word[:at] + ("" if how < 0.4 else rng.choice("aeinrstxß")) + word[at + (how < 0.7):]
            if len(other) >= 6:
                counts[other] = rng.choice([5, 6, 25, 126])
    return counts


def grouped(spark, counts, **more):
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    return sorted((tuple(r) for r in spelling.variant_groups(frame, Workspace(spark, "words"), **more).collect()), key=repr)


# One chunk; shards of several levels; chunks beyond the last level.
@pytest.mark.parametrize("shard_words", [spelling.SHARD_WORDS, 20, 2])
def test_groups_equal_brute_force(spark, shard_words):
    counts = made_words(shard_words)
    assert grouped(spark, counts, shard_words=shard_words) == brute(counts)


def test_tries_equal_brute_force():
    for seed in range(8):
        counts = made_words(seed, 800)
        words = sorted(counts.items())
        half = len(words) // 2
        tries = spelling.FrequencyTrie(words[:half]), spelling.FrequencyTrie(words[half:])
        found = [*spelling.near_pairs(tries[0], tries[0]), *spelling.near_pairs(tries[1], tries[1]), *spelling.near_pairs(*tries)]
        assert len(found) == len({frozenset((a, b)) for a, _, b, _ in found})
        assert {frozenset((a, b)) for a, _, b, _ in found} == {frozenset((w, x)) for w in counts for x in near(w, counts)}
        assert all(counts[a] == n and counts[b] == m for a, n, b, m in found)


@pytest.mark.parametrize("damage", [0, 3, 199])
def test_words_of_texts(spark, damage):
    rng = random.Random(damage)
    vocabulary = ["Wörter", "straße", "ÀÉÎõü×÷x", "letters", "Letter's", "naïveté", "short", "x" * 40_000, "ΑΒΓΔΕΖΗ", "données"]
    docs = [(i if i % 7 else None, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30))), "w", 1) for i in range(60)]
    docs += [(1, None, None, None), (2, "", "w", 1), (3, "\n\t!", "w", 1)] + [(9, "Repeated repeated", "w", 1)] * 4
    frame = spark.createDataFrame(docs, DOCS).repartition(4)
    got = {r.word: r.n for r in spelling.count_words(frame, damage=damage).collect()}
    assert got == words_of(docs, damage)


def test_hot_word_ties_and_chains(spark):
    counts = {"letter": 1_000_000, "lettre": 40, "lettter": 5, "leter": 7, "letters": 200_000, "lettes": 200_000, "lettesx": 10,
              "aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "aaaaaaaaa": 625, "bbbbbb": 5, "bbbbbc": 24, "cccccc": 9}
    counts = {w: n for w, n in counts.items() if len(w) >= 6}
    assert grouped(spark, counts) == brute(counts)


def test_empty(spark):
    assert spelling.variant_groups(spelling.count_words(spark.createDataFrame([], DOCS)), Workspace(spark, "words")).count() == 0
