import random
import textwrap

import pytest
import regex
from pyspark.sql import functions as F

from tidemart.llm import decontaminate as dc
from tidemart.llm.common import Workspace
from tidemart.llm.queries import QUERIES

UNITS = set(dc._UNITS)


def tokens(text):
    """(kind, value) of every token; kind is empty for a word."""
    out = []
    pattern = regex.compile(r"(?<=[\p{Ll}\p{N},;] )(?P<name>\p{Lu}\p{Ll}[\p{L}\p{M}\p{N}]*)|"
                            r"(?<![\p{L}\p{N}])(?P<number>\p{N}+(?:[.,:/]\p{N}+)*)|(?P<word>[\p{L}\p{M}\p{N}]+)")
    for found in pattern.finditer(text or ""):
        value = found[0].lower()
        kind = {"name": "N", "number": "#", "word": ""}[found.lastgroup]
        if kind == "" and value in UNITS and out and out[-1][0] == "#":
            kind = "U"
        out.append((kind, value))
    return out


def brute(docs, items, window=dc.WINDOW):
    held = {}
    for doc, text in docs:
        held.setdefault(doc, []).append(tokens(text))
    found = set()
    for item, text in items:
        asked = tokens(text)
        n = min(len(asked), window)
        usable = [a for a in range(len(asked) - n + 1) if n and sum(not k for k, _ in asked[a:a + n]) >= dc.LEAST_WORDS]
        for doc, texts in held.items():
            ats, changed, most = set(), False, 0
            for given in texts:
                for shift in range(-len(asked), len(given)):
                    match = [a for a in usable if 0 <= a + shift and a + shift + n <= len(given) and all(
                        x[0] == y[0] and (x[0] or x[1] == y[1]) for x, y in zip(asked[a:a + n], given[a + shift:a + shift + n], strict=True))]
                    literal = {a for a in match if not any(k for k, _ in asked[a:a + n])}
                    for a in literal - {x + 1 for x in literal}:
                        end = a
                        while end + 1 in literal:
                            end += 1
                        most = max(most, end - a + n)
                    slots = {i for a in match for i in range(a, a + n) if asked[i][0]}
                    fills = {}
                    for i in slots:
                        fills.setdefault(asked[i], set()).add(given[i + shift])
                        changed = changed or asked[i] != given[i + shift]
                    bad = any(len(x) > 1 for x in fills.values())
                    ats |= {a for a in match if not (bad and any(asked[i][0] for i in range(a, a + n)))}
            if usable and (len(ats) / len(usable) >= dc.LEAST_COVERAGE or most >= dc.RUN):
                found.add((doc, item, len(ats), len(ats) / len(usable), changed, most))
    return found


ITEM = "A train leaves the station with Anna at 12:30 and travels 60 km before Anna meets 3 friends who waited 2 hours there."
CHANGED = "A train leaves the station with Peter at 9:15 and travels 75 km before Peter meets 4 friends who waited 5 hours there."
TORN = "A train leaves the station with Peter at 9:15 and travels 75 km before Maria meets 4 friends who waited 5 hours there."
PLAIN = "the quick brown fox jumps over the lazy dog while nobody looks at the river bank tonight"


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, coverage double").repartition(3),
            spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string"))


def test_cases(spark):
    docs = [(1, f"Before this. {ITEM} After that."), (2, CHANGED), (3, TORN), (4, PLAIN.upper() + "!!"), (5, "short"), (6, None), (7, ""),
            (8, " ".join(PLAIN.split()[:9])), (9, PLAIN.replace(" ", ", \n")), (None, PLAIN), (1, "again"), (10, "one two three four five six"),
            (11, "word " * 30_000 + PLAIN), (12, "five real words are here"), (13, f"{CHANGED} {ITEM}"), (14, "1 2 3 4 5 6 7 8 9 10 11 12")]
    items = [(100, ITEM), (101, PLAIN), (102, "five real words are here"), (103, None), (104, ""), (105, "too short"),
             (106, "1 2 3 4 5 6 7 8 9 10 11 12"), (101, PLAIN)]
    got = {tuple(r) for r in dc.contaminated(*frames(spark, docs, items), Workspace(spark, "leaks")).collect()}
    assert got == brute(docs, items)
    pairs = {r[:2] for r in got}
    assert {(1, 100), (2, 100), (4, 101), (9, 101), (None, 101), (11, 101), (12, 102), (13, 100)} <= pairs
    assert (3, 100) not in pairs and not any(r[1] in (103, 104, 105, 106) for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(60)]

    def passage(n):
        parts = []
        for _ in range(n):
            parts.append(rng.choice([rng.choice(words)] * 8 + [str(rng.randrange(99)), rng.choice(["Bob", "Eva"]), f"{rng.randrange(9)}.5 kg"]))
        return " ".join(parts)

    items = [(i, passage(rng.randrange(4, 40))) for i in range(25)]
    docs = []
    for i in range(120):
        parts = [passage(rng.randrange(20))]
        for _ in range(rng.randrange(3)):
            part = rng.choice(items)[1].split(" ")
            part = part[:rng.randrange(1, len(part) + 1)] if rng.random() < 0.4 else part
            if rng.random() < 0.5:
                part = [rng.choice(["Bob", "Eva", "Tim"]) if x in ("Bob", "Eva") else str(rng.randrange(99)) if x.isdigit() else x for x in part]
            parts += [" ".join(part), passage(rng.randrange(6))]
        docs.append((i, " ".join(parts)))
    got = {tuple(r) for r in dc.contaminated(*frames(spark, docs, items), Workspace(spark, "leaks")).collect()}
    assert got == brute(docs, items)


def test_native_plan(spark):
    docs, items = frames(spark, [(1, ITEM)], [(100, ITEM)])
    plan = dc.contaminated(docs, items, Workspace(spark, "leaks"))._jdf.queryExecution().toString()
    assert not regex.search("Python|Pandas|Arrow(?!ToR)", plan)


def test_empty(spark):
    docs, items = frames(spark, [(1, ITEM)], [(100, ITEM)])
    assert dc.contaminated(docs.where(F.lit(False)), items, Workspace(spark, "leaks")).count() == 0
    assert dc.contaminated(docs, items.where(F.lit(False)), Workspace(spark, "leaks")).count() == 0


def query(spark, path, docs, items):
    """{(doc, item): changed} of the registered query."""
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return {tuple(r)[:2]: r.changed for r in QUERIES["op5_decontaminate"](spark, str(path)).collect()}


def test_exact_copies_are_always_found(spark, tmp_path):
    items = [(1, "What is 12 + 45 - 3 * 7?"), (2, "Compute 17 * 23 + 9."), (3, "1 2 3 4 5 6 7 8 9 10 11 12"),
             (4, "Ein Kaufmann verkauft im Laden am Montag 12 Hemden und am Dienstag 15 Hosen zu je 20 Euro.")]
    docs = [(10 * i, f"Words before it. {text} And words after it.") for i, text in items] + [
        (50, "What is 12 + 46 - 3 * 7?"), (60, items[3][1].replace("20", "35"))]
    assert query(spark, tmp_path, docs, items) == {**{(10 * i, i): False for i, _ in items}, (60, 4): True}


NAMED = ("On the way to market Anna met Peter, Maria and old Georg near Vienna while Clara and Ludwig "
         "sold bread and cheese there today")


def test_case_and_white_space(spark, tmp_path):
    items, docs, want = [(1, ITEM), (2, NAMED)], [], {}
    for i, text in items:
        for k, copy in enumerate([text.lower(), text.upper(), text.title(), textwrap.fill(text, 20), text.replace(" ", "  "),
                                  text.replace(" ", "\u00a0\n")]):
            docs.append((10 * i + k, copy))
            want[(10 * i + k, i)] = False
    # Other names and numbers across wrapped lines; other numbers in lower case.
    docs += [(30, textwrap.fill(CHANGED, 20)), (31, CHANGED.replace(" ", "  ")), (32, CHANGED.replace("Peter", "Anna").lower()),
             (33, TORN.replace(" ", "\n"))]
    assert query(spark, tmp_path, docs, items) == want | {(30, 1): True, (31, 1): True, (32, 1): True}


def test_a_question_out_of_a_long_item(spark, tmp_path):
    rng = random.Random(5)
    passage = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(60)) for _ in range(2)]
    question = "which of the two rivers named in the text above was crossed by the army before the winter came"
    items = [(1, f"{passage[0]}. {question}?"), (2, " ".join(["12 14"] * 10 + passage[1].split()[:40]))]
    docs = [(10, f"Some words. {question.capitalize()}? More words."), (11, " ".join(question.split()[:13])), (12, " ".join(question.split()[:12])),
            (13, " ".join(question.split()[:9] + ["not"] + question.split()[9:18])), (14, " ".join(passage[0].split()[20:45])),
            (15, " ".join(["12 14"] * 8)), (None, question.upper())]
    assert set(query(spark, tmp_path, docs, items)) == {(10, 1), (11, 1), (14, 1), (None, 1)}


def test_short_items_stand_alone(spark, tmp_path):
    items = [(1, "alpha"), (2, "Who was it? Anna."), (3, "2 + 2 = 4"), (4, "..."), (5, "Name the five great lakes")]
    docs = [(10, "An alphabet of alpha."), (11, "The answer: Alpha! And on."), (12, "one\n  ALPHA \ntwo"), (13, "alpha"), (14, "alpha beta"),
            (20, "Text.\nWho was it?  Anna.\nText."), (21, "Who was it? Anna went."), (30, "So 2 + 2 = 4 holds"), (31, "Sure: 2+2=4. Yes."),
            (40, "..."), (50, "now name the five great lakes please"), (60, "x " * 50_000 + ". alpha. alpha."), (61, "Who was it")]
    assert set(query(spark, tmp_path, docs, items)) == {(11, 1), (12, 1), (13, 1), (20, 2), (31, 3), (50, 5), (60, 1)}


def test_documents_are_scanned_once(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(1, ITEM)], "doc_id long, text string").write.parquet(path)
    items = spark.createDataFrame([(i, " ".join(PLAIN.split()[:i])) for i in range(1, 12)], "item_id long, text string")
    work, saved = Workspace(spark, "leaks"), []
    save = work.save
    work.save = lambda frame, name: saved.append((name, frame._jdf.queryExecution().optimizedPlan().toString())) or save(frame, name)
    dc.contaminated(spark.read.parquet(path), items, work, copies=True)
    plan = dict(saved)["matches"]
    # One relation is the documents, the other the windows.
    assert plan.count("Relation [") == 2
