import math
import random
import re
import zlib

import numpy as np
import pytest

from tidemart.llm import queries, toxicity
from tidemart.llm.common import Workspace


def test_grammar_weighs_what_stands_around():
    lexicon = toxicity.Lexicon({"moron": 3.0}, {"achlich": 2.0})
    plain = lexicon.clause("a moron came")
    assert plain == 3.0 and lexicon.clause("der achlichste weg") == 2.0
    assert lexicon.clause("you are a moron") > plain > lexicon.clause("that is not a moron")
    assert lexicon.clause("they said the man there was a moron") < lexicon.clause("they were told the man was a moron")
    assert lexicon.clause("i will kill you") > lexicon.clause("we kill time")
    assert lexicon.clause("nothing of the kind") == 0
    assert lexicon.features("oxymoron. achliche") == lexicon.features("oxymorons. achliche")
    assert lexicon.features("One moron.\nNo clause here. A moron!")[0] == pytest.approx(1.0986, abs=1e-3)
    assert lexicon.features(None) == lexicon.features("") == [0.0] * 4


def test_held_out_accuracy(spark, small):
    big = small.replace("sf0.001", "sf0.01")
    scored = queries.QUERIES["op9_toxicity"](spark, big)
    labels = spark.read.parquet(f"{big}/labels.parquet").select("doc_id", "toxic")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) >= 0.9
    assert scored.count() == spark.read.parquet(f"{big}/documents.parquet").count()


def test_cases(spark):
    rng = random.Random(9)
    words = "the of and house tree river walks under small green light over".split()
    rows = []
    for i in range(240):
        text = rng.choices(words, k=40)
        if i % 3 == 0:
            text[5], text[20] = "scoundrel", "You scoundrel."
        rows.append((i, " ".join(text), int(i % 3 == 0)))
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(900, None, "y"), (901, "", "y"), (None, "Scoundrel!", None),
                                  (0, rows[0][1], "again"), (902, "word " * 60_000, "long")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1, None), (3, 0), (5000, 1), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, labels, Workspace(spark, "toxicity"))).collect()
    assert len(got) == 245 and all((r.score >= 0.5) == ("scoundrel" in (r.text or "").lower()) for r in got)
    none = toxicity.train(docs, labels.limit(0), Workspace(spark, "toxicity"))
    assert {round(r.score, 6) for r in toxicity.score(docs, none).collect()} == {0.25}
    assert toxicity.score(docs.limit(0), none).count() == 0


def brute_clause(text, words, stems):
    """The grammar as a loop over the words before each one."""
    kinds, weights = [], []
    for word in re.findall(r"\w+(?:['’]\w+)*", text):
        weight = words.get(word) or next((stems[word[:n]] for n in (8, 7, 6, 5, 4) if n <= len(word) and word[:n] in stems), 0)
        weights.append(weight)
        kinds.append(toxicity.INSULT if weight else toxicity._CLASS.get(word, toxicity.OTHER))
    total = 0.0
    for i, kind in enumerate(kinds):
        if kind not in (toxicity.INSULT, toxicity.THREAT):
            continue
        threat = kind == toxicity.THREAT
        value = weights[i] or 1.0
        if threat:
            value *= 1.5 if toxicity.MODAL in kinds[max(0, i - 3):i] else 0.4
        if toxicity.TARGET in kinds[max(0, i - 5):i]:
            value *= 1.3
        if toxicity.NEGATION in kinds[max(0, i - 3):i]:
            value *= 0.2 if threat else 0.4
        if toxicity.REPORT in kinds[max(0, i - 40):i]:
            value *= 0.6
        total += value
    return total


def brute_features(text, words, stems):
    if not text:
        return [0.0] * 4
    text = text.lower()
    scores = [x for x in (brute_clause(c, words, stems) for c in re.split(r"[.!?;\n]", text)) if x]
    if not scores:
        return [0.0] * 4
    total = sum(scores)
    return [math.log1p(len(scores)), math.log1p(total), min(max(scores), 20.0) / 5,
            math.log1p(100 * total / (text.count(" ") + text.count("\n") + 21))]


def test_grammar_equals_brute_force():
    rng = random.Random(10)
    words, stems = {"moron": 3.0, "twit": 1.5}, {"achl": 1.0, "achlich": 2.0, "scou": 2.5}
    lexicon = toxicity.Lexicon(words, stems)
    parts = ["you", "kill", "will", "not", "said", "moron", "twit", "achliche", "achlos", "Scoundrel", "isn't", "they", "house", "tree",
             "walks", "oxymoron", "the_moron", "shoot", "nie", "dit", "é", "word", "small", "light", "over", "river"]
    marks = [" ", " ", " ", " ", " ", " ", ". ", "\n", "; ", "!", "-", "’"]
    for n in [*range(60), *[rng.randrange(200) for _ in range(400)], 60_000]:
        text = "".join(rng.choice(parts) + rng.choice(marks) for _ in range(n))
        assert lexicon.features(text) == pytest.approx(brute_features(text, words, stems))


def test_repeated_rows_and_own_columns(spark):
    model = toxicity.ToxicityModel(toxicity.Lexicon({"moron": 3.0}, {}), np.array([-2.0, 3.0, 1.0, 0.0, 0.0]))
    docs = spark.createDataFrame([(1, "A moron.", "x", 7), (1, "A moron.", "x", 7), (2, "moron " * 100_000, "y", None)],
                                 "doc_id long, text string, score string, toxic int")
    got = toxicity.score(docs, model).collect()
    assert [c for c in got[0].asDict()] == ["doc_id", "text", "toxic", "score"]
    assert sorted((r.doc_id, r.toxic) for r in got) == [(1, 7), (1, 7), (2, None)]
    assert len({r.score for r in got if r.doc_id == 1}) == 1 and all(r.score > 0.5 for r in got)


def test_a_document_without_id_is_not_held_out(spark, tmp_path):
    docs = [(i, "you are a moron" if i % 2 else "a house by the river") for i in range(40)]
    spark.createDataFrame([*docs, (None, "a moron"), (None, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([*((i, i % 2) for i in range(40)), (None, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.QUERIES["op9_toxicity"](spark, str(tmp_path)).collect()
    assert [r.held_out for r in got if r.doc_id is None] == [False, False] and len(got) == 42
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
