import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemart.llm import language_id, queries
from tidemart.llm.common import Workspace

WORDS = {"en": "the of and that with from house water street over night", "de": "der und die nicht mit auf haus straße über nacht",
         "fr": "le de et que avec pour maison eau rue été nuit", "es": "el de y que con para casa agua calle año noche"}
COLUMNS = "doc_id long, text string, declared string, suffix string, domain string, host string"


def text(rng, lang, n=30):
    return " ".join(rng.choices(WORDS[lang].split(), k=n))


@pytest.fixture(scope="module")
def models(spark):
    rng = random.Random(1)
    rows = [(text(rng, lang), lang) for lang in WORDS for _ in range(80)] + [(None, "en"), ("abc", None), ("x", "xx")]
    return language_id.train(spark.createDataFrame(rows, "text string, lang string"))


def brute(rows, models):
    """The fusion, row by row, in plain numbers."""
    langs = models.languages
    likely = models.likelihoods(pa.array([r[1] for r in rows], pa.string()))
    chance = [None if x is None else np.exp(x) / np.exp(x).sum() for x in likely]

    def sums(pick):
        out = {}
        for r, c in zip(rows, chance, strict=True):
            if c is not None and (k := pick(r)) is not None:
                out[k] = out.get(k, 0) + c
        return out

    def smooth(s, parent):
        return (s + language_id.SMOOTHING * parent) / (s.sum() + language_id.SMOOTHING)

    total = sum((c for c in chance if c is not None), np.zeros(len(langs))) + 1
    overall = total / total.sum()
    domains = {k: smooth(s, overall) for k, s in sums(lambda r: r[4]).items()}
    hosts = {}
    for k, s in sums(lambda r: r[5]).items():
        parent = next((domains[r[4]] for r in rows if r[5] == k and r[4] in domains), overall)
        hosts[k] = smooth(s, parent)
    given = []
    for at in (2, 3):
        met = sums(lambda r, at=at: r[at])
        every = sum(met.values(), np.zeros(len(langs))) + 0.5 * len(met)
        given.append({k: np.log((s + 0.5) / every) for k, s in met.items()})
    out = []
    for r, x in zip(rows, likely, strict=True):
        if x is None:
            out.append((r[0], None, None))
            continue
        logs = np.array(x) + np.log(hosts.get(r[5], domains.get(r[4], overall)))
        logs = logs + given[0].get(r[2], 0) + given[1].get(r[3], 0)
        out.append((r[0], langs[int(logs.argmax())], 1 / np.exp(logs - logs.max()).sum()))
    return out


def rows():
    rng = random.Random(2)
    out = []
    for i in range(400):
        lang = rng.choice(list(WORDS))
        n = rng.choice([1, 2, 30, 200])
        declared = rng.choice([lang, lang, None, "en"])
        host = rng.choice([None, f"{lang}.example.com", "www.example.org"])
        domain = None if host is None else ".".join(host.split(".")[1:])
        out.append((i, text(rng, lang, n), declared, None if domain is None else domain.split(".")[-1], domain, host))
    return out + [(900, None, "en", None, None, None), (901, "", None, "com", "example.com", None), (902, "12 -- 3", "de", None, None, "h"),
                  (None, text(rng, "de"), None, None, None, None), (3, *out[3][1:]), (904, "straße " * 40_000, None, None, None, "h")]


def test_equals_brute_force(spark, models):
    given = rows()
    got = language_id.identify(spark.createDataFrame(given, COLUMNS).repartition(3), models, Workspace(spark, "language")).collect()
    want = sorted(brute(given, models), key=repr)
    got = sorted(got, key=lambda r: repr((r.doc_id, r.language, r.posterior)))
    assert [(r.doc_id, r.language) for r in got] == [w[:2] for w in want]
    for r, w in zip(got, want, strict=True):
        assert (r.posterior is None) == (w[2] is None) and (w[2] is None or math.isclose(r.posterior, w[2], rel_tol=1e-6))
        assert r.kept == (w[2] is not None and w[2] >= language_id.LEAST_POSTERIOR)


def test_evidence_decides_short_texts(spark, models):
    base = [(i, "haus und straße", "de", "de", "beispiel.de", "a.beispiel.de") for i in range(60)]
    base += [(100 + i, "house and street", "en", "com", "example.com", "b.example.com") for i in range(60)]
    given = [*base, (500, "de", "de", "de", "beispiel.de", "a.beispiel.de"), (501, "de", "en", "com", "example.com", "b.example.com")]
    got = {r.doc_id: r.language for r in language_id.identify(
        spark.createDataFrame(given, COLUMNS), models, Workspace(spark, "language")).collect()}
    assert got[500] == "de" and got[501] == "en"


def test_markup_and_addresses(spark):
    html = '<!DOCTYPE html><HTML class="a" lang="FR-ca"><script>var x = "<p>";</script><p>Bon<b>jour</b></p><!-- no --></html>'
    page = spark.createDataFrame([(1, "https://me@M.news.Example.co/fr/1?x=2#a", html), (2, None, None), (3, "x", "no tags")],
                                 "page_id long, url string, html string")
    found = {r.page_id: r for r in language_id.page_evidence(page).collect()}
    assert (found[1].declared, found[1].host, found[1].domain, found[1].suffix) == ("fr", "m.news.example.co", "example.co", "co")
    assert found[1].text.split() == ["Bon", "jour"]
    assert found[2].host is None and found[3].declared is None


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small.replace('sf0.001', 'sf0.01')}/documents.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    models = language_id.train(docs.where(~held))
    rows = language_id.document_evidence(docs.where(held)).withColumn("declared", F.lit(None).cast("string"))
    got = language_id.identify(rows, models, Workspace(spark, "language")).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.language == r.lang for r in got]) >= 0.95


def test_empty(spark, models):
    assert language_id.identify(spark.createDataFrame([], COLUMNS), models, Workspace(spark, "language")).count() == 0


FOREIGN = ["В начале было слово, и слово было у всех людей, которые жили в этом большом городе на берегу широкой реки.",
           "在很久以前有一个住在山里的老人每天早上都会走到河边去看太阳升起来的样子然后回家吃饭睡觉",
           "W Szczebrzeszynie chrząszcz brzmi w trzcinie i Szczebrzeszyn z tego słynie, że wszyscy chcą go zobaczyć",
           "xq zvkj wqpx jjkz vbqx zzpk qwxv kkjq xzvb pqjw vxkz qjzp wvkx bqzj xkpv jqwz kvbx zpqj wxkv"]


def test_foreign_texts_are_not_kept(spark, small):
    docs = spark.read.parquet(f"{small.replace('sf0.001', 'sf0.01')}/documents.parquet")
    models = language_id.train(docs)
    own = language_id.document_evidence(docs)
    strange = spark.createDataFrame([(-1 - i, x, None, None, None, None) for i, x in enumerate(FOREIGN)], COLUMNS)
    got = language_id.identify(own.unionByName(strange), models, Workspace(spark, "language")).collect()
    assert not any(r.kept for r in got if r.doc_id < 0)
    assert np.mean([r.kept for r in got if r.doc_id >= 0]) >= 0.99


def test_languages_are_the_labels_met(spark):
    rng = random.Random(3)
    rows = [(text(rng, lang), lang) for lang in ("en", "de") for _ in range(80)]
    rows += [(" ".join(rng.choices("il della che con casa acqua strada notte sono anche".split(), k=30)), "it") for _ in range(80)]
    models = language_id.train(spark.createDataFrame([*rows, ("seldom met", "xx")], "text string, lang string"))
    assert models.languages == ("en", "de", "it", "xx")
    given = [(1, "della casa che sono anche con acqua della strada", None, None, None, None)]
    got = language_id.identify(spark.createDataFrame(given, COLUMNS), models, Workspace(spark, "language")).collect()
    assert got[0].language == "it" and got[0].kept


@pytest.mark.parametrize("n", [1, 49, 50])
def test_few_rows_make_a_language(spark, n):
    """A label's rows count from the first on; nothing changes at any number of them."""
    rng = random.Random(4)
    rows = [(text(rng, lang), lang) for lang in ("en", "de") for _ in range(300)]
    italian = "il della che con casa acqua strada notte sono anche".split()
    rows += [(" ".join(rng.choices(italian, k=60)), "IT-ch") for _ in range(n)]
    models = language_id.train(spark.createDataFrame([*rows, ("the of and", "not a tag")], "text string, lang string"))
    assert models.languages == ("en", "de", "it")
    given = [(1, " ".join(rng.choices(italian, k=40)), None, None, None, None), (2, text(rng, "en"), None, None, None, None),
             (3, FOREIGN[0], None, None, None, None)]
    got = {r.doc_id: r for r in language_id.identify(
        spark.createDataFrame(given, COLUMNS), models, Workspace(spark, "language")).collect()}
    assert (got[1].language, got[2].language, got[2].kept, got[3].kept) == ("it", "en", True, False)


def test_query_reports_rows_it_was_not_trained_on(spark, small):
    folder = small.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    told = queries.QUERIES["op6_language_id"](spark, folder)
    rows = told.where("held_out").join(docs, "doc_id").collect()
    assert 120 < len(rows) < 280 and told.where("page_id IS NOT NULL AND held_out").count() == 0
    # By the text alone: no label of these rows, nor one declared by them, has a part in it.
    assert np.mean([r.text_language == r.lang for r in rows if r.text_language]) >= 0.95
