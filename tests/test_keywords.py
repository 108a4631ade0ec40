"""Dictionary words and finest words, also in windows."""

import random

from pyspark.sql import functions as F

from tidemart.operators import keywords
from tidemart.plans import warehouse
from tidemart.sources import page_log
from tidemart.streaming import jobs
from stream_files import finish, put, text_stream


def vocabulary(spark, *words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def occurrences(text, words):
    return sorted((p + 1, w) for w in {x.lower() for x in words} for p in range(len(text)) if w and text.lower().startswith(w, p))


def finest(run, words):
    hits = occurrences(run, words)
    covered = {i for p, w in hits for i in range(p, p + len(w))}
    return sorted([w for _, w in hits] + [c for i, c in enumerate(run, 1) if i not in covered])


def test_match_equals_a_plain_search(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcä") for _ in range(rng.randint(1, 6))) for _ in range(60)] + ["x" * 40, "", "AB", "c"]
    texts = ["".join(rng.choice("abcäx") for _ in range(rng.randint(0, 60))) for _ in range(40)] + ["x" * 90, "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = sorted((r.id, r.position, r.word) for r in keywords.keyword_dictionary_match(rows, "text", vocabulary(spark, *words)).collect())
    assert got == sorted((i, p, w) for i, t in enumerate(texts) if t for p, w in occurrences(t, words))


def test_a_long_word_adds_no_probes(spark):
    """At most two rows per character go to the join, however long the longest word is."""
    texts = ["the quick brown fox jumps over the lazy dog " * 5] * 3
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    assert keywords.starts_of(rows, "text", 40).count() <= 2 * sum(map(len, texts))
    heads = keywords.dictionary_heads(vocabulary(spark, "quick", "quiet", "qi", "q", "z" * 40).withColumnRenamed("word", "_word"))
    assert {r["_head"]: r["_sizes"] for r in heads.collect()} == {"qu": [5], "qi": [2], "q": [1], "zz": [40]}


def test_finest_words(spark):
    words = ["程序", "程序员", "序员", "电脑", "mixed"]
    texts = ["程序员", "我是程序员abc电脑", "mixed 我我", "", None, "程序员程序员", "only words 12"]
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id int, text string, _text string").drop("_text")
    got = {}
    for r in keywords.keyword_finest(rows, "text", vocabulary(spark, *words)).collect():
        got.setdefault(r.id, []).append(r.word)
    assert {i: sorted(w) for i, w in got.items()} == {
        0: finest("程序员", words), 1: sorted([*finest("我是程序员", words), "abc", *finest("电脑", words)]), 2: ["mixed", "我", "我"],
        5: finest("程序员程序员", words), 6: ["12", "only", "words"]}
    assert sorted(got[0]) == ["序员", "程序", "程序员"]


def test_windows_of_finest_words_as_a_stream(spark, tmp_path):
    page = '{{"common":{{}},"page":{{"item":"{}","item_type":"keyword","last_page_id":"search"}},"ts":{}}}'
    said = [[page.format("程序员", 1_000), page.format("电脑 x", 9_999)], [page.format("我程序员", 10_000), page.format("程序员", 2_000)]]
    words = ["程序", "程序员"]

    def counts(frame):
        return sorted((r.keyword, str(r.stt), r.keyword_count) for r in frame.collect())

    folder = put(tmp_path / "in", [*said, [page.format("end", 4_000_000_000_000)]])
    view = page_log.read_page_view(text_stream(spark, folder))
    path, out = str(tmp_path / "words"), str(tmp_path / "out")
    finish(jobs.fine_words_job(view, lambda: vocabulary(spark, *words), path, str(tmp_path / "ck1")))
    stored = (spark.readStream.schema("rt timestamp, word string")
              .option("maxFilesPerTrigger", "100").parquet(f"{path}/batch=*").withWatermark("rt", "2 seconds"))
    finish(jobs.fine_keyword_job(stored, lambda b, n: b.write.mode("overwrite").parquet(f"{out}/batch={n}"), str(tmp_path / "ck2")))
    batch = warehouse.dws_keyword_window(page_log.read_page_view(spark.read.text(folder)), dictionary=vocabulary(spark, *words))
    got, want = counts(spark.read.parquet(out)), counts(batch.where("keyword <> 'end'"))
    assert got == want and len(want) == 8
    assert {w for w, _, _ in want} == {"程序", "程序员", "我", "电", "脑", "x"}
