import gzip
import hashlib
import random

from pyspark.sql import functions as F

from tidemart.llm import warc
from tidemart.llm.common import Workspace
from tidemart.llm.shared_files import get

LONG = "<p>é漢🙂</p>" * 20
ROWS = [
    (5, "http://www.Example.com/a?b=1#c", LONG), (3, "https://example.com/a", LONG), (9, "https://example.com/a", LONG),
    (1, None, "short"), (2, "http://user@x.example.org:80/p q\n", "short"), (4, "not an address", None), (6, "", ""),
    (7, "ftp://h/", "x" * 99), (8, "ftp://h/", "x" * 99), (10, "ftp://h/", "y" * 100), (11, "ftp://h", "y" * 100),
    (None, "http://a.b/", LONG), (None, None, None), (12, "http://big/", "z" * 400_000), (3, "https://example.com/a", LONG),
    (13, "http://a.b/\r\n\r\nWARC-Type: fake", "header" * 30), (-4, "http://a.b/", "negative" * 20), (14, "http://a.b/c", "negative" * 20),
]
COLUMNS = "page_id long, url string, html string"


def wanted(rows):
    first = {}
    for ident, _, html in rows:
        if len((html or "").encode()) >= 100:
            first.setdefault(html, []).append(2**63 if ident is None else ident)
    out = []
    for ident, _, html in rows:
        data = (html or "").encode()
        least = min(first.get(html, [ident]), key=lambda x: 2**63 if x is None else x)
        same = least == ident or (ident is None and least == 2**63)
        out.append((ident, len(data), hashlib.sha256(data).hexdigest(), "response" if same else "revisit",
                    None if same else least))
    return sorted(out, key=repr)


def round_trip(spark, rows, **sizes):
    pages = spark.createDataFrame([(*r, "k") for r in rows], COLUMNS + ", key string").repartition(3)
    work = Workspace(spark, "warc")
    captures = warc.write_archives(pages, work, file_bytes=sizes.get("file", 500))
    assert captures.count() == len(rows)
    root = warc.build_index(captures, work, block_captures=sizes.get("block", 2))
    keys = pages.select(warc.capture_key(F.col("url"), F.col("page_id")).alias("key"))
    return pages, work, captures, root, warc.fetch(warc.lookup(keys, root), work)


def test_round_trip(spark):
    *_, records = round_trip(spark, ROWS)
    rows = records.collect()
    got = [(r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=repr) == wanted(ROWS)
    texts = {r[0]: r[2] or "" for r in ROWS}
    assert all(r.payload is None if r.record_type == "revisit" else bytes(r.payload).decode() == texts[r.id] for r in rows if r.id)


def test_files_are_archives(spark):
    _, work, captures, _, _ = round_trip(spark, ROWS)
    for file in {r.file for r in captures.collect()}:
        text = gzip.decompress(get(f"{work.path('warc')}/{file}"))
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")


def test_lookup_by_key_and_by_prefix(spark):
    rng = random.Random(3)
    rows = [(i, f"http://{rng.choice('abc')}.{rng.choice(['x', 'xy'])}.org/{rng.randrange(40)}", str(i) * 40) for i in range(700)]
    pages, work, captures, root, _ = round_trip(spark, rows, block=5)
    asked = [warc_key for warc_key in {r.k for r in pages.select(warc.url_key(F.col("url")).alias("k")).collect()}]
    frame = spark.createDataFrame([(f"{k} ",) for k in asked] + [("zz",), ("",), (None,), ("org,x,a)/1",)], "key string")
    held = captures.collect()
    got = warc.lookup(frame, root, prefix=True).collect()
    want = {(w, r.key, r.file, r.offset) for w in [r.key for r in frame.collect()] if w is not None for r in held if r.key.startswith(w)}
    assert {(r.wanted, r.key, r.file, r.offset) for r in got} == want and len(got) == len(want)
    assert warc.lookup(frame, root).count() == 0


def test_keys(spark):
    frame = spark.createDataFrame([("http://www.Example.com:80/A?b",), ("https://u:p@a.b",), (None,), ("x y",)], "url string")
    got = [r.k for r in frame.select(warc.url_key(F.col("url")).alias("k")).collect()]
    assert got == ["com:80,example,www)/A?b", "b,a)", "-)", "-)x%20y"]


def test_empty(spark):
    *_, records = round_trip(spark, [])
    assert records.count() == 0
