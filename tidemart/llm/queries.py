"""One query per operator, over its whole table, with production parameters; and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import bpe, decontaminate, embedding_dedup, hamming_search, jaccard, language_id, licence_scan, line_dedup, merkle, secret_scan, spelling, toxicity, warc
from tidemart.llm.common import Workspace, importable, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(function: Callable[[SparkSession, str], DataFrame]):
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_ngram_jaccard_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return jaccard.JaccardJoin(Workspace(spark, "op1"), words=4, percent=85).run(docs).components()


@query
def op2_bpe_round_trip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op3_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    kept = line_dedup.dedup_lines(docs, Workspace(spark, "op3"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL["op3_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING min(doc_id) <> max(doc_id)),
marked AS (
  SELECT k.*, coalesce(s.first <> k.doc_id, false) AS lost FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


def secret_columns(scanned: DataFrame) -> DataFrame:
    """Counts and digests of found spans."""
    base = F.filter("spans", lambda x: x.kind != "markov")

    def said(spans):
        return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start, x.end)))

    def of(kind):
        return F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [of(kind) for kind in ("assign", "access", "hex")]
    return scanned.select("doc_id", *counts, F.sha2(said(base).cast("binary"), 256).alias("base_sha256"),
                          said(F.col("spans")).alias("spans"))


@query
def op4_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    models = secret_scan.fit(secret_scan.labelled_runs(docs))
    return secret_columns(secret_scan.scan(docs, models).drop("text"))


@query
def op9_toxicity(spark, sf_dir):
    # A document without an id has no labels and is not held out.
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = table(spark, sf_dir, "labels", ["doc_id", "toxic"]).where(~held_out)
    model = toxicity.train(docs, labels, Workspace(spark, "op9"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    pages = table(spark, sf_dir, "pages")
    rows = (language_id.document_evidence(docs).withColumn("page_id", F.lit(None).cast("long"))
            .unionByName(language_id.page_evidence(pages).withColumn("doc_id", F.lit(None).cast("long"))))
    # Models of four fifths of the labelled documents; the labels of the others were never seen.
    trained = language_id.training_share("doc_id")
    told = language_id.identify(rows, language_id.train(docs.where(trained)), Workspace(spark, "op6"), key=("doc_id", "page_id"))
    return told.withColumn("held_out", F.col("doc_id").isNotNull() & ~trained)


@query
def op7_warc_round_trip(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    work = Workspace(spark, "op7")
    root = warc.build_index(warc.write_archives(pages, work), work)
    keys = pages.select(warc.capture_key(F.col("url"), F.col("page_id")).alias("key"))
    records = warc.fetch(warc.lookup(keys, root), work, payloads=False)
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op7_warc_round_trip"] = """
WITH rows AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
first AS (
  SELECT payload_digest, min(page_id) AS first FROM rows WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN f.first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> page_id THEN f.first END AS refers_to
FROM rows LEFT JOIN first f USING (payload_digest)"""


@query
def op8_embedding_dedup(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    return embedding_dedup.link_vectors(vectors, Workspace(spark, "op8"))


@query
def op5_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"), Workspace(spark, "op5"), copies=True)


@query
def op10_licence_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return licence_scan.scan(docs).select("doc_id", "known", F.array_join("licences", ",").alias("licences"),
                                          F.array_join("rules", ",").alias("rules"))


SQL["op1_ngram_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS grams
  FROM words),
grams AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS n, b.n AS m, count(*) AS common
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n),
links AS (SELECT x, y FROM shared WHERE 100 * common >= 85 * (n + m - common)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, e.y FROM reached r JOIN edges e ON r.y = e.x)
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x) USING (doc_id)"""

# Every pair, where the operator finds them by filters; its recall is tested apart.
SQL["op8_embedding_dedup"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b
  ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reached AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT x AS vec_id, min(y) AS component_id FROM reached GROUP BY x)
LEFT JOIN (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x) USING (vec_id)"""


@query
def op13_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    altered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    other = merkle.leaf_of(*(F.col(c) + 1 if c == "n_chars" else F.col(c) for c in fields))
    made = merkle.build(docs, fields, "lang", "doc_id", Workspace(spark, "op13"), {"altered": F.when(altered, other)})
    folded = merkle.fold(F.coalesce("kept.altered", "leaf"), F.col("witness"))
    return made.rows.select("kept.doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("witness")), 256).alias("proof_sha256"),
                            folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


# Checksums of byte strings: a table of 256 remainders, made by eight steps each, and a pass over the bytes.
_CRC_TABLE = """
crc_steps AS (
  SELECT i AS byte, i AS value, 0 AS step FROM range(256) t(i)
  UNION ALL SELECT byte, CASE WHEN value % 2 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END, step + 1
  FROM crc_steps WHERE step < 8),
crc_table AS (SELECT list(value ORDER BY byte) AS remainders FROM crc_steps WHERE step = 8)"""


def _crc(text: str) -> str:
    """SQL of the checksum of a text, where ``remainders`` is in reach."""
    byte = f"CAST('0x' || substr(hex(encode({text})), 2 * i - 1, 2) AS BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen({text}) + 1), lambda i: {byte})), "
            "lambda a, b: xor(a >> 8, remainders[(xor(a, b) & 255) + 1])), 4294967295)")


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _leaf(chars: str) -> str:
    return f"sha256({' || '.join(_field(x) for x in ('doc_id', 'source', 'lang', chars, 'text'))})"


def _levels(name: str, key: str) -> str:
    """SQL of the levels of trees whose leaves are the rows of ``name`` (key, pos, n, digest)."""
    return f"""
{name}_levels AS (
  SELECT {key}, 0 AS lvl, pos, n, digest FROM {name}
  UNION ALL SELECT {key}, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM {name}_levels WHERE n > 1 GROUP BY {key}, lvl, pos // 2, n)"""


def _paths(name: str, levels: str, key: str, start: str) -> str:
    """SQL of the folded digests and the siblings so far of rows that start at leaves of those levels."""
    return f"""
{name} AS (
  {start}
  UNION ALL SELECT p.id, p.{key}, p.lvl + 1, p.pos // 2, (p.n + 1) // 2,
    sha256(CASE WHEN p.pos % 2 = 1 THEN s.digest || p.folded ELSE p.folded || coalesce(s.digest, '') END),
    p.proof || coalesce(s.digest, '')
  FROM {name} p LEFT JOIN {levels} s ON s.{key} = p.{key} AND s.lvl = p.lvl AND s.pos = xor(p.pos, 1)
  WHERE p.n > 1)"""


SQL["op13_merkle_manifest"] = f"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (
  SELECT *, row_number() OVER () AS id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree, {_leaf('n_chars')} AS digest,
    CASE WHEN {_crc('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS given
  FROM documents, crc_table),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n FROM docs),
{_levels('leaves', 'tree')},
subroots AS (
  SELECT tree, digest, '' AS top, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n
  FROM leaves_levels WHERE n = 1),
{_levels('subroots', 'top')},
{_paths('low', 'leaves_levels', 'tree',
        "SELECT id, tree, 0 AS lvl, pos, n, given AS folded, '' AS proof FROM leaves")},
{_paths('high', 'subroots_levels', 'top',
        "SELECT l.id, '' AS top, 0 AS lvl, s.pos, s.n, l.folded, l.proof FROM low l JOIN subroots s USING (tree) WHERE l.n = 1")}
SELECT doc_id, d.digest AS leaf, s.digest AS subroot, r.digest AS root, sha256(h.proof) AS proof_sha256,
       h.folded AS folded_root, h.folded = r.digest AS verified
FROM leaves d JOIN subroots s USING (tree) JOIN (SELECT * FROM high WHERE n = 1) h USING (id)
CROSS JOIN (SELECT digest FROM subroots_levels WHERE n = 1) r"""


@query
def op12_spelling_variants(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return spelling.variant_groups(spelling.count_words(docs, damage=199), Workspace(spark, "op12"))


SQL["op12_spelling_variants"] = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run),
summed AS (
  SELECT run, n, {_crc("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h FROM runs, crc_table),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM summed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (
  SELECT word, n, pos, substr(word, 1, pos - 1) || substr(word, pos + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM words)),
replaced AS (SELECT a.word AS a, b.word AS b, b.n AS n FROM cut a JOIN cut b ON a.rest = b.rest AND a.pos = b.pos AND a.word <> b.word),
shorter AS (SELECT DISTINCT c.word AS a, c.n AS n_a, w.word AS b, w.n AS n_b FROM cut c JOIN words w ON c.rest = w.word),
near AS (
  SELECT a, b, n FROM replaced UNION SELECT a, b, n_b FROM shorter UNION SELECT b, a, n_a FROM shorter),
best AS (
  SELECT a AS word, count(*) AS n_near, max(n) AS most FROM near GROUP BY a),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * w.n THEN most END AS form_n,
    CASE WHEN most >= 5 * w.n THEN (SELECT min(encode(b)) FROM near x WHERE x.a = w.word AND x.n = most) END AS code
  FROM words w LEFT JOIN best USING (word)),
forms AS (SELECT word, n, n_near, form_n, decode(code) AS form FROM formed),
ways AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT w.word, w.next, f.form FROM ways w JOIN forms f ON f.word = w.next)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM ways WHERE next IS NULL) USING (word)"""


@query
def op11_nearest_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    return hamming_search.nearest(vectors, Workspace(spark, "op11"), F.col("vec_id") % 50 == 0)


# Every pair, where the operator finds them by codes; its recall is tested apart.
SQL["op11_nearest_neighbours"] = """
WITH usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND len(q.v) = len(c.v) AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5"""
