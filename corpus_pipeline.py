"""Documents made ready for training: language, repeated lines, near copies, benchmark leaks, tokens.

Every stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes each result as Parquet in
the run's shared folder and reads it back as the next stage's documents. Decisions travel as narrow
tables of ids, and texts stay where they are: ids to drop are sent to all executors while their
counted number allows it, else joined in a shuffle.

Defined results: all stages but the last return the columns they were given. A row without an id
can't be named and is never dropped; rows that repeat an id share its fate, and of equal rows of an id one
stays. A document whose lines all go stays, empty. Extra columns pass through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import bpe, decontaminate, jaccard, language_id, line_dedup
from tidemart.llm.common import Workspace, importable, small_side, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _without(docs: DataFrame, ids: DataFrame, work: Workspace, name: str = "gone") -> DataFrame:
    """Documents but those whose id is listed."""
    gone = work.save(ids.where("doc_id IS NOT NULL").distinct(), name)
    return docs.join(small_side(gone), "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; blank ones and those of too little evidence go."""
    importable(spark, lean=True)
    work = Workspace(spark, "language")
    models = language_id.train(docs)
    told = language_id.identify(language_id.document_evidence(docs), models, work)
    return _without(docs, told.groupBy("doc_id").agg(F.max("kept").alias("kept")).where(~F.col("kept")).select("doc_id"), work)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; ``n_chars`` follows the text."""
    importable(spark, lean=True)
    kept = line_dedup.dedup_lines(docs.withColumns({f"own_{c}": F.col(c) for c in ("n_lines", "n_dropped") if c in docs.columns}),
                                  Workspace(spark, "lines"))
    columns = {c: F.col(f"`{c}`") for c in docs.columns}
    columns |= {c: F.col(f"own_{c}").alias(c) for c in ("n_lines", "n_dropped") if c in docs.columns}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return kept.select(*columns.values())


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of near copies (five words, similarity 0.8)."""
    importable(spark, lean=True)
    work = Workspace(spark, "copies")
    found = work.save(jaccard.JaccardJoin(work, words=5, percent=80).run(docs).components(), "found")
    kept = _without(docs, found.where("component_id <> doc_id").select("doc_id"), work)
    again = work.save(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    if again.isEmpty():
        return kept
    repeated = kept.join(small_side(again), "doc_id", "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
    return _without(kept, again, work, "once").unionByName(repeated.dropDuplicates(["doc_id", "text"]))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    work = Workspace(spark, "leaks")
    leaks = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"), work, copies=True)
    return _without(docs, leaks.select("doc_id"), work)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids (packed, 4 bytes each), their number, and whether they decode to the text."""
    importable(spark, lean=True)
    exact = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    both = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN, cached=80_000)
    return (both.withColumn("n_tokens", (F.length("ids") / 4).cast("long")).withColumn("exact", exact)
            .drop("decoded"))


STAGES = [
    ("language_id", known_language),
    ("line_dedup", unrepeated_lines),
    ("ngram_jaccard_join", one_of_near_copies),
    ("benchmark_decontamination", without_benchmarks),
    ("bpe", tokens),
]

# SQL can't fit the language models or encode bytes; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark, lean=True)
    work = Workspace(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = work.save(stage(spark, docs, sf_dir), name)
        if before:
            work.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
