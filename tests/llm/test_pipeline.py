import random
import struct
import sys
from pathlib import Path

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from tidemart.llm import bpe, language_id

sys.path.insert(0, str(Path(__file__).parent))
import test_decontaminate
import test_jaccard
import test_language_id
import test_line_dedup

ITEM = test_decontaminate.PLAIN
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, n_dropped string"


def documents():
    rng = random.Random(12)
    rows, i = [], 0
    for lang in test_language_id.WORDS:
        vocabulary = ["".join(rng.choices(test_language_id.WORDS[lang].replace(" ", ""), k=5)) + x for x in test_language_id.WORDS[lang].split()]
        for copies in (1, 1, 1, 4, 9):
            base = rng.choices(vocabulary, k=80)
            for _ in range(copies):
                words = list(base)
                for _ in range(rng.randrange(3)):
                    words[rng.randrange(80)] = rng.choice(vocabulary)
                # Several lines, of which some repeat in the copies, or one that never does.
                width = rng.choice([20, 80, 80]) if copies > 1 else 20
                lines = [" ".join(words[k:k + width]) for k in range(0, 80, width)]
                if rng.random() < 0.3:
                    lines.append(f"The common last line of {lang} pages")
                if rng.random() < 0.2:
                    lines.append(ITEM)
                rows.append((i, "\n".join(lines), lang, rng.choice(["src1", "src2"])))
                i += 1
    rows += [(i, None, "en", "src1"), (i + 1, "", "en", None), (i + 2, "12 -- 34", "de", "src1"), (i + 3, ITEM.upper(), "en", "src2"),
             (i + 4, "the of and " * 20_000, "en", "src3"), (None, "the of and with", "en", "src1"), (7, rows[7][1], rows[7][2], "src1"),
             (i + 5, "short text of the house", None, "src1"), (i + 6, rows[0][1], "en", "src1")]
    rng.shuffle(rows)
    return [(*r, len(r[1] or ""), "own") for r in rows]


def brute(spark, rows, items):
    """(doc_id, text) that the first four stages leave."""
    models = language_id.train(spark.createDataFrame(rows, COLUMNS))
    told = test_language_id.brute([(r[0], r[1], r[2] and r[2].lower(), None, None, r[3]) for r in rows], models)
    kept = {i for i, lang, chance in told if lang is not None and chance >= language_id.LEAST_POSTERIOR}
    left = [(r[0], r[1]) for r in rows if r[0] is None or r[0] in kept]
    left = [(i, text) for i, _, _, text in test_line_dedup.brute(left)]
    named = test_jaccard.brute(left, 5, 80)
    lost = {i for i, _, component in named if component is not None and component != i}
    left = [x for x in left if x[0] not in lost]
    left = [x for x in left if x[0] is None] + sorted({x for x in left if x[0] is not None})
    leaks = {x[0] for x in test_decontaminate.brute(left, items)}
    return [x for x in left if x[0] is None or x[0] not in leaks]


def test_run_equals_brute_force(spark, tmp_path):
    rows, items = documents(), [(1, ITEM), (2, test_decontaminate.ITEM)]
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = brute(spark, rows, items)
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(want, key=repr)
    assert 10 < len(want) < len(rows) - 12
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")))
    for row in got:
        ids = library.encode_ordinary(row.text)
        assert row.exact and row.n_tokens == len(ids) and bytes(row.ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert row.n_chars == len(row.text) and row.n_dropped == "own"


@pytest.mark.parametrize("at", range(5))
def test_stages_keep_columns_and_stand_empty_tables(spark, tmp_path, at):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([], COLUMNS)
    out = corpus_pipeline.STAGES[at][1](spark, docs, str(tmp_path))
    assert out.columns[:6] == docs.columns and (at == 4 or len(out.columns) == 6) and out.count() == 0


def test_stage_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "bpe"]
