import random
import struct

import public_tokenizers as P
import pytest
import tiktoken

from tidemart.llm import bpe

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def oracle():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS),
                             special_tokens={})


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_pieces_equal_the_library(oracle):
    encoder, rng = bpe.Encoder(bpe.read_ranks(RANKS), P.PATTERN), random.Random(2)
    texts = ["", " ", "\n\n  x", "it's we'll", "naïve Ünïcödé 漢字かな 🙂🙂", "\u0000​", "a" * 50_000,
             "ab" * 9_000, "".join(rng.choice("abcdeé漢 ") for _ in range(30_000)), "<|endoftext|>"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 1000)]))
                      for _ in range(rng.randrange(60))) for _ in range(300)]
    for text in texts:
        assert encoder.encode(text) == packed(oracle.encode_ordinary(text))


def test_frames(spark, oracle):
    rows = [(1, None, "x"), (2, "", None), (3, "one two", "y"), (3, "one two", "y"), (None, "z" * 3000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    ids = bpe.encode(docs, RANKS, P.PATTERN)
    back = bpe.decode(ids.withColumn("list", bpe.unpack()), RANKS).collect()
    assert [(r.doc_id, r.text) for r in back] == [(r[0], r[1]) for r in rows]
    for row in back:
        want = oracle.encode_ordinary(row.text or "")
        assert bytes(row.ids) == packed(want) and row["list"] == want
        assert bytes(row.decoded) == (row.text or "").encode()
    both = bpe.round_trip(docs, RANKS, P.PATTERN)
    assert both.columns == ["doc_id", "text", "decoded", "ids"]
    assert sorted(both.collect(), key=repr) == sorted(bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS).collect(), key=repr)
    assert bpe.decode(bpe.encode(docs.limit(0), RANKS, P.PATTERN), RANKS).count() == 0
