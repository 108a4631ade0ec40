"""Small helpers of the streaming tests."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

VALUE = T.StructType([T.StructField("value", T.StringType())])


def put(folder: Path, chunks: list[list[str]]) -> str:
    """One text file per chunk, in the order in which a stream is to read them."""
    folder.mkdir(parents=True, exist_ok=True)
    start = len(list(folder.iterdir()))
    for i, lines in enumerate(chunks, start):
        path = folder / f"{i:04d}.txt"
        path.write_text("".join(line + "\n" for line in lines))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def chunks(lines: list, n: int) -> list[list]:
    size = max(1, -(-len(lines) // n))
    return [lines[i:i + size] for i in range(0, len(lines), size)]


def texts(frame) -> list[str]:
    return [r.value for r in frame.select("value").collect()]


def text_stream(spark, folder: str, files: int = 1):
    from tidemart.sources.messages import read_text_stream
    return read_text_stream(spark, folder, maxFilesPerTrigger=str(files))


def finish(query) -> None:
    assert query.awaitTermination(300), "stream did not end"
    assert query.exception() is None


def rows(frame, *drop: str) -> list:
    names = sorted(c for c in frame.columns if c not in drop)
    # Maps are compared as text.
    kinds = dict(frame.dtypes)
    shown = [F.to_json(n).alias(n) if kinds[n].startswith("map") else F.col(n) for n in names]
    return sorted((tuple(r) for r in frame.select(*shown).collect()), key=repr)
