"""Message topics: text in, text out of a broker or of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_topic_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A broker topic from its earliest offset (needs the Kafka connector on the class path)."""
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic)
           .option("startingOffsets", "earliest")
           .options(**options).load())
    return messages(raw, "partition", "offset")


def read_text_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A directory of text files, one message per line, read from the first file on."""
    return messages(spark.readStream.options(**options).text(path))


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """The same directory as a batch."""
    return messages(spark.read.text(path))


def messages(raw: DataFrame, *keep: str) -> DataFrame:
    """Message text as ``value``; messages without content are dropped."""
    names = [c for c in raw.columns if c in keep or c == "src_table"]
    return raw.select(F.col("value").cast("string").alias("value"), *names).where(
        F.col("value").isNotNull())


def parsed(raw: DataFrame, schema: T.StructType, *keep: str, text: Column | None = None) -> DataFrame:
    """JSON messages as the columns of ``schema``, beside all columns other than ``value``.

    Messages without content are dropped; ``keep`` may name ``value``, to have the text too.
    The columns come out of a generator: filters on them are not pushed into a second parse.
    """
    source = F.col("value") if text is None else text
    rows = F.when(F.col("value").isNotNull(), F.array(F.from_json(source, schema)))
    return raw.select(*[c for c in raw.columns if c != "value"], *keep, F.inline(rows))
