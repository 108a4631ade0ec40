"""The database change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.functions import scalars
from tidemart.functions.predicates import LANDED_BY
from tidemart.sources import messages


def may_name(value: Column, tables: list[str]) -> Column:
    """Whether message text can be about one of the tables, before it is parsed.

    Exact in one direction: text that neither holds a table's name nor any unicode escape,
    with which a name could be spelled differently, cannot be about the table.
    """
    keep = value.contains("\\u")
    for name in tables:
        keep = keep | value.contains(name)
    return keep


def read_change_log(raw: DataFrame, tables: list[str] | None = None, typed: bool = False) -> DataFrame:
    """Typed envelope of each message; works on a batch and on a stream.

    Text that is no JSON object parses to an envelope of nulls, which no table filter keeps.
    With ``tables`` other messages are dropped before the costly parse. ``seq`` says which of two
    changes came later: by second, and within a second by the log's offset, or the topic's where
    the message has none. ``typed`` adds the column ``typed``: the payload with its JSON types.
    """
    if tables:
        raw = raw.where(may_name(F.col("value"), tables))
    offset = F.coalesce("xoffset", "offset") if "offset" in raw.columns else F.col("xoffset")
    seq = F.struct(F.col("ts").try_cast("bigint").alias("second"), offset.alias("offset"))
    rows = messages.parsed(raw, schemas.CHANGE_TYPED if typed else schemas.CHANGE)
    if typed:
        as_text = F.transform_values("data", lambda k, v: v.cast("string"))
        rows = rows.withColumns({"typed": F.col("data"), "data": as_text})
    return rows.withColumn("seq", seq).drop("xoffset")


def with_event_time(log: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Adds ``row_time`` from the envelope's epoch second, and its watermark."""
    return log.withColumn(
        "row_time", scalars.epoch_seconds_to_timestamp(F.col("ts"))
    ).withWatermark("row_time", delay)


def land_change_log(raw: DataFrame, path: str, mode: str = "append", gather: bool = False) -> None:
    """Parse the log once and store it by table.

    Every fact job reads a few tables of one log. Landed, each job scans only the
    directories of its tables and never parses JSON again. Each task writes the tables that it meets, so that
    nothing is shuffled. ``gather`` rebalances the parsed log first, at the price of shuffling all of it: few
    files per table, for a log that mixes very many tables in small pieces.
    """
    log = read_change_log(raw).drop(LANDED_BY).withColumn(LANDED_BY, F.coalesce("table", F.lit("none")))
    if gather:
        log = log.hint("rebalance", LANDED_BY)
    log.write.mode(mode).partitionBy(LANDED_BY).parquet(path)


def read_landed_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
