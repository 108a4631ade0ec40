"""Joins of change streams, dictionaries and time intervals.

Every function works on batches and on streams alike.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when it has at most this many rows and characters.
BROADCAST_ROWS = 100_000
BROADCAST_CHARS = 64 * 1024 * 1024


def small_enough(side: DataFrame, rows: int = BROADCAST_ROWS, chars: int = BROADCAST_CHARS) -> bool:
    """Whether a batch side fits a broadcast. Reads at most ``rows + 1`` of its rows."""
    size = F.length(F.to_json(F.struct(*side.columns)))
    found = side.limit(rows + 1).select(size.alias("n")).agg(
        F.count("*").alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("chars")).first()
    return found["rows"] <= rows and found["chars"] <= chars


def checked_broadcast(side: DataFrame) -> DataFrame:
    """The side with a broadcast hint if it is small.

    A larger side comes back without hint: Spark then shuffles both sides by the key, and
    adaptive execution splits a hot key of the other side.
    """
    if side.isStreaming or not small_enough(side):
        return side
    return F.broadcast(side)


def lookup_join(rows: DataFrame, dictionary: DataFrame, code: str, name: str,
                how: str = "inner") -> DataFrame:
    """Adds the dictionary name of ``code`` as ``name``; inner drops rows without a match."""
    side = checked_broadcast(dictionary.select(
        F.col("dic_code").alias("_code"), F.col("dic_name").alias(name)))
    return rows.join(side, rows[code] == F.col("_code"), how).drop("_code")


def double_lookup_join(rows: DataFrame, dictionary: DataFrame,
                       first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """Two lookups of one dictionary; each pair is a code column and its name column."""
    return lookup_join(lookup_join(rows, dictionary, *first), dictionary, *second)


def config_join(log: DataFrame, routes: DataFrame, on: Column) -> DataFrame:
    """Change log joined with the routing rows that hold now."""
    return log.join(checked_broadcast(routes), on, "inner")


def salted_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, salts: int,
                spread_by: str) -> DataFrame:
    """Inner equality join that spreads each key over ``salts`` tasks.

    Left rows take a salt from ``spread_by``, right rows are copied to every salt. A batch
    does not need this, adaptive execution splits its hot keys; a stream has no such help.
    """
    same = F.col(left_key) == F.col(right_key)
    if salts <= 1:
        return left.join(right, same, "inner")
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copied = right.withColumn("_salts", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(
        copied, same & (F.col("_salt") == F.col("_salts")), "inner").drop("_salt", "_salts")


def interval_join(left: DataFrame, right: DataFrame, on: Column, left_time: str, right_time: str,
                  lower: timedelta, upper: timedelta) -> DataFrame:
    """Pairs with ``right_time + lower <= left_time <= right_time + upper`` that meet ``on``.

    Time is cut into slots as wide as the interval. A left row lies in one slot, and a right
    row's interval touches two at most, so it is copied to those. The slot joins the
    equality keys: a hot key is spread over its slots, and rows far apart in time never meet.
    """
    def micros(delta: timedelta) -> int:
        return delta // timedelta(microseconds=1)

    low, high = micros(lower), micros(upper)
    width = max(high - low, 1)

    def slot(moment: Column) -> Column:
        # Floor division, also before 1970: pmod leaves a multiple of the width.
        return ((moment - F.pmod(moment, F.lit(width))) / F.lit(width)).cast("bigint")

    left_us = F.unix_micros(left_time)
    right_us = F.unix_micros(right_time)
    slotted = left.withColumn("_slot", slot(left_us))
    copied = right.withColumn(
        "_slots", F.explode(F.sequence(slot(right_us + F.lit(low)), slot(right_us + F.lit(high)))))
    within = (
        (F.col(left_time) >= F.col(right_time) + F.expr(f"interval {low} microseconds"))
        & (F.col(left_time) <= F.col(right_time) + F.expr(f"interval {high} microseconds")))
    return slotted.join(
        copied, on & (F.col("_slot") == F.col("_slots")) & within, "inner"
    ).drop("_slot", "_slots")
