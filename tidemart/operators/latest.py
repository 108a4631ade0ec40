"""Keyed tables out of changes: the last value of a key wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key in the given order.

    The maximum is taken in each task before the shuffle, so that a hot key sends one
    row per task. ``order`` should tell all changes of a key apart, as the log's second and
    offset do. Rows that it does not are copies of one message, or carry no offset; of those a
    hash of their values chooses, so that a repeated task finds the same row.
    """
    others = [c for c in rows.columns if c not in keys]
    values = [F.array_sort(F.map_entries(f.name)) if f.dataType.typeName() == "map" else F.col(f.name)
              for f in rows.schema.fields if f.name in others and f.dataType.typeName() != "variant"]
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)],
                    F.xxhash64(F.lit(0), *values).alias("tie"))
    top = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), rank).alias("last"))
    return top.select(*[
        F.col(c) if c in keys else F.col("last")[c].alias(c) for c in rows.columns])


def one_per_key(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The last row of each key, as the unique side of a join.

    Copies of a key are gone before the join can pair them up. The key leaves as an expression,
    so the join shuffles this side again, on its own: adaptive execution splits a hot key of
    the other side only where both inputs of the join are shuffles, not an aggregate.
    """
    last = latest_per_key(rows.where(F.col(key).isNotNull()), [key], order)
    return last.withColumn(key, F.concat(F.col(key), F.lit("")))


def keyed_changes(feed: DataFrame, keys: list[str], sequence: Column) -> DataFrame:
    """Change records as keyed writes: ``row`` is the new row, or null for a removal.

    An update that moves a row to another key removes the old key as well.
    """
    def key_of(image: str) -> Column:
        return F.struct(*[F.col(image)[k].alias(k) for k in keys])

    removal = F.when(
        F.col("before").isNotNull()
        & ((F.col("op") == "d") | ~key_of("before").eqNullSafe(key_of("after"))),
        F.struct(key_of("before").alias("key"), F.lit(True).alias("removed"),
                 F.col("before").alias("row")))
    write = F.when(
        F.col("after").isNotNull() & (F.col("op") != "d"),
        F.struct(key_of("after").alias("key"), F.lit(False).alias("removed"),
                 F.col("after").alias("row")))
    return feed.select(
        sequence.alias("seq"),
        F.explode(F.filter(F.array(removal, write), lambda w: w.isNotNull())).alias("w"),
    ).select("w.key", "seq", "w.removed", "w.row")


def apply_changes(feed: DataFrame, keys: list[str], sequence: Column) -> DataFrame:
    """The table as it stands after all change records of the feed."""
    writes = keyed_changes(feed, keys, sequence)
    last = latest_per_key(writes, ["key"], [F.col("seq")])
    return last.where(~F.col("removed")).select("row.*")
