"""Page log: repair of the new-visitor flag, and the split into outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def visit_day() -> Column:
    return F.to_date(F.timestamp_millis("ts"))


def first_visits(records: DataFrame, arrival: str) -> DataFrame:
    """Day that the first arriving record of each device leaves behind.

    A record flagged new leaves its own day, any other the day before. Only that first
    record counts. Minimum by arrival is taken before the shuffle: a hot device sends
    one row per task.
    """
    day = F.when(F.col("is_new") == "1", visit_day()).otherwise(F.date_sub(visit_day(), 1))
    return records.groupBy("mid").agg(
        F.min_by(day, F.col(arrival)).alias("first_day"),
        F.max(F.coalesce(F.col("is_new") == "1", F.lit(False))).alias("has_new"))


def clear_repeated(records: DataFrame, first: DataFrame) -> DataFrame:
    """Sets ``is_new`` to 0 on records flagged new on a later day than the first visit.

    Only records flagged new can change. The others pass without a shuffle, dirty ones among
    them, and devices that never sent the flag do not take part in the join. The device of
    the joined side is an expression, so that both sides are shuffled for the join and
    adaptive execution can split a hot device.
    """
    flagged = F.coalesce((F.col("is_new") == "1") & F.col("mid").isNotNull(), F.lit(False))
    if "dirty" in records.columns:
        flagged = flagged & ~F.col("dirty")
    side = first.where("has_new").select(
        F.concat("mid", F.lit("")).alias("_device"), "first_day")
    again = visit_day() != F.col("first_day")
    joined = records.where(flagged).join(side, F.col("mid") == F.col("_device"), "left")
    common = F.when(again, F.transform_values(
        "common", lambda k, v: F.when(k == "is_new", F.parse_json(F.lit('"0"'))).otherwise(v))
    ).otherwise(F.col("common"))
    repaired = joined.withColumn("common", common).withColumn(
        "is_new", F.when(again, F.lit("0")).otherwise(F.col("is_new")))
    return records.where(~flagged).unionByName(repaired.select(*records.columns))


def visitor_flag_repair(records: DataFrame, arrival: str) -> DataFrame:
    """Repair over a whole log; ``arrival`` is the order in which records came in.

    Dirty records, if the log still holds them, neither count nor change.
    """
    good = records.where(~F.col("dirty")) if "dirty" in records.columns else records
    return clear_repeated(records, first_visits(good, arrival))


def _record(*names: str, **renamed: Column) -> Column:
    return F.to_json(F.struct(
        *[F.col(n) for n in names], *[c.alias(n) for n, c in renamed.items()]))


def _whole(record: Column) -> Column:
    """A record's JSON text with its fields of other names."""
    rest = F.concat(F.substring(record, F.lit(1), F.length(record) - 1), F.lit(","),
                    F.substring(F.to_json("rest"), 2, 2**31 - 1))
    return F.when(F.coalesce(F.size("rest"), F.lit(0)) > 0, rest).otherwise(record)


def _or_nothing(items: Column) -> Column:
    return F.when(F.size(items) > 0, F.lit(None)).otherwise(items)


def _tagged(output: str, value: Column) -> Column:
    return F.struct(F.lit(output).alias("output"), value.alias("value"))


OUTPUTS = "array<struct<output:string,value:string>>"


def log_split(records: DataFrame) -> DataFrame:
    """Each record as its outputs, rows of ``output`` and JSON ``value``.

    A dirty record gives its text as ``dirty``. A record with an error goes to ``error`` in
    full, and on without it. With start data it is a ``start`` record. Otherwise it gives one
    ``display`` per display, one ``action`` per action (without the record's time) and one
    ``page`` record without those lists. Records that pass on whole keep fields of any name, and
    all values keep their JSON types. One pass makes all outputs; written by ``output``
    no branch is computed twice.
    """
    failed = F.col("err").isNotNull()
    started = F.col("start").isNotNull()
    single = F.filter(F.array(
        F.when(failed, _tagged("error", _whole(_record(
            "common", "page", "start", "displays", "actions", "err", "ts")))),
        F.when(started, _tagged("start", _whole(_record(
            "common", "page", "start", "displays", "actions", "ts")))),
        F.when(~started, _tagged("page", _whole(F.to_json(F.struct(
            "common", "page", _or_nothing(F.col("displays")).alias("displays"),
            _or_nothing(F.col("actions")).alias("actions"), "ts"))))),
    ), lambda o: o.isNotNull())

    def of_page(items: str, each) -> Column:
        return F.when(started | F.col(items).isNull(), F.array().cast(OUTPUTS)).otherwise(
            F.transform(items, each))

    displays = of_page("displays", lambda d: _tagged(
        "display", _record("common", "page", display=d, ts=F.col("ts"))))
    actions = of_page("actions", lambda a: _tagged(
        "action", _record("common", "page", action=a)))
    outputs = F.concat(single, displays, actions)
    if "dirty" in records.columns:
        outputs = F.when(
            F.col("dirty"), F.array(_tagged("dirty", F.col("value")))).otherwise(outputs)
    return records.select(F.inline(outputs))


def pages_only(records: DataFrame) -> DataFrame:
    return records.where(F.col("start").isNull())


def explode_displays(records: DataFrame) -> DataFrame:
    """One row per display of a page record; empty or missing lists give no row."""
    return pages_only(records).select(
        "common", "page", F.explode("displays").alias("display"), "ts")


def explode_actions(records: DataFrame) -> DataFrame:
    """One row per action of a page record, without the record's time."""
    return pages_only(records).select("common", "page", F.explode("actions").alias("action"))
