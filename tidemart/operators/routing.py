"""Routing of change-log rows by a live configuration table.

Routes are rows that hold always, or versions that say when each has held: then a message meets the
routes of its own time, whenever it is processed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions import scalars
from tidemart.operators import joins, latest
from tidemart.schemas import ROUTE

DIM = "dim"
FACT = "dwd"


def _key_columns(sink_type: str) -> list[str]:
    return ["source_table"] if sink_type == DIM else ["source_table", "source_type"]


def apply_config_changes(feed: DataFrame, sink_type: str, sequence: Column) -> DataFrame:
    """Routing rows of one sink type after all change records.

    A row that leaves the sink type, or changes its key, leaves its old key too.
    """
    def mine(image: str) -> Column:
        return F.when(F.col(image)["sink_type"] == sink_type, F.col(image))

    own = feed.select("op", mine("before").alias("before"), mine("after").alias("after"),
                      sequence.alias("seq"))
    table = latest.apply_changes(own, _key_columns(sink_type), F.col("seq"))
    return table.select(*ROUTE.fieldNames())


# Where a routing row holds from, and up to, in milliseconds; null is without end.
VALID = ("valid_from", "valid_to")
HISTORY_KEYS = ["source_table", "source_type", "seq", "ended"]


def route_writes(feed: DataFrame, sink_type: str) -> DataFrame:
    """Each change of routing rows of one sink type: the key, the row, ``seq`` and whether it ended the key.

    Rows of the feed's first read (operation ``r``) have held since ever: their ``seq`` is 0.
    """
    def mine(image: str) -> Column:
        return F.when(F.col(image)["sink_type"] == sink_type, F.col(image))

    keys = _key_columns(sink_type)
    own = feed.select("op", mine("before").alias("before"), mine("after").alias("after"),
                      F.when(F.col("op") == "r", 0).otherwise(F.col("ts_ms")).alias("seq"))
    writes = latest.keyed_changes(own, keys, F.col("seq"))
    rest = [c for c in ROUTE.fieldNames() if c not in keys]
    return writes.select(*(F.col("key")[c].alias(c) for c in keys), *(F.col("row")[c].alias(c) for c in rest),
                         "seq", F.col("removed").alias("ended"))


def route_versions(writes: DataFrame, sink_type: str) -> DataFrame:
    """Routing rows with the time each has held (``VALID``), out of all their changes.

    Of several changes of a key in one millisecond one counts, a new row before an end.
    """
    keys = _key_columns(sink_type)
    single = latest.latest_per_key(writes, [*keys, "seq"], [~F.col("ended")])
    until = F.lead("seq").over(Window.partitionBy(*keys).orderBy("seq"))
    held = single.withColumn("valid_to", until).where(~F.col("ended"))
    return held.select(*ROUTE.fieldNames(), F.col("seq").alias("valid_from"), "valid_to")


def _held(routes: DataFrame) -> tuple[list[str], Column]:
    """The columns of routes that say when they hold, and whether they hold for a message.

    A message has its second only; a change within that second counts as made before it. Routes
    without versions hold always, and a message without a time meets those only that still hold.
    """
    if VALID[0] not in routes.columns:
        return [], F.lit(True)
    at = F.col("ts").try_cast("bigint") * 1000 + 999
    holds = (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
    return list(VALID), F.coalesce(holds, at.isNull() & F.col("valid_to").isNull())


def dim_route(log: DataFrame, routes: DataFrame, apply_deletes: bool = False) -> DataFrame:
    """Rows of configured dimension tables: pruned payload, destination, operation.

    Any operation passes, a deletion too, which is then written like an update; with
    ``apply_deletes`` the row is marked as removed instead.
    """
    validity, holds = _held(routes)
    config = routes.select(
        F.col("source_table").alias("_table"), "sink_table", "sink_columns",
        F.coalesce("sink_pk", F.lit("id")).alias("sink_pk"), *validity)
    routed = joins.config_join(log, config, (F.col("table") == F.col("_table")) & holds)
    removed = (F.col("type") == "delete") if apply_deletes else F.lit(False)
    return routed.select(
        "sink_table",
        F.col("data")[F.col("sink_pk")].alias("row_key"),
        F.col("type").alias("operation"),
        scalars.keep_listed(F.col("data"), F.col("sink_columns")).alias("payload"),
        removed.alias("removed"),
        F.col("ts").try_cast("bigint").alias("ts"), "seq")


def fact_route(log: DataFrame, routes: DataFrame) -> DataFrame:
    """Rows of configured facts, keyed by table and operation: pruned payload and ``ts``.

    The payload keeps its JSON types where the log has them (``typed``).
    """
    validity, holds = _held(routes)
    config = routes.select(
        F.col("source_table").alias("_table"), F.col("source_type").alias("_type"),
        "sink_table", "sink_columns", *validity)
    routed = joins.config_join(
        log, config, (F.col("table") == F.col("_table")) & (F.col("type") == F.col("_type")) & holds)
    return routed.select(
        "sink_table",
        scalars.keep_listed(F.col("typed" if "typed" in log.columns else "data"), F.col("sink_columns")).alias("payload"),
        F.col("ts").try_cast("bigint").alias("ts"))


def fact_message(routed: DataFrame) -> DataFrame:
    """Destination and JSON text of routed facts: the payload's columns and ``ts``, a number."""
    columns = F.transform_values(F.map_filter("payload", lambda k, v: k != "ts"), lambda k, v: v.cast("variant"))
    body = F.map_concat(
        F.map_filter(columns, lambda k, v: v.isNotNull() & ~F.is_variant_null(v)),
        F.when(F.col("ts").isNotNull(), F.create_map(F.lit("ts"), F.col("ts").cast("variant")))
        .otherwise(F.create_map().cast("map<string,variant>")))
    return routed.select("sink_table", F.to_json(body).alias("value"))
