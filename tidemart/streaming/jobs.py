"""Structured Streaming jobs. Each takes streams and returns its started query or queries.

Joins and windows run as native stateful operators (state in RocksDB, checkpointed). What must
be looked up as it is now, dictionaries and routing rows, is read again in each micro-batch; routes
that know when they held (``route_history_job``) are met by each message at its own time.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemart.functions.scalars import epoch_seconds_to_timestamp
from tidemart.operators import latest, routing, traffic
from tidemart.plans import facts, warehouse
from tidemart.sinks import writers
from tidemart.sinks.dimensions import DimensionTables
from tidemart.sinks.keyed import REMOVED, KeyedTable
from tidemart.sources import page_log, table_feed, tables
from tidemart.streaming import retracting
from tidemart.schemas import ROUTE

# Reads a side table as it is now.
Snapshot = Callable[[], DataFrame]


def upsert(stream: DataFrame, table: KeyedTable, checkpoint: str,
           shape: Callable[[DataFrame, tuple[str, ...]], DataFrame] = lambda rows, keep: rows,
           mode: str = "append") -> StreamingQuery:
    """Run a stream into an upsert table, shaping each micro-batch on the way.

    Append-mode rows are ordered by their places in the log, which the shape keeps for that: a
    later batch may bring an older change. Update-mode rows already are the last of their key.
    """
    keep = facts.sequences(stream) if mode == "append" else ()

    def write(batch: DataFrame, batch_id: int) -> None:
        table.merge(shape(batch, keep), batch_id, [F.col(c) for c in keep], facts.SEQUENCES)
    return writers.start(stream, write, checkpoint, mode)


def comment_job(log: DataFrame, dictionary: Snapshot, table: KeyedTable,
                checkpoint: str) -> StreamingQuery:
    return upsert(facts.comment_rows(log), table, checkpoint,
                  lambda b, keep: facts.shape_comment(b, dictionary(), keep))


def cart_job(log: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return writers.stream_append_table(facts.dwd_cart_add(log), path, checkpoint)


def lines_job(lines: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Order lines joined with their order, to the files that the promotion job reads.

    An unbounded inner join of two streams: each side waits for the other.
    """
    return writers.stream_append_table(lines, path, checkpoint)


def promotion_job(lines: DataFrame, activity: DataFrame, coupon: DataFrame, table: KeyedTable,
                  checkpoint: str, shape: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Second half of the order-detail and cancellation facts: retracting left joins, as an
    update-mode aggregation."""
    return upsert(facts.with_promotions(lines, activity, coupon), table, checkpoint,
                  lambda b, keep: shape(b), "update")


def _timed(rows: DataFrame, ts: str, name: str, delay: str) -> DataFrame:
    return rows.withColumn(
        name, epoch_seconds_to_timestamp(F.col(ts))).withWatermark(name, delay)


def _near(name: str, ttl: timedelta) -> Column:
    gap = F.expr(f"interval {ttl // timedelta(microseconds=1)} microseconds")
    return (F.col(name) >= F.col("line_time") - gap) & (F.col(name) <= F.col("line_time") + gap)


def bounded_order_join(lines: DataFrame, orders: DataFrame, ttl: timedelta,
                       delay: str = "0 seconds") -> DataFrame:
    """Order lines joined with their order when at most ``ttl`` lies between the two.

    Both sides drop older state. The line's event time goes on as ``line_time``.
    """
    timed = _timed(orders, "order_ts", "order_time", delay)
    same = (F.col("order_id") == F.col("_order")) & _near("order_time", ttl)
    return _timed(lines, "ts", "line_time", delay).join(timed, same, "inner").drop("order_time")


def bounded_left_join(lines: DataFrame, activity: DataFrame, coupon: DataFrame,
                      ttl: timedelta, delay: str = "0 seconds") -> DataFrame:
    """Lines with activity and coupon, with state kept for ``ttl`` only.

    Parts are joined when their event times are at most ``ttl`` apart, so the engine drops
    older state. A line comes out once, when all that may still match has passed.
    """
    wide = lines if "line_time" in lines.columns else _timed(lines, "ts", "line_time", delay)
    for name, part in (("activity_time", activity), ("coupon_time", coupon)):
        timed = _timed(part, "ts", name, delay).drop("ts", "seq").withColumnRenamed(
            "order_detail_id", "_line")
        # One event-time column may remain for the next join.
        wide = wide.join(timed, (F.col("id") == F.col("_line")) & _near(name, ttl), "left"
                         ).drop("_line", name)
    return wide.drop("line_time")


def retracting_job(lines: DataFrame, activity: DataFrame, coupon: DataFrame, table: KeyedTable, checkpoint: str,
                   ttl: timedelta, shape: Callable[[DataFrame, tuple[str, ...]], DataFrame] = lambda rows, keep: rows.drop("retracts"),
                   delay: str = "0 seconds") -> StreamingQuery:
    """The retracting left joins with state for ``ttl``: lines reach the table at once, and again with each part."""
    return upsert(retracting.retracting_join(lines, activity, coupon, ttl, delay), table, checkpoint, shape)


def bounded_cancel_job(log: DataFrame, table: KeyedTable, checkpoint: str,
                       ttl: timedelta = timedelta(seconds=910)) -> StreamingQuery:
    """Cancellations in one query: three native joins, all with state for ``ttl``."""
    lines = bounded_order_join(facts.order_lines(log), facts.cancelled_orders(log), ttl)
    joined = bounded_left_join(lines, facts.activities(log), facts.coupons(log), ttl)
    return upsert(joined, table, checkpoint,
                  lambda b, keep: facts.shape_order_cancel(facts.take_order_time(b), keep))


def pay_job(log: DataFrame, order_detail: DataFrame, dictionary: Snapshot, table: KeyedTable,
            checkpoint: str, lower: timedelta = facts.PAY_LOWER,
            upper: timedelta = facts.PAY_UPPER) -> StreamingQuery:
    """Interval join of two watermarked streams; both carry ``row_time``."""
    pairs = facts.paid_lines(order_detail, facts.paid(log), lower, upper)
    return upsert(pairs, table, checkpoint, lambda b, keep: facts.shape_pay_success(
        facts.name_payment_type(b, dictionary()), keep))


def refund_job(log: DataFrame, dictionary: Snapshot, table: KeyedTable,
               checkpoint: str, salts: int = 1) -> StreamingQuery:
    return upsert(facts.refund_requests(log, salts), table, checkpoint,
                  lambda b, keep: facts.shape_order_refund(b, dictionary(), keep))


def refund_pay_job(log: DataFrame, dictionary: Snapshot, table: KeyedTable,
                   checkpoint: str, salts: int = 1) -> StreamingQuery:
    return upsert(facts.refunded_payments(log, salts), table, checkpoint,
                  lambda b, keep: facts.shape_refund_pay_success(b, dictionary(), keep))


def changes_job(feed: DataFrame, table: KeyedTable, checkpoint: str,
                sequence: str = "ts_ms") -> StreamingQuery:
    """Keep a table current from its change feed; its key columns are ``table.keys``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        writes = latest.keyed_changes(batch, table.keys, F.col(sequence))
        table.merge(writes.select("row.*", REMOVED, "seq"), batch_id, [F.col("seq")], ("seq",))
    return writers.start(feed, write, checkpoint)


def routes_job(feed: DataFrame, sink_type: str, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Keep the routing rows of one sink type current from the configuration's feed."""
    changes = tables.read_table_changes(feed, ROUTE)
    own = changes.select("op", "ts_ms", *[
        F.when(F.col(image)["sink_type"] == sink_type, F.col(image)).alias(image)
        for image in ("before", "after")])
    return changes_job(own, table, checkpoint)


def route_history_job(feed: DataFrame, sink_type: str, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Keep every change of the routing rows; ``routing.route_versions`` of the table are routes that know
    when they held. The table's keys are ``routing.HISTORY_KEYS``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table.merge(routing.route_writes(tables.read_table_changes(batch, ROUTE), sink_type), batch_id)
    return writers.start(feed, write, checkpoint)


def dim_catalog_job(feed: DataFrame, dims: DimensionTables, checkpoint: str) -> StreamingQuery:
    """Create or widen dimension tables as their routing rows come. Configuration rows are few; a micro-batch's
    are met one by one, in their order."""
    def write(batch: DataFrame, batch_id: int) -> None:
        writes = routing.route_writes(tables.read_table_changes(batch, ROUTE), routing.DIM)
        for route in writes.where("NOT ended").orderBy("seq", "sink_table").toLocalIterator():
            dims.create(route)
    return writers.start(feed, write, checkpoint)


def simple_facts_job(log: DataFrame, routes: Snapshot, path: str, checkpoint: str) -> StreamingQuery:
    """Configured facts below the directory of their destination."""
    write = writers.batches_by_destination(path, "sink_table")
    return writers.start(
        log, lambda b, n: write(warehouse.dwd_simple_facts(b, routes()), n), checkpoint)


def dim_job(log: DataFrame, routes: Snapshot, table: KeyedTable, checkpoint: str,
            apply_deletes: bool = False) -> StreamingQuery:
    """Configured dimension tables, all in one keyed table by destination and row key."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = warehouse.dim_rows(batch, routes(), apply_deletes).select(
            "sink_table", "row_key", "payload", REMOVED, "ts", "seq")
        table.merge(rows, batch_id, [F.col("seq")], ("seq",))
    return writers.start(log, write, checkpoint)


def traffic_job(raw: DataFrame, arrival: str, visits: KeyedTable, path: str,
                checkpoint: str) -> StreamingQuery:
    """Page log to its outputs. ``visits`` keeps each device's first day, by ``mid``.

    A device enters ``visits`` once, with its first record; the batch's own first records are
    found with a partial aggregation, so a hot device costs one row per task.
    """
    write = writers.batches_by_destination(path, "output")

    def each(batch: DataFrame, batch_id: int) -> None:
        parsed = page_log.parse_page_log(batch).persist()
        good, _ = page_log.split_dirty(parsed)
        first = traffic.first_visits(good, arrival)
        known = visits.rows(before=batch_id)
        if known is not None:
            earlier = known.select("mid", F.col("first_day").alias("known_day"))
            first = first.join(earlier, "mid", "left")
        else:
            first = first.withColumn("known_day", F.lit(None).cast("date"))
        first = first.persist()
        visits.merge(first.where("known_day IS NULL").select("mid", "first_day"), batch_id)
        settled = first.select(
            "mid", F.coalesce("known_day", "first_day").alias("first_day"), "has_new")
        write(traffic.log_split(traffic.clear_repeated(parsed, settled)), batch_id)
        first.unpersist()
        parsed.unpersist()

    return writers.start(raw, each, checkpoint)


def keyword_job(page_view: DataFrame, write: writers.BatchWriter, checkpoint: str) -> StreamingQuery:
    """Closed keyword windows to a writer, for instance a JDBC insert."""
    return writers.start(warehouse.dws_keyword_window(page_view), write, checkpoint)


def fine_words_job(page_view: DataFrame, dictionary: Snapshot, path: str, checkpoint: str) -> StreamingQuery:
    """Finest words of the searches with their event time, to files that the window job reads.

    Each micro-batch reads the dictionary anew; a batch that is repeated replaces its own directory.
    """
    searched = page_view.select("page", "rt")

    def write(batch: DataFrame, batch_id: int) -> None:
        warehouse.search_words(batch, dictionary()).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return writers.start(searched, write, checkpoint)


def fine_keyword_job(words: DataFrame, write: writers.BatchWriter, checkpoint: str) -> StreamingQuery:
    """Closed windows of words that another query has made; ``words`` has ``rt`` with its watermark."""
    return writers.start(warehouse.word_windows(words), write, checkpoint)


def emp_dept_job(employees: DataFrame, departments: DataFrame, path: str, checkpoint: str,
                 lower: timedelta = timedelta(milliseconds=-5),
                 upper: timedelta = timedelta(milliseconds=5)) -> StreamingQuery:
    pairs = facts.emp_dept_interval(employees, departments, lower, upper)
    return writers.stream_append_table(pairs, path, checkpoint)


def fact_stream(spark, table: KeyedTable, schema: T.StructType, delay: str = "0 seconds") -> DataFrame:
    """The changes of an upsert table as an append stream with event time.

    Each upsert is a new row, as in a compacted topic read from its start.
    """
    rows = table_feed.read_table_feed(spark, table.path, schema)
    return rows.withColumn(
        "row_time", epoch_seconds_to_timestamp(F.col("ts"))).withWatermark("row_time", delay)
