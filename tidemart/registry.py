"""Every operator as a query over the warehouse tables."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart import feeds, schemas, session
from tidemart.functions import predicates, scalars
from tidemart.operators import joins, keywords, latest, routing, traffic
from tidemart.plans import facts, warehouse
from tidemart.sinks import writers
from tidemart.sinks.dimensions import DimensionTables
from tidemart.sinks.keyed import KeyedTable
from tidemart.sources import change_log, messages, page_log, tables
from tidemart.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


# A row of the tables' columns takes about 20 bytes; as a message, and parsed, it takes many times as much. Shuffles are
# sized for that, and a task reads so much of a table at most: what it makes of it must fit its memory.
EXPANSION, TASK_BYTES = 32, 16 * 1024 * 1024


def query(function: Query, expansion: int = EXPANSION) -> Query:
    """Register under the function's name, with the session prepared for its input first."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session.size_shuffles(spark, expansion * session.input_bytes(spark, sf_dir))
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(TASK_BYTES))
        return function(session.prepare(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def stream_query(function: Query) -> Query:
    """The same for a query that goes through its input in slices: each shuffle holds one slice, and each of its
    partitions costs a state store a slice."""
    @functools.wraps(function)
    def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
        size = session.input_bytes(spark, sf_dir)
        with session.streaming(spark, size, EXPANSION * size):
            return function(spark, sf_dir)

    query(streamed, 1)
    return function


def log_of(*raw: DataFrame, typed: bool = False) -> DataFrame:
    return change_log.read_change_log(feeds.union(*raw), typed=typed)


def second_text(column: str) -> Column:
    return F.date_format(column, scalars.SECOND).alias(column)


# The routing configuration of the demonstration shop.
ROUTES = """
SELECT * FROM VALUES
  ('base_region', 'ALL', 'dim_base_region', 'dim', 'id,region_name', NULL, NULL),
  ('base_province', 'ALL', 'dim_base_province', 'dim', 'id,name,region_id,area_code', 'id', NULL),
  ('user_info', 'ALL', 'dim_user_info', 'dim', 'id,name,province_id', 'id', NULL),
  ('shop_info', 'ALL', 'dim_shop_info', 'dim', 'id,name', 'id', NULL),
  ('base_brand', 'ALL', 'dim_base_brand', 'dim', 'tm_id,tm_name', 'tm_id', NULL),
  ('user_info', 'insert', 'dwd_user_register', 'dwd', 'id,name,segment', NULL, NULL),
  ('comment_info', 'insert', 'dwd_comment', 'dwd', 'id,user_id,appraise', NULL, NULL),
  ('base_region', 'bootstrap-insert', 'dwd_region', 'dwd', 'id', NULL, NULL)
AS t(source_table, source_type, sink_table, sink_type, sink_columns, sink_pk, sink_extend)
"""


def routes(spark: SparkSession, sink_type: str) -> DataFrame:
    return tables.routes_of(spark.sql(ROUTES), sink_type)


def good_records(spark: SparkSession, d: str) -> DataFrame:
    good, _ = page_log.split_dirty(page_log.parse_page_log(feeds.page_log(spark, d)))
    return good


# Sources

@query
def read_text_stream(spark, d):
    raw = feeds.comments(spark, d)
    some = raw.select("src_table", F.when(~F.col("value").contains("5-LOW"), F.col("value")).alias("value"))
    return messages.messages(some).select("value")


@query
def read_change_log(spark, d):
    return log_of(feeds.order_updates(spark, d)).select(
        "database", "table", "type", "ts", F.col("data")["id"].alias("id"),
        F.col("data")["order_status"].alias("now"), F.col("old")["order_status"].alias("before"))


@query
def read_change_log_with_event_time(spark, d):
    log = change_log.with_event_time(log_of(feeds.order_updates(spark, d)))
    return log.select(F.col("data")["id"].alias("id"), second_text("row_time"))


@query
def read_page_view(spark, d):
    view = page_log.read_page_view(feeds.search_log(spark, d))
    return view.select(F.col("common")["mid"].alias("mid"), F.col("page")["item"].alias("item"),
                       F.col("page")["last_page_id"].alias("last_page_id"), "ts", second_text("rt"))


@query
def read_fact_stream(spark, d):
    return tables.read_fact_stream(feeds.order_line_facts(spark, d)).select(
        "id", "order_id", "sku_id", "province_id", "split_total_amount", "source_id", "ts",
        second_text("row_time"))


@query
def read_table_changes(spark, d):
    feed = tables.read_table_changes(feeds.person_changes(spark, d), schemas.PERSON)
    return feed.select(F.col("before.id").alias("before_id"), F.col("after.id").alias("after_id"),
                       F.col("after.name").alias("after_name"), "op", "ts_ms")


@query
def snapshot_changelog_table(spark, d):
    feed = tables.read_table_changes(feeds.person_changes(spark, d), schemas.PERSON)
    return latest.apply_changes(feed, ["id"], F.col("ts_ms"))


@query
def read_lookup_table(spark, d):
    return tables.read_lookup_table(
        spark, "parquet", f"{d}/supplier.parquet", code="s_suppkey", name="s_name")


@query
def read_config_table(spark, d):
    feed = tables.read_table_changes(feeds.route_changes(spark, d), schemas.ROUTE)
    config = feed.where("after IS NOT NULL").select("after.*")
    return tables.routes_of(config, routing.DIM)


@query
def read_csv_lines(spark, d):
    return tables.parse_csv_lines(feeds.employee_lines(spark, d), schemas.EMPLOYEE)


@query
def read_olap_table(spark, d):
    return tables.read_table(spark, "parquet", f"{d}/supplier.parquet").select(
        "s_suppkey", "s_name", "s_nationkey")


# Parsing, filters, projections

@query
def parse_json_with_dirty_split(spark, d):
    good, dirty = page_log.split_dirty(page_log.parse_page_log(feeds.page_log(spark, d)))
    return good.select(F.lit("main").alias("output"), "mid", "ts", F.lit(None).cast("string").alias("value")
                       ).unionByName(dirty.select(
                           F.lit("dirty").alias("output"), F.lit(None).cast("string").alias("mid"),
                           F.lit(None).cast("bigint").alias("ts"), "value"))


def _log_identity(log: DataFrame) -> DataFrame:
    return log.select("table", "type", "ts", F.col("data")["id"].alias("id"))


@query
def filter_bootstrap_markers(spark, d):
    return _log_identity(predicates.without_bootstrap_markers(log_of(feeds.dimension_rows(spark, d))))


@query
def filter_bootstrap_all(spark, d):
    return _log_identity(predicates.without_bootstrap(log_of(feeds.dimension_rows(spark, d))))


@query
def map_field_project(spark, d):
    return log_of(feeds.new_orders(spark, d)).select(
        *predicates.fields("id consignee total_amount user_id order_comment province_id"))


@query
def select_table_event(spark, d):
    log = log_of(feeds.new_orders(spark, d), feeds.order_updates(spark, d),
                 feeds.comments(spark, d))
    return _log_identity(predicates.table_events(
        log, "order_info", "update", database=feeds.DATABASE))


@query
def status_transition_filter(spark, d):
    log = log_of(feeds.new_orders(spark, d), feeds.order_updates(spark, d))
    codes = (predicates.ORDER_CANCELLED, predicates.ORDER_REFUND_REQUESTED, predicates.ORDER_REFUNDED)
    return feeds.union(*[
        predicates.status_changed_to(log, "order_info", "order_status", code).select(
            F.lit(code).alias("code"), *predicates.fields("id user_id province_id operate_time"), "ts")
        for code in codes])


PAID = "id user_id order_id payment_type callback_time payment_status"


@query
def payment_success_filter(spark, d):
    return predicates.payments(log_of(feeds.payment_updates(spark, d))).select(
        *predicates.fields(PAID), "ts")


@query
def payment_filter_any_status(spark, d):
    return predicates.payments(log_of(feeds.payment_updates(spark, d)), require_success=False).select(
        *predicates.fields(PAID), "ts")


@query
def cart_change_filter(spark, d):
    return predicates.cart_additions(log_of(feeds.cart(spark, d)), database=feeds.DATABASE).select(
        "type", *predicates.fields("id sku_num"), F.col("old")["sku_num"].alias("old_sku_num"))


@query
def search_filter(spark, d):
    view = page_log.read_page_view(feeds.search_log(spark, d))
    return predicates.searches(view).select(F.col("page")["item"].alias("item"), second_text("rt"))


@query
def column_prune_by_config(spark, d):
    routed = routing.dim_route(log_of(feeds.dimension_rows(spark, d)), routes(spark, routing.DIM))
    return routed.select(
        "sink_table", "row_key", scalars.map_to_json(F.col("payload")).alias("payload"))


@query
def remove_json_field(spark, d):
    kept = good_records(spark, d).drop("err", "displays", "actions")
    return kept.select(F.to_json(F.struct("common", "page", "start", "ts")).alias("value"))


# Scalar functions

@query
def cart_delta(spark, d):
    log = predicates.table_events(log_of(feeds.cart(spark, d)), "cart_info")
    return log.select(F.col("data")["id"].alias("id"), scalars.cart_delta(
        F.col("type"), F.col("data")["sku_num"], F.col("old")["sku_num"]).alias("sku_num"))


@query
def decimal_mul_to_string(spark, d):
    lines = facts.order_lines(log_of(feeds.order_details(spark, d)))
    return lines.select("id", "split_original_amount")


@query
def date_format_day(spark, d):
    lines = facts.order_lines(log_of(feeds.order_details(spark, d)))
    return lines.select("id", scalars.format_day(F.col("create_time")).alias("date_id"))


@query
def window_bounds_format(spark, d):
    view = page_log.read_page_view(feeds.search_log(spark, d))
    return view.select(F.window("rt", "10 seconds").alias("window"), "ts").select(
        *scalars.window_bounds(F.col("window")), "ts")


@query
def epoch_to_timestamp(spark, d):
    events = feeds.table(spark, d, "events").select(
        "event_id", F.unix_millis(feeds.instant("ts")).alias("ms"))
    seconds = scalars.epoch_seconds_to_timestamp((F.col("ms") / 1000).cast("bigint").cast("string"))
    return events.select(
        "event_id", F.date_format(seconds, scalars.SECOND).alias("from_seconds"),
        F.date_format(scalars.epoch_ms_to_timestamp(F.col("ms")), "yyyy-MM-dd HH:mm:ss.SSS").alias("from_ms"))


@query
def epoch_ms_to_date(spark, d):
    events = feeds.table(spark, d, "events").select(
        "event_id", F.unix_millis(feeds.instant("ts")).alias("ms"))
    return events.select("event_id", scalars.epoch_ms_to_date(F.col("ms")).alias("day"),
                         scalars.epoch_ms_to_datetime(F.col("ms")).alias("moment"))


@query
def date_to_epoch_ms(spark, d):
    orders = feeds.table(spark, d, "orders").select("o_orderkey", feeds.when_text("o_orderdate").alias("t"))
    return orders.select(
        "o_orderkey", scalars.date_to_epoch_ms(F.left("t", F.lit(10))).alias("day_ms"),
        scalars.date_to_epoch_ms(F.col("t"), full=True).alias("moment_ms"))


@query
def processing_stamps(spark, d):
    return feeds.table(spark, d, "events").select(
        "event_id", (scalars.write_second() > F.unix_seconds(feeds.instant("ts"))).alias("second_after"),
        (scalars.write_time() > feeds.instant("ts")).alias("time_after"))


@query
def json_to_string(spark, d):
    log = log_of(feeds.comments(spark, d))
    return log.select(scalars.map_to_json(F.col("data")).alias("value"))


@query
def string_to_json(spark, d):
    events = feeds.table(spark, d, "events")
    return events.select("event_id", scalars.json_to_map(F.col("props"))["k"].alias("k"))


@query
def route_key(spark, d):
    log = log_of(feeds.dimension_rows(spark, d))
    return log.select(F.col("data")["id"].alias("id"), scalars.route_key(F.col("table")).alias("dim_key"),
                      scalars.route_key(F.col("table"), F.col("type")).alias("fact_key"))


# Joins

@query
def lookup_join(spark, d):
    comments = predicates.table_events(log_of(feeds.comments(spark, d)), "comment_info").select(
        *predicates.fields("id appraise"))
    return joins.lookup_join(comments, feeds.dictionary(spark, d), "appraise", "appraise_name")


@query
def double_lookup_join(spark, d):
    rows = predicates.table_events(log_of(feeds.refunds(spark, d)), "order_refund_info").select(
        *predicates.fields("id refund_type refund_reason_type"))
    return joins.double_lookup_join(rows, feeds.dictionary(spark, d), ("refund_type", "type_name"),
                                    ("refund_reason_type", "reason_name"))


@query
def stream_inner_join(spark, d):
    log = log_of(feeds.order_details(spark, d), feeds.new_orders(spark, d))
    return facts.placed_lines(log).select("id", "order_id", "sku_id", "user_id", "total_amount")


@query
def multi_key_join(spark, d):
    log = log_of(feeds.refund_payments(spark, d), feeds.refunds(spark, d))
    paid = predicates.table_events(log, "refund_payment").select(
        *predicates.fields("id order_id sku_id"))
    return facts.join_requests(paid, facts.last_requests(log)).drop("request_seq")


@query
def stream_left_join_retracting(spark, d):
    log = log_of(feeds.order_details(spark, d), feeds.detail_activities(spark, d),
                 feeds.detail_coupons(spark, d))
    wide = facts.with_promotions(
        facts.order_lines(log).select("id", "sku_id", "seq"), facts.activities(log), facts.coupons(log))
    return wide.select("id", "sku_id", "activity_id", "activity_rule_id", "coupon_id", "coupon_use_id")


def _payment_log(spark, d):
    return change_log.with_event_time(log_of(feeds.payment_updates(spark, d)))


def _order_line_facts(spark, d):
    return tables.read_fact_stream(feeds.order_line_facts(spark, d))


@query
def interval_join(spark, d):
    paid = predicates.payments(_payment_log(spark, d)).select(
        F.col("data")["id"].alias("payment_id"), F.col("data")["order_id"].alias("pay_order_id"),
        F.col("row_time").alias("pay_time"))
    pairs = joins.interval_join(
        _order_line_facts(spark, d), paid, F.col("order_id") == F.col("pay_order_id"),
        "row_time", "pay_time", facts.PAY_LOWER, facts.PAY_UPPER)
    return pairs.select("id", "order_id", "payment_id", second_text("row_time"), second_text("pay_time"))


def _employees(spark, d):
    rows = tables.parse_csv_lines(feeds.employee_lines(spark, d), schemas.EMPLOYEE)
    return tables.with_event_ms(rows)


def _departments(spark, d):
    rows = tables.parse_csv_lines(feeds.department_lines(spark, d), schemas.DEPARTMENT)
    return tables.with_event_ms(rows)


@query
def interval_join_symmetric(spark, d):
    hour = timedelta(hours=1)
    pairs = facts.emp_dept_interval(_employees(spark, d), _departments(spark, d), -hour, hour)
    return pairs.select("empno", "deptno", "dname", (F.col("dept_ts") - F.col("ts")).alias("gap_ms"))


@query
def config_broadcast_join(spark, d):
    log = log_of(feeds.dimension_rows(spark, d))
    joined = joins.config_join(
        log, routes(spark, routing.DIM), F.col("table") == F.col("source_table"))
    return joined.select("table", "type", F.col("data")["id"].alias("id"), "sink_table", "sink_columns")


# Aggregations, windows, state

@query
def keyword_tumbling_count(spark, d):
    words = warehouse.search_words(page_log.read_page_view(feeds.search_log(spark, d)))
    return keywords.keyword_tumbling_count(words)


@query
def visitor_flag_repair(spark, d):
    repaired = traffic.visitor_flag_repair(good_records(spark, d), "arrival")
    return repaired.select("arrival", "mid", "is_new", F.col("common")["is_new"].cast("string").alias("common_is_new"), "ts")


@query
def log_split(spark, d):
    return traffic.log_split(good_records(spark, d))


@query
def explode_displays(spark, d):
    return traffic.explode_displays(good_records(spark, d)).select(
        F.col("common")["mid"].cast("string").alias("mid"), F.col("page")["page_id"].cast("string").alias("page_id"),
        F.col("display")["item"].cast("string").alias("item"), F.col("display")["pos_seq"].cast("string").alias("pos_seq"), "ts")


@query
def explode_actions(spark, d):
    return traffic.explode_actions(good_records(spark, d)).select(
        F.col("common")["mid"].cast("string").alias("mid"), F.col("page")["page_id"].cast("string").alias("page_id"),
        F.col("action")["action_id"].cast("string").alias("action_id"), F.col("action")["item"].cast("string").alias("item"),
        F.col("action")["ts"].cast("string").alias("action_ts"))


@query
def apply_config_changes(spark, d):
    return warehouse.current_routes(feeds.route_changes(spark, d), routing.DIM)


@query
def dim_route(spark, d):
    rows = warehouse.dim_rows(log_of(feeds.dimension_rows(spark, d)), routes(spark, routing.DIM))
    return rows.select("sink_table", "row_key", "operation",
                       scalars.map_to_json(F.col("payload")).alias("payload"), "ts")


@query
def fact_route(spark, d):
    log = predicates.without_bootstrap(log_of(feeds.dimension_rows(spark, d), feeds.comments(spark, d), typed=True))
    return routing.fact_route(log, routes(spark, routing.FACT)).select(
        "sink_table", scalars.map_to_json(F.col("payload")).alias("payload"), "ts")


# Fact and dimension jobs

@query
def dwd_traffic_log(spark, d):
    # Landed in columns, so that the three passes of the job parse the text once.
    path = session.shared_dir(spark, "page_log")
    page_log.land_page_log(feeds.page_log(spark, d), path)
    return warehouse.dwd_traffic_log(spark.read.parquet(path), "arrival")


@query
def dwd_comment_info(spark, d):
    return facts.dwd_comment_info(log_of(feeds.comments(spark, d)), feeds.dictionary(spark, d))


@query
def dwd_cart_add(spark, d):
    return facts.dwd_cart_add(log_of(feeds.cart(spark, d)), database=feeds.DATABASE)


def trade_log(spark, d):
    return log_of(feeds.order_details(spark, d), feeds.new_orders(spark, d),
                  feeds.order_changes(spark, d), feeds.detail_activities(spark, d),
                  feeds.detail_coupons(spark, d))


# Slices of the keys that large batch facts go through, each with shuffles of its own.
KEY_SLICES = 6


@query
def dwd_order_detail(spark, d):
    return facts.dwd_order_detail(trade_log(spark, d), feeds.dictionary(spark, d), feeds.DATABASE, KEY_SLICES)


@query
def dwd_order_cancel(spark, d):
    return facts.dwd_order_cancel(trade_log(spark, d))


@query
def landed_log(spark, d):
    """Cancelled lines from a mixed log that was landed by table."""
    path = session.shared_dir(spark, "log")
    raw = feeds.union(feeds.order_details(spark, d), feeds.order_changes(spark, d), feeds.comments(spark, d),
                      feeds.detail_activities(spark, d), feeds.detail_coupons(spark, d))
    change_log.land_change_log(raw.select("value"), path)
    return facts.dwd_order_cancel(change_log.read_landed_log(spark, path), number=KEY_SLICES)


@query
def dwd_pay_success(spark, d):
    fact = facts.dwd_pay_success(
        _payment_log(spark, d), _order_line_facts(spark, d), feeds.dictionary(spark, d))
    return facts.last_payment(fact)


@query
def dwd_pay_any_status_day(spark, d):
    """The variant without the status test, over a day instead of a quarter of an hour."""
    fact = facts.dwd_pay_success(
        _payment_log(spark, d), _order_line_facts(spark, d), feeds.dictionary(spark, d),
        require_success=False, lower=timedelta(days=-1))
    return facts.last_payment(fact)


@query
def dwd_order_refund(spark, d):
    log = log_of(feeds.refunds(spark, d), feeds.new_orders(spark, d), feeds.order_changes(spark, d))
    return facts.dwd_order_refund(log, feeds.dictionary(spark, d)).drop(*facts.VOLATILE)


@query
def dwd_refund_pay_success(spark, d):
    log = log_of(feeds.refund_payments(spark, d), feeds.refunds(spark, d),
                 feeds.order_changes(spark, d))
    return facts.dwd_refund_pay_success(log, feeds.dictionary(spark, d)).drop(*facts.VOLATILE)


@query
def dwd_simple_facts(spark, d):
    log = log_of(feeds.dimension_rows(spark, d), feeds.comments(spark, d), typed=True)
    return warehouse.dwd_simple_facts(log, routes(spark, routing.FACT))


@query
def dim_tables(spark, d):
    rows = warehouse.dim_tables(log_of(feeds.dimension_rows(spark, d)), routes(spark, routing.DIM))
    return rows.select("sink_table", "row_key", scalars.map_to_json(F.col("payload")).alias("payload"))


@query
def dws_keyword_window(spark, d):
    return warehouse.dws_keyword_window(page_log.read_page_view(feeds.search_log(spark, d))).drop("ts")


@query
def emp_dept_interval(spark, d):
    minutes = timedelta(minutes=30)
    return facts.emp_dept_interval(_employees(spark, d), _departments(spark, d), -minutes, minutes)


# Keyed tables and words

@query
def upsert_by_key(spark, d):
    """Three batches of events, the newest first, into one keyed table; read at the end."""
    events = feeds.table(spark, d, "events").select(
        "user_id", "event_id", "event_type", feeds.money("value").alias("value"), "ts")
    table = KeyedTable(spark, session.shared_dir(spark, "upsert"), ["user_id"])
    day = F.coalesce(F.dayofmonth("ts"), F.lit(0))
    for number, part in enumerate((day > 20, (day > 10) & (day <= 20), day <= 10)):
        table.merge(events.where(part).drop("ts"), number, [F.col("event_id")])
    return table.read()


@query
def keyword_split(spark, d):
    turns = feeds.table(spark, d, "conversations").select("conv_id", "turn", "text")
    return keywords.keyword_split(turns, "text")


@query
def keyword_dictionary_match(spark, d):
    """Words of the answers, wherever they stand in what the user says."""
    turns = feeds.table(spark, d, "conversations")
    said = turns.where("role = 'user'").select("conv_id", "turn", "text")
    heard = turns.where("role <> 'user'").select("text")
    words = keywords.keyword_split(heard, "text").distinct()
    # Stored, so that measuring the dictionary does not make it a second time.
    path = session.shared_dir(spark, "dictionary")
    words.write.parquet(path)
    return keywords.keyword_dictionary_match(said, "text", spark.read.parquet(path))


@query
def keyword_finest(spark, d):
    """Finest words of what the user says, by the words of the answers."""
    turns = feeds.table(spark, d, "conversations")
    said = turns.where("role = 'user'").select("conv_id", "turn", "text")
    words = keywords.keyword_split(turns.where("role <> 'user'").select("text"), "text").distinct()
    path = session.shared_dir(spark, "dictionary")
    words.write.parquet(path)
    return keywords.keyword_finest(said, "text", spark.read.parquet(path))


# Sinks: written below the shared folder and read back

@query
def write_topic(spark, d):
    path = session.shared_dir(spark, "topic")
    writers.write_text_topic(feeds.comments(spark, d), path)
    return messages.read_text(spark, path)


@query
def write_by_destination(spark, d):
    path = session.shared_dir(spark, "destinations")
    log = log_of(feeds.dimension_rows(spark, d), feeds.comments(spark, d), typed=True)
    writers.write_by_destination(
        warehouse.dwd_simple_facts(log, routes(spark, routing.FACT)), path)
    return spark.read.text(path).select("sink_table", "value")


@query
def write_append_table(spark, d):
    path = session.shared_dir(spark, "append")
    log = log_of(feeds.cart(spark, d))
    writers.write_append_table(facts.dwd_cart_add(log, database=feeds.DATABASE), path)
    return spark.read.parquet(path)


def _users(spark):
    return routes(spark, routing.DIM).where("source_table = 'user_info'")


@query
def create_dim_if_absent(spark, d):
    """The dimension table of the users: created twice, then filled."""
    path = session.shared_dir(spark, "dims")
    route = _users(spark).first()
    for _ in range(2):
        home = writers.create_dim_if_absent(
            spark, path, route.sink_table, route.sink_columns, route.sink_pk, route.sink_extend)
    rows = warehouse.dim_tables(log_of(feeds.dimension_rows(spark, d)), _users(spark))
    writers.write_append_table(
        writers.dim_table(rows, route.sink_table, route.sink_columns), home)
    return spark.read.parquet(home)


@query
def upsert_dim(spark, d):
    """Dimension rows merged twice, and read back from every destination."""
    table = KeyedTable(spark, session.shared_dir(spark, "dims"), ["sink_table", "row_key"])
    rows = warehouse.dim_rows(log_of(feeds.dimension_rows(spark, d)), routes(spark, routing.DIM))
    for batch in range(2):
        table.merge(rows.select("sink_table", "row_key", "payload", "removed", "ts", "seq"), batch,
                    [F.col("seq")], ("seq",))
    return table.read().select(
        "sink_table", "row_key", scalars.map_to_json(F.col("payload")).alias("payload"))


@query
def write_olap_json(spark, d):
    path = session.shared_dir(spark, "olap")
    view = page_log.read_page_view(feeds.search_log(spark, d))
    writers.write_olap_json(warehouse.dws_keyword_window(view), path)
    return spark.read.schema(schemas.KEYWORD_WINDOW).json(path).drop("ts")


# Streams: the whole input through a started query, the result read back

class Folders:
    """Folders below the shared one that nothing reads once the streams over them have ended."""

    def __init__(self, spark: SparkSession):
        self.spark, self.made = spark, []

    def new(self, purpose: str) -> str:
        self.made.append(session.shared_dir(self.spark, purpose))
        return self.made[-1]

    def remove(self) -> None:
        while self.made:
            session.remove(self.spark, self.made.pop())


def landed(spark: SparkSession, raw: DataFrame, purpose: str, used: Folders | None = None) -> str:
    """Raw messages as files below the shared folder, for a stream to read."""
    path = used.new(purpose) if used else session.shared_dir(spark, purpose)
    raw.write.parquet(path)
    return path


# Files that a micro-batch takes at least, and the bytes that it takes at most. An ordered input is cut into files of a
# sixteenth of that, and into four slices at least.
FILES, SLICES, SLICE_BYTES = 4, 4, 256 * 1024 * 1024
FILE_BYTES = SLICE_BYTES // 16
BOUNDED = {"maxFilesPerTrigger": str(FILES)}
# Bytes of a message on disk for each byte of the tables that it is made of.
LANDED = 8


def bounded(files: int, size: int, most: int = SLICE_BYTES) -> dict[str, str]:
    """Reader options that cut files of a size into ``SLICES`` micro-batches or more, of so many bytes at most, but not
    into less than ``FILES``."""
    return {"maxFilesPerTrigger": str(max(FILES, min(files // SLICES, files * most // max(size, 1))))}


# A landed message is deleted when the micro-batch that has read it is committed. Such a topic has one reader.
READ_ONCE = {"cleanSource": "delete"}


def stored_stream(spark: SparkSession, path: str, schema, **options: str) -> DataFrame:
    """Stored rows, in no order, as a stream. Bounded micro-batches may be larger than those of an ordered
    stream, because each of them writes state anew that all of the input has left."""
    files = spark.read.schema(schema).parquet(path).inputFiles()
    limit = bounded(len(files), session.input_bytes(spark, path), 4 * SLICE_BYTES)
    return spark.readStream.schema(schema).options(**limit, **options).parquet(path)


def stream_of(spark: SparkSession, raw: DataFrame, purpose: str, used: Folders | None = None, **options: str) -> DataFrame:
    """Raw messages, landed in no order, as a stream; with ``used`` they are deleted as they are read."""
    path = landed(spark, raw, purpose, used)
    if options:
        return stored_stream(spark, path, raw.schema, **(READ_ONCE if used else {}))
    return spark.readStream.schema(raw.schema).parquet(path)


def ordered_stream(spark: SparkSession, raw: DataFrame, purpose: str, place: Column,
                   last: DataFrame | None = None, used: Folders | None = None) -> DataFrame:
    """Raw messages as a stream that meets them in order, a slice of them in each micro-batch; with ``used`` they are
    deleted as they are read.

    The messages are dealt by ranges of ``place`` and landed once: each file holds what comes after all of the
    file before, so that a micro-batch may begin with any of them. Messages without a place come first. ``last`` are
    messages that end the input.
    """
    path = used.new(purpose) if used else session.shared_dir(spark, purpose)
    size = LANDED * sum(session.input_bytes(spark, f) for f in raw.inputFiles())
    count = max(FILES * SLICES, -(-size // FILE_BYTES))
    raw.withColumn("_place", place).repartitionByRange(count, F.col("_place").asc_nulls_first()).drop(
        "_place").write.parquet(path)
    session.in_name_order(spark, path)
    if last is not None:
        last.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(raw.schema).options(**bounded(count, size), **(READ_ONCE if used else {})).parquet(path)


def json_number(path: str) -> Column:
    return F.get_json_object("value", path).cast("double")


def messages_of(spark: SparkSession, schema, *texts: str) -> DataFrame:
    """Message texts as rows of a raw feed; other columns are null."""
    row = [F.col("value").cast("string") if n == "value" else F.lit(None).alias(n) for n in schema.fieldNames()]
    return spark.createDataFrame([(t,) for t in texts], "value string").select(*row).to(schema)


def finish(started, used: Folders | None = None) -> None:
    """Wait for the end of a stream, and delete what only that has used."""
    started.awaitTermination()
    if used:
        used.remove()


@stream_query
def stream_read_text(spark, d):
    topic = session.shared_dir(spark, "in")
    writers.write_text_topic(feeds.comments(spark, d).repartition(2 * FILES), topic)
    out = session.shared_dir(spark, "out")
    finish(writers.stream_text_topic(
        messages.read_text_stream(spark, topic, **BOUNDED), out, session.shared_dir(spark, "ck")))
    return messages.read_text(spark, out)


def _lines_then_promotions(spark, d, placed: DataFrame, lines_of: Callable[[DataFrame], DataFrame],
                           shape: Callable[[DataFrame], DataFrame]) -> KeyedTable:
    """Order lines by two native joins: inner with the order, retracting left with the rest. Each query has a topic of its
    own, and what the first has used is gone before the second lands its messages."""
    used, stored = Folders(spark), Folders(spark)
    lines, path = lines_of(change_log.read_change_log(stream_of(spark, placed, "in", used, **BOUNDED))), stored.new("lines")
    finish(jobs.lines_job(lines, path, used.new("ck")), used)
    parts = feeds.union(feeds.detail_activities(spark, d), feeds.detail_coupons(spark, d))
    log = change_log.read_change_log(stream_of(spark, parts, "in", stored, **BOUNDED))
    table = KeyedTable(spark, session.shared_dir(spark, "fact"), ["id"])
    finish(jobs.promotion_job(stored_stream(spark, path, lines.schema), facts.activities(log), facts.coupons(log), table,
                              stored.new("ck"), shape), stored)
    return table


@stream_query
def stream_order_detail(spark, d):
    """Order lines with their order as it was placed, activity and coupon."""
    placed = feeds.union(feeds.order_details(spark, d), feeds.new_orders(spark, d))
    return _lines_then_promotions(spark, d, placed, facts.placed_lines,
                                  lambda b: facts.shape_order_detail(b, feeds.dictionary(spark, d))).read()


@stream_query
def stream_order_cancel(spark, d):
    """Lines of cancelled orders; an order changes twice within a second."""
    placed = feeds.union(feeds.order_details(spark, d), feeds.order_changes(spark, d))
    return _lines_then_promotions(spark, d, placed, facts.cancelled_lines, facts.shape_order_cancel).read()


@stream_query
def state_ttl(spark, d):
    """Lines with the state of the left joins kept for 910 seconds, over a log in order."""
    raw = feeds.union(feeds.order_details(spark, d),
                      feeds.detail_activities(spark, d), feeds.detail_coupons(spark, d))
    used = Folders(spark)
    # With the table's name beside its message, each of the three parses its own messages only.
    log = change_log.read_change_log(ordered_stream(spark, raw, "in", json_number("$.ts"), used=used))
    table = KeyedTable(spark, session.shared_dir(spark, "fact"), ["id"])
    lines = facts.order_lines(log).select("id", "sku_id", "ts", "seq")
    finish(jobs.retracting_job(
        lines, facts.activities(log), facts.coupons(log), table,
        used.new("ck"), timedelta(seconds=910)), used)
    return table.read().select("id", "activity_id", "coupon_id")


@stream_query
def watermark_bounded(spark, d):
    """Keyword windows that a watermark of two seconds has closed; a last search far in the
    future closes them all."""
    raw = feeds.search_log(spark, d)
    end = ('{"common":{},"page":{"item":"end","item_type":"keyword","last_page_id":"search"},'
           '"ts":4000000000000}')
    view = page_log.read_page_view(ordered_stream(
        spark, raw, "in", json_number("$.ts"), last=messages_of(spark, raw.schema, end)))
    out = session.shared_dir(spark, "out")
    finish(jobs.keyword_job(
        view, lambda b, n: b.write.mode("overwrite").parquet(f"{out}/batch={n}"),
        session.shared_dir(spark, "ck")))
    return spark.read.parquet(out).drop("batch", "ts")


@stream_query
def watermark_monotonous(spark, d):
    """The interval join of two streams whose watermarks follow without delay."""
    emps, depts = feeds.employee_lines(spark, d), feeds.department_lines(spark, d)
    place = F.element_at(F.split("value", ","), -1).cast("double")

    def lines(raw: DataFrame, schema) -> DataFrame:
        return tables.with_event_ms(tables.parse_csv_lines(
            ordered_stream(spark, raw, "in", place), schema))

    out = session.shared_dir(spark, "out")
    minutes = timedelta(minutes=30)
    finish(jobs.emp_dept_job(
        lines(emps, schemas.EMPLOYEE), lines(depts, schemas.DEPARTMENT),
        out, session.shared_dir(spark, "ck"), -minutes, minutes))
    return spark.read.parquet(out)


@stream_query
def stream_traffic_log(spark, d):
    visits = KeyedTable(spark, session.shared_dir(spark, "visits"), ["mid"])
    out = session.shared_dir(spark, "out")
    raw = feeds.page_log(spark, d)
    finish(jobs.traffic_job(
        ordered_stream(spark, raw, "in", F.col("arrival").cast("double")), "arrival", visits,
        out, session.shared_dir(spark, "ck")))
    return spark.read.text(out).select("output", "value")


@stream_query
def stream_pay_success(spark, d):
    """Order lines kept in an upsert table by four batches and compacted twice; then its changes, as a
    stream, meet the payments."""
    lines = KeyedTable(spark, session.shared_dir(spark, "lines"), ["id"], compact_every=2)
    rows = _order_line_facts(spark, d).drop("row_time")
    for number in range(4):
        lines.merge(rows.where(F.pmod(F.xxhash64("id"), F.lit(4)) == number), number)
    raw = feeds.payment_updates(spark, d)
    log = change_log.with_event_time(change_log.read_change_log(ordered_stream(spark, raw, "in", json_number("$.ts"))))
    table = KeyedTable(spark, session.shared_dir(spark, "fact"), ["order_detail_id"])
    finish(jobs.pay_job(log, jobs.fact_stream(spark, lines, schemas.ORDER_LINE_FACT),
                        lambda: feeds.dictionary(spark, d), table, session.shared_dir(spark, "ck")))
    return table.read()


@stream_query
def stream_refund(spark, d):
    """Refund requests; the order they are joined with changes twice within a second."""
    raw = feeds.union(feeds.refunds(spark, d), feeds.order_changes(spark, d))
    used = Folders(spark)
    table = KeyedTable(spark, session.shared_dir(spark, "fact"), ["id"])
    finish(jobs.refund_job(change_log.read_change_log(stream_of(spark, raw, "in", used, **BOUNDED)),
                           lambda: feeds.dictionary(spark, d), table, used.new("ck")), used)
    return table.read().drop(*facts.VOLATILE)


@stream_query
def stream_refund_pay(spark, d):
    raw = feeds.union(feeds.refund_payments(spark, d), feeds.refunds(spark, d),
                      feeds.order_changes(spark, d))
    used = Folders(spark)
    table = KeyedTable(spark, session.shared_dir(spark, "fact"), ["id"])
    finish(jobs.refund_pay_job(
        change_log.read_change_log(stream_of(spark, raw, "in", used, **BOUNDED)),
        lambda: feeds.dictionary(spark, d), table, used.new("ck")), used)
    return table.read().drop(*facts.VOLATILE)


@stream_query
def stream_comment_info(spark, d):
    table = KeyedTable(spark, session.shared_dir(spark, "fact"), ["id"])
    finish(jobs.comment_job(
        change_log.read_change_log(stream_of(spark, feeds.comments(spark, d), "in", **BOUNDED)),
        lambda: feeds.dictionary(spark, d), table, session.shared_dir(spark, "ck")))
    return table.read()


@stream_query
def stream_changes(spark, d):
    """A table kept current from its change feed, whose files come in no order."""
    feed = tables.read_table_changes(
        stream_of(spark, feeds.person_changes(spark, d).repartition(2 * FILES), "in", **BOUNDED), schemas.PERSON)
    table = KeyedTable(spark, session.shared_dir(spark, "people"), ["id"])
    finish(jobs.changes_job(feed, table, session.shared_dir(spark, "ck")))
    return table.read()


@stream_query
def stream_dims(spark, d):
    """All dimension tables kept current, many changes of a key within a second."""
    table = KeyedTable(spark, session.shared_dir(spark, "dims"), ["sink_table", "row_key"])
    finish(jobs.dim_job(
        change_log.read_change_log(stream_of(spark, feeds.dimension_rows(spark, d), "in", **BOUNDED)),
        lambda: routes(spark, routing.DIM), table, session.shared_dir(spark, "ck")))
    return table.read().select(
        "sink_table", "row_key", scalars.map_to_json(F.col("payload")).alias("payload"))


def _route_feed(spark, d):
    """The configuration's change feed: its first read; half-way through the customers' log their table gets
    another destination and more columns; half-way through the shops' log their route is deleted."""
    known = spark.sql(ROUTES).where("sink_type = 'dim'")
    row = F.struct(*known.columns)

    def half(name: str, column: str) -> int:
        return 1_700_000_000 + feeds.table(spark, d, name).agg(F.max(column)).first()[0] // 2

    def record(rows, op, at, before=None, after=None):
        empty = F.lit(None).cast(rows.select(row.alias("r")).schema["r"].dataType)
        return rows.select(F.to_json(F.struct(
            (empty if before is None else before).alias("before"), (empty if after is None else after).alias("after"),
            F.lit(op).alias("op"), F.lit(at * 1000).alias("ts_ms"))).alias("value"))

    users, shops = known.where("source_table = 'user_info'"), known.where("source_table = 'shop_info'")
    new = F.struct(*(F.lit({"sink_table": "dim_user_new", "sink_columns": "id,name,province_id,segment"}[c]).alias(c)
                     if c in ("sink_table", "sink_columns") else F.col(c) for c in known.columns))
    return (record(known, "r", 1_800_000_000, after=row)
            .unionByName(record(users, "u", half("customer", "c_custkey"), before=row, after=new))
            .unionByName(record(shops, "d", half("supplier", "s_suppkey"), before=row)))


@stream_query
def stream_dims_as_of(spark, d):
    """Dimension rows under the routes of their own time, though all changes of the routes came before."""
    history = KeyedTable(spark, session.shared_dir(spark, "routes"), routing.HISTORY_KEYS)
    feed = stream_of(spark, _route_feed(spark, d), "feed")
    finish(jobs.route_history_job(feed, routing.DIM, history, session.shared_dir(spark, "ck")))
    table = KeyedTable(spark, session.shared_dir(spark, "dims"), ["sink_table", "row_key"])
    finish(jobs.dim_job(
        change_log.read_change_log(stream_of(spark, feeds.dimension_rows(spark, d), "in", **BOUNDED)),
        lambda: routing.route_versions(history.read(), routing.DIM), table, session.shared_dir(spark, "ck")))
    return table.read().select(
        "sink_table", "row_key", scalars.map_to_json(F.col("payload")).alias("payload"))


@stream_query
def stream_dim_catalog(spark, d):
    """Dimension tables that a stream of routing rows creates, filled under the routes of each message's time: their
    columns, rows, and rows with a value in the last column."""
    dims = DimensionTables(spark, session.shared_dir(spark, "dims"))
    history = KeyedTable(spark, session.shared_dir(spark, "routes"), routing.HISTORY_KEYS)
    feed = _route_feed(spark, d)
    finish(jobs.dim_catalog_job(stream_of(spark, feed, "feed"), dims, session.shared_dir(spark, "ck")))
    finish(jobs.route_history_job(stream_of(spark, feed, "feed"), routing.DIM, history, session.shared_dir(spark, "ck")))
    finish(jobs.dim_job(
        change_log.read_change_log(stream_of(spark, feeds.dimension_rows(spark, d), "in", **BOUNDED)),
        lambda: routing.route_versions(history.read(), routing.DIM), dims.rows, session.shared_dir(spark, "ck")))

    def described(name: str) -> DataFrame:
        rows = dims.read(name)
        return rows.agg(F.lit(name).alias("sink_table"), F.lit(",".join(rows.columns)).alias("columns"),
                        F.count("*").alias("n_rows"), F.count(rows.columns[-1]).alias("n_last"))

    parts = [described(name) for name in dims.tables()]
    return functools.reduce(DataFrame.unionByName, parts)


@stream_query
def stream_routes(spark, d):
    """Routing rows kept current; the files of the feed come in no order."""
    table = KeyedTable(spark, session.shared_dir(spark, "routes"), ["source_table"])
    feed = stream_of(spark, feeds.route_changes(spark, d).repartition(2 * FILES), "in", **BOUNDED)
    finish(jobs.routes_job(feed, routing.DIM, table, session.shared_dir(spark, "ck")))
    return table.read()
