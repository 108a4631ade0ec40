"""The shop's raw feeds, made from the warehouse tables.

The tables have no change log and no page log. These functions derive both from their rows,
as JSON text of the documented layouts, so that every job runs its real parsing path over the
whole tables. A change feed carries ``src_table``, as a log landed by table does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.scalars import MONEY, SECOND

DATABASE = "shop"


# Setting that deals the tables over so many tasks as they are read. Making and parsing JSON is the
# bulk of the work, and a table that is one row group would be one task. Unset: as the files are.
FEED_PARTITIONS = "spark.tidemart.feed.partitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    dealt = spark.conf.get(FEED_PARTITIONS, None)
    return rows.repartition(int(dealt)) if dealt else rows


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def money(column: str) -> Column:
    return F.col(column).cast(MONEY).cast("string")


def when_text(column: str) -> Column:
    return F.date_format(column, SECOND)


def instant(column: str) -> Column:
    return F.col(column).cast("timestamp")


def prefixed(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def change(rows: DataFrame, source: str, kind: Column | str, ts: Column,
           data: dict[str, Column], old: dict[str, Column] | None = None,
           only_old: Column | None = None, offset: Column | None = None) -> DataFrame:
    """Rows as change messages of table ``source``; ``offset`` is the place in the log."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    parts = [F.lit(DATABASE).alias("database"), F.lit(source).alias("table"), kind.alias("type"),
             ts.alias("ts"), F.struct(*[c.alias(n) for n, c in data.items()]).alias("data")]
    if offset is not None:
        parts.append(offset.alias("xoffset"))
    if old is not None:
        before = F.struct(*[c.alias(n) for n, c in old.items()])
        parts.append((before if only_old is None else F.when(only_old, before)).alias("old"))
    return rows.select(F.lit(source).alias("src_table"), F.to_json(F.struct(*parts)).alias("value"))


def line_id() -> Column:
    """Identity of an order line: lines are distinct only as whole rows."""
    return F.md5(F.concat_ws(
        "|", text("l_orderkey"), text("l_partkey"), text("l_suppkey"), text("l_linenumber"),
        money("l_quantity"), money("l_extendedprice"), money("l_discount"), money("l_tax"),
        "l_returnflag", "l_linestatus", when_text("l_shipdate")))


def order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return change(lines, "order_detail", "insert", F.unix_seconds(instant("l_shipdate")), {
        "id": line_id(), "order_id": F.col("l_orderkey"), "sku_id": F.col("l_partkey"),
        "sku_name": prefixed("sku-", F.col("l_partkey")), "order_price": money("l_extendedprice"),
        "sku_num": F.col("l_quantity").cast("int"), "create_time": when_text("l_shipdate"),
        "source_type": prefixed("N", F.col("l_suppkey") % 30), "source_id": F.col("l_suppkey"),
        "split_total_amount": money("l_extendedprice"),
        "split_activity_amount": money("l_discount"), "split_coupon_amount": money("l_tax")})


def new_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return change(orders, "order_info", "insert", F.unix_seconds(instant("o_orderdate")), {
        "id": F.col("o_orderkey"), "consignee": prefixed("buyer-", F.col("o_custkey")),
        "consignee_tel": prefixed("13", F.col("o_custkey")), "total_amount": money("o_totalprice"),
        "order_status": F.lit("1001"), "user_id": F.col("o_custkey"),
        "delivery_address": F.col("o_orderpriority"),
        "out_trade_no": prefixed("T", F.col("o_orderkey")),
        "create_time": when_text("o_orderdate"), "province_id": F.col("o_custkey") % 34,
        "activity_reduce_amount": F.lit("0.00"), "coupon_reduce_amount": F.lit("0.00"),
        "original_total_amount": money("o_totalprice"), "feight_fee": F.lit("8.00")})


def order_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One status change per order."""
    orders = table(spark, sf_dir, "orders")
    code = (F.when(F.col("o_orderstatus") == "F", "1003")
            .when(F.col("o_orderstatus") == "P", "1005").otherwise("1006"))
    return change(orders, "order_info", "update", F.unix_seconds(instant("o_orderdate")), {
        "id": F.col("o_orderkey"), "user_id": F.col("o_custkey"),
        "province_id": F.col("o_custkey") % 34, "operate_time": when_text("o_orderdate"),
        "order_status": code}, {"order_status": F.lit("1001")})


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two status changes per order within one second; the later one moves it to another province.

    The messages of both are mixed, so that only their offsets tell which came later.
    """
    orders = table(spark, sf_dir, "orders").withColumn("_turn", F.explode(F.array(F.lit(2), F.lit(1))))
    code = (F.when(F.col("o_orderstatus") == "F", "1003")
            .when(F.col("o_orderstatus") == "P", "1005").otherwise("1006"))
    return change(orders, "order_info", "update", F.unix_seconds(instant("o_orderdate")), {
        "id": F.col("o_orderkey"), "user_id": F.col("o_custkey"),
        "province_id": (F.col("o_custkey") + F.col("_turn") - 1) % 34,
        "operate_time": when_text("o_orderdate"), "order_status": code},
        {"order_status": F.lit("1001")}, offset=F.col("_turn"))


def detail_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_discount >= 0.05")
    return change(lines, "order_detail_activity", "insert", F.unix_seconds(instant("l_shipdate")), {
        "id": F.col("l_linenumber"), "order_id": F.col("l_orderkey"), "order_detail_id": line_id(),
        "activity_id": F.col("l_partkey") % 100, "activity_rule_id": F.col("l_suppkey") % 10,
        "sku_id": F.col("l_partkey"), "create_time": when_text("l_shipdate")})


def detail_coupons(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    return change(lines, "order_detail_coupon", "insert", F.unix_seconds(instant("l_shipdate")), {
        "id": F.col("l_linenumber"), "order_id": F.col("l_orderkey"), "order_detail_id": line_id(),
        "coupon_id": F.col("l_partkey") % 50, "coupon_use_id": F.col("l_suppkey"),
        "sku_id": F.col("l_partkey"), "create_time": when_text("l_shipdate")})


def refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    return change(lines, "order_refund_info", "insert", F.unix_seconds(instant("l_shipdate")), {
        "id": line_id(), "user_id": F.col("l_suppkey"), "order_id": F.col("l_orderkey"),
        "sku_id": F.col("l_partkey"), "refund_type": prefixed("N", F.col("l_suppkey") % 30),
        "refund_num": F.col("l_quantity").cast("int"), "refund_amount": money("l_extendedprice"),
        "refund_reason_type": prefixed("R", F.col("l_partkey") % 6),
        "refund_reason_txt": F.col("l_linestatus"), "create_time": when_text("l_shipdate")},
        offset=F.col("l_quantity").cast("int"))


def refund_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    return change(lines, "refund_payment", "insert", F.unix_seconds(instant("l_shipdate")), {
        "id": line_id(), "order_id": F.col("l_orderkey"), "sku_id": F.col("l_partkey"),
        "payment_type": prefixed("N", F.col("l_partkey") % 30),
        "callback_time": when_text("l_shipdate"), "total_amount": money("l_extendedprice")})


def cart(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    first = F.col("l_linenumber") == 1
    return change(
        lines, "cart_info", F.when(first, "insert").otherwise("update"),
        F.unix_seconds(instant("l_shipdate")), {
            "id": line_id(), "user_id": F.col("l_suppkey"), "sku_id": F.col("l_partkey"),
            "cart_price": money("l_extendedprice"), "sku_num": F.col("l_quantity").cast("int"),
            "sku_name": prefixed("sku-", F.col("l_partkey")), "is_checked": F.lit("0"),
            "create_time": when_text("l_shipdate"), "source_type": F.col("l_returnflag"),
            "source_id": F.col("l_suppkey")},
        {"sku_num": F.col("l_linenumber") * 7}, only_old=~first)


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return change(orders, "comment_info", "insert", F.unix_seconds(instant("o_orderdate")), {
        "id": F.col("o_orderkey"), "user_id": F.col("o_custkey"),
        "sku_id": F.col("o_orderkey") % 100, "appraise": prefixed("N", F.col("o_custkey") % 30),
        "comment_txt": F.col("o_orderpriority")})


def _event_number() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def payment_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as payments; a third of them did not succeed."""
    bought = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    status = F.when(_event_number() % 3 == 0, "1601").otherwise("1602")
    return change(bought, "payment_info", "update", F.unix_seconds(instant("ts")), {
        "id": F.col("event_id"), "user_id": F.col("user_id"), "order_id": F.col("user_id"),
        "payment_type": prefixed("N", _event_number() % 30), "callback_time": when_text("ts"),
        "payment_status": status}, offset=F.col("event_id"))


def order_line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views and clicks as messages of the order-line fact topic."""
    seen = table(spark, sf_dir, "events").where("event_type IN ('view', 'click')")
    return seen.select(F.to_json(F.struct(
        text("event_id").alias("id"), text("user_id").alias("order_id"),
        text("user_id").alias("user_id"), text(_event_number()).alias("sku_id"),
        F.col("event_type").alias("sku_name"), text(F.col("user_id") % 34).alias("province_id"),
        when_text("ts").alias("create_time"), money("value").alias("split_total_amount"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_id"),
        text(F.unix_seconds(instant("ts"))).alias("ts"))).alias("value"))


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations and regions as dictionary codes; some codes in use have no entry."""
    nations = table(spark, sf_dir, "nation").select(
        prefixed("N", F.col("n_nationkey")).alias("dic_code"), F.col("n_name").alias("dic_name"))
    regions = table(spark, sf_dir, "region").select(
        prefixed("R", F.col("r_regionkey")).alias("dic_code"), F.col("r_name").alias("dic_name"))
    return nations.unionByName(regions)


def dimension_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small and middle tables as changes of dimension tables."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    supplier = table(spark, sf_dir, "supplier")
    part = table(spark, sf_dir, "part")
    start = F.lit(1_700_000_000)
    regions = {"id": F.col("r_regionkey"), "region_name": F.col("r_name")}
    feeds = [
        change(region, "base_region", "bootstrap-start", start, regions),
        change(region, "base_region", "bootstrap-insert", start, regions),
        change(region, "base_region", "bootstrap-complete", start, regions),
        change(nation, "base_province", "bootstrap-insert", start, {
            "id": F.col("n_nationkey"), "name": F.col("n_name"), "region_id": F.col("n_regionkey"),
            "area_code": F.lit(None).cast("string")}),
        change(customer, "user_info", "insert", start + F.col("c_custkey"), {
            "id": F.col("c_custkey"), "name": F.col("c_name"), "province_id": F.col("c_nationkey"),
            "balance": money("c_acctbal"), "segment": F.col("c_mktsegment")}),
        change(supplier, "shop_info", "insert", start + F.col("s_suppkey"), {
            "id": F.col("s_suppkey"), "name": F.col("s_name"), "province_id": F.col("s_nationkey"),
            "balance": money("s_acctbal")}),
        # Each brand's row is updated by every part of it, many times within a second.
        change(part, "base_brand", "update", start + F.floor(F.col("p_partkey") / 100), {
            "tm_id": F.col("p_brand"), "tm_name": F.col("p_name"), "size": F.col("p_size")},
            offset=F.col("p_partkey")),
    ]
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed)
    return out


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as page-log text, with ``arrival``; some records are broken or lack the device."""
    events = table(spark, sf_dir, "events")
    if not spark.conf.get(FEED_PARTITIONS, None):
        # An event is short and its record long: few row groups would be few and long tasks.
        events = events.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    k = _event_number()
    started = F.col("event_type") == "signup"
    failed = F.col("event_type") == "error"
    common = F.struct(
        text(F.col("user_id") % 34).alias("ar"), F.when(started, "1").otherwise("0").alias("is_new"),
        prefixed("mid_", F.col("user_id")).alias("mid"), text("user_id").alias("uid"))
    page = F.struct(
        F.col("event_type").alias("page_id"), F.lit("home").alias("last_page_id"),
        text(k).alias("item"), F.lit("sku_id").alias("item_type"), k.alias("during_time"))
    # Made per row with a slice of a fixed list, as many as the row's number says.
    displays = F.slice(F.array(*[F.struct(
        F.lit(str(j)).alias("item"), F.lit("sku_id").alias("item_type"), F.lit(4).alias("pos_id"),
        F.lit(j).alias("pos_seq")) for j in range(3)]), F.lit(1), k % 4)
    actions = F.slice(F.array(*[F.struct(
        F.lit("favor_add").alias("action_id"), text(k + j).alias("item"),
        F.unix_millis(instant("ts")).alias("ts")) for j in range(2)]), F.lit(1), k % 3)
    record = F.to_json(F.struct(
        F.when(k != 27, common).alias("common"), F.when(~started, page).alias("page"),
        F.when(started, F.struct(F.lit("icon").alias("entry"), k.alias("loading_time"))).alias("start"),
        F.when(~started, displays).alias("displays"), F.when(~started, actions).alias("actions"),
        F.when(failed, F.struct((k + 1000).alias("error_code"), F.lit("timeout").alias("msg"))).alias("err"),
        F.unix_millis(instant("ts")).alias("ts"),
        F.when(k % 5 == 0, prefixed("t-", F.col("event_id"))).alias("trace")))
    # Broken text is a record cut off after 30 characters.
    value = F.when(k == 13, F.substring(record, 1, 30)).otherwise(record)
    return events.select(F.col("event_id").alias("arrival"), value.alias("value"))


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as page views: what the user says is a keyword search."""
    turns = table(spark, sf_dir, "conversations")
    return turns.select(F.to_json(F.struct(
        F.struct(prefixed("mid_", F.col("conv_id")).alias("mid")).alias("common"),
        F.struct(
            F.col("text").alias("item"), F.lit("keyword").alias("item_type"),
            F.when(F.col("role") == "user", "search").otherwise("home").alias("last_page_id"),
            F.lit("good_list").alias("page_id")).alias("page"),
        (F.col("conv_id") * 3000 + F.col("turn") * 1000).alias("ts"))).alias("value"))


def route_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records of a routing table with one row per part, in the order of ``seq``.

    The operation follows from the part: kept, created, renamed to another key, deleted.
    """
    part = table(spark, sf_dir, "part")

    def image(suffix: str, sink: Column) -> Column:
        return F.struct(
            F.concat("p_brand", F.lit("_"), text("p_size"), F.lit(suffix)).alias("source_table"),
            F.lit("insert").alias("source_type"),
            F.concat(F.lit("dim_"), F.lower("p_type"), F.lit(suffix)).alias("sink_table"),
            sink.alias("sink_type"), F.lit("id,name").alias("sink_columns"),
            text("p_partkey").alias("sink_pk"))

    op = F.element_at(F.array(F.lit("r"), F.lit("c"), F.lit("u"), F.lit("d")),
                      (F.col("p_partkey") % 4 + 1).cast("int"))
    sink = F.when(F.col("p_size") % 5 == 0, "dwd").otherwise("dim")
    moved = F.when(F.col("p_size") % 2 == 0, "").otherwise("_b")
    before = F.when(op.isin("u", "d"), image("", sink))
    after = (F.when(op.isin("r", "c"), image("", sink))
             .when((op == "u") & (moved == ""), image("", sink))
             .when(op == "u", image("_b", sink)))
    return part.select(F.to_json(F.struct(
        before.alias("before"), after.alias("after"), op.alias("op"),
        F.col("p_partkey").alias("ts_ms"))).alias("value"))


def person_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change records of a table with one row per user; errors delete the row."""
    events = table(spark, sf_dir, "events")
    row = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("name"),
                   _event_number().alias("age"))
    gone = F.col("event_type") == "error"
    op = F.when(gone, "d").when(F.col("event_type") == "signup", "c").otherwise("u")
    return events.select(F.to_json(F.struct(
        F.when(op != "c", row).alias("before"), F.when(~gone, row).alias("after"),
        op.alias("op"), F.col("event_id").alias("ts_ms"))).alias("value"))


def employee_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    return bought.select(F.concat_ws(
        ",", text("event_id"), "event_type", text("user_id"),
        text(F.unix_millis(instant("ts")))).alias("value"))


def department_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "events").where("event_type = 'view'")
    return seen.select(F.concat_ws(
        ",", text("user_id"), prefixed("view-", F.col("event_id")),
        text(F.unix_millis(instant("ts")))).alias("value"))


def union(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
