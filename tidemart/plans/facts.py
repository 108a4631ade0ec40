"""Fact tables of the shop, each a function of its inputs. The same code runs on batches and,
where the engine allows the joins, on streams (see ``tidemart.streaming.jobs``)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions import scalars
from tidemart.functions.predicates import (
    ORDER_CANCELLED, ORDER_REFUND_REQUESTED, ORDER_REFUNDED,
    cart_additions, fields, payments, status_changed_to, table_events)
from tidemart.operators import joins, latest, slices

# Columns read from the change log.
LINE = ("id order_id sku_id sku_name order_price sku_num create_time source_type source_id "
        "split_total_amount split_activity_amount split_coupon_amount")
ORDER = ("id consignee consignee_tel total_amount order_status user_id delivery_address "
         "order_comment out_trade_no trade_body process_status tracking_no parent_order_id "
         "province_id activity_reduce_amount coupon_reduce_amount original_total_amount "
         "feight_fee feight_fee_reduce")
CART = ("id user_id sku_id cart_price sku_num sku_name is_checked create_time operate_time "
        "source_type source_id")
REFUND = ("id user_id order_id sku_id refund_type refund_num refund_amount refund_reason_type "
          "refund_reason_txt create_time")
REFUND_PAYMENT = "id order_id sku_id payment_type callback_time total_amount"

# A payment follows its order line by a quarter of an hour at most.
PAY_LOWER = timedelta(minutes=-15)
PAY_UPPER = timedelta(seconds=5)

# Columns that hold the time of the write.
VOLATILE = ["row_op_ts"]


def dwd_comment_info(log: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Comments with the name of their rating. Key: id."""
    return shape_comment(last_per_id(comment_rows(log)), dictionary)


def comment_rows(log: DataFrame) -> DataFrame:
    return table_events(log, "comment_info", "insert").select(
        *fields("id user_id sku_id appraise comment_txt"), "ts", "seq")


def shape_comment(comments: DataFrame, dictionary: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return joins.lookup_join(comments, dictionary, "appraise", "appraise_name").select(
        "id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts", *keep)


def dwd_cart_add(log: DataFrame, database: str | None = None) -> DataFrame:
    """What was put into carts: inserts in full, raised quantities by their increase."""
    delta = scalars.cart_delta(F.col("type"), F.col("data")["sku_num"], F.col("old")["sku_num"])
    return cart_additions(log, database).select(
        *[delta.alias(n) if n == "sku_num" else F.col("data")[n].alias(n) for n in CART.split()])


def order_lines(log: DataFrame, database: str | None = None) -> DataFrame:
    """Inserted order lines with their amount before discounts."""
    return table_events(log, "order_detail", "insert", database=database).select(
        *fields(LINE),
        scalars.multiply_as_text(F.col("data")["sku_num"], F.col("data")["order_price"])
        .alias("split_original_amount"),
        "ts", "seq")


def activities(log: DataFrame, database: str | None = None) -> DataFrame:
    return table_events(log, "order_detail_activity", "insert", database=database).select(
        *fields("order_detail_id activity_id activity_rule_id"), "ts", "seq")


def coupons(log: DataFrame, database: str | None = None) -> DataFrame:
    return table_events(log, "order_detail_coupon", "insert", database=database).select(
        *fields("order_detail_id coupon_id coupon_use_id"), "ts", "seq")


# Places in the log of a row and of what it was joined with, which order the rows of a key: of all
# pairs of a line and a change of its order, the last line with the last change comes last.
SEQUENCES = ("seq", "order_seq", "request_seq", "pay_seq")


def sequences(rows: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in SEQUENCES if c in rows.columns)


def last_per_id(rows: DataFrame) -> DataFrame:
    """One row per ``id`` in a batch: a message sent again changes nothing. A stream keeps all
    rows, for the upsert table to choose the last."""
    return rows if rows.isStreaming else latest.latest_per_key(
        rows, ["id"], [F.col(c) for c in sequences(rows)])


def with_promotions(lines: DataFrame, activity: DataFrame, coupon: DataFrame) -> DataFrame:
    """Order lines with their last activity and last coupon, or nulls. One row per line.

    The three inputs are one input of parts keyed by order line, and an aggregation keeps the
    last of each part: one shuffle for all three. In an update-mode stream a line comes out at
    once, null padded, and again when a part arrives.
    """
    order = list(sequences(lines))
    others = [c for c in lines.columns if c != "id" and c not in order]
    parts = {
        "line": (lines, "id", [*order, *others]),
        "activity": (activity, "order_detail_id", ["seq", "activity_id", "activity_rule_id"]),
        "coupon": (coupon, "order_detail_id", ["seq", "coupon_id", "coupon_use_id"])}

    def kind(frame: DataFrame, names: list[str]) -> T.StructType:
        return T.StructType([T.StructField(n, frame.schema[n].dataType) for n in names])

    keyed = []
    for own, (frame, key, names) in parts.items():
        slots = [(F.struct(*names) if other == own else F.lit(None)).cast(kind(f, n)).alias(other)
                 for other, (f, _, n) in parts.items()]
        keyed.append(frame.select(F.col(key).alias("id"), *slots))
    union = keyed[0].unionByName(keyed[1]).unionByName(keyed[2])
    if union.isStreaming:
        # A micro-batch has few parts of a line: to combine them before the shuffle would only sort all of them once more.
        union = union.repartition("id")
    last = union.groupBy("id").agg(*[F.max(p).alias(p) for p in parts])
    return last.where(F.col("line").isNotNull()).select(
        "id", *[F.col("line")[n].alias(n) for n in [*order, *others]],
        *[F.col(p)[n].alias(n) for p in ("activity", "coupon") for n in parts[p][2] if n != "seq"])


def last_of_order(rows: DataFrame) -> DataFrame:
    """The last change of each order in a batch; a stream keeps all of them, for the
    upsert table to choose the last."""
    return rows if rows.isStreaming else latest.one_per_key(rows, "_order", [F.col("order_seq")])


def placed_orders(log: DataFrame, database: str | None = None) -> DataFrame:
    """Orders as they were placed, keyed by ``_order``."""
    return last_of_order(table_events(log, "order_info", "insert", database=database).select(
        *[F.col("data")[n].alias("_order" if n == "id" else n) for n in ORDER.split()],
        F.col("ts").alias("order_ts"), F.col("seq").alias("order_seq")))


def placed(lines: DataFrame, orders: DataFrame, salts: int = 1) -> DataFrame:
    return joins.salted_join(lines, orders, "order_id", "_order", salts, "id").drop("_order", "order_ts")


def placed_lines(log: DataFrame, database: str | None = None, salts: int = 1) -> DataFrame:
    """Order lines joined with the order as it was placed."""
    return placed(order_lines(log, database), placed_orders(log, database), salts)


ORDER_DETAIL = (LINE + " " + ORDER.removeprefix("id ")
                + " activity_id activity_rule_id coupon_id coupon_use_id").split()


def shape_order_detail(rows: DataFrame, dictionary: DataFrame | None = None,
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """The published columns, and four more that the payment job reads."""
    if dictionary is None:
        named = rows.withColumn("source_type_name", F.lit(None).cast("string"))
    else:
        named = joins.lookup_join(rows, dictionary, "source_type", "source_type_name", "left")
    return named.select(
        *ORDER_DETAIL, scalars.format_day(F.col("create_time")).alias("date_id"),
        "source_type_name", "split_original_amount", "ts", *keep)


def dwd_order_detail(log: DataFrame, dictionary: DataFrame | None = None,
                     database: str | None = None, number: int = 1) -> DataFrame:
    """Order lines with their order, activity and coupon. Key: id.

    In more than one slice of the orders, and then of the lines, parsed parts and the result are stored.
    """
    def build(*parts: DataFrame) -> DataFrame:
        return shape_order_detail(with_promotions(*parts), dictionary)

    if number == 1:
        return build(placed_lines(log, database), activities(log, database), coupons(log, database))
    key = "order_detail_id"
    lines = slices.by_slices([slices.stored(order_lines(log, database), "order_id", number),
                              slices.stored(placed_orders(log, database), "_order", number)], placed, "id")
    return slices.by_slices([lines, slices.stored(activities(log, database), key, number),
                             slices.stored(coupons(log, database), key, number)], build)


def orders_changed_to(log: DataFrame, code: str, columns: str,
                      database: str | None = None) -> DataFrame:
    """Orders whose status has become ``code``, as ``_order``, columns and ``order_ts``."""
    return last_of_order(status_changed_to(
        log, "order_info", "order_status", code, database).select(
        F.col("data")["id"].alias("_order"), *fields(columns), F.col("ts").alias("order_ts"),
        F.col("seq").alias("order_seq")))


def cancelled_orders(log: DataFrame, database: str | None = None) -> DataFrame:
    return orders_changed_to(log, ORDER_CANCELLED, "user_id province_id operate_time", database)


def take_order_time(joined: DataFrame) -> DataFrame:
    """A cancelled line's time is that of the cancellation."""
    return joined.drop("_order", "ts").withColumnRenamed("order_ts", "ts")


# What a cancellation tells of its lines: the joins carry and keep nothing else.
CANCELLED_LINE = ("id order_id sku_id sku_name sku_num split_original_amount split_activity_amount "
                  "split_coupon_amount split_total_amount seq").split()


def cancelled(lines: DataFrame, orders: DataFrame, salts: int = 1) -> DataFrame:
    return take_order_time(joins.salted_join(lines, orders, "order_id", "_order", salts, "id"))


def cancelled_lines(log: DataFrame, database: str | None = None, salts: int = 1) -> DataFrame:
    """Order lines joined with the cancellation of their order."""
    return cancelled(order_lines(log, database).select(*CANCELLED_LINE), cancelled_orders(log, database), salts)


def shape_order_cancel(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return rows.select(
        "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
        "activity_rule_id", "coupon_id", scalars.format_day(F.col("operate_time")).alias("date_id"),
        F.col("operate_time").alias("cancel_time"), "sku_num", "split_original_amount",
        "split_activity_amount", "split_coupon_amount", "split_total_amount", "ts", *keep)


def dwd_order_cancel(log: DataFrame, database: str | None = None, number: int = 1) -> DataFrame:
    """Lines of cancelled orders with their amounts, activity and coupon. Key: id.

    In more than one slice of the orders, and then of the lines, the log must be a landed one, which is read for each slice.
    """
    def build(*parts: DataFrame) -> DataFrame:
        return shape_order_cancel(with_promotions(*parts))

    if number == 1:
        return build(cancelled_lines(log, database), activities(log, database), coupons(log, database))
    key = "order_detail_id"
    lines = slices.by_slices([slices.Scanned(order_lines(log, database).select(*CANCELLED_LINE), "order_id", number),
                              slices.Scanned(cancelled_orders(log, database), "_order", number)], cancelled, "id")
    return slices.by_slices([lines, slices.Scanned(activities(log, database), key, number),
                             slices.Scanned(coupons(log, database), key, number)], build)


def paid(log: DataFrame, require_success: bool = True) -> DataFrame:
    return payments(log, require_success).select(
        F.col("data")["order_id"].alias("pay_order_id"),
        F.col("data")["payment_type"].alias("payment_type_code"),
        *fields("callback_time"), F.col("row_time").alias("pay_time"), F.col("ts").alias("pay_ts"),
        F.col("seq").alias("pay_seq"))


def paid_lines(order_detail: DataFrame, paid_rows: DataFrame, lower: timedelta = PAY_LOWER,
               upper: timedelta = PAY_UPPER) -> DataFrame:
    """Payments joined with the order lines written around their time.

    The inputs carry the event times ``row_time`` and ``pay_time``.
    """
    return joins.interval_join(
        order_detail, paid_rows, F.col("order_id") == F.col("pay_order_id"),
        "row_time", "pay_time", lower, upper)


def name_payment_type(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    return joins.lookup_join(rows, dictionary, "payment_type_code", "payment_type_name")


def shape_pay_success(pairs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return pairs.select(
        F.col("id").alias("order_detail_id"), "order_id", "user_id", "sku_id", "sku_name",
        "province_id", "activity_id", "activity_rule_id", "coupon_id", "payment_type_code",
        "payment_type_name", "callback_time", "source_id",
        F.col("source_type").alias("source_type_code"), "source_type_name", "sku_num",
        "split_original_amount", "split_activity_amount", "split_coupon_amount",
        F.col("split_total_amount").alias("split_payment_amount"), F.col("pay_ts").alias("ts"), *keep)


def dwd_pay_success(log: DataFrame, order_detail: DataFrame, dictionary: DataFrame,
                    require_success: bool = True, lower: timedelta = PAY_LOWER,
                    upper: timedelta = PAY_UPPER) -> DataFrame:
    """Payments with their type's name and the order lines they pay. Key: order_detail_id.

    ``log`` and ``order_detail`` carry the event time ``row_time``. Of an order's payments in
    one second only the last to arrive can stay in the upsert table, so only that is joined: a
    line never meets more payments than the interval has seconds. ``pay_seq`` orders a line's
    payments.
    """
    named = name_payment_type(paid(log, require_success), dictionary)
    last = latest.latest_per_key(named, ["pay_order_id", "pay_time"], [F.col("pay_seq")])
    return shape_pay_success(paid_lines(order_detail, last, lower, upper), ("pay_seq",))


def refund_requests(log: DataFrame, salts: int = 1) -> DataFrame:
    """Refund requests joined with the order that turned to refund."""
    refunds = last_per_id(
        table_events(log, "order_refund_info", "insert").select(*fields(REFUND), "ts", "seq"))
    orders = orders_changed_to(log, ORDER_REFUND_REQUESTED, "province_id")
    return joins.salted_join(
        refunds, orders, "order_id", "_order", salts, "id").drop("_order", "order_ts")


def last_requests(log: DataFrame) -> DataFrame:
    """The last refund request of each article of an order; a stream keeps all of them."""
    requests = table_events(log, "order_refund_info").select(
        F.col("data")["order_id"].alias("_request_order"),
        F.col("data")["sku_id"].alias("_request_sku"), *fields("refund_num"),
        F.col("seq").alias("request_seq"))
    if requests.isStreaming:
        return requests
    keys = ["_request_order", "_request_sku"]
    last = latest.latest_per_key(requests, keys, [F.col("request_seq")])
    # Expressions, for the same reason as in one_per_key.
    return last.withColumns({k: F.concat(F.col(k), F.lit("")) for k in keys})


def join_requests(paid_back: DataFrame, requests: DataFrame) -> DataFrame:
    """Join on two keys, order and article."""
    return paid_back.join(
        requests, (F.col("order_id") == F.col("_request_order"))
        & (F.col("sku_id") == F.col("_request_sku")), "inner"
    ).drop("_request_order", "_request_sku")


def shape_order_refund(joined: DataFrame, dictionary: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    named = joins.double_lookup_join(
        joined, dictionary, ("refund_type", "refund_type_name"),
        ("refund_reason_type", "refund_reason_type_name"))
    return named.select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        scalars.format_day(F.col("create_time")).alias("date_id"), "create_time",
        F.col("refund_type").alias("refund_type_code"), "refund_type_name",
        F.col("refund_reason_type").alias("refund_reason_type_code"), "refund_reason_type_name",
        "refund_reason_txt", "refund_num", "refund_amount", "ts",
        scalars.write_time().alias("row_op_ts"), *keep)


def dwd_order_refund(log: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Refund requests with their order's province and two names. Key: id."""
    return shape_order_refund(refund_requests(log), dictionary)


def refunded_payments(log: DataFrame, salts: int = 1) -> DataFrame:
    """Refund payments joined with the refunded order and the request of the same article."""
    paid_back = last_per_id(table_events(log, "refund_payment").select(*fields(REFUND_PAYMENT), "ts", "seq"))
    orders = orders_changed_to(log, ORDER_REFUNDED, "user_id province_id")
    joined = joins.salted_join(
        paid_back, orders, "order_id", "_order", salts, "id").drop("_order", "order_ts")
    return join_requests(joined, last_requests(log))


def shape_refund_pay_success(joined: DataFrame, dictionary: DataFrame,
                             keep: tuple[str, ...] = ()) -> DataFrame:
    return joins.lookup_join(joined, dictionary, "payment_type", "payment_type_name").select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        F.col("payment_type").alias("payment_type_code"), "payment_type_name",
        scalars.format_day(F.col("callback_time")).alias("date_id"), "callback_time",
        "refund_num", F.col("total_amount").alias("refund_amount"), "ts",
        scalars.write_time().alias("row_op_ts"), *keep)


def dwd_refund_pay_success(log: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Refund payments with their order, request and payment type. Key: id."""
    return shape_refund_pay_success(refunded_payments(log), dictionary)


def last_payment(fact: DataFrame) -> DataFrame:
    """The upsert table of the payment fact: each line's last payment to arrive."""
    return latest.latest_per_key(fact, ["order_detail_id"], [F.col("pay_seq")]).drop("pay_seq")


def emp_dept_interval(employees: DataFrame, departments: DataFrame,
                      lower: timedelta = timedelta(milliseconds=-5),
                      upper: timedelta = timedelta(milliseconds=5)) -> DataFrame:
    """Employees with the departments whose time is at most the interval away.

    Both inputs carry ``event_time``.
    """
    depts = departments.select(
        F.col("deptno").alias("dept_deptno"), F.col("dname"), F.col("ts").alias("dept_ts"),
        F.col("event_time").alias("dept_time"))
    # dept.ts in [emp.ts + lower, emp.ts + upper]
    pairs = joins.interval_join(
        depts, employees, F.col("dept_deptno") == F.col("deptno"),
        "dept_time", "event_time", lower, upper)
    return pairs.select("empno", "ename", "deptno", "ts", "dept_deptno", "dname", "dept_ts")
