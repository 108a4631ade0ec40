"""Streams give what the batch gives."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tidemart import feeds, registry, schemas
from tidemart.operators import latest, routing
from tidemart.plans import facts, warehouse
from tidemart.sinks import writers
from tidemart.sinks.keyed import KeyedTable
from tidemart.sources import change_log, page_log, tables
from tidemart.streaming import jobs
from stream_files import chunks, finish, put, rows, text_stream, texts


def log_stream(spark, folder, files=1):
    return change_log.read_change_log(text_stream(spark, folder, files))


def trade_texts(spark, small):
    raw = feeds.union(
        feeds.order_details(spark, small), feeds.new_orders(spark, small),
        feeds.order_changes(spark, small), feeds.detail_activities(spark, small),
        feeds.detail_coupons(spark, small))
    return texts(raw)


def run_lines(spark, tmp_path, folder, lines_of, shape, files):
    """Both halves of a retracting fact, to the end of the input."""
    lines_path = str(tmp_path / "lines")
    lines = lines_of(log_stream(spark, folder, files))
    finish(jobs.lines_job(lines, lines_path, str(tmp_path / "ck1")))
    table = KeyedTable(spark, str(tmp_path / "fact"), ["id"])
    stored = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", "6").parquet(lines_path)
    log = log_stream(spark, folder, files)
    finish(jobs.promotion_job(stored, facts.activities(log), facts.coupons(log), table,
                              str(tmp_path / "ck2"), shape))
    return table


@pytest.mark.parametrize("seed", [1, 2])
def test_order_detail_in_any_order(spark, small, tmp_path, seed):
    lines = trade_texts(spark, small)
    random.Random(seed).shuffle(lines)
    folder = put(tmp_path / "in", chunks(lines, 3))
    table = run_lines(spark, tmp_path, folder, facts.placed_lines, facts.shape_order_detail, 1)
    want = facts.dwd_order_detail(registry.trade_log(spark, small))
    assert rows(table.read()) == rows(want)


def test_order_cancel(spark, small, tmp_path):
    lines = trade_texts(spark, small)
    random.Random(3).shuffle(lines)
    folder = put(tmp_path / "in", chunks(lines, 3))
    table = run_lines(spark, tmp_path, folder, facts.cancelled_lines, facts.shape_order_cancel, 2)
    assert rows(table.read()) == rows(facts.dwd_order_cancel(registry.trade_log(spark, small)))


def test_retracting_left_join_pads_first(spark, tmp_path):
    def parts(name, schema, *files):
        for i, values in enumerate(files):
            spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(
                str(tmp_path / name / f"f={i}"))
        return (spark.readStream.schema(schema).parquet(str(tmp_path / name / "f=*")))

    seq = "seq struct<second: bigint, offset: bigint>"
    lines = parts("l", f"id string, sku string, {seq}", [("1", "s", (10, 1))])
    activity = parts("a", f"order_detail_id string, activity_id string, activity_rule_id string, {seq}", [])
    coupon = parts("c", f"order_detail_id string, coupon_id string, coupon_use_id string, {seq}", [])
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])

    def run():
        finish(jobs.promotion_job(lines, activity, coupon, table, str(tmp_path / "ck"), lambda b: b))
        return [(r.id, r.activity_id, r.coupon_id) for r in table.read().collect()]

    assert run() == [("1", None, None)]
    spark.createDataFrame([("1", "A", "R", (11, 5))], activity.schema).write.parquet(str(tmp_path / "a/f=7"))
    assert run() == [("1", "A", None)]
    spark.createDataFrame([("1", "B", "R", (11, 6)), ("2", "Z", "R", (12, 7))], activity.schema).write.parquet(
        str(tmp_path / "a/f=8"))
    assert run() == [("1", "B", None)]
    # An older activity that arrives late changes nothing.
    spark.createDataFrame([("1", "old", "R", (11, 2))], activity.schema).write.parquet(str(tmp_path / "a/f=9"))
    assert run() == [("1", "B", None)]


def test_bounded_left_join_keeps_state_for_ttl(spark, tmp_path):
    def stream(name, schema, *files):
        for i, values in enumerate(files):
            put(tmp_path / name, [[",".join(v) for v in values]])
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").csv(str(tmp_path / name))

    late = [("9", "x", "90000")]
    lines = stream("l", "id string, sku string, ts string",
                   [("1", "s", "100"), ("2", "s", "100"), ("3", "s", "100")], late, [("8", "x", "95000")])
    activity = stream("a", "order_detail_id string, activity_id string, ts string",
                      [("1", "A1", "110"), ("2", "too far", "1200")], late, [("8", "x", "95000")])
    coupon = stream("c", "order_detail_id string, coupon_id string, ts string",
                    [("3", "C3", "90")], late, [("8", "x", "95000")])
    joined = jobs.bounded_left_join(lines, activity, coupon, timedelta(seconds=910))
    out = str(tmp_path / "out")
    finish(writers.stream_append_table(joined, out, str(tmp_path / "ck")))
    got = {r.id: (r.activity_id, r.coupon_id) for r in spark.read.parquet(out).collect()}
    assert {k: got[k] for k in "123"} == {"1": ("A1", None), "2": (None, None), "3": (None, "C3")}


def test_bounded_cancellations(spark, tmp_path):
    import json

    def change(table, kind, ts, data, old=None):
        body = {"table": table, "type": kind, "ts": ts, "data": data}
        return json.dumps(body if old is None else {**body, "old": old})

    def line(key, order, ts):
        return change("order_detail", "insert", ts, {"id": key, "order_id": order, "sku_num": 2, "order_price": "1.50"})

    def cancel(order, ts):
        return change("order_info", "update", ts, {"id": order, "order_status": "1003", "user_id": "u",
                      "operate_time": "2024-01-02 03:04:05"}, {"order_status": "1001"})

    def sentinels(ts):
        return [line(f"x{ts}", "none", ts), cancel(f"none{ts}", ts)] + [
            change(f"order_detail_{p}", "insert", ts, {"order_detail_id": f"none{ts}"})
            for p in ("activity", "coupon")]

    first = [line("1", "a", 1000), line("2", "b", 1000), line("3", "a", 1000), cancel("a", 1900),
             cancel("b", 1911),
             change("order_detail_activity", "insert", 1000, {"order_detail_id": "1", "activity_id": "A"})]
    folder = put(tmp_path / "in", [first, sentinels(90_000), sentinels(95_000), sentinels(99_000)])
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    finish(jobs.bounded_cancel_job(log_stream(spark, folder), table, str(tmp_path / "ck")))
    got = {r.id: (r.user_id, r.activity_id, r.date_id, r.split_original_amount, r.ts)
           for r in table.read().collect()}
    # The cancellation of order b came 911 seconds after its line.
    assert got == {"1": ("u", "A", "2024-01-02", "3.0000", "1900"),
                   "3": ("u", None, "2024-01-02", "3.0000", "1900")}


def test_comments_use_dictionary_of_now(spark, small, tmp_path):
    folder = put(tmp_path / "in", chunks(texts(feeds.comments(spark, small)), 3))
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    asked = []

    def dictionary():
        asked.append(1)
        return feeds.dictionary(spark, small)

    finish(jobs.comment_job(log_stream(spark, folder), dictionary, table, str(tmp_path / "ck")))
    assert len(asked) == 3
    want = facts.dwd_comment_info(registry.log_of(feeds.comments(spark, small)),
                                  feeds.dictionary(spark, small))
    assert rows(table.read()) == rows(want)


def test_cart_is_appended(spark, small, tmp_path):
    folder = put(tmp_path / "in", chunks(texts(feeds.cart(spark, small)), 3))
    out = str(tmp_path / "out")
    finish(jobs.cart_job(log_stream(spark, folder), out, str(tmp_path / "ck")))
    assert rows(spark.read.parquet(out)) == rows(facts.dwd_cart_add(registry.log_of(feeds.cart(spark, small))))


@pytest.mark.parametrize("job,batch,inputs", [
    (jobs.refund_job, facts.dwd_order_refund, (feeds.refunds, feeds.order_changes)),
    (jobs.refund_pay_job, facts.dwd_refund_pay_success,
     (feeds.refund_payments, feeds.refunds, feeds.order_changes)),
])
def test_refunds_in_any_order(spark, small, tmp_path, job, batch, inputs):
    raw = feeds.union(*[f(spark, small) for f in inputs])
    lines = texts(raw)
    random.Random(5).shuffle(lines)
    folder = put(tmp_path / "in", chunks(lines, 3))
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    dictionary = feeds.dictionary(spark, small)
    finish(job(log_stream(spark, folder), lambda: dictionary, table, str(tmp_path / "ck"), salts=3))
    want = batch(registry.log_of(raw), dictionary)
    assert rows(table.read(), "row_op_ts") == rows(want, "row_op_ts")


def by_time(frame, column):
    return [r.value for r in frame.orderBy(column).select("value").collect()]


def test_payments_by_interval(spark, small, tmp_path):
    paid = feeds.payment_updates(spark, small).withColumn(
        "t", F.get_json_object("value", "$.ts").cast("bigint"))
    seen = feeds.order_line_facts(spark, small).withColumn(
        "t", F.get_json_object("value", "$.ts").cast("bigint"))
    paid_dir = put(tmp_path / "paid", chunks(by_time(paid, "t"), 3))
    seen_dir = put(tmp_path / "seen", chunks(by_time(seen, "t"), 3))
    day = timedelta(days=1)
    log = change_log.with_event_time(log_stream(spark, paid_dir), "2 days")
    facts_stream = change_log.with_event_time(text_stream(spark, seen_dir).select(
        F.from_json("value", schemas.ORDER_LINE_FACT).alias("r")).select("r.*"), "2 days")
    table = KeyedTable(spark, str(tmp_path / "t"), ["order_detail_id"])
    dictionary = feeds.dictionary(spark, small)
    finish(jobs.pay_job(log, facts_stream, lambda: dictionary, table, str(tmp_path / "ck"), lower=-day))
    want = facts.last_payment(facts.dwd_pay_success(
        registry._payment_log(spark, small), registry._order_line_facts(spark, small),
        dictionary, lower=-day))
    assert rows(table.read()) == rows(want) and want.count()


def test_keyword_windows_close_and_drop_late_rows(spark, small, tmp_path):
    raw = feeds.search_log(spark, small).withColumn(
        "t", F.get_json_object("value", "$.ts").cast("bigint"))
    lines = by_time(raw, "t")
    page = '{{"common":{{}},"page":{{"item":"{}","item_type":"keyword","last_page_id":"search"}},"ts":{}}}'
    sentinel = page.format("sentinel", 10**12)
    folder = put(tmp_path / "in", chunks(lines, 3) + [[sentinel], [page.format("tardy", 5)], [sentinel]])
    out = str(tmp_path / "out")
    view = page_log.read_page_view(text_stream(spark, folder))
    finish(jobs.keyword_job(view, lambda b, n: b.write.mode("overwrite").parquet(f"{out}/batch={n}"),
                            str(tmp_path / "ck")))
    got = spark.read.parquet(out).drop("batch")
    assert rows(got, "ts") == rows(registry.dws_keyword_window(spark, small))


def test_traffic_state_over_batches(spark, small, tmp_path):
    raw = feeds.page_log(spark, small)
    ordered = [(r.arrival, r.value) for r in raw.orderBy("arrival").collect()]
    for i, part in enumerate(chunks(ordered, 4)):
        spark.createDataFrame(part, raw.schema).coalesce(2).write.parquet(str(tmp_path / f"in/f={i}"))
    import os
    for i in range(4):
        for f in (tmp_path / f"in/f={i}").iterdir():
            os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", "2").parquet(
        str(tmp_path / "in/f=*"))
    visits = KeyedTable(spark, str(tmp_path / "visits"), ["mid"], compact_every=2)
    out = str(tmp_path / "out")
    finish(jobs.traffic_job(stream, "arrival", visits, out, str(tmp_path / "ck")))
    got = spark.read.option(
        "basePath", out).text(f"{out}/batch=*/output=*").drop("batch")
    assert rows(got) == rows(registry.dwd_traffic_log(spark, small))
    assert len(visits.version().runs) <= 2
    assert visits.read().count() == visits.rows().count()


def test_routes_then_dimensions_and_facts(spark, small, tmp_path):
    feed = put(tmp_path / "feed", chunks(texts(feeds.route_changes(spark, small).coalesce(1)), 3))
    routes = KeyedTable(spark, str(tmp_path / "routes"), ["source_table"])
    finish(jobs.routes_job(text_stream(spark, feed), routing.DIM, routes, str(tmp_path / "ck1")))
    want = registry.apply_config_changes(spark, small)
    assert rows(routes.read()) == rows(want)

    folder = put(tmp_path / "in", [texts(feeds.dimension_rows(spark, small))])
    dims = KeyedTable(spark, str(tmp_path / "dims"), ["sink_table", "row_key"])
    config = registry.routes(spark, routing.DIM)
    finish(jobs.dim_job(log_stream(spark, folder), lambda: config, dims, str(tmp_path / "ck2")))
    assert rows(dims.read().drop("ts")) == rows(warehouse.dim_tables(
        registry.log_of(feeds.dimension_rows(spark, small)), config))

    out = str(tmp_path / "facts")
    config = registry.routes(spark, routing.FACT)
    finish(jobs.simple_facts_job(log_stream(spark, folder), lambda: config, out, str(tmp_path / "ck3")))
    got = spark.read.option("basePath", out).text(f"{out}/batch=*/sink_table=*").drop("batch")
    assert rows(got) == rows(warehouse.dwd_simple_facts(
        registry.log_of(feeds.dimension_rows(spark, small)), config))


def test_changes_job_replay_and_compaction(spark, small, tmp_path):
    lines = [r.value for r in feeds.person_changes(spark, small).withColumn(
        "t", F.get_json_object("value", "$.ts_ms").cast("bigint")).orderBy("t").collect()]
    folder = put(tmp_path / "in", chunks(lines, 3))
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    feed = tables.read_table_changes(text_stream(spark, folder), schemas.PERSON)
    finish(jobs.changes_job(feed, table, str(tmp_path / "ck")))
    want = rows(registry.snapshot_changelog_table(spark, small))
    assert rows(table.read()) == want
    table.compact()
    assert rows(table.read()) == want
    again = tables.read_table_changes(spark.read.text(folder + "/0002.txt"), schemas.PERSON)
    writes = latest.keyed_changes(again, ["id"], F.col("ts_ms")).select("row.*", "removed", "seq")
    table.merge(writes, 2, [F.col("seq")], ("seq",))
    assert rows(table.read()) == want


def test_later_change_wins_in_an_earlier_batch(spark, tmp_path):
    def change(name, at):
        row = f'{{"id":1,"name":"{name}","age":1}}'
        return f'{{"before":{row},"after":{row},"op":"u","ts_ms":{at}}}'

    folder = put(tmp_path / "in", [[change("new", 20)], [change("old", 10)], [change("older", 5)]])
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], compact_every=2)
    finish(jobs.changes_job(tables.read_table_changes(text_stream(spark, folder), schemas.PERSON),
                            table, str(tmp_path / "ck")))
    assert [r.name for r in table.read().collect()] == ["new"]


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [3, 2, 1, 0], [1, 3, 0, 2]])
def test_offsets_decide_within_a_second(spark, tmp_path, order):
    import json

    def message(table, kind, offset, data, old=None):
        body = {"table": table, "type": kind, "ts": 100, "xoffset": offset, "data": data}
        return json.dumps({**body, "old": old} if old else body)

    def turned(province, offset):
        return message("order_info", "update", offset, {"id": "o", "order_status": "1005", "province_id": province},
                       {"order_status": "1001"})

    def refund(num, offset):
        return message("order_refund_info", "insert", offset, {
            "id": "r", "order_id": "o", "refund_type": "N1", "refund_reason_type": "N1", "refund_num": num})

    lines = [turned("old", 1), turned("new", 2), refund("1", 3), refund("2", 4)]
    dictionary = spark.createDataFrame([("N1", "one")], "dic_code string, dic_name string")
    folder = put(tmp_path / "in", [[lines[i]] for i in order])
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    finish(jobs.refund_job(log_stream(spark, folder), lambda: dictionary, table, str(tmp_path / "ck")))
    batch = facts.dwd_order_refund(change_log.read_change_log(spark.read.text(folder)), dictionary)
    for got in (table.read(), batch):
        assert [(r.id, r.province_id, r.refund_num) for r in got.collect()] == [("r", "new", "2")]


def test_replayed_messages_leave_one_row_per_key(spark, small):
    raw = feeds.union(feeds.order_details(spark, small), feeds.new_orders(spark, small),
                      feeds.detail_activities(spark, small), feeds.detail_coupons(spark, small))
    once, twice = registry.log_of(raw), registry.log_of(raw, raw)
    assert rows(facts.dwd_order_detail(twice)) == rows(facts.dwd_order_detail(once))


def test_employee_stream_bounds(spark, tmp_path):
    emp = put(tmp_path / "emp", [["1,ann,10,1000"], ["9,zoe,99,900000"], ["8,yes,98,990000"]])
    dept = put(tmp_path / "dept", [[f"10,d{gap},{1000 + gap}" for gap in (-6, -5, 0, 5, 6)],
                                   ["97,z,900000"], ["96,y,990000"]])
    options = {"maxFilesPerTrigger": "1"}
    employees = tables.with_event_ms(tables.read_csv_stream(spark, emp, schemas.EMPLOYEE, **options))
    departments = tables.with_event_ms(tables.read_csv_stream(spark, dept, schemas.DEPARTMENT, **options))
    out = str(tmp_path / "out")
    finish(jobs.emp_dept_job(employees, departments, out, str(tmp_path / "ck")))
    assert sorted(r.dname for r in spark.read.parquet(out).collect()) == ["d-5", "d0", "d5"]


def test_fact_stream_reads_each_upsert(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    schema = schemas.ORDER_LINE_FACT
    blank = [None] * (len(schema) - 2)
    table.merge(spark.createDataFrame([("1", *blank, "10")], schema), 0)
    table.merge(spark.createDataFrame([("1", *blank, "20")], schema), 1)
    out = str(tmp_path / "out")
    finish(writers.stream_append_table(
        jobs.fact_stream(spark, table, schema), out, str(tmp_path / "ck")))
    got = spark.read.parquet(out).select("id", F.unix_seconds("row_time").alias("s")).collect()
    assert sorted((r.id, r.s) for r in got) == [("1", 10), ("1", 20)]
