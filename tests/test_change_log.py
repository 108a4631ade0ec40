"""Change log: envelope, filters, facts, routing, on hand-made rows."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tidemart import schemas, session
from tidemart.functions import predicates, scalars
from tidemart.operators import joins, keywords, latest, routing
from tidemart.plans import facts
from tidemart.sinks import writers
from tidemart.sources import change_log, messages, tables


def message(table, kind, data, old=None, ts=100, database="shop"):
    body = {"database": database, "table": table, "type": kind, "ts": ts, "data": data, "xid": 1}
    return json.dumps(body if old is None else {**body, "old": old})


def log(spark, *values, **options):
    frame = spark.createDataFrame([(v,) for v in values], "value string")
    return change_log.read_change_log(frame, **options)


def dictionary(spark, **names):
    return spark.createDataFrame(list(names.items()), schemas.DICTIONARY)


def test_envelope(spark):
    rows = log(spark, message("t", "insert", {"id": 1622138907505061891, "p": 3.5, "n": None}),
               "broken", None).where("`table` IS NOT NULL").collect()
    assert len(rows) == 1
    assert rows[0].data == {"id": "1622138907505061891", "p": "3.5", "n": None}
    assert rows[0].old is None and rows[0].ts == "100"


def test_messages_drop_null(spark):
    frame = spark.createDataFrame([("a", 1), (None, 2)], "value string, offset int")
    assert messages.messages(frame, "offset").collect()[0].asDict() == {"value": "a", "offset": 1}


def test_text_filter_before_parsing_is_exact(spark):
    hidden = '{"table":"\\u0074wo","type":"insert","ts":1,"data":{"id":"2"}}'
    values = [message("one", "insert", {"id": 1}), hidden, message("three", "insert", {"id": "3"})]
    got = predicates.table_events(log(spark, *values, tables=["two"]), "two").collect()
    assert [r.data["id"] for r in got] == ["2"]


def test_landed_log_prunes_by_table(spark, tmp_path):
    raw = spark.createDataFrame([(message(t, "insert", {"id": 1}),) for t in ("a", "b")], "value string")
    change_log.land_change_log(raw, str(tmp_path / "log"))
    landed = change_log.read_landed_log(spark, str(tmp_path / "log"))
    one = predicates.table_events(landed, "a", "insert")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(src_table" in plan
    assert one.count() == 1


def test_bootstrap_filters(spark):
    kinds = ["bootstrap-start", "bootstrap-insert", "bootstrap-complete", "insert", None]
    frame = log(spark, *[message("t", k, {"id": 1}) for k in kinds])
    assert {r.type for r in predicates.without_bootstrap_markers(frame).collect()} == {
        "bootstrap-insert", "insert", None}
    assert [r.type for r in predicates.without_bootstrap(frame).collect()] == ["insert"]


def test_status_needs_a_change(spark):
    frame = log(
        spark,
        message("order_info", "update", {"id": 1, "order_status": "1003"}, {"order_status": "1001"}),
        message("order_info", "update", {"id": 2, "order_status": "1003"}, {"user_id": "9"}),
        message("order_info", "insert", {"id": 3, "order_status": "1003"}),
        message("order_info", "update", {"id": 4, "order_status": "1004"}, {"order_status": "1001"}))
    got = predicates.status_changed_to(frame, "order_info", "order_status", "1003").collect()
    assert [r.data["id"] for r in got] == ["1"]


def test_cart(spark):
    frame = log(
        spark,
        message("cart_info", "insert", {"id": 1, "sku_num": 2}),
        message("cart_info", "update", {"id": 2, "sku_num": 10}, {"sku_num": 9}),
        message("cart_info", "update", {"id": 3, "sku_num": 1}, {"sku_num": 4}),
        message("cart_info", "update", {"id": 4, "sku_num": 7}, {"is_checked": "1"}),
        message("cart_info", "update", {"id": 5, "sku_num": 7}, {"sku_num": "many"}),
        message("cart_info", "delete", {"id": 6, "sku_num": 7}),
        message("cart_info", "insert", {"id": 7, "sku_num": 1}, database="other"))
    got = facts.dwd_cart_add(frame, database="shop").orderBy("id").collect()
    assert [(r.id, r.sku_num, r.operate_time) for r in got] == [("1", "2", None), ("2", "1", None)]
    assert facts.dwd_cart_add(frame).count() == 3


def test_scalars(spark):
    one = spark.range(1).select(
        scalars.multiply_as_text(F.lit("2.5"), F.lit("15.00")).alias("money"),
        scalars.multiply_as_text(F.lit("x"), F.lit("15.00")).alias("bad"),
        scalars.date_to_epoch_ms(F.lit("1970-01-02")).alias("day"),
        scalars.date_to_epoch_ms(F.lit("1970-01-01 09:00:00"), full=True).alias("full"),
        scalars.format_day(F.lit("2024-05-06 07:08:09")).alias("date"),
        scalars.format_day(F.lit("soon")).alias("nodate"),
        scalars.epoch_ms_to_datetime(F.lit(1500)).alias("moment"),
        scalars.route_key(F.lit("t"), F.lit("insert")).alias("route")).first()
    assert one.money == "37.5000" and one.bad is None
    assert one.day == 16 * 3_600_000 and one.full == 3_600_000
    assert one.date == "2024-05-06" and one.nodate is None
    assert one.moment == "1970-01-01 00:00:01" and one.route == "t_insert"


def test_lookup_beyond_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "zz")], "id string, code string")
    names = dictionary(spark, a="A", b="B")
    small = joins.lookup_join(rows, names, "code", "name")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(joins, "small_enough", lambda side: False)
    large = joins.lookup_join(rows, names, "code", "name")
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect())) == [
        ("1", "a", "A"), ("2", "b", "B")]


def test_small_enough_counts_rows_and_text(spark):
    side = spark.createDataFrame([("a", "x" * 100), ("b", "y" * 100)], schemas.DICTIONARY)
    assert joins.small_enough(side)
    assert not joins.small_enough(side, rows=1)
    assert not joins.small_enough(side, chars=150)


@pytest.mark.parametrize("base", [0, 1_700_000_000_000, -5_000_000])
def test_interval_bounds_are_inclusive(spark, base):
    emp = spark.createDataFrame([(1, "e", 7, base)], schemas.EMPLOYEE)
    dept = spark.createDataFrame(
        [(7, str(gap), base + gap) for gap in (-6, -5, 0, 5, 6)] + [(8, "other", base)],
        schemas.DEPARTMENT)
    got = facts.emp_dept_interval(tables.with_event_ms(emp), tables.with_event_ms(dept))
    assert sorted(r.dname for r in got.collect()) == ["-5", "0", "5"]


def test_interval_join_equals_brute_force(spark):
    left = spark.range(400).selectExpr(
        "id", "id % 3 AS k", "timestamp_millis(id * 137 % 5000 - 2500) AS lt")
    right = spark.range(300).selectExpr(
        "id AS rid", "id % 3 AS rk", "timestamp_millis(id * 211 % 5000 - 2500) AS rt")
    on = F.col("k") == F.col("rk")
    low, high = timedelta(milliseconds=-120), timedelta(milliseconds=45)
    got = joins.interval_join(left, right, on, "lt", "rt", low, high).select("id", "rid")
    gap = F.unix_millis("lt") - F.unix_millis("rt")
    want = left.join(right, on).where(gap.between(-120, 45)).select("id", "rid")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


ROUTE = dict(source_table="a", source_type="ALL", sink_table="dim_a", sink_type="dim",
             sink_columns="id,name", sink_pk="id", sink_extend=None)


def feed(spark, *changes):
    values = [json.dumps({"before": b, "after": a, "op": op, "ts_ms": i})
              for i, (op, b, a) in enumerate(changes)]
    frame = spark.createDataFrame([(v,) for v in values], "value string")
    return tables.read_table_changes(frame, schemas.ROUTE)


def route(**more):
    return {**ROUTE, **more}


def config(spark, *changes):
    rows = routing.apply_config_changes(feed(spark, *changes), "dim", F.col("ts_ms")).collect()
    return {r.source_table: r.sink_table for r in rows}


def test_config_changes(spark):
    assert config(spark, ("r", None, route()), ("c", None, route(source_table="b", sink_table="dim_b"))) == {
        "a": "dim_a", "b": "dim_b"}
    assert config(spark, ("c", None, route()), ("u", route(), route(sink_table="dim_x"))) == {"a": "dim_x"}
    assert config(spark, ("c", None, route()), ("d", route(), None)) == {}
    # A new key leaves the old one, as does another kind of sink.
    assert config(spark, ("c", None, route()), ("u", route(), route(source_table="z"))) == {"z": "dim_a"}
    assert config(spark, ("c", None, route()), ("u", route(), route(sink_type="dwd"))) == {}
    assert config(spark, ("c", None, route(sink_type="dwd"))) == {}


def routes(spark, *rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], schemas.ROUTE)


def test_dim_route(spark):
    frame = log(
        spark, message("a", "insert", {"id": 1, "name": "n", "type": "own", "secret": 2}),
        message("a", "delete", {"id": 2, "name": "m"}), message("b", "insert", {"id": 3}))
    got = routing.dim_route(frame, routes(spark, route(sink_columns="id,name,type", sink_pk=None)))
    rows = {r.row_key: r for r in got.collect()}
    assert set(rows) == {"1", "2"}
    assert rows["1"].payload == {"id": "1", "name": "n", "type": "own"}
    assert rows["1"].operation == "insert" and not rows["2"].removed
    kept = routing.dim_route(frame, routes(spark, route()), apply_deletes=True).collect()
    assert {r.row_key: r.removed for r in kept} == {"1": False, "2": True}


def test_fact_route_needs_the_operation(spark):
    frame = log(spark, message("a", "insert", {"id": 1, "name": None, "ts": "inner"}),
                message("a", "update", {"id": 2}))
    got = routing.fact_message(routing.fact_route(
        frame, routes(spark, route(source_type="insert", sink_type="dwd", sink_columns="id,name,ts"))))
    assert [json.loads(r.value) for r in got.collect()] == [{"id": "1", "ts": 100}]


def test_latest_per_key(spark):
    rows = spark.createDataFrame(
        [("a", 1, {"x": "1"}), ("a", 3, {"x": "3"}), ("b", 2, {"x": "2"}), ("a", 2, None)],
        "k string, n int, m map<string,string>")
    got = latest.latest_per_key(rows, ["k"], [F.col("n")]).orderBy("k").collect()
    assert [(r.k, r.n, r.m) for r in got] == [("a", 3, {"x": "3"}), ("b", 2, {"x": "2"})]


def test_dictionary_match_equals_brute_force(spark):
    words = ["ab", "b", "bca", "程序", "程序员", "员"]
    texts = {1: "abca ABCA", 2: "程序员", 3: "", 4: "😀ab", 5: None}
    rows = spark.createDataFrame(list(texts.items()), "id int, text string")
    vocabulary = spark.createDataFrame([(w,) for w in words], "word string")
    got = keywords.keyword_dictionary_match(rows, "text", vocabulary)
    want = {(i, p + 1, w) for i, t in texts.items() if t for w in words
            for p in range(len(t)) if t.lower().startswith(w, p)}
    found = [(r.id, r.position, r.word) for r in got.collect()]
    assert len(found) == len(want) and set(found) == want


def test_finest_words(spark):
    rows = spark.createDataFrame([(1, "Java程序员 好 v2")], "id int, text string")
    vocabulary = spark.createDataFrame([("程序",), ("程序员",)], "word string")
    got = keywords.keyword_finest(rows, "text", vocabulary)
    assert sorted(r.word for r in got.collect()) == sorted(["java", "程序", "程序员", "好", "v2"])


def test_dim_table_is_created_once(spark, tmp_path):
    home = writers.create_dim_if_absent(spark, str(tmp_path), "dim_a", "id,name", None, "SALT_BUCKETS = 4")
    spark.createDataFrame([("1", "n")], writers.dim_schema("id,name")).write.mode("append").parquet(home)
    assert writers.create_dim_if_absent(spark, str(tmp_path), "dim_a", "id,name") == home
    assert home.endswith("DIM_A") and spark.read.parquet(home).count() == 1
    assert writers.dim_schema("id,name", None, "X")["id"].metadata == {"primary_key": True, "extend": "X"}


def test_transient_columns_are_left_out(spark):
    frame = spark.range(1).select("id", writers.transient(F.lit(1), "note"))
    assert writers.without_transient(frame).columns == ["id"]


def test_shared_dir_follows_the_session(spark):
    assert session.shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
