"""Messages meet the routes of their own time."""

import json

from pyspark.sql import functions as F

from tidemart.operators import routing
from tidemart.plans import warehouse
from tidemart.schemas import ROUTE
from tidemart.sinks.dimensions import DimensionTables
from tidemart.sinks.keyed import KeyedTable
from tidemart.sources import change_log, tables
from tidemart.streaming import jobs
from stream_files import finish, put, text_stream


def route(table, sink, columns="id", sink_type="dim", source_type="ALL"):
    return {"source_table": table, "source_type": source_type, "sink_table": sink, "sink_type": sink_type,
            "sink_columns": columns, "sink_pk": "id", "sink_extend": None}


def change(op, at, before=None, after=None):
    return json.dumps({"before": before, "after": after, "op": op, "ts_ms": at})


def message(table, ts, key, kind="insert"):
    return json.dumps({"database": "shop", "table": table, "type": kind, "ts": ts, "data": {"id": key, "name": "n"}})


A, B, C = route("t", "dim_a"), route("t", "dim_b", "id,name"), route("u", "dim_c")
FEED = [change("r", 999_000_000, after=A), change("u", 100_000, A, B), change("d", 200_000, B), change("c", 300_500, after=A),
        change("c", 150_000, after=C), change("u", 250_000, C, {**C, "source_table": "v"})]
LOG = [message("t", 50, "1"), message("t", 99, "2"), message("t", 100, "3"), message("t", 199, "4"), message("t", 200, "5"),
       message("t", 299, "6"), message("t", 300, "7"), message("u", 100, "8"), message("u", 150, "9"), message("u", 250, "10"),
       message("v", 249, "11"), message("v", 250, "12"), message("t", None, "13")]
WANT = [("dim_a", "1"), ("dim_a", "13"), ("dim_a", "2"), ("dim_a", "7"), ("dim_b", "3"), ("dim_b", "4"), ("dim_c", "12"), ("dim_c", "9")]


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_batch(spark):
    writes = routing.route_writes(tables.read_table_changes(frame(spark, FEED), ROUTE), routing.DIM)
    versions = routing.route_versions(writes, routing.DIM)
    rows = warehouse.dim_rows(change_log.read_change_log(frame(spark, LOG)), versions)
    assert sorted((r.sink_table, r.row_key) for r in rows.collect()) == WANT
    named = {r.row_key for r in rows.where(F.map_contains_key("payload", "name")).collect()}
    assert named == {"3", "4"}


def test_facts_by_table_and_operation(spark):
    x, y = route("t", "dwd_x", sink_type="dwd", source_type="insert"), route("t", "dwd_y", sink_type="dwd", source_type="update")
    feed = [change("c", 100_000, after=x), change("c", 100_000, after=y), change("u", 200_000, x, {**x, "sink_table": "dwd_z"})]
    log = [message("t", 99, "1"), message("t", 100, "2"), message("t", 200, "3"), message("t", 200, "4", "update")]
    versions = routing.route_versions(routing.route_writes(tables.read_table_changes(frame(spark, feed), ROUTE), routing.FACT), routing.FACT)
    got = routing.fact_route(change_log.read_change_log(frame(spark, log)), versions)
    assert sorted((r.sink_table, r.payload["id"]) for r in got.collect()) == [("dwd_x", "2"), ("dwd_y", "4"), ("dwd_z", "3")]


def test_two_messages_of_one_batch_meet_two_routes(spark, tmp_path):
    """A route changes between two messages that one micro-batch brings; the feed's files come in any order."""
    history = KeyedTable(spark, str(tmp_path / "routes"), routing.HISTORY_KEYS, compact_every=2)
    feed = text_stream(spark, put(tmp_path / "feed", [FEED[3:], FEED[:2], FEED[2:3]]))
    finish(jobs.route_history_job(feed, routing.DIM, history, str(tmp_path / "ck")))
    table = KeyedTable(spark, str(tmp_path / "dims"), ["sink_table", "row_key"])
    log = change_log.read_change_log(text_stream(spark, put(tmp_path / "log", [LOG])))
    finish(jobs.dim_job(log, lambda: routing.route_versions(history.read(), routing.DIM), table, str(tmp_path / "ck2")))
    assert sorted((r.sink_table, r.row_key) for r in table.read().collect()) == WANT


def test_routed_facts_keep_their_json_types(spark):
    data = {"id": 7, "price": 1.50, "name": "n", "paid": True, "note": None, "tags": ["a", 1], "ts": 5, "other": 1}
    text = json.dumps({"database": "shop", "table": "t", "type": "insert", "ts": 300, "data": data})
    routes = spark.createDataFrame([tuple(route("t", "dwd_t", "id,price,name,paid,note,tags,ts", "dwd", "insert").values())], ROUTE)
    got = {}
    for typed in (True, False):
        log = change_log.read_change_log(frame(spark, [text]), typed=typed)
        got[typed] = json.loads(warehouse.dwd_simple_facts(log, routes).first().value)
    assert got[True] == {"id": 7, "price": 1.5, "name": "n", "paid": True, "tags": ["a", 1], "ts": 300}
    assert got[False] == {"id": "7", "price": "1.5", "name": "n", "paid": "true", "tags": '["a",1]', "ts": 300}


def test_tables_come_with_their_routes_and_grow(spark, tmp_path):
    """A route added mid-stream has its table before its first row; a column added later is null in earlier rows."""
    dims, folder = DimensionTables(spark, str(tmp_path / "dims"), compact_every=2), tmp_path / "feed"
    config = {"now": spark.createDataFrame([tuple(route("t", "dim_t").values())], ROUTE)}

    def configure(*texts):
        finish(jobs.dim_catalog_job(text_stream(spark, put(folder, [list(texts)])), dims, str(tmp_path / "ck")))

    def write(*texts):
        log = change_log.read_change_log(text_stream(spark, put(tmp_path / "log", [list(texts)])))
        finish(jobs.dim_job(log, lambda: config["now"], dims.rows, str(tmp_path / "ck2")))

    old, wide = route("t", "dim_t"), route("t", "dim_t", "id,name")
    configure(change("r", 1, after=old))
    assert dims.tables() == ["dim_t"] and dims.read("dim_t").columns == ["id"] and dims.read("dim_t").count() == 0
    write(message("t", 50, "1"))
    configure(change("u", 60_000, old, wide), change("c", 70_000, after=route("u", "dim_u", "id,x")))
    assert dims.tables() == ["dim_t", "dim_u"] and dims.read("dim_u").count() == 0
    config["now"] = spark.createDataFrame([tuple(wide.values()), tuple(route("u", "dim_u", "id,x").values())], ROUTE)
    write(message("t", 100, "2"), message("u", 100, "9"))
    assert sorted(map(tuple, dims.read("dim_t").collect())) == [("1", None), ("2", "n")]
    assert [tuple(r) for r in dims.read("dim_u").collect()] == [("9", None)]
    # The same row again, or one with fewer columns, makes no version; the key stays marked.
    configure(change("u", 80_000, wide, wide), change("u", 90_000, wide, old))
    assert [v.fieldNames() for v in dims.versions("dim_t")] == [["id"], ["id", "name"]]
    assert dims.versions("dim_t")[-1]["id"].metadata == {"primary_key": True}
