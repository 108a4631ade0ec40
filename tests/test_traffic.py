"""Page log: dirty records, flag repair branch by branch, and the split."""

import json

from pyspark.sql import functions as F

from tidemart.operators import traffic
from tidemart.plans import warehouse
from tidemart.sources import page_log

DAY = 86_400_000
NOON = 20_000 * DAY + DAY // 2


def record(mid="m", is_new="0", ts=NOON, **more):
    common = {"mid": mid, "ar": "1"}
    if is_new is not None:
        common["is_new"] = is_new
    return json.dumps({"common": common, "ts": ts, **more})


def raw(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "arrival bigint, value string")


def parsed(spark, *values):
    return page_log.parse_page_log(raw(spark, *values))


def test_dirty_records(spark):
    bad = ["", "not json", '{"common":{"mid":"m"},"ts":', '{"common":{"mid":"m"},"ts":1} tail',
           "[1]", "7", "null", '{"page":{}}', '{"common":{},"ts":1}', '{"common":{"mid":"m"}}',
           '{"common":{"mid":"m"},"ts":"soon"}']
    good = [record(), "  " + record(mid="n") + "\r", record(mid="o", ts=str(NOON))]
    frame = parsed(spark, *bad, None, *good)
    ok, dirty = page_log.split_dirty(frame)
    assert sorted(r.value for r in dirty.collect()) == sorted(bad)
    assert sorted((r.mid, r.ts) for r in ok.collect()) == [("m", NOON), ("n", NOON), ("o", NOON)]


def repaired(spark, *flags_and_days):
    values = [record(is_new=f, ts=NOON + d * DAY) for f, d in flags_and_days]
    out = traffic.visitor_flag_repair(parsed(spark, *values), "arrival").orderBy("arrival").select(
        "is_new", F.col("common")["is_new"].cast("string").alias("inner")).collect()
    assert all(r.is_new == r.inner for r in out)
    return [r.is_new for r in out]


def test_flag_repair_branches(spark):
    # New without state stays, new on the same day stays, new on another day is cleared.
    assert repaired(spark, ("1", 0), ("1", 0), ("1", 1)) == ["1", "1", "0"]
    # Old without state leaves the day before: new on that day of all days stays.
    assert repaired(spark, ("0", 0), ("1", 0), ("1", -1)) == ["0", "0", "1"]
    # Old with state changes nothing.
    assert repaired(spark, ("1", 0), ("0", 3), ("1", 0)) == ["1", "0", "1"]
    # A missing flag counts as old.
    assert repaired(spark, (None, 0), ("1", 0)) == [None, "0"]
    # Arrival decides, not time.
    assert repaired(spark, ("1", 5), ("1", 0)) == ["1", "0"]


def outputs(spark, *values):
    got = {}
    frame = warehouse.dwd_traffic_log(parsed(spark, *values), "arrival")
    for row in frame.collect():
        got.setdefault(row.output, []).append(row.value)
    return got


def test_split_of_page_with_error(spark):
    page = record(
        page={"page_id": "home", "during_time": 5, "item": None},
        displays=[{"item": "1", "pos_id": 4}, {"item": "2", "pos_id": 4}],
        actions=[{"action_id": "favor", "ts": 3}], err={"error_code": 9, "msg": "x"},
        trace_id="t", extra={"n": [1, 2.5, None]}, nothing=None)
    got = {k: [json.loads(v) for v in vs] for k, vs in outputs(spark, page).items()}
    common, shown = {"mid": "m", "ar": "1", "is_new": "0"}, {"page_id": "home", "during_time": 5}
    more = {"trace_id": "t", "extra": {"n": [1, 2.5, None]}}
    assert got["page"] == [{"common": common, "page": shown, "ts": NOON, **more}]
    assert sorted(d["display"]["item"] for d in got["display"]) == ["1", "2"]
    assert all(d["ts"] == NOON and d["common"] == common for d in got["display"])
    assert got["action"] == [
        {"common": common, "page": shown, "action": {"action_id": "favor", "ts": 3}}]
    assert got["error"][0]["err"] == {"error_code": 9, "msg": "x"} and "displays" in got["error"][0]
    assert got["error"][0]["extra"] == more["extra"]
    assert "start" not in got and "dirty" not in got


def test_split_of_start_and_empty_lists(spark):
    start = record(start={"entry": "icon"}, displays=[{"item": "1"}])
    empty = record(mid="e", page={"page_id": "p"}, displays=[])
    got = outputs(spark, start, empty, "broken")
    assert json.loads(got["start"][0])["start"] == {"entry": "icon"}
    assert json.loads(got["page"][0])["displays"] == []
    assert got["dirty"] == ["broken"]
    assert set(got) == {"start", "page", "dirty"}


def test_landed_log_gives_the_same(spark, tmp_path):
    lines = raw(spark, record(is_new="1"), record(is_new="1", ts=NOON + DAY), "broken",
                record(page={"page_id": "p"}, err={"msg": "x"}))
    page_log.land_page_log(lines, str(tmp_path / "log"))
    landed = warehouse.dwd_traffic_log(spark.read.parquet(str(tmp_path / "log")), "arrival")
    direct = warehouse.dwd_traffic_log(page_log.parse_page_log(lines), "arrival")
    assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, direct.collect()))


def test_explodes_skip_start_and_missing(spark):
    frame = parsed(spark, record(start={"a": "b"}, displays=[{"item": "1"}]), record(), record(
        page={"page_id": "p"}, displays=[{"item": "2"}], actions=[]))
    good, _ = page_log.split_dirty(frame)
    assert [r.display["item"].toPython() for r in traffic.explode_displays(good).collect()] == ["2"]
    assert traffic.explode_actions(good).count() == 0
    assert "ts" not in traffic.explode_actions(good).columns


def test_page_view_time(spark):
    view = page_log.read_page_view(raw(spark, record(ts=1500, page={"item": "x"})))
    assert view.select(F.date_format("rt", "ss.SSS")).first()[0] == "01.500"
