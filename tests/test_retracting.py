"""The retracting left join with time to live: pads first, retracts, forgets."""

import json
import random
from datetime import timedelta

import pandas as pd
import pyarrow as pa

from tidemart.plans import facts
from tidemart.sinks import writers
from tidemart.sinks.keyed import KeyedTable
from tidemart.sources import change_log
from tidemart.streaming import jobs, retracting
from stream_files import finish, put, text_stream

TTL = timedelta(seconds=910)


def message(table, ts, offset=0, **data):
    return json.dumps({"database": "shop", "table": table, "type": "insert", "ts": ts, "xoffset": offset, "data": data})


def line(key, ts, sku="s", offset=0):
    return message("order_detail", ts, offset, id=key, order_id="o", sku_id=sku)


def activity(key, ts, name, offset=0):
    return message("order_detail_activity", ts, offset, order_detail_id=key, activity_id=name, activity_rule_id="r")


def coupon(key, ts, name, offset=0):
    return message("order_detail_coupon", ts, offset, order_detail_id=key, coupon_id=name, coupon_use_id="u")


def joined(spark, folder):
    log = change_log.read_change_log(text_stream(spark, folder))
    lines = facts.order_lines(log).select("id", "sku_id", "ts", "seq")
    return retracting.retracting_join(lines, facts.activities(log), facts.coupons(log), TTL, "1000 seconds", buckets=8)


def emitted(spark, folder, tmp_path):
    """Rows (id, sku, activity, coupon, retracts) of each micro-batch."""
    out = str(tmp_path / "out")
    finish(writers.start(joined(spark, folder), lambda b, n: b.write.mode("overwrite").parquet(f"{out}/batch={n}"), str(tmp_path / "ck")))
    found = {}
    for r in spark.read.parquet(out).collect():
        found.setdefault(r.batch, set()).add((r.id, r.sku_id, r.activity_id, r.coupon_id, r.retracts))
    return [found.get(n, set()) for n in range(max(found) + 1)]


def held(spark, checkpoint):
    """Ids in the state, out of the buckets' tables."""
    state = spark.read.format("statestore").option("stateVarName", "held").load(checkpoint)
    return [x for r in state.select("value.parts").collect() for x in pa.ipc.open_stream(bytes(r.parts)).read_pandas()["id"]]


def test_pads_retracts_and_forgets(spark, tmp_path):
    folder = put(tmp_path / "in", [
        [line("1", 1000), line("2", 1000), activity("3", 990, "A3"), line(None, 1000), activity(None, 1000, "none")],
        [activity("1", 1200, "A1", 1), coupon("1", 1910, "C1"), activity("1", 1100, "older")],
        # Line 3 after its activity; line 2's comes too late; a message sent again changes nothing.
        [line("3", 1100), activity("2", 1911, "late"), coupon("1", 1910, "C1")],
        # A line's later message takes its place; what is past its time is gone.
        [line("3", 1100, "other", 5), activity("4", 1900, "A4")],
        [line("end", 90_000)], [line("end2", 95_000)],
        [line("4", 95_001), activity("4", 95_000, "A4 again")]])
    got = emitted(spark, folder, tmp_path)
    assert got[0] == {("1", "s", None, None, False), ("2", "s", None, None, False)}
    assert got[1] == {("1", "s", "A1", "C1", True)}
    assert got[2] == {("3", "s", "A3", None, False)}
    assert got[3] == {("3", "other", "A3", None, True)}
    assert got[6] == {("4", "s", "A4 again", None, False)}
    assert set(held(spark, str(tmp_path / "ck"))) <= {"4", "end", "end2"}


def test_state_does_not_grow_with_the_stream(spark, tmp_path):
    """Of 1,500 lines over 30 time spans the state holds the last ones' only."""
    files = [[x for i in range(50) for x in (line(f"{n}-{i}", 1000 * n + 1000), activity(f"{n}-{i}", 1000 * n + 1005, "A"))] for n in range(30)]
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    log = change_log.read_change_log(text_stream(spark, put(tmp_path / "in", files)))
    finish(jobs.retracting_job(facts.order_lines(log), facts.activities(log), facts.coupons(log), table, str(tmp_path / "ck"), TTL))
    assert table.read().where("activity_id = 'A'").count() == 1_500
    assert len(held(spark, str(tmp_path / "ck"))) <= 2 * 50 * 4


def test_batches_do_not_matter():
    """Parts dealt over batches in any way end in what a plain loop over all of them gives."""
    rng = random.Random(2)
    for _ in range(50):
        parts = [("line", str(i % 4), 100 * i, i) for i in range(4)]
        parts += [(rng.choice(retracting.KINDS[1:]), str(rng.randrange(5)), rng.randrange(0, 900), i + 10) for i in range(25)]
        rows = pd.DataFrame([{"id": i, "kind": k, "at": at, "rank": f"{n:05d}", "body": f"{k}{n}"} for k, i, at, n in parts])
        state = rows.iloc[:0]
        cuts = sorted(rng.sample(range(len(rows)), 3))
        for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            state = retracting.last_parts(state, rows.iloc[a:b].sample(frac=1, random_state=1), 300)
        want = {}
        for k, i, at, n in parts[:4]:
            best = {kind: max(((m, f"{kind}{m}") for kind2, j, t, m in parts if kind2 == kind and j == i and abs(t - at) <= 300), default=(0, None))[1]
                    for kind in retracting.KINDS[1:]}
            want[i] = (f"{k}{n}", best["activity"], best["coupon"])
        out = retracting.joined(state)
        assert {i: tuple(None if x != x else x for x in r) for i, *r in out.astype(object).itertuples()} == want
