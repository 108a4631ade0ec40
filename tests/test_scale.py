"""Plans under skew: a third of all rows on one key."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidemart import feeds, registry, session
from tidemart.operators import latest, traffic
from tidemart.plans import facts
from tidemart.sinks import writers
from tidemart.sources import page_log

# Small limits, so that adaptive execution treats test data as a cluster treats large data.
TINY = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def tiny(spark):
    before = {k: spark.conf.get(k, None) for k in TINY}
    for name, value in TINY.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def final_plan(frame) -> str:
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def hot_lines(spark, small):
    """The order lines with a third of them on one order."""
    raw = feeds.order_details(spark, small)
    hot = F.regexp_replace("value", '"order_id":\\d+', '"order_id":7')
    third = F.xxhash64("value") % 3 == 0
    # Several map tasks: a hot key of a single one cannot be split.
    return raw.withColumn("value", F.when(third, hot).otherwise(F.col("value"))).repartition(8)


def test_hot_order_is_split(tiny, small):
    log = registry.log_of(hot_lines(tiny, small), feeds.new_orders(tiny, small))
    lines = facts.placed_lines(log)
    assert "skewed" in final_plan(lines)
    assert lines.count() == feeds.table(tiny, small, "lineitem").count()


def test_hot_device_is_split(tiny):
    day = 86_400_000
    rows = [(i, json.dumps({"common": {"mid": "hot" if i % 3 == 0 else f"m{i}", "is_new": "1"},
                            "page": {"page_id": hashlib.sha256(b"%d" % i).hexdigest()}, "ts": (i % 5) * day}))
            for i in range(6000)]
    raw = tiny.createDataFrame(rows, "arrival bigint, value string").repartition(8)
    good, _ = page_log.split_dirty(page_log.parse_page_log(raw))
    fixed = traffic.visitor_flag_repair(good, "arrival")
    assert "skewed" in final_plan(fixed)
    got = {r.is_new: r.n for r in fixed.where("mid = 'hot'").groupBy("is_new").agg(
        F.count("*").alias("n")).collect()}
    same = sum(1 for i in range(0, 6000, 3) if i % 5 == 0)
    assert got == {"1": same, "0": 2000 - same}


def test_salted_join_is_whole(spark, small):
    log = registry.log_of(hot_lines(spark, small), feeds.new_orders(spark, small))
    plain, salted = facts.placed_lines(log), facts.placed_lines(log, salts=5)
    assert sorted(r.id for r in plain.collect()) == sorted(r.id for r in salted.collect())


def test_first_visits_combine_before_the_shuffle(spark, small):
    first = traffic.first_visits(registry.good_records(spark, small), "arrival")
    text = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in text and "SortAggregate" not in text


def test_copies_of_one_side_do_not_multiply(spark, small):
    once = registry.log_of(feeds.order_details(spark, small), feeds.order_updates(spark, small))
    copies = registry.log_of(feeds.order_details(spark, small), *[feeds.order_updates(spark, small)] * 3)
    assert facts.cancelled_lines(copies).count() == facts.cancelled_lines(once).count() > 0


def test_filters_and_columns_reach_the_scan(spark, small):
    paid = registry.QUERIES["payment_success_filter"](spark, small)
    plan = paid._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,purchase)" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in plan


def test_other_tables_are_not_read(spark, small):
    log = registry.trade_log(spark, small)
    plan = facts.activities(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_latest_combines_before_the_shuffle(spark, small):
    events = feeds.table(spark, small, "events")
    plan = latest.latest_per_key(events, ["user_id"], [F.col("event_id")])
    assert "partial_max_by" in plan._jdf.queryExecution().executedPlan().toString()


def test_shuffles_grow_with_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    cores = spark.sparkContext.defaultParallelism
    gigabyte = 1024 ** 3
    assert session.size_shuffles(spark, 1) == cores
    assert session.size_shuffles(spark, 1000 * gigabyte) == 2000
    assert session.size_shuffles(spark, 100_000 * gigabyte) == 200_000
    assert session.size_shuffles(spark, gigabyte) == 200_000
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_destination_is_rebalanced(tiny, tmp_path):
    rows = tiny.range(20000).repartition(8).selectExpr(
        "if(id % 3 = 0, 'hot', concat('t', id % 7)) AS sink_table", "sha2(string(id), 256) AS value")
    writers.write_by_destination(rows, str(tmp_path / "out"))
    files = {p.name: len(list(p.glob("*.txt"))) for p in (tmp_path / "out").iterdir() if p.is_dir()}
    assert files["sink_table=hot"] > 1
    assert tiny.read.text(str(tmp_path / "out")).count() == 20000
