"""What large inputs would cost: partitions of state, copies on disk, passes over messages. On rows of the tests' own."""

import pytest
from pyspark.sql import functions as F

from tidemart import feeds, registry, session
from tidemart.operators import slices
from tidemart.plans import facts
from tidemart.sinks.keyed import KeyedTable
from tidemart.streaming import jobs
from stream_files import rows


@pytest.fixture
def shop(spark, tmp_path):
    """Orders, their lines (some twice, some without an order) and the tables of names."""
    path = tmp_path / "shop"
    day = "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id % 9 AS int))"
    made = {
        "orders": spark.range(60).selectExpr(
            "if(id % 20 = 0, null, id) AS o_orderkey", "id % 7 AS o_custkey", "element_at(array('F', 'P', 'O'), cast(id % 3 + 1 AS int)) AS o_orderstatus",
            "100.5 * id AS o_totalprice", f"{day} AS o_orderdate", "'5-LOW' AS o_orderpriority"),
        "lineitem": spark.range(300).selectExpr("if(id < 280, id, id - 20) AS id").selectExpr(
            "if(id % 50 = 0, null, id % 70) AS l_orderkey", "id % 11 AS l_partkey", "id % 13 AS l_suppkey", "cast(id AS int) AS l_linenumber",
            "cast(id % 5 + 1 AS double) AS l_quantity", "10.25 * id AS l_extendedprice", "(id % 10) / 100 AS l_discount", "0.01D AS l_tax",
            "if(id % 4 = 0, 'R', 'N') AS l_returnflag", "'O' AS l_linestatus", f"{day} AS l_shipdate"),
        "nation": spark.range(25).selectExpr("cast(id AS int) AS n_nationkey", "concat('n', id) AS n_name"),
        "region": spark.range(5).selectExpr("cast(id AS int) AS r_regionkey", "concat('r', id) AS r_name")}
    for name, frame in made.items():
        frame.coalesce(1).write.parquet(str(path / f"{name}.parquet"))
    return str(path)


@pytest.fixture
def folders(monkeypatch, tmp_path):
    made = []

    def shared(_, purpose):
        made.append(tmp_path / f"{len(made)}-{purpose}")
        return str(made[-1])
    monkeypatch.setattr(session, "shared_dir", shared)
    return made


def left(made) -> list[str]:
    return sorted(p.name.partition("-")[2] for p in made if p.exists())


@pytest.fixture
def many(spark):
    """A session with many more shuffle partitions than the input needs."""
    before = spark.conf.get(session.PARTITIONS)
    spark.conf.set(session.PARTITIONS, "300")
    yield 300
    spark.conf.set(session.PARTITIONS, before)


def test_state_is_partitioned_by_the_input(spark, shop, many, monkeypatch):
    seen = []
    job = jobs.lines_job

    def lines_job(*args):
        seen.append(int(spark.conf.get(session.PARTITIONS)))
        return job(*args)
    monkeypatch.setattr(jobs, "lines_job", lines_job)
    out = registry.QUERIES["stream_order_detail"](spark, shop)
    assert seen == [2 * spark.sparkContext.defaultParallelism]
    assert spark.conf.get(session.PARTITIONS) == str(many)
    assert spark.conf.get(session.CLEANUP) == "false"
    assert rows(out) == rows(facts.dwd_order_detail(registry.trade_log(spark, shop), feeds.dictionary(spark, shop), feeds.DATABASE))


def test_state_grows_in_partitions(spark):
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get(session.PARTITIONS)
    with session.streaming(spark, 10 * cores * session.STATE_BYTES, 5000 * session.SHUFFLE_BYTES):
        assert spark.conf.get(session.PARTITIONS) == str(10 * cores)
    assert spark.conf.get(session.PARTITIONS) == "5000"
    spark.conf.set(session.PARTITIONS, before)


def test_stored_rows_are_sorted_once(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    for batch in range(3):
        table.merge(spark.range(batch, batch + 50).selectExpr("string(id) AS id", f"'{batch}' AS v"), batch)
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("partial_max_by") < plan.index("Exchange")
    assert {r.id: r.v for r in table.read().collect()} == {
        str(i): str(max(b for b in range(3) if b <= i < b + 50)) for i in range(52)}


def test_a_message_is_parsed_by_its_own_table_only(spark, shop, monkeypatch):
    landed = []
    ordered = registry.ordered_stream

    def ordered_stream(spark, raw, *args, **named):
        landed.append(raw.columns)
        return ordered(spark, raw, *args, **named)
    monkeypatch.setattr(registry, "ordered_stream", ordered_stream)
    out = registry.QUERIES["state_ttl"](spark, shop)
    assert landed == [["src_table", "value"]]
    log = registry.log_of(feeds.order_details(spark, shop), feeds.detail_activities(spark, shop), feeds.detail_coupons(spark, shop))
    wide = facts.with_promotions(facts.order_lines(log), facts.activities(log), facts.coupons(log))
    assert rows(out) == rows(wide.select("id", "activity_id", "coupon_id"))


def test_cancellations_leave_only_their_table(spark, shop, folders):
    out = registry.QUERIES["stream_order_cancel"](spark, shop)
    assert left(folders) == ["fact"]
    assert rows(out) == rows(facts.dwd_order_cancel(registry.trade_log(spark, shop))) != []


@pytest.mark.parametrize("name", ["stream_refund", "stream_refund_pay", "state_ttl", "stream_order_detail"])
def test_streams_leave_only_their_table(spark, shop, folders, name):
    registry.QUERIES[name](spark, shop).count()
    assert left(folders) == ["fact"]


def test_a_join_of_streams_has_one_store_a_partition(spark, shop, folders, monkeypatch):
    monkeypatch.setattr(session, "remove", lambda *_: None)
    out = registry.QUERIES["stream_refund_pay"](spark, shop)
    stores = {p.name for made in folders if made.name.endswith("-ck") for p in made.glob("state/*/0/*") if p.is_dir()}
    assert not any("keyToNumValues" in s for s in stores)
    batch = registry.QUERIES["dwd_refund_pay_success"](spark, shop)
    assert rows(out) == rows(batch) != []


def test_slices_give_what_the_whole_gives(spark, folders):
    a = spark.range(500).selectExpr("if(id % 9 = 0, null, string(id % 40)) AS k", "id AS x")
    b = spark.range(60).selectExpr("if(id % 9 = 0, null, string(id)) AS k2", "id AS y").where("y % 2 = 0")

    def build(left_rows, right_rows):
        return left_rows.join(right_rows, F.col("k").eqNullSafe(F.col("k2")), "left").select("k", "x", "y")
    whole = rows(build(a, b))
    first = slices.by_slices([slices.stored(a, "k", 5), slices.Scanned(b, "k2", 5)], build, "x")
    again = slices.by_slices([first], lambda r: r)
    assert rows(again) == whole
    assert left(folders) == ["facts"]


def test_order_details_go_slice_by_slice(spark, shop, folders, monkeypatch):
    asked = []
    add = slices.Stored.add
    monkeypatch.setattr(slices.Stored, "add", lambda self, frame: asked.append(self.key) or add(self, frame))
    out = registry.QUERIES["dwd_order_detail"](spark, shop)
    assert {"order_id", "_order", "id", "order_detail_id"} == set(asked) and left(folders) == ["facts"]
    assert rows(out) == rows(facts.dwd_order_detail(registry.trade_log(spark, shop), feeds.dictionary(spark, shop), feeds.DATABASE)) != []


def test_landed_cancellations_go_slice_by_slice(spark, shop, folders):
    out = registry.QUERIES["landed_log"](spark, shop)
    assert left(folders) == ["facts", "log"]
    assert rows(out) == rows(facts.dwd_order_cancel(registry.trade_log(spark, shop))) != []


def test_slices_leave_no_shuffles(spark, folders):
    before = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()
    a = slices.stored(spark.range(1000).selectExpr("string(id % 50) AS k"), "k", 4)
    out = slices.by_slices([a], lambda r: r.groupBy("k").agg(F.count("*").alias("n")))
    assert spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size() <= before
    assert out.count() == 50
