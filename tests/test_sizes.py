"""What jobs write, shuffle and read at once, as the tables grow."""

import json

from pyspark.sql import functions as F

from tidemart import feeds, registry, session
from tidemart.plans import facts
from tidemart.sources import change_log
from stream_files import texts


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def folders(spark, monkeypatch, tmp_path) -> list:
    """The shared folders that are asked for from now on."""
    made = []

    def shared(_, purpose):
        made.append(tmp_path / f"{len(made)}-{purpose}")
        return str(made[-1])
    monkeypatch.setattr(session, "shared_dir", shared)
    return made


def message_times(spark, path) -> list[tuple[float, float]]:
    """First and last place of each file, in the order in which a stream reads them."""
    out = []
    for file in sorted(path.glob("*.parquet"), key=lambda p: p.stat().st_mtime):
        places = [json.loads(v)["ts"] for v in texts(spark.read.parquet(str(file)))]
        known = [p for p in places if p is not None]
        out.append((min(known, default=-1), max(known, default=-1)))
    return out


def disordered(spark, n=3000):
    rows = [(json.dumps({"ts": None if i % 100 == 0 else (i * 7919) % n}),) for i in range(n)]
    return spark.createDataFrame(rows, "value string").repartition(5)


def test_ordered_input_is_landed_once_and_in_order(spark, monkeypatch, tmp_path):
    made = folders(spark, monkeypatch, tmp_path)
    raw = disordered(spark)
    registry.ordered_stream(spark, raw, "in", registry.json_number("$.ts"))
    assert [p.name for p in made] == ["0-in"]
    times = message_times(spark, made[0])
    assert len(times) >= 12
    assert all(a[1] <= b[0] for a, b in zip(times, times[1:], strict=False))
    assert sorted(texts(spark.read.parquet(str(made[0])))) == sorted(texts(raw))


def test_ordered_input_grows_in_files_not_in_their_size(spark, monkeypatch, tmp_path):
    made = folders(spark, monkeypatch, tmp_path)
    monkeypatch.setattr(registry, "FILE_BYTES", 2000)
    path = str(tmp_path / "raw")
    disordered(spark).write.parquet(path)
    registry.ordered_stream(spark, spark.read.parquet(path), "in", registry.json_number("$.ts"))
    assert len(list(made[0].glob("*.parquet"))) > 30
    quarter = registry.SLICE_BYTES // 4
    assert registry.bounded(16, 1000) == {"maxFilesPerTrigger": "4"}
    assert registry.bounded(4000, 4000 * quarter) == {"maxFilesPerTrigger": "4"}
    assert registry.bounded(4000, 1000 * quarter) == {"maxFilesPerTrigger": "16"}


def test_files_are_written_again_where_times_cannot_be_set(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(0, 400).repartitionByRange(4, "id").write.parquet(path)
    before = sorted(p.name for p in (tmp_path / "t").glob("*.parquet"))
    monkeypatch.setattr(session, "stamp", lambda *a: None)
    session.in_name_order(spark, path)
    files = sorted((tmp_path / "t").glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
    assert not set(before) & {p.name for p in files}
    assert [spark.read.parquet(str(f)).agg(F.min("id")).first()[0] for f in files] == [0, 100, 200, 300]


def test_landing_a_log_shuffles_nothing(spark, small, tmp_path, monkeypatch):
    raw = feeds.union(feeds.order_details(spark, small), feeds.comments(spark, small)).select("value")
    seen = []
    hint = type(raw).hint
    monkeypatch.setattr(type(raw), "hint", lambda self, name, *a: seen.append(name) or hint(self, name, *a))
    change_log.land_change_log(raw, str(tmp_path / "a"))
    assert seen == []
    change_log.land_change_log(raw, str(tmp_path / "b"), gather=True)
    assert seen == ["rebalance"]
    a, b = (change_log.read_landed_log(spark, str(tmp_path / p)) for p in "ab")
    kinds = [{r[0]: r[1] for r in x.groupBy("src_table").count().collect()} for x in (a, b)]
    assert kinds[0] == kinds[1] and len(kinds[0]) == 2


def test_cancellations_carry_only_their_own_columns(spark, small):
    log = registry.log_of(feeds.order_details(spark, small), feeds.order_changes(spark, small))
    assert not {"source_type", "source_id", "create_time", "order_price"} & set(facts.cancelled_lines(log).columns)


def test_batches_are_sized_for_messages_and_streams_for_slices(spark, small, monkeypatch):
    asked = []
    monkeypatch.setattr(session, "size_shuffles", lambda _, size: asked.append(size))
    registry.QUERIES["read_olap_table"](spark, small)
    size = session.input_bytes(spark, small)
    assert asked == [registry.EXPANSION * size]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(registry.TASK_BYTES)

    def stream_of_nothing(spark, d):
        return spark.range(0)
    registry.stream_query(stream_of_nothing)
    registry.QUERIES.pop("stream_of_nothing")(spark, small)
    assert asked[1:] == [size]


def test_events_are_dealt_before_they_become_records(spark, small):
    plan = plan_of(feeds.page_log(spark, small))
    assert "RoundRobinPartitioning" in plan
    assert plan.index("Project") < plan.index("RoundRobinPartitioning") < plan.index("FileScan")
