"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Every query runs to its last row.
"""

from __future__ import annotations

import json
import os
import time

import pyspark

from tidemart import feeds, registry
from tidemart.session import build_session

HEADLINE = [
    "dwd_traffic_log", "dwd_comment_info", "dwd_cart_add", "dwd_order_detail", "dwd_order_cancel",
    "dwd_pay_success", "dwd_pay_any_status_day", "dwd_order_refund", "dwd_refund_pay_success",
    "dwd_simple_facts", "dim_tables", "dws_keyword_window", "emp_dept_interval",
    "visitor_flag_repair", "apply_config_changes", "snapshot_changelog_table",
    "keyword_dictionary_match", "stream_traffic_log", "stream_refund", "stream_order_detail",
    "upsert_by_key", "write_by_destination",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, feeds.FEED_PARTITIONS: cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    # Every query runs twice and the second run counts: class loading and code generation are not
    # what is measured.
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "wall time of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "shuffle_partitions": int(cpus), "spark": pyspark.__version__}))
    spark.stop()


if __name__ == "__main__":
    main()
