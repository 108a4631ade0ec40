"""Jobs beside the fact tables: traffic log, keyword windows, dimensions, simple facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions import predicates, scalars
from tidemart.operators import keywords, latest, routing, traffic
from tidemart.schemas import ROUTE
from tidemart.sources import tables


def dwd_traffic_log(parsed: DataFrame, arrival: str) -> DataFrame:
    """Parsed page log to dirty, error, start, page, display and action records.

    The log is read three times: for the first visits, for records that cannot change, and
    for those flagged new. On a large log land it first (``page_log.land_page_log``), so that
    the text is parsed once and the first pass reads three columns.
    """
    return traffic.log_split(traffic.visitor_flag_repair(parsed, arrival))


def search_words(page_view: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Words of all searches with their event time; with a dictionary (a batch only) the finest ones."""
    found = predicates.searches(page_view).select(F.col("page")["item"].alias("item"), "rt")
    if dictionary is not None:
        return keywords.keyword_finest(found, "item", dictionary)
    return keywords.keyword_split(found, "item")


def dws_keyword_window(page_view: DataFrame, width: str = "10 seconds", dictionary: DataFrame | None = None) -> DataFrame:
    """Searched words per window. ``ts`` is the second of the write."""
    return word_windows(search_words(page_view, dictionary), width)


def word_windows(words: DataFrame, width: str = "10 seconds") -> DataFrame:
    return keywords.keyword_tumbling_count(words, width=width).withColumn("ts", scalars.write_second())


def current_routes(feed: DataFrame, sink_type: str) -> DataFrame:
    """Routing rows after the configuration table's change feed."""
    changes = tables.read_table_changes(feed, ROUTE)
    return routing.apply_config_changes(changes, sink_type, F.col("ts_ms"))


def dim_rows(log: DataFrame, routes: DataFrame, apply_deletes: bool = False) -> DataFrame:
    """Changes of dimension tables with their destination."""
    return routing.dim_route(predicates.without_bootstrap_markers(log), routes, apply_deletes)


def dim_tables(log: DataFrame, routes: DataFrame, apply_deletes: bool = False) -> DataFrame:
    """Content of all dimension tables: the last row of each key."""
    rows = dim_rows(log, routes, apply_deletes)
    last = latest.latest_per_key(rows, ["sink_table", "row_key"], [F.col("seq")])
    return last.where(~F.col("removed")).select("sink_table", "row_key", "payload")


def dwd_simple_facts(log: DataFrame, routes: DataFrame) -> DataFrame:
    """Configured facts as destination and JSON text."""
    return routing.fact_message(routing.fact_route(predicates.without_bootstrap(log), routes))
