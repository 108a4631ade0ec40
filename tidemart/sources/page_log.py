"""The page log and the page view derived from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.functions import scalars
from tidemart.sources import messages


def _without_nulls(values: Column) -> Column:
    return F.map_filter(values, lambda k, v: ~F.is_variant_null(v))


def parse_page_log(raw: DataFrame) -> DataFrame:
    """Parsed records with ``mid``, ``is_new``, ``ts`` and the flag ``dirty``.

    ``rest`` holds a record's fields of other names, if it has any; only then are they parsed.

    A record is dirty when it is no JSON object, or when its device ``common.mid`` or
    its time cannot be read. ``value`` stays beside the parsed fields, so that the dirty
    output and the good one come from one pass.
    """
    others = [c for c in raw.columns if c != "value"]
    text = F.btrim("value", F.lit(" \t\r\n"))
    whole = text.startswith("{") & text.endswith("}")
    log = messages.parsed(raw, schemas.PAGE_LOG, "value", text=F.when(whole, F.col("value")))
    maps = [_without_nulls(F.col(n)).alias(n) for n in ("common", "page", "start", "err")]
    lists = [F.transform(n, _without_nulls).alias(n) for n in ("displays", "actions")]
    mid = F.try_variant_get(F.col("common")["mid"], "$", "string")
    ts = F.col("ts").try_cast("bigint")
    known = schemas.PAGE_LOG.fieldNames()
    more = F.exists(F.json_object_keys("value"), lambda k: ~k.isin(known))
    rest = F.when(more, F.map_filter(F.from_json("value", schemas.VALUE_MAP),
                                     lambda k, v: ~k.isin(known) & ~F.is_variant_null(v)))
    return log.select(
        *others, "value", *maps, *lists, rest.alias("rest"), ts.alias("ts"), mid.alias("mid"),
        F.try_variant_get(F.col("common")["is_new"], "$", "string").alias("is_new"),
        (mid.isNull() | ts.isNull()).alias("dirty"))


def split_dirty(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records, and the text of the dirty ones."""
    good = parsed.where(~F.col("dirty")).drop("value", "dirty")
    return good, parsed.where("dirty").select("value")


def land_page_log(raw: DataFrame, path: str, mode: str = "append") -> None:
    """Parse the log once and store it in columns, the text of dirty records only."""
    parsed = parse_page_log(raw)
    kept = F.when(F.col("dirty"), F.col("value"))
    parsed.withColumn("value", kept).write.mode(mode).parquet(path)


def read_page_view(raw: DataFrame, delay: str = "2 seconds") -> DataFrame:
    """``common``, ``page`` and ``ts`` with event time ``rt`` and its watermark."""
    view = messages.parsed(raw.select("value"), schemas.PAGE_VIEW)
    return view.withColumn(
        "rt", scalars.epoch_ms_to_timestamp(F.col("ts"))).withWatermark("rt", delay)
