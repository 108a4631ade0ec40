"""Side tables: dictionaries, routing configuration, change feeds, CSV lines, OLAP tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart import schemas
from tidemart.functions import scalars
from tidemart.sources import messages


def read_table(spark: SparkSession, fmt: str, path: str | None = None, **options: str) -> DataFrame:
    """A batch scan of an external table through any installed reader."""
    reader = spark.read.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


def read_lookup_table(spark: SparkSession, fmt: str, path: str | None = None,
                      code: str = "dic_code", name: str = "dic_name", **options: str) -> DataFrame:
    """The dictionary ``dic_code``, ``dic_name`` out of the columns that hold them.

    Call it inside a micro-batch to look up the dictionary as it is now.
    """
    return read_table(spark, fmt, path, **options).select(
        F.col(code).cast("string").alias("dic_code"), F.col(name).alias("dic_name"))


def routes_of(config: DataFrame, sink_type: str) -> DataFrame:
    """Routing rows of one kind of sink, ``dim`` or ``dwd``."""
    names = schemas.ROUTE.fieldNames()
    return config.where(F.col("sink_type") == sink_type).select(*names)


def read_table_changes(raw: DataFrame, row: T.StructType) -> DataFrame:
    """Change records ``before``, ``after``, ``op``, ``ts_ms`` of one watched table."""
    return messages.parsed(raw, schemas.table_change(row))


def parse_csv_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Comma separated text lines as typed rows."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return lines.select(F.inline(F.array(F.from_csv("value", columns))))


def read_csv_stream(spark: SparkSession, path: str, schema: T.StructType,
                    **options: str) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).csv(path)


def read_fact_stream(raw: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Order-line facts out of their topic, with event time: each upsert is a new row."""
    rows = messages.parsed(raw, schemas.ORDER_LINE_FACT)
    return rows.withColumn("row_time", scalars.epoch_seconds_to_timestamp(
        F.col("ts"))).withWatermark("row_time", delay)


def with_event_ms(rows: DataFrame, column: str = "ts", name: str = "event_time",
                  delay: str = "0 seconds") -> DataFrame:
    """Event time from an epoch-millisecond column, with its watermark."""
    return rows.withColumn(
        name, scalars.epoch_ms_to_timestamp(F.col(column))).withWatermark(name, delay)
