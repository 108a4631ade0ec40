"""Dimension tables that come into being with their routing rows.

All tables are all-text and lie below one folder: their rows in one upsert table by destination and row
key, so that a micro-batch is one write however many tables it meets, and their schemas in a catalog of
small files, one per table and version. A table exists, empty, from its routing row on. A routing row with more
columns adds a version of the schema; earlier rows show nulls there. Columns are never taken away.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.sinks.keyed import KeyedTable
from tidemart.sinks.writers import dim_schema

CATALOG = "_tables"


class DimensionTables:
    def __init__(self, spark: SparkSession, path: str, compact_every: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.rows = KeyedTable(spark, f"{self.path}/rows", ["sink_table", "row_key"], compact_every)
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._files = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self._hadoop.Path("/".join([self.path, CATALOG, *parts]))

    def tables(self) -> list[str]:
        """Names of the tables that exist."""
        return sorted(s.getPath().getName() for s in self._listed())

    def _listed(self, *parts: str) -> list:
        folder = self._at(*parts)
        return list(self._files.listStatus(folder)) if self._files.exists(folder) else []

    def versions(self, sink_table: str) -> list[T.StructType]:
        """The schemas that a table has had, oldest first."""
        out = []
        for status in sorted(self._listed(sink_table), key=lambda s: s.getPath().getName()):
            if not status.getPath().getName().startswith("."):
                source = self._files.open(status.getPath())
                try:
                    out.append(T.StructType.fromJson(json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))))
                finally:
                    source.close()
        return out

    def create(self, route: Row) -> T.StructType:
        """The schema of a route's table, made or widened when needed; a route seen before changes nothing."""
        known = self.versions(route.sink_table)
        wanted = dim_schema(route.sink_columns, route.sink_pk, route.sink_extend)
        schema = known[-1] if known else T.StructType([])
        wider = T.StructType([*schema.fields, *(f for f in wanted.fields if f.name not in schema.fieldNames())])
        if known and len(wider) == len(schema):
            return schema
        draft = self._at(route.sink_table, f".{len(known):06d}")
        out = self._files.create(draft, True)
        out.write(bytearray(wider.json().encode()))
        out.close()
        if not self._files.rename(draft, self._at(route.sink_table, f"{len(known):06d}.json")):
            raise RuntimeError(f"version {len(known)} of {route.sink_table} is taken: a catalog has one writer")
        return wider

    def read(self, sink_table: str) -> DataFrame:
        """A table's rows in its newest schema; empty while it has none."""
        schema, rows = self.versions(sink_table)[-1], self.rows.read()
        if rows is None:
            return self.spark.createDataFrame([], schema)
        return rows.where(F.col("sink_table") == sink_table).select(
            *[F.col("payload")[f.name].alias(f.name, metadata=f.metadata) for f in schema.fields])
