"""The changes of an upsert table as a stream, through Spark's Python data source interface.

A reader starts with what the table's runs still hold, then meets each later batch's rows. An offset names
a version of the table and the last batch it holds: a version's runs never change, so a repeated micro-batch
reads the same rows, also when the table has been compacted meanwhile. Of a key that changed
several times before the reader came to it, the rows that a compaction has passed over are not
seen; its last row always is. A row is seen once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from tidemart.sinks.keyed import BATCH, COMMITS, commit_name, commit_numbers, runs_of


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else f"file://{uri}")


class _Piece(InputPartition):
    """A file, and the batches whose rows are to be read from it: after one, up to another."""

    def __init__(self, path: str, after: int, upto: int):
        self.path, self.after, self.upto = path, after, upto


class _Changes(DataSourceStreamReader):
    def __init__(self, path: str, schema: T.StructType):
        self.path, self.schema = path.rstrip("/"), schema

    def _commits(self) -> list[tuple[int, int]]:
        system, path = _opened(f"{self.path}/{COMMITS}")
        return commit_numbers(f.base_name for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)))

    def initialOffset(self) -> dict:
        return {"version": -1, "batch": -1}

    def latestOffset(self) -> dict:
        commits = self._commits()
        number, upto = commits[-1] if commits else (-1, -1)
        return {"version": number, "batch": upto}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if end["batch"] <= start["batch"]:
            return []
        system, path = _opened(f"{self.path}/{COMMITS}/{commit_name(end['version'], end['batch'])}")
        with system.open_input_file(path) as source:
            runs = runs_of(source.read().decode())
        pieces = []
        for run in runs:
            if run.last > start["batch"]:
                system, folder = _opened(f"{self.path}/{run.path}")
                pieces += [_Piece(f"{self.path}/{run.path}/{f.base_name}", start["batch"], end["batch"])
                           for f in system.get_file_info(fs.FileSelector(folder)) if f.base_name.endswith(".parquet")]
        return pieces

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, path = _opened(partition.path)
        wanted = to_arrow_schema(self.schema)
        with system.open_input_file(path) as source:
            file = pq.ParquetFile(source)
            there = [n for n in wanted.names if n in file.schema_arrow.names]
            for batch in file.iter_batches(columns=[*there, *({BATCH} - {*there})]):
                batches = batch.column(BATCH).to_pylist()
                batch = batch.filter(pa.array([partition.after < b <= partition.upto for b in batches], pa.bool_()))
                columns = [batch.column(f.name).cast(f.type) if f.name in there else pa.nulls(batch.num_rows, f.type) for f in wanted]
                yield pa.RecordBatch.from_arrays(columns, schema=wanted)


class TableFeed(DataSource):
    """Options: ``path``, the table's folder. The schema must be given; columns that a run lacks are null."""

    @classmethod
    def name(cls) -> str:
        return "table_feed"

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _Changes(self.options["path"], schema)


def read_table_feed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The changes of the upsert table below ``path`` as an append stream."""
    spark.dataSource.register(TableFeed)
    return spark.readStream.format(TableFeed.name()).schema(schema).option("path", path).load()
