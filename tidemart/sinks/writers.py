"""Writers for topics, tables and external stores, for batches and for streams.

Batch writers double as the body of a micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

# A batch writer gets the rows of one micro-batch and its number.
BatchWriter = Callable[[DataFrame, int], None]


def start(stream: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append",
          every: str | None = None) -> StreamingQuery:
    """Run a stream into a batch writer: through all available input, or on and on."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(write).option(
        "checkpointLocation", checkpoint)
    trigger = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return trigger.start()


def write_topic(values: DataFrame, servers: str, topic: str) -> None:
    """JSON text to one broker topic (needs the Kafka connector on the class path)."""
    (values.select("value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def stream_topic(values: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    return (values.select("value").writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())


def write_text_topic(values: DataFrame, path: str, mode: str = "append") -> None:
    """JSON text to a directory that stands for the topic, one message per line."""
    values.select("value").write.mode(mode).text(path)


def stream_text_topic(values: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The same from a stream; the file sink's own log makes each message appear once."""
    return (values.select("value").writeStream.format("text").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def write_by_destination(rows: DataFrame, path: str, by: str = "sink_table",
                         mode: str = "append") -> None:
    """Rows ``value`` below the directory of their destination, which leaves the row.

    Rebalancing keeps each task from opening a file for each destination, and splits a
    destination that gets most of the rows.
    """
    (rows.select(by, "value").hint("rebalance", by)
     .write.mode(mode).partitionBy(by).text(path))


def write_by_topic(rows: DataFrame, servers: str, by: str = "sink_table") -> None:
    """Rows ``value`` to the broker topic that each row names."""
    (rows.select(F.col(by).alias("topic"), "value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).save())


def batches_by_destination(path: str, by: str) -> BatchWriter:
    """Batch writer that replaces its own directory when a batch is replayed."""
    def write(rows: DataFrame, batch_id: int) -> None:
        write_by_destination(rows, f"{path}/batch={batch_id}", by, mode="overwrite")
    return write


def write_append_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def stream_append_table(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (rows.writeStream.format("parquet").option("path", path).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def without_transient(rows: DataFrame) -> DataFrame:
    """Rows without the columns whose metadata says that they are not to be stored."""
    return rows.drop(*[f.name for f in rows.schema.fields if f.metadata.get("transient")])


def transient(column, name: str):
    """Mark a column as one that sinks leave out."""
    return column.alias(name, metadata={"transient": True})


def write_jdbc_batched(rows: DataFrame, url: str, table: str, batch_rows: int = 5000,
                       **options: str) -> None:
    """Insert rows into an external table, many per round trip."""
    (without_transient(rows).write.format("jdbc").mode("append")
     .options(url=url, dbtable=table, batchsize=str(batch_rows), **options).save())


def write_olap_json(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Rows as JSON lines for the bulk load of an OLAP store."""
    rows.write.mode(mode).json(path)


def print_sink(stream: DataFrame, checkpoint: str | None = None) -> StreamingQuery:
    writer = stream.writeStream.format("console").option("truncate", "false")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def dim_schema(sink_columns: str, sink_pk: str | None = None,
               sink_extend: str | None = None) -> T.StructType:
    """All-text schema of a dimension table; the key is marked, ``id`` unless named."""
    key = sink_pk or "id"
    return T.StructType([
        T.StructField(name, T.StringType(), True, {
            **({"primary_key": True} if name == key else {}),
            **({"extend": sink_extend} if name == key and sink_extend else {})})
        for name in sink_columns.split(",")])


def create_dim_if_absent(spark: SparkSession, path: str, sink_table: str, sink_columns: str,
                         sink_pk: str | None = None, sink_extend: str | None = None) -> str:
    """Directory of a dimension table, created empty with its schema when it is missing."""
    home = f"{path.rstrip('/')}/{sink_table.upper()}"
    schema = dim_schema(sink_columns, sink_pk, sink_extend)
    spark.createDataFrame([], schema).write.mode("ignore").parquet(home)
    return home


def dim_table(rows: DataFrame, sink_table: str, sink_columns: str) -> DataFrame:
    """One dimension table, all text, out of the rows of all of them."""
    return rows.where(F.col("sink_table") == sink_table).select(
        *[F.col("payload")[name].alias(name) for name in sink_columns.split(",")])
