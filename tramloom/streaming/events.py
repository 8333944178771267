"""Sources and sinks of the live queries, and the wire format between them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramloom import schemas as sc
from tramloom.functions import delay as delays
from tramloom.session import shared_dir
from tramloom.streaming.sinks import BatchFolders

_QUARANTINE = T.StructType([*sc.STOP_EVENT.fields, T.StructField("_corrupt", sc.S)])


def parse_stop_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON messages as stop events plus the quarantine column ``malformed``.

    Keys are snake_case and unknown ones are ignored.  An absent cancellation is
    false and an absent sequence 0; an absent direction or relationship stays null.
    A message that does not parse, or states an unknown relationship, is kept as text
    in ``malformed`` with all fields null.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = messages.withColumn(
        "event", F.from_json(F.col(value).cast("string"), _QUARANTINE, options)
    )
    relation = F.col("event.schedule_relationship")
    bad = (
        F.col("event").isNull()
        | F.col("event._corrupt").isNotNull()
        | F.coalesce(~relation.isin(*sc.SCHEDULE_RELATIONSHIPS), F.lit(False))
    )

    def field(name: str) -> Column:
        column = F.col(f"event.{name}")
        default = {"is_cancelled": False, "stop_sequence": 0}.get(name)
        if default is not None:
            column = F.coalesce(column, F.lit(default))
        return F.when(~bad, column).alias(name)

    rest = [c for c in messages.columns if c != value]
    return parsed.select(
        *rest, *[field(f.name) for f in sc.STOP_EVENT.fields],
        F.when(bad, F.col(value).cast("string")).alias("malformed"),
    )


def render_stop_events(events: DataFrame) -> DataFrame:
    """Stop events as messages: ``key`` is the route, ``value`` the snake_case JSON.

    A message has all fields of the contract; one that ``events`` lacks is null.
    """
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'", "ignoreNullFields": "false"}
    columns = [
        F.col(f.name) if f.name in events.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in sc.STOP_EVENT.fields
    ]
    return events.select(
        F.col("route_key").alias("key"), F.to_json(F.struct(*columns), options).alias("value")
    )


def kafka_stop_events(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Stop events of a topic.  Needs the Kafka connector on the class path."""
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .load()
    )
    return parse_stop_events(messages.select("value"))


def write_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str):
    """Start publishing (key, value) messages to a topic, zstd-compressed."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.compression.type", "zstd")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def sorted_out(root: str) -> BatchFolders:
    """The sink that writes parsed messages once, in three parts: ``malformed`` ones as text,
    ``unmeasured`` ones (cancelled, added, of an unstated kind, without a delay), and the rest,
    whose delay may be averaged.
    """
    measurable = delays.measurable(
        F.col("schedule_relationship"), F.col("is_cancelled"), F.col("delay_seconds"))
    return BatchFolders(root, {
        "malformed": F.col("malformed").isNotNull(), "unmeasured": ~F.coalesce(measurable, F.lit(False))})


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, name: str) -> DataFrame:
    """Parquet files of one name in a folder as a stream."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
    )


def flush_windows(windows: DataFrame, path: str, checkpoint: str, every: str | None = "5 minutes"):
    """Start appending finished windows to a Parquet folder, every so often or, with None, once."""
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        windows.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )


def run_available(stream: DataFrame, mode: str, keys: list[str] | None = None) -> DataFrame:
    """Run a stream over what its source holds now and return the result as a table.

    Each batch is written to the shared folder under its own number, so a repeated
    batch replaces itself.  In update mode a key may appear in several batches; the
    newest row of each key is the result.  Nothing passes through the driver.
    """
    spark = stream.sparkSession
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    table = f"{root}/table"

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{root}/checkpoint")
        .foreachBatch(store)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", sc.L)])
    stored = spark.read.schema(schema).option("basePath", table).parquet(f"{table}/batch=*")
    return newest(stored, keys) if keys else stored.drop("batch")


def newest(stored: DataFrame, keys: list[str]) -> DataFrame:
    """The row of each key's last batch."""
    columns = [c for c in stored.columns if c != "batch"]
    rest = [c for c in columns if c not in keys]
    latest = F.max_by(F.struct(*rest), "batch").alias("latest")
    return stored.groupBy(*keys).agg(latest).select(*keys, "latest.*").select(columns)
