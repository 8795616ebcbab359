"""Marketplace events with their three envelope columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine import fixed_values as fixed
from vitrine import schemas
from vitrine.operators.ordering import in_order


def event_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    schema: T.StructType = schemas.EVENT,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Events that arrive as files in a folder."""
    return spark.readStream.format(fmt).schema(schema).options(**(options or {})).load(path)


def decode_broker(raw: DataFrame) -> DataFrame:
    """Event columns from broker records ``value, partition, timestamp``.

    Partition and enqueue time of the broker become the envelope columns; a value that
    is no JSON gives NULL columns.
    """
    body = F.from_json(F.col("value").cast("string"), schemas.LISTING).alias("body")
    return raw.select(
        body,
        F.current_timestamp().alias("EventProcessedUtcTime"),
        F.col("partition").cast("bigint").alias("PartitionId"),
        F.col("timestamp").alias("EventEnqueuedUtcTime"),
    ).select("body.*", "EventProcessedUtcTime", "PartitionId", "EventEnqueuedUtcTime")


def broker_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Events from a Kafka-compatible broker; needs the Kafka connector on the class path."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )
    return decode_broker(raw)


def heartbeats(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """Events of a reserved code whose time is the clock's."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return beats(ticks, "timestamp")


HEARTBEAT = "heartbeat"


def beats(df: DataFrame, at: str) -> DataFrame:
    """Events of a reserved code at the times ``at``, two for each: what is seen twice in its window comes to nothing.

    Without a code, or with a filter on it later, Spark would leave them out before it sets the watermark.
    """
    times = ("EventProcessedUtcTime", "EventEnqueuedUtcTime")
    values = {"codigo": F.lit(HEARTBEAT), **{name: F.col(at).cast("timestamp") for name in times}}
    twice = df.select(at, F.explode(F.array(F.lit(1), F.lit(2))))
    return twice.select(*[values.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schemas.EVENT.fields])


def with_heartbeat(events: DataFrame, beats: DataFrame) -> DataFrame:
    """Events and heartbeats as one stream, before the event time is set.

    An idle stream's watermark stands still, and its last windows never end. Heartbeats move it on; the consumer
    lets none of them through.
    """
    return events.select(*schemas.EVENT.names).unionByName(beats)


def type_events(df: DataFrame, strict_discount_record: bool = False) -> DataFrame:
    """The eleven event columns in their types; values that do not convert are NULL.

    ``strict_discount_record`` reads the discount as a record: no text is one, so a
    text discount becomes NULL.
    """
    columns = []
    for field in schemas.EVENT.fields:
        value = F.col(field.name).try_cast(field.dataType)
        if field.name == "desconto" and strict_discount_record:
            value = F.lit(None).cast("string")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def with_event_time(
    df: DataFrame,
    col: str = "EventEnqueuedUtcTime",
    late: str = "drop",
    delay: str = fixed.LATENESS,
    arrival: str = "EventProcessedUtcTime",
    out_of_order: str = "keep",
    partition: str = "PartitionId",
) -> DataFrame:
    """Set the event time and how late an event may come.

    ``drop`` leaves out events behind the watermark; ``adjust`` moves the time of a
    late event up to ``arrival`` minus ``delay``. A zone-less time is read as UTC.
    ``out_of_order="adjust"`` then moves an event that comes behind a later one of its ``partition`` up to that
    one's time (see ``in_order``), so that no tolerance for disorder is needed.
    """
    event_time = F.col(col).cast("timestamp")
    if late == "adjust":
        floor = F.col(arrival).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        event_time = F.greatest(event_time, floor)
    elif late != "drop":
        raise ValueError("late must be 'drop' or 'adjust'")
    df = df.withColumn(col, event_time)
    if out_of_order == "adjust":
        df = in_order(df, col, partition, arrival)
    elif out_of_order != "keep":
        raise ValueError("out_of_order must be 'keep' or 'adjust'")
    return df.withWatermark(col, delay) if df.isStreaming else df
