"""Sinks: raw ticks, bars, alerts, reports, marts.

Stream sinks are ``foreachBatch`` callbacks. ``foreachBatch`` is
at-least-once, so every batch writes its own ``batch_id=N`` folder with
``mode("overwrite")``: a replayed batch replaces its earlier output
instead of appending a second copy. No empty-batch ``count()`` guard —
writing zero rows is harmless and the guard would run the plan twice.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.schemas import REPORT

BatchFn = Callable[[DataFrame, int], None]


def _batch_path(target: str, batch_id: int) -> str:
    return os.path.join(target, f"batch_id={batch_id}")


def write_batch(df: DataFrame, batch_id: int, target: str, fmt: str = "parquet",
                options: dict[str, str] | None = None) -> None:
    """Idempotent per-batch write (overwrite of the batch's folder)."""
    (df.write.format(fmt).options(**(options or {})).mode("overwrite")
       .save(_batch_path(target, batch_id)))


def sink_raw(target: str, fmt: str = "parquet", options: dict[str, str] | None = None) -> BatchFn:
    """Raw tick store. ``fmt="mongodb"`` (with its connector on the
    classpath and ``options`` naming the collection) appends to the
    document store instead; parquet is the default."""
    def fn(df: DataFrame, batch_id: int) -> None:
        if fmt == "parquet":
            write_batch(df, batch_id, target)
        else:
            df.withColumn("batch_id", F.lit(batch_id)).write.format(fmt).options(
                **(options or {})).mode("append").save()
    return fn


def sink_bars(target: str, jdbc: dict[str, str] | None = None) -> BatchFn:
    """Bar store. Every version carries ``batch_id`` (staging keeps the
    newest per bar). With ``jdbc`` options (url, dbtable, user, ...)
    versions are appended over JDBC; otherwise parquet per batch."""
    def fn(df: DataFrame, batch_id: int) -> None:
        out = df.withColumn("created_at", F.current_timestamp().cast("timestamp_ntz"))
        if jdbc:
            out.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.format("jdbc") \
               .options(**jdbc).mode("append").save()
        else:
            write_batch(out, batch_id, target)
    return fn


def topic_write_options(servers: str, topic: str | None = None) -> dict[str, str]:
    """Options of a write to a topic. Without ``topic`` every row names
    its own in a ``topic`` column (``operators.alerts.route``)."""
    opts = {"kafka.bootstrap.servers": servers}
    if topic is not None:
        opts["topic"] = topic
    return opts


def topic_records(df: DataFrame) -> DataFrame:
    """The columns that a topic takes: key, value and, if there, topic."""
    return df.select(*[F.col(c).cast("string" if c == "topic" else "binary").alias(c)
                       for c in ("key", "value", "topic") if c in df.columns])


def sink_topic(servers: str, topic: str | None = None, fmt: str = "kafka") -> BatchFn:
    """Records to a topic (at least once; needs the Kafka connector)."""
    def fn(df: DataFrame, batch_id: int) -> None:
        topic_records(df).write.format(fmt).options(**topic_write_options(servers, topic)).save()
    return fn


def sink_alerts(target: str | None = None, servers: str | None = None, topic: str | None = None) -> BatchFn:
    """Alert (key, value) records: to a topic when ``servers`` is given,
    else as one folder per batch under ``target``."""
    if servers:
        return sink_topic(servers, topic)

    def fn(df: DataFrame, batch_id: int) -> None:
        write_batch(df, batch_id, target)
    return fn


def sink_totals(target: str) -> BatchFn:
    """Ticks and anomalies per symbol of each micro-batch; a replayed batch
    replaces its own counts, so ``read_totals`` holds for the stream's whole
    life, restarts included."""
    def fn(df: DataFrame, batch_id: int) -> None:
        write_batch(df.groupBy("symbol").agg(F.count(F.lit(1)).alias("sent_ticks"),
                                             F.count_if(F.col("is_anomaly")).alias("sent_anomalies")), batch_id, target)
    return fn


def read_totals(spark: SparkSession, target: str) -> DataFrame:
    """Running totals per symbol over all micro-batches so far."""
    stored = spark.read.schema("symbol string, sent_ticks long, sent_anomalies long").parquet(target)
    return stored.groupBy("symbol").agg(F.sum("sent_ticks").alias("sent_ticks"), F.sum("sent_anomalies").alias("sent_anomalies"))


def write_bars(df: DataFrame, path: str, partition: str = "date") -> None:
    """Bars by day: partition pruning on date, row-group statistics on
    (symbol, window_start) for the store's access paths.

    Range partitioning on (date, symbol) gives each task a contiguous
    slice, so files per day stay few while a busy day is still split
    over several tasks (hash-partitioning on date alone would send a
    whole day to one task)."""
    (df.withColumn(partition, F.to_date("window_start"))
       .repartitionByRange(partition, "symbol")
       .sortWithinPartitions(partition, "symbol", "window_start")
       .write.mode("overwrite").partitionBy(partition).parquet(path))


def materialize(spark: SparkSession, df: DataFrame, name: str, kind: str = "view",
                path: str | None = None) -> DataFrame:
    """``view``: a temp view over the plan; ``table``: written as parquet
    at ``path`` and re-read, cutting lineage."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind == "table":
        if not path:
            raise ValueError("a table needs a path")
        df.write.mode("overwrite").parquet(path)
        out = spark.read.parquet(path)
        out.createOrReplaceTempView(name)
        return out
    raise ValueError(f"unknown kind {kind!r}")


def write_report(df: DataFrame, target: str, hour_key: str) -> None:
    """Store the report row of one hour. The hour's own folder is
    overwritten, so a retried or re-run job leaves one row per hour."""
    df.write.mode("overwrite").parquet(os.path.join(target, f"hour={hour_key}"))


def read_reports(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(REPORT).parquet(target).select(*REPORT.names)
