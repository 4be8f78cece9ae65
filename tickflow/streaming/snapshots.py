"""Whole-market snapshots while the stream runs.

A bucket's snapshot is due once the watermark has passed the bucket's end.
What a batch hands on is small: of every bucket that is still open the
latest tick per symbol, and of every symbol the tick that it carries into
the next bucket. Batch N reads what batch N - 1 wrote and writes into the
other of two slots, so a replayed batch emits the same snapshots again.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.operators.market import market_snapshot
from tickflow.schemas import TICK
from tickflow.sinks import BatchFn, write_batch
from tickflow.streaming.late import watermark_of

_STATE = T.StructType([*TICK.fields, T.StructField("event_time", T.TimestampType()), T.StructField("frontier", T.TimestampType()),
                       T.StructField("batch_id", T.LongType())])
_FIELDS = [*TICK.fieldNames(), "event_time"]


def _slot(root: str, batch_id: int) -> str:
    return os.path.join(root, "state", f"slot={batch_id % 2}")


def _read(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    return spark.createDataFrame([], _STATE) if batch_id < 0 else spark.read.schema(_STATE).parquet(_slot(root, batch_id))


def _ticks(batch: DataFrame) -> DataFrame:
    """Ticks with the fields of a tick message and their event time."""
    if "timestamp" not in batch.columns:
        batch = batch.withColumn("timestamp", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))
    return batch.filter(F.col("event_time").isNotNull()).select(
        *[(F.col(f.name) if f.name in batch.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TICK.fields], "event_time")


def _latest(ticks: DataFrame, *by) -> DataFrame:
    rest = F.max_by(F.struct(*_FIELDS), F.struct("event_time", "tick_number"))
    return ticks.groupBy("symbol", *by).agg(rest.alias("t")).select("t.*")


def _due(ticks: DataFrame, frontier, until, every: str) -> DataFrame:
    """Snapshots of the buckets after the one that starts at ``frontier`` (None: from the first on) up to the one at ``until``."""
    step = F.expr(f"INTERVAL {every}")
    known = ticks.filter(F.col("event_time") < F.lit(until) + step)
    if frontier is not None:  # a carried tick stands in the last bucket that is out
        known = known.withColumn("event_time", F.greatest("event_time", F.lit(frontier)))
    out = market_snapshot(known, every, until)
    return out if frontier is None else out.filter(F.col("snapshot_start") > F.lit(frontier))


def sink_snapshots(root: str, checkpoint: str, every: str = "10 seconds") -> BatchFn:
    """Snapshots that are due into ``root/snapshots``, per batch. The query's ticks need a watermark.

    A tick of a bucket whose snapshot is out is too late to change it.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _read(spark, root, batch_id - 1)
        frontier = before.agg(F.max("frontier")).first()[0]
        mark = watermark_of(spark, checkpoint, batch_id) or 0  # 0: no tick has been seen
        step = F.expr(f"INTERVAL {every}")
        new = _ticks(batch)
        if frontier is not None:
            new = new.filter(F.col("event_time") >= F.lit(frontier) + step)
        kept = before.select(*_FIELDS).unionByName(_latest(new, F.window("event_time", every))).persist()
        try:
            # the last bucket that ends at or before the watermark
            last = spark.range(1).select((F.window(F.timestamp_millis(F.lit(mark)), every)["start"] - step).alias("b")).first()["b"]
            first = kept.agg(F.min(F.window("event_time", every)["start"])).first()[0]
            if first is not None and last >= first and (frontier is None or last > frontier):
                write_batch(_due(kept, frontier, last, every), batch_id, os.path.join(root, "snapshots"))
                frontier = last
            opened = kept if frontier is None else kept.filter(F.col("event_time") >= F.lit(frontier) + step)
            after = _latest(opened, F.window("event_time", every))
            if frontier is not None:
                after = after.unionByName(_latest(kept.filter(F.col("event_time") < F.lit(frontier) + step)))
            (after.select(*_FIELDS, F.lit(frontier).cast("timestamp").alias("frontier"), F.lit(batch_id).cast("long").alias("batch_id"))
                  .write.mode("overwrite").parquet(_slot(root, batch_id)))
        finally:
            kept.unpersist()
    return fn


def open_snapshots(spark: SparkSession, root: str, every: str = "10 seconds") -> DataFrame:
    """Snapshots of the buckets that are still open, as far as ticks have come: what a stopped stream leaves."""
    state = spark.read.schema(_STATE).parquet(os.path.join(root, "state"))
    newest = state.agg(F.max("batch_id")).first()[0]
    mine = state.filter(F.col("batch_id") == F.lit(newest))
    last = mine.agg(F.max("frontier").alias("frontier"), F.max(F.window("event_time", every)["start"]).alias("b")).first()
    return _due(mine.select(*_FIELDS), last["frontier"], last["b"], every)


def read_snapshots(spark: SparkSession, root: str, every: str = "10 seconds", include_open: bool = True) -> DataFrame:
    """All snapshots of a stream: those that were due, and, if wanted, those of its open buckets."""
    schema = "key binary, value binary, timestamp timestamp, snapshot_start timestamp"
    out = spark.read.schema(schema).parquet(os.path.join(root, "snapshots")).drop("batch_id")
    return out.unionByName(open_snapshots(spark, root, every)) if include_open else out
