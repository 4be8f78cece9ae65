"""Bars and the ticks that came too late for them, from one streaming query.

Spark drops a window assignment that lies behind the watermark without a
trace. Here the query passes the plain ticks on beside the bars (a narrow
branch, no shuffle). ``foreachBatch`` knows the watermark that Spark drops
by in this batch: the one that the batch before ran with, written in the
query's own checkpoint before that batch started, hence the same after a
restart. Ticks behind it go to a second table, one row per window they
missed; the others are left out before anything is kept.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.sinks import BatchFn, write_batch
from tickflow.sinks.bar_store import store_versions
from tickflow.streaming.runner import stream_bars

TICK_COLUMNS = ["symbol", "asset_type", "event_time", "tick_number", "price", "volume"]


def bars_and_ticks(ticks: DataFrame, size: str, slide: str | None, watermark: str, **kw) -> DataFrame:
    """(bar, tick): bars as ``stream_bars`` gives them, and every tick with a price; one of the two is NULL."""
    bars = stream_bars(ticks, size, slide, watermark, **kw)
    bar = F.struct(*[F.col(c) for c in bars.columns])
    tick = F.struct(*[F.col(c) for c in TICK_COLUMNS])
    # the one watermark of the query: the tick branch declares the same
    passed = ticks.withWatermark("event_time", watermark).filter(F.col("price").isNotNull())
    left = bars.select(bar.alias("bar"))
    right = passed.select(tick.alias("tick"))
    return left.unionByName(right, allowMissingColumns=True)


def watermark_of(spark: SparkSession, checkpoint: str, batch_id: int) -> int | None:
    """Watermark (epoch ms) that batch ``batch_id`` ran with; None before the first batch."""
    if batch_id < 0:
        return None
    lines = [r["value"] for r in spark.read.text(os.path.join(checkpoint, "offsets", str(batch_id))).collect()]  # a few lines
    return next((json.loads(x)["batchWatermarkMs"] for x in lines if "batchWatermarkMs" in x), None)


def _windows(size: str, slide: str | None) -> Column:
    return F.window("event_time", size, slide) if slide else F.window("event_time", size)


def late_assignments(ticks: DataFrame, mark_ms: int, size: str, slide: str | None) -> DataFrame:
    """One row per window that a tick missed: the window ends at or before the watermark."""
    mark = F.timestamp_millis(F.lit(mark_ms))
    return (ticks.filter(F.col("event_time") < mark).withColumn("w", _windows(size, slide)).filter(F.col("w.end") <= mark)
                 .select(*TICK_COLUMNS, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), mark.alias("watermark")))


def sink_bars_and_late(root: str, checkpoint: str, size: str, slide: str | None) -> BatchFn:
    """Batches of ``bars_and_ticks``: bars into the version store under ``root``, missed windows into ``root/late``."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        mark = watermark_of(batch.sparkSession, checkpoint, batch_id - 1)
        behind = F.col("tick.event_time") < F.timestamp_millis(F.lit(mark or 0))
        kept = batch.filter(F.col("bar").isNotNull() | behind).persist()  # bars and late ticks only
        try:
            bars = kept.filter(F.col("bar").isNotNull()).select("bar.*")
            store_versions(bars.withColumn("created_at", F.current_timestamp().cast("timestamp_ntz")), batch_id, root)
            ticks = kept.filter(F.col("tick").isNotNull()).select("tick.*")
            write_batch(late_assignments(ticks, mark or 0, size, slide), batch_id, os.path.join(root, "late"))
        finally:
            kept.unpersist()
    return fn


def read_late(spark: SparkSession, root: str) -> DataFrame:
    """Window assignments that were dropped, with the micro-batch that dropped them."""
    schema = ("symbol string, asset_type string, event_time timestamp, tick_number long, price double, volume long, "
              "window_start timestamp, window_end timestamp, watermark timestamp, batch_id long")
    return spark.read.schema(schema).parquet(os.path.join(root, "late"))
