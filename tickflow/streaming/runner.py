"""Streaming queries: raw ticks, OHLCV bars, alerts.

The same operators as the batch path run on a streaming DataFrame:
decode → quarantine → alerts → watermark → windowed bars. Sources are
Kafka-shaped (key, value, timestamp); in tests and replays they are
parquet files of that shape, read with ``maxFilesPerTrigger``.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickflow.operators.alerts import alert_messages, with_alerts
from tickflow.operators.bars import bars
from tickflow.schemas import TOPIC_RECORD
from tickflow.sinks import BatchFn, sink_alerts, sink_bars, sink_raw, sink_totals
from tickflow.sources.topic import decode_ticks, is_bad, split_bad


def file_topic(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Kafka-shaped stream over parquet files (oldest files first)."""
    return (spark.readStream.schema(TOPIC_RECORD).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))


def parse(raw: DataFrame, with_bad: bool = False):
    """decode → (good ticks with alerts[, bad rows]).

    Without ``with_bad`` the quarantined rows are left out; how many goes
    into the query's progress (observedMetrics["quarantine"])."""
    decoded = decode_ticks(raw, keep_corrupt=True)
    if not with_bad:
        decoded = decoded.observe("quarantine", F.count(F.lit(1)).alias("records"),
                                  F.count_if(is_bad()).alias("left_out"))
    good, bad = split_bad(decoded)
    good = with_alerts(good.withColumn("processing_time", F.current_timestamp()))
    return (good, bad) if with_bad else good


def stream_bars(ticks: DataFrame, size: str = "1 minute", slide: str | None = "30 seconds",
                watermark: str = "5 minutes", **kw) -> DataFrame:
    """Watermarked windowed bars; window bounds stored as TIMESTAMP_NTZ (UTC)."""
    b = bars(ticks.withWatermark("event_time", watermark), size, slide, **kw)
    return (b.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
             .withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))


def stream_alerts(ticks: DataFrame) -> DataFrame:
    return alert_messages(ticks)


def stream_raw(ticks: DataFrame) -> DataFrame:
    return ticks


def start(df: DataFrame, name: str, mode: str, checkpoint: str, sink: BatchFn | None = None,
          trigger: dict | None = None, fmt: str | None = None, path: str | None = None,
          options: dict[str, str] | None = None) -> StreamingQuery:
    """Start one query with its own checkpoint and trigger
    (e.g. ``{"processingTime": "15 seconds"}`` or ``{"availableNow": True}``)."""
    w = (df.writeStream.queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint).options(**(options or {})))
    w = w.trigger(**(trigger or {"processingTime": "3 seconds"}))
    if sink is not None:
        w = w.foreachBatch(sink)
    elif fmt:
        w = w.format(fmt)
        if path:
            w = w.option("path", path)
    return w.start()


@dataclass
class StreamTargets:
    raw: str
    bars: str
    alerts: str
    quarantine: str
    checkpoints: str
    totals: str | None = None


def targets_under(root: str) -> StreamTargets:
    return StreamTargets(*(os.path.join(root, n) for n in
                           ("raw", "bars", "alerts", "quarantine", "checkpoints", "totals")))


def stream_job(spark: SparkSession, raw: DataFrame, t: StreamTargets,
               size: str = "1 minute", slide: str | None = "30 seconds", watermark: str = "5 minutes",
               triggers: tuple[dict, dict] | None = None, jdbc: dict[str, str] | None = None,
               alert_topic: tuple[str, str] | None = None) -> list[StreamingQuery]:
    """Two queries over one tick stream.

    * stateless: raw ticks, alerts and quarantined rows share one
      ``foreachBatch`` — the source is read and parsed once per batch
      (the batch is cached, then written to the three sinks);
    * stateful: watermarked bars in update mode (each changed bar is
      re-emitted; the bar store keeps versions by batch_id).

    ``alert_topic`` (servers, topic) sends the alerts to a topic instead
    of files.
    """
    trig_stateless, trig_bars = triggers or ({"processingTime": "3 seconds"},
                                             {"processingTime": "15 seconds"})
    decoded = decode_ticks(raw, keep_corrupt=True).withColumn("processing_time", F.current_timestamp())
    good = with_alerts(split_bad(decoded)[0])
    # running totals of the producer (ticks and anomalies): per micro-batch
    # in the query progress (observedMetrics["tick_totals"]), and for the
    # stream's life in the store of totals
    decoded = decoded.observe("tick_totals", F.count(F.lit(1)).alias("sent_ticks"),
                              F.count_if(F.col("is_anomaly")).alias("sent_anomalies"))

    raw_sink, alert_sink, bad_sink = sink_raw(t.raw), sink_alerts(t.alerts, *(alert_topic or ())), sink_raw(t.quarantine)
    total_sink = sink_totals(t.totals) if t.totals else None

    def stateless(batch: DataFrame, batch_id: int) -> None:
        # the micro-batch is decoded once, cached, and fans out to three sinks
        cached = batch.persist()
        try:
            g, b = split_bad(cached)
            g = with_alerts(g)
            raw_sink(g, batch_id)
            alert_sink(alert_messages(g), batch_id)
            bad_sink(b, batch_id)
            if total_sink:
                total_sink(g, batch_id)
        finally:
            cached.unpersist()

    q1 = start(decoded, "ticks_stateless", "append", os.path.join(t.checkpoints, "stateless"),
               stateless, trig_stateless)
    q2 = start(stream_bars(good, size, slide, watermark), "bars", "update",
               os.path.join(t.checkpoints, "bars"), sink_bars(t.bars, jdbc), trig_bars)
    return [q1, q2]
