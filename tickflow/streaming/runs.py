"""Run a streaming query to completion over a replay of a table.

Used by the registered stream queries and the tests: the table is
replayed as time-ordered Kafka-shaped files, the query runs with an
``availableNow`` trigger into a per-batch sink, and the stored output is
read back as a batch DataFrame. All folders live under the shared
checkpoint folder and are fresh per run.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.session import scratch_path
from tickflow.sinks import BatchFn, write_batch
from tickflow.streaming.replay import write_replay
from tickflow.streaming.runner import file_topic, parse, start


def run_replay(spark: SparkSession, ticks: DataFrame, build: Callable[[DataFrame], DataFrame],
               mode: str = "append", n_slices: int = 4, resend: bool = False,
               sink: Callable[[str], BatchFn] | None = None, order: list[int] | None = None,
               name: str = "replay", files_per_slice: int | None = None,
               batch_dirs: list[str] | None = None,
               read: Callable[[SparkSession, str], DataFrame] | None = None) -> tuple[DataFrame, list]:
    """Replay ``ticks`` → ``build(raw_stream)`` → stored output.

    ``order`` replays slices in another order (late data); returns the
    stored rows and the query's progress reports. Each slice is written
    as ``files_per_slice`` files (by default as its rows need) and each
    micro-batch reads exactly one slice (``maxFilesPerTrigger``);
    ``batch_dirs``, if given, receives their folders in that order. On a
    cluster the source is the live topic instead.
    """
    root = scratch_path(spark, name)
    topic = os.path.join(root, "topic")
    dirs, files_per_slice = write_replay(ticks, topic, n_slices=n_slices, resend=resend, files_per_slice=files_per_slice)
    if order is not None:
        # re-write the slices in the requested order into a second topic
        topic = os.path.join(root, "topic-reordered")
        for i, j in enumerate(order):
            (spark.read.parquet(dirs[j]).repartition(files_per_slice)
             .write.mode("overwrite").parquet(os.path.join(topic, f"s{i:05d}")))
        dirs = [os.path.join(topic, f"s{i:05d}") for i in range(len(order))]
    if batch_dirs is not None:
        batch_dirs += dirs
    return run_topic(spark, topic, files_per_slice, build, mode, sink, name, read)


def checkpoint_of(out: str) -> str:
    """Checkpoint folder of the query whose sink writes under ``out``."""
    return os.path.join(os.path.dirname(out), "checkpoint")


def run_topic(spark: SparkSession, topic: str, files_per_slice: int, build: Callable[[DataFrame], DataFrame],
              mode: str = "append", sink: Callable[[str], BatchFn] | None = None, name: str = "replay",
              read: Callable[[SparkSession, str], DataFrame] | None = None) -> tuple[DataFrame, list]:
    """Stream the files of a replayed ``topic`` through ``build`` to completion. ``read`` reads what the sink
    has stored, by default one folder of batches."""
    root = scratch_path(spark, name)
    out = os.path.join(root, "out")
    raw = file_topic(spark, os.path.join(topic, "*"), files_per_trigger=files_per_slice)
    fn = sink(out) if sink else (lambda df, i: write_batch(df, i, out))
    q = start(build(raw), name, mode, checkpoint_of(out), fn, {"availableNow": True})
    q.awaitTermination()
    progress = q.recentProgress
    if q.exception():
        raise RuntimeError(str(q.exception()))
    if read:
        return read(spark, out), progress
    try:
        stored = spark.read.parquet(out)
    except Exception:  # noqa: BLE001 - no batch wrote anything
        stored = None
    return stored, progress


def late_windows(spark: SparkSession, batch_dirs: list[str], progress: list, size: str, slide: str | None) -> int:
    """Window assignments of ticks that came behind the watermark.

    Counted on the ticks themselves, batch by batch, against the watermark
    that the batch before had (the one Spark drops late rows by), so the
    number does not depend on partial aggregation or file layout.
    """
    marks = {p["batchId"]: p["eventTime"].get("watermark") for p in progress if "eventTime" in p}
    read = [p["batchId"] for p in sorted(progress, key=lambda p: p["batchId"]) if p["numInputRows"] > 0]
    late = 0
    for batch, folder in zip(read, batch_dirs, strict=True):
        mark = marks.get(batch - 1)
        if mark:
            w = F.window("event_time", size, slide) if slide else F.window("event_time", size)
            windows = parse(spark.read.parquet(folder)).filter(F.col("price").isNotNull()).select(w.alias("w"))
            late += windows.filter(F.col("w.end") <= F.lit(mark).cast("timestamp")).count()
    return late
