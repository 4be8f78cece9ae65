"""Indicators of a tick stream without a task per symbol.

``stateful.stream_indicators`` folds a symbol's micro-batch in one call. Here
a micro-batch is an ordinary table: the last HISTORY ticks of every symbol
are put in front of it and ``enrich`` cuts each symbol into chunks of
bounded size, each with the rows it needs of the chunk before it. So a hot
symbol is spread over tasks, and its ticks never meet in one call.

What is handed from batch to batch is a table of HISTORY rows a symbol.
Batch N reads the one that batch N - 1 wrote and writes its own into the
other of two slots, so a replayed batch finds what it found the first time.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickflow.operators.indicators import ENRICHED_COLUMNS, enrich, with_quote, with_signal, with_tick_anomaly
from tickflow.schemas import PERIODS_PER_YEAR
from tickflow.sinks import BatchFn
from tickflow.streaming.stateful import HISTORY

_INPUT = ["symbol", "asset_type", "currency", "event_time", "tick_number", "price", "volume"]
TAIL = ("symbol string, asset_type string, currency string, event_time timestamp, tick_number long, price double, volume long, "
        "seen long")


def _slot(root: str, batch_id: int) -> str:
    return os.path.join(root, "tail", f"slot={batch_id % 2}")


def read_tail(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """Last ticks of every symbol as of the end of batch ``batch_id``; ``seen``: the symbol's ticks so far."""
    if batch_id < 0:
        return spark.createDataFrame([], TAIL)
    return spark.read.schema(TAIL).parquet(_slot(root, batch_id))


def new_tail(tail: DataFrame, on_time: DataFrame) -> DataFrame:
    """The last HISTORY of a symbol's old and new ticks (a rank limit that every task applies first)."""
    both = tail.withColumn("n", F.lit(0)).unionByName(on_time.withColumn("seen", F.lit(0).cast("long")).withColumn("n", F.lit(1)))
    w = Window.partitionBy("symbol").orderBy(F.col("event_time").desc(), F.col("tick_number").desc())
    last = both.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= HISTORY).drop("_r", "n", "seen")
    seen = both.groupBy("symbol").agg((F.max("seen") + F.sum("n")).alias("seen"))
    return last.join(seen, "symbol")


def enrich_batch(ticks: DataFrame, tail: DataFrame, registry: DataFrame, periods: int = PERIODS_PER_YEAR, **kw) -> tuple[DataFrame, DataFrame]:
    """(all columns of ``enrich`` and ``late``, the tail after this batch).

    A tick not newer than its symbol's newest of earlier batches is late: it
    is passed on without indicators and changes nothing.
    """
    ticks = ticks.select(*_INPUT)
    known = tail.groupBy("symbol").agg(F.max(F.struct("event_time", "tick_number")).alias("_newest"), F.count(F.lit(1)).alias("_held"), F.max("seen").alias("_seen"))
    flagged = ticks.join(known, "symbol", "left").withColumn(
        "late", F.coalesce(F.struct("event_time", "tick_number") <= F.col("_newest"), F.lit(False)))
    on_time, late = flagged.filter(~F.col("late")).select(*_INPUT), flagged.filter("late").select(*_INPUT)
    out = enrich(tail.select(*_INPUT).unionByName(on_time), registry, periods, **kw).join(known, "symbol", "left")
    out = out.filter(F.col("tick_seq") > F.coalesce("_held", F.lit(0))).withColumn(
        "tick_seq", F.col("tick_seq") + F.coalesce(F.col("_seen") - F.col("_held"), F.lit(0)))
    nothing = {c: F.lit(None).cast("double") for c in ("_ret", "open", "high", "low", "returns_pct", "sma5", "sma20", "realized_vol")}
    behind = late.withColumns({**nothing, "tick_seq": F.lit(None).cast("long")})
    behind = with_quote(with_signal(with_tick_anomaly(behind)), registry)
    both = out.select(*ENRICHED_COLUMNS, F.lit(False).alias("late")).unionByName(behind.select(*ENRICHED_COLUMNS, F.lit(True).alias("late")))
    return both, new_tail(tail, on_time)


def sink_indicators(root: str, registry: DataFrame, sink: BatchFn, periods: int = PERIODS_PER_YEAR, **kw) -> BatchFn:
    """Micro-batches of parsed ticks, enriched, into ``sink``; the handed-over ticks under ``root``.

    ``target_rows`` bounds the rows of a chunk.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tail = read_tail(spark, root, batch_id - 1)
        ticks = batch.select(*_INPUT).persist()
        try:
            out, after = enrich_batch(ticks, tail, registry, periods, **kw)
            sink(out, batch_id)
            after.write.mode("overwrite").parquet(_slot(root, batch_id))
        finally:
            ticks.unpersist()
    return fn

