"""Stateful stream operators: per-symbol indicators, de-duplication,
late-data accounting and the hourly roll-up of bars.

``lag`` and row frames are not allowed on streams, so the indicator
stream keeps, per symbol, the last 20 prices as state
(``applyInPandasWithState``). The state is bounded (20 doubles + the
newest order key and tick count per symbol); each call sees one symbol's
ticks of one micro-batch, as large as the caller lets a trigger be. Rows of a batch arrive
unordered, so they are sorted in the function; a tick older than the
stored newest tick is late: it is emitted with ``late = true`` and not
folded into the state.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickflow.functions.numeric import price_round, rnd
from tickflow.operators.indicators import ENRICHED_COLUMNS, with_quote, with_signal, with_tick_anomaly
from tickflow.schemas import PERIODS_PER_YEAR

HISTORY = 20

STATE_SCHEMA = "prices array<double>, last_time timestamp, last_tick bigint, seen bigint"
RAW_SCHEMA = ("symbol string, asset_type string, currency string, event_time timestamp, tick_number bigint, "
              "tick_seq bigint, price double, volume bigint, prev_price double, open double, hi double, lo double, "
              "sma5_raw double, sma20_raw double, ms double, late boolean")
_INPUT = ["symbol", "asset_type", "currency", "event_time", "tick_number", "price", "volume"]


def _window_mean(a: np.ndarray, k: int) -> np.ndarray:
    """Mean of a[i-k+1..i] (fewer at the start), summed left to right as
    a row frame is; NaN entries are skipped (SQL avg ignores NULL)."""
    n = len(a)
    ok = ~np.isnan(a)
    vals = np.where(ok, a, 0.0)
    start = np.maximum(np.arange(n) - (k - 1), 0)
    acc = vals[start].copy()
    cnt = ok[start].astype(np.int64)
    for j in range(1, k):
        idx = start + j
        m = idx <= np.arange(n)
        acc[m] += vals[idx[m]]
        cnt[m] += ok[idx[m]]
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(cnt > 0, acc / np.maximum(cnt, 1), np.nan)


def _window_extreme(a: np.ndarray, k: int, best) -> np.ndarray:
    """``best`` (np.fmax or np.fmin) of a[i-k+1..i], fewer at the start; NaN entries are skipped."""
    out = a.copy()
    for j in range(1, min(k, len(a))):
        out[j:] = best(out[j:], a[:-j])
    return out


def _indicators(key, batches: Iterator[pd.DataFrame], state: GroupState, idle_ms: int | None = None) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    pdf = pd.concat(list(batches), ignore_index=True)
    if state.exists:
        prices, last_time, last_tick, seen = state.get
        hist = list(prices)
    else:
        hist, last_time, last_tick, seen = [], None, None, 0
    pdf = pdf.sort_values(["event_time", "tick_number"], kind="mergesort").reset_index(drop=True)
    if last_time is not None:
        lt = pd.Timestamp(last_time)
        et = pd.to_datetime(pdf["event_time"])
        late = (et < lt) | ((et == lt) & (pdf["tick_number"] <= last_tick))
    else:
        late = pd.Series(False, index=pdf.index)
    on_time = pdf[~late.values].reset_index(drop=True)
    h = len(hist)
    allp = np.array(hist + on_time["price"].astype(float).tolist(), dtype=float)
    prev = np.concatenate([[np.nan], allp[:-1]])
    with np.errstate(invalid="ignore", divide="ignore"):
        ret = np.where(prev == 0, 0.0, (allp - prev) / prev)
    ms = _window_mean(ret * ret, 10)
    first = np.maximum(np.arange(len(allp)) - 4, 0)
    out = on_time.assign(
        tick_seq=np.arange(seen + 1, seen + 1 + len(on_time)), prev_price=prev[h:], open=allp[first][h:],
        hi=_window_extreme(allp, 5, np.fmax)[h:], lo=_window_extreme(allp, 5, np.fmin)[h:],
        sma5_raw=_window_mean(allp, 5)[h:], sma20_raw=_window_mean(allp, 20)[h:], ms=ms[h:], late=False)
    if late.any():
        nothing = dict.fromkeys(("prev_price", "open", "hi", "lo", "sma5_raw", "sma20_raw", "ms"), np.nan)
        out = pd.concat([out, pdf[late.values].assign(tick_seq=None, **nothing, late=True)], ignore_index=True)
    if len(on_time):
        last = on_time.iloc[-1]
        state.update((allp[-HISTORY:].tolist(), pd.Timestamp(last["event_time"]).to_pydatetime(),
                      int(last["tick_number"]), seen + len(on_time)))
    if idle_ms is not None and state.exists:
        state.setTimeoutDuration(idle_ms)
    yield out[[c.split()[0] for c in RAW_SCHEMA.split(", ")]].astype({"tick_seq": "Int64", "volume": "Int64"})


def stream_indicators(ticks: DataFrame, registry: DataFrame, periods: int = PERIODS_PER_YEAR,
                      idle_ms: int | None = None) -> DataFrame:
    """All columns of the batch ``enrich`` on a tick stream (same
    definitions and rounding), and ``late``: a tick older than the
    symbol's newest is passed on without indicators. ``idle_ms`` (processing
    time) forgets a symbol that has been silent for so long; by default a
    symbol's 20 prices are kept for good."""
    fold = partial(_indicators, idle_ms=idle_ms)
    raw = (ticks.select(*_INPUT).groupBy("symbol")
           .applyInPandasWithState(lambda key, batches, state: fold(key, batches, state), RAW_SCHEMA, STATE_SCHEMA, "append",
                                   GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout))
    ret = F.when(F.col("prev_price") == 0, F.lit(0.0)).otherwise(
        (F.col("price") - F.col("prev_price")) / F.col("prev_price"))
    out = (raw.withColumn("_ret", ret)
              .withColumn("returns_pct", rnd(F.col("_ret") * F.lit(100.0), 4))
              .withColumn("sma5", price_round("sma5_raw"))
              .withColumn("sma20", price_round("sma20_raw"))
              .withColumn("high", price_round("hi"))
              .withColumn("low", price_round("lo"))
              .withColumn("realized_vol", rnd(F.sqrt("ms") * F.lit(float(np.sqrt(periods))), 4)))
    return with_quote(with_signal(with_tick_anomaly(out)), registry).select(*ENRICHED_COLUMNS, "late")


def dedup(ticks: DataFrame, keys=("symbol", "tick_number"), delay: str = "5 minutes") -> DataFrame:
    """Drop re-sent ticks: first copy of each key within the watermark
    delay (state per key is evicted once the watermark passes it)."""
    return ticks.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(keys))


def hourly_rollup(ticks: DataFrame, size: str = "1 hour", bar_size: str = "1 minute",
                  bar_slide: str | None = None, watermark: str = "5 minutes") -> DataFrame:
    """Two chained stateful stages on one stream: bars, then hourly
    totals of those bars (append mode: an hour is emitted once the
    watermark passes its end; ``window_time`` carries the event time of
    each bar into the second window)."""
    from tickflow.operators.bars import bar_aggregates
    w = F.window("event_time", bar_size, bar_slide) if bar_slide else F.window("event_time", bar_size)
    b = (ticks.withWatermark("event_time", watermark).filter(F.col("price").isNotNull())
         .groupBy(w.alias("window"), "symbol", "asset_type").agg(*bar_aggregates()))
    return (b.groupBy(F.window(F.window_time("window"), size).alias("h"), "symbol", "asset_type")
             .agg(F.sum("volume").alias("hour_volume"), F.sum("tick_count").alias("hour_ticks"),
                  F.sum("alert_count").alias("hour_alerts"), F.count(F.lit(1)).alias("n_bars"))
             .select(F.col("h.start").cast("timestamp_ntz").alias("hour_start"), "symbol", "asset_type",
                     "hour_volume", "hour_ticks", "hour_alerts", "n_bars"))
