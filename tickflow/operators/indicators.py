"""Per-symbol tick indicators: return, SMA, realized volatility, rolling
OHLC, tick sequence, quote and signal.

Semantics (intended meaning of the reference's tick maker, without its
warm-up padding): history is the symbol's ticks ordered by
(event_time, tick_number); the previous price is ``lag(price)``; SMA n
averages the last n prices including the current one (fewer at the
start); realized volatility is the uncentred RMS of the last 10 returns
(current included) × √252; return and volatility are NULL on a symbol's
first tick. All frames run through ``over_history`` so no task holds a
whole symbol.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.functions.alerts import anomaly_type
from tickflow.functions.numeric import price_round, rnd
from tickflow.operators.history import over_history
from tickflow.operators.joins import with_dimension
from tickflow.schemas import PERIODS_PER_YEAR

ORDER = ("event_time", "tick_number")
KEY = "symbol"


def _lag_price(w):
    return F.lag("price", 1).over(w)


def _ret() -> Column:
    prev = F.col("_prev")
    return F.when(prev == 0, F.lit(0.0)).otherwise((F.col("price") - prev) / prev)


def _hist(df, lookback, stages, seq_col=None, **kw):
    return over_history(df, KEY, ORDER, lookback, stages, seq_col=seq_col, **kw)


def with_returns(df: DataFrame, **kw) -> DataFrame:
    """prev_price, returns_pct = round(100·(p − prev)/prev, 4)."""
    out = _hist(df, 1, [{"_prev": _lag_price}], **kw)
    return (out.withColumn("prev_price", F.col("_prev"))
               .withColumn("returns_pct", rnd(_ret() * F.lit(100.0), 4))
               .drop("_prev"))


def with_sma(df: DataFrame, n: tuple[int, ...] = (5, 20), **kw) -> DataFrame:
    """sma{k}: mean of the last k prices, rounded by price precision."""
    stage = {f"_sma{k}": (lambda w, k=k: F.avg("price").over(w.rowsBetween(-(k - 1), 0))) for k in n}
    out = _hist(df, max(n) - 1, [stage], **kw)
    for k in n:
        out = out.withColumn(f"sma{k}", price_round(f"_sma{k}")).drop(f"_sma{k}")
    return out


def with_signal(df: DataFrame) -> DataFrame:
    """BUY when sma5 > sma20 (compared after rounding), else SELL."""
    return df.withColumn("signal", F.when(F.col("sma5") > F.col("sma20"), F.lit("BUY"))
                         .otherwise(F.lit("SELL")))


def _rv_stages(n: int):
    return [
        {"_prev": _lag_price},
        {"_ret": lambda w: _ret()},
        {"_ms": lambda w: F.avg(F.col("_ret") * F.col("_ret")).over(w.rowsBetween(-(n - 1), 0))},
    ]


def _rv(periods: int) -> Column:
    return rnd(F.sqrt(F.col("_ms")) * F.lit(math.sqrt(periods)), 4)


def with_realized_vol(df: DataFrame, n: int = 10, periods: int = PERIODS_PER_YEAR, **kw) -> DataFrame:
    """realized_vol = round(sqrt(mean(r²) over last n returns)·√periods, 4)."""
    out = _hist(df, n, _rv_stages(n), **kw)
    return out.withColumn("realized_vol", _rv(periods)).drop("_prev", "_ret", "_ms")


def with_rolling_ohlc(df: DataFrame, n: int = 5, **kw) -> DataFrame:
    """Tick open (price n−1 ticks back, or the first), high/low over the
    last n prices, rounded by price precision."""
    f = lambda w: w.rowsBetween(-(n - 1), 0)
    stage = {"open": lambda w: F.first("price").over(f(w)),
             "_hi": lambda w: F.max("price").over(f(w)),
             "_lo": lambda w: F.min("price").over(f(w))}
    out = _hist(df, n - 1, [stage], **kw)
    return (out.withColumn("high", price_round("_hi")).withColumn("low", price_round("_lo"))
               .drop("_hi", "_lo"))


def with_tick_number(df: DataFrame, name: str = "tick_seq", **kw) -> DataFrame:
    """1-based running tick number per symbol (per-symbol row_number)."""
    return _hist(df, 0, [], seq_col=name, **kw)


def with_quote(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Spread = price·pct(type) (round 6); bid/ask = price ∓ spread/2
    (round 4). Joins the broadcast registry on symbol (J1)."""
    reg = registry.select("symbol", "spread_pct")
    out = with_dimension(df, reg, "symbol", "left")
    half = F.col("price") * F.col("spread_pct") / F.lit(2.0)
    return (out.withColumn("spread", rnd(F.col("price") * F.col("spread_pct"), 6))
               .withColumn("bid", rnd(F.col("price") - half, 4))
               .withColumn("ask", rnd(F.col("price") + half, 4))
               .drop("spread_pct"))


def with_tick_anomaly(df: DataFrame, ret: str = "_ret") -> DataFrame:
    """is_anomaly = |return| > 0.03; anomaly_type flash_crash/price_spike."""
    return (df.withColumn("is_anomaly", F.coalesce(F.abs(F.col(ret)) > F.lit(0.03), F.lit(False)))
              .withColumn("anomaly_type", anomaly_type(ret)))


ENRICHED_COLUMNS = [
    "symbol", "asset_type", "currency", "event_time", "tick_number", "tick_seq",
    "price", "volume", "open", "high", "low", "bid", "ask", "spread",
    "returns_pct", "sma5", "sma20", "realized_vol", "is_anomaly", "anomaly_type", "signal",
]


def enrich(ticks: DataFrame, registry: DataFrame, periods: int = PERIODS_PER_YEAR, **kw) -> DataFrame:
    """All tick indicators in one windowed pass (one shuffle)."""
    first = {
        "_prev": _lag_price,
        "_sma5": lambda w: F.avg("price").over(w.rowsBetween(-4, 0)),
        "_sma20": lambda w: F.avg("price").over(w.rowsBetween(-19, 0)),
        "open": lambda w: F.first("price").over(w.rowsBetween(-4, 0)),
        "_hi": lambda w: F.max("price").over(w.rowsBetween(-4, 0)),
        "_lo": lambda w: F.min("price").over(w.rowsBetween(-4, 0)),
    }
    stages = [first, {"_ret": lambda w: _ret()},
              {"_ms": lambda w: F.avg(F.col("_ret") * F.col("_ret")).over(w.rowsBetween(-9, 0))}]
    out = _hist(ticks, 19, stages, seq_col="tick_seq", **kw)
    out = (out.withColumn("returns_pct", rnd(F.col("_ret") * F.lit(100.0), 4))
              .withColumn("sma5", price_round("_sma5"))
              .withColumn("sma20", price_round("_sma20"))
              .withColumn("high", price_round("_hi"))
              .withColumn("low", price_round("_lo"))
              .withColumn("realized_vol", _rv(periods)))
    out = with_signal(with_tick_anomaly(out))
    out = with_quote(out, registry)
    return out.select(*ENRICHED_COLUMNS)
