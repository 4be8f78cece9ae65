"""Staging bars: clean, rename and round the stored bars (view)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.functions.numeric import ratio, rnd


def staging(bars: DataFrame) -> DataFrame:
    """close > 0, volume > 0, high ≥ low; prices/VWAP at 4 decimals,
    volatility/spread at 6; alert_rate_pct = round(alerts/ticks·100, 2).
    The filter is a plain predicate, so Catalyst pushes it to the scan."""
    b = bars.filter((F.col("close") > 0) & (F.col("volume") > 0) & (F.col("high") >= F.col("low")))
    return b.select(
        "window_start", "window_end", "symbol", "asset_type",
        rnd("open", 4).alias("open"), rnd("high", 4).alias("high"),
        rnd("low", 4).alias("low"), rnd("close", 4).alias("close"),
        "volume", rnd("vwap", 4).alias("vwap"),
        rnd("avg_realized_vol", 6).alias("realized_vol"),
        rnd("avg_spread", 6).alias("avg_spread"),
        "tick_count", "alert_count",
        rnd("avg_return_pct", 4).alias("avg_return_pct"),
        rnd("stddev_return_pct", 4).alias("stddev_return_pct"),
        rnd(ratio("alert_count", "tick_count") * F.lit(100.0), 2).alias("alert_rate_pct"),
        "created_at",
    )


def stamp(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """created_at = ``as_of`` (the store's insert time) or, for replays,
    the bar's window_end. Rows that violate NOT NULL columns are kept, for
    the quality check to count them."""
    created = F.lit(as_of).cast("timestamp_ntz") if as_of else F.col("window_end")
    return df.withColumn("created_at", created)
