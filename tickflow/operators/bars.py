"""OHLCV bars over event-time windows (sliding or tumbling).

One ``groupBy(window, symbol, asset_type)``: partial aggregation on the
map side, one shuffle by (window, symbol, asset_type), final aggregate.
The window is part of the key, so a hot symbol spreads over many tasks.
open/close are ``min_by``/``max_by`` on a total order key
(event_time, tick_number), never arrival order. When the ticks carry
``tick_seq`` (the per-symbol running number from ``enrich``, monotone
in that order) it is used as the key: a single BIGINT keeps the
aggregation buffer fixed-width, so Spark plans a hash aggregate with
map-side combine instead of sorting every partition (a struct key forces
a sort-based aggregate).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.functions.numeric import rnd
from tickflow.schemas import BAR_FIELDS, BAR_ROUNDING


def _order_key(order: Sequence[str]) -> Column:
    if len(order) == 1:
        return F.col(order[0])
    return F.struct(*[F.col(c) for c in order])


def default_order(df: DataFrame) -> tuple[str, ...]:
    return ("tick_seq",) if "tick_seq" in df.columns else ("event_time", "tick_number")


def bar_aggregates(source: str = "price", order: Sequence[str] = ("event_time", "tick_number"),
                   zero_volume: float | None = None, full: bool = True,
                   where: Column | None = None) -> list[Column]:
    """Bar columns. ``full=False`` keeps OHLCV, VWAP and tick_count only
    (for sources that carry no indicators). ``where`` restricts every
    aggregate to the rows where it holds (SQL ``FILTER (WHERE ...)``), so
    several bar variants can come out of one aggregation pass."""
    def c(name: str) -> Column:
        return F.col(name) if where is None else F.when(where, F.col(name))

    key = _order_key(order)
    if where is not None:
        key = F.when(where, key)  # rows outside ``where`` have no order: min_by/max_by skip them
    if source == "tick_ohlc":
        o, h, l = F.min_by(c("open"), key), F.max(c("high")), F.min(c("low"))  # noqa: E741
    elif source == "price":
        o, h, l = F.min_by(c("price"), key), F.max(c("price")), F.min(c("price"))  # noqa: E741
    else:
        raise ValueError(f"unknown bar source {source!r}")
    vol = F.sum(c("volume"))
    vwap = F.try_divide(F.sum(c("price") * c("volume")), vol)
    if zero_volume is not None:
        vwap = F.when(vol == 0, F.lit(float(zero_volume))).otherwise(vwap)
    n = F.count(F.lit(1)) if where is None else F.count_if(where)
    core = [
        o.alias("open"), h.alias("high"), l.alias("low"),
        F.max_by(c("price"), key).alias("close"),
        vol.alias("volume"),
        vwap.alias("vwap"),
    ]
    if not full:
        return core + [n.alias("tick_count")]
    alerting = F.col("price_alert").isNotNull() if where is None else where & F.col("price_alert").isNotNull()
    return core + [
        F.avg(c("realized_vol")).alias("avg_realized_vol"),
        F.avg(c("spread")).alias("avg_spread"),
        n.alias("tick_count"),
        F.count_if(alerting).alias("alert_count"),
        F.avg(c("returns_pct")).alias("avg_return_pct"),
        F.stddev_samp(c("returns_pct")).alias("stddev_return_pct"),
    ]


def bars(df: DataFrame, size: str = "1 minute", slide: str | None = "30 seconds",
         source: str = "price", zero_volume: float | None = None,
         order: Sequence[str] | None = None, time_col: str = "event_time",
         full: bool = True, extra: Sequence[Column] = ()) -> DataFrame:
    """OHLCV + VWAP bars. ``slide=None`` gives tumbling bars.

    Ticks without a price are left out (a NULL price with a volume would
    bias VWAP); ticks without event time fall out of every window.
    """
    order = order or default_order(df)
    w = F.window(time_col, size, slide) if slide else F.window(time_col, size)
    agg = (df.filter(F.col("price").isNotNull())
             .groupBy(w.alias("window"), "symbol", "asset_type")
             .agg(*bar_aggregates(source, order, zero_volume, full), *extra))
    rest = [c for c in agg.columns if c != "window"]
    return agg.select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), *rest)


def round_bars(df: DataFrame, rounding: dict[str, int] = BAR_ROUNDING) -> DataFrame:
    """Publish bar doubles at fixed precision (for comparison/staging)."""
    return df.withColumns({c: rnd(c, n) for c, n in rounding.items() if c in df.columns})


def bollinger(df: DataFrame, k: float = 2.0) -> DataFrame:
    """upper/lower = vwap ± k·stddev%·vwap/100, rounded to 4."""
    band = F.lit(k) * F.col("stddev_return_pct") * F.col("vwap") / F.lit(100.0)
    return (df.withColumn("bollinger_upper", rnd(F.col("vwap") + band, 4))
              .withColumn("bollinger_lower", rnd(F.col("vwap") - band, 4)))


def ohlc_valid_expr(o="open", h="high", l="low", c="close") -> Column:  # noqa: E741
    """Strict OHLC rule: low ≤ open ≤ high, low ≤ close ≤ high, low ≤ high."""
    O, H, L, C = (F.col(x) for x in (o, h, l, c))
    return (L <= O) & (O <= H) & (L <= C) & (C <= H) & (L <= H)


def ohlc_valid(df: DataFrame) -> DataFrame:
    return df.withColumn("ohlc_valid", ohlc_valid_expr())
