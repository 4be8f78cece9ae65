"""Driver tables and the tick views derived from them.

Ticks are a view over ``events`` (or ``lineitem`` for larger daily bars);
see FIXTURES.md §3 for the mapping. Only the columns a tick needs are
selected, so the parquet scan reads those alone.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.schemas import (
    EVENT_ASSETS, EVENT_PRICE_RANGES, MARKET_ASSETS, MARKET_PRICE_RANGES,
    SPREAD_PCT,
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def event_asset_type(symbol="symbol"):
    """Fixed mapping of event types to asset types for test ticks."""
    s = F.col(symbol) if isinstance(symbol, str) else symbol
    out = None
    for sym, _price, kind, _ccy in EVENT_ASSETS:
        out = F.when(s == sym, F.lit(kind)) if out is None else out.when(s == sym, F.lit(kind))
    return out.otherwise(F.lit(None).cast("string"))


def events_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base ticks (symbol, asset_type, currency, event_time, tick_number,
    price, volume) over the ``events`` table."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("symbol"),
        event_asset_type("event_type").alias("asset_type"),
        F.lit("USD").alias("currency"),
        F.col("ts").alias("event_time"),
        F.col("event_id").alias("tick_number"),
        (F.lit(100.0) + F.col("value") / F.lit(20.0)).alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
    )


def lineitem_ticks(spark: SparkSession, sf_dir: str, n_symbols: int = 50) -> DataFrame:
    """Ticks over ``lineitem`` for daily bars: symbol = partkey mod 50,
    price = unit price; the order key ends in the price, because
    (orderkey, linenumber) is not unique."""
    li = read_table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return li.select(
        (F.col("l_partkey") % n_symbols).cast("string").alias("symbol"),
        F.lit("part").alias("asset_type"),
        F.col("l_shipdate").alias("event_time"),
        F.col("l_orderkey"), F.col("l_linenumber"),
        price.alias("price"),
        F.col("l_quantity").cast("bigint").alias("volume"),
    )


def _fixed(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A small fixed table as a local relation, whose size the planner knows."""
    value = lambda x: f"{x!r}D" if isinstance(x, float) else "'" + str(x).replace("'", "\\'") + "'"
    body = ", ".join("(" + ", ".join(map(value, r)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")


def registry(spark: SparkSession, universe: str = "events") -> DataFrame:
    """Asset registry: symbol, initial_price, asset_type, currency,
    spread_pct. A fixed, tiny dimension (5 or 10 rows)."""
    rows = EVENT_ASSETS if universe == "events" else MARKET_ASSETS
    data = [(s, float(p), t, c, SPREAD_PCT.get(t, 0.0002)) for s, p, t, c in rows]
    return _fixed(spark, data, "symbol, initial_price, asset_type, currency, spread_pct")


def price_ranges(spark: SparkSession, universe: str = "events") -> DataFrame:
    rows = EVENT_PRICE_RANGES if universe == "events" else MARKET_PRICE_RANGES
    return _fixed(spark, [(s, float(lo), float(hi)) for s, lo, hi in rows], "symbol, lo, hi")
