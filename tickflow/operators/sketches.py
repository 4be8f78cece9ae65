"""Distinct symbols by mergeable HyperLogLog sketches.

An exact distinct count must see every symbol again for every span. A sketch
per hour is a few KB, is kept up by a stream, and the sketches of any hours
are united without reading a tick.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of a sketch's registers: 4096, a relative error of about 1.6 % (one standard deviation).
LG_K = 12


def hourly_sketches(df: DataFrame, size: str = "1 hour", col: str = "symbol", time: str = "event_time", lg_k: int = LG_K) -> DataFrame:
    """(hour_start, sketch) of ``col`` per window; also on a stream, where the window bounds the state."""
    return (df.groupBy(F.window(time, size).alias("w")).agg(F.hll_sketch_agg(F.col(col), lg_k).alias("sketch"))
              .select(F.col("w.start").alias("hour_start"), "sketch"))


def distinct_count(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """Estimated distinct values of the union of ``sketches``, per ``by`` (none: one row): (..., n_symbols)."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_symbols"))
