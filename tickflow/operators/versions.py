"""Stored bar versions → newest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BAR_KEY = ("symbol", "window_start", "window_end")


def latest_version(df: DataFrame, keys: Sequence[str] = BAR_KEY, version: str = "batch_id") -> DataFrame:
    """Keep the row with the highest ``version`` per key.

    One aggregate with ``max_by`` (map-side partial, then one shuffle by
    key) and no window. The whole row is one struct, so Spark sorts each
    partition by key for it.
    """
    others = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
              .agg(F.max_by(F.struct(*others), F.col(version)).alias("_v"))
              .select(*keys, *[F.col(f"_v.{c}").alias(c) for c in others]))
