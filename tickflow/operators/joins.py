"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def with_dimension(facts: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a fact table to a dimension (registry, price ranges).

    No hint: the size threshold and AQE decide from the dimension's real
    size whether it is broadcast.
    """
    return facts.join(dim, on, how)
