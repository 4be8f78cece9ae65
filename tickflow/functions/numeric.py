"""Numeric and time helpers shared by all operators.

``rnd`` is the single rounding form used everywhere a derived double is
published: a nudge of 10^-(n+5) in the direction of the sign settles
half-way ties identically in Spark (decimal HALF_UP) and in engines that
round the binary value, so results compare bit-equal across engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickflow.schemas import DEFAULT_PRICE_DECIMALS, PRICE_DECIMALS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nudge(n: int) -> float:
    return float(f"1e-{n + 5}")


def rnd(c, n: int) -> Column:
    """Round to ``n`` decimals with a sign-directed tie nudge."""
    x = _col(c)
    return F.round(x + F.signum(x) * F.lit(nudge(n)), n)


def ratio(x, y) -> Column:
    """x / y, NULL when y is 0 or NULL (SQL ``x / NULLIF(y, 0)``)."""
    return F.try_divide(_col(x).cast("double"), _col(y))


def price_round(c, asset_type="asset_type") -> Column:
    """Round a price by the asset type's precision (forex 4, else 2)."""
    out = None
    for kind, n in PRICE_DECIMALS.items():
        cond = _col(asset_type) == F.lit(kind)
        out = F.when(cond, rnd(c, n)) if out is None else out.when(cond, rnd(c, n))
    return out.otherwise(rnd(c, DEFAULT_PRICE_DECIMALS))


def since(c, as_of: str, interval: str) -> Column:
    """``c > as_of - INTERVAL interval`` with an explicit ``as_of``."""
    return _col(c) > (F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {interval}"))


def trunc_ts(unit: str, c) -> Column:
    """``date_trunc`` that keeps a TIMESTAMP_NTZ input as TIMESTAMP_NTZ."""
    return F.date_trunc(unit, _col(c)).cast("timestamp_ntz")


def exact_mean_gt(c, threshold: float, decimals: int = 2) -> Column:
    """Aggregate: mean(c) > threshold, decided exactly for values that
    carry ``decimals`` places (the comparison runs on scaled integers, as
    a NUMERIC mean would, so summation order cannot tip it)."""
    scale = 10 ** decimals
    scaled = F.sum(F.round(_col(c) * F.lit(scale)).cast("bigint"))
    n = F.count(_col(c))
    return scaled > F.lit(int(round(threshold * scale))) * n


def price_decimals(asset_type="asset_type") -> Column:
    """Decimal places of a price by asset type (forex 4, else 2)."""
    out = None
    for kind, n in PRICE_DECIMALS.items():
        cond = _col(asset_type) == F.lit(kind)
        out = F.when(cond, F.lit(n)) if out is None else out.when(cond, F.lit(n))
    return out.otherwise(F.lit(DEFAULT_PRICE_DECIMALS))
