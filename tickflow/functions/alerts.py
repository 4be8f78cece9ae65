"""Alert, anomaly and risk classifications as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickflow.schemas import (
    ALERT_PCT, ANOMALY_RETURN, CRITICAL_PCT, HIGH_RISK_PCT, MEDIUM_RISK_PCT,
)
from tickflow.functions.numeric import _col, exact_mean_gt


def price_alert(ret_pct="returns_pct") -> Column:
    """FLASH_CRASH below -3 %, SPIKE above +3 %, else NULL (strict)."""
    r = _col(ret_pct)
    return (F.when(r < -ALERT_PCT, F.lit("FLASH_CRASH"))
            .when(r > ALERT_PCT, F.lit("SPIKE"))
            .otherwise(F.lit(None).cast("string")))


def alert_severity(ret_pct="returns_pct") -> Column:
    """CRITICAL beyond ±8 %, HIGH beyond ±3 %, else NONE (NULL → NONE)."""
    r = _col(ret_pct)
    return (F.when(r < -CRITICAL_PCT, F.lit("CRITICAL"))
            .when(r < -ALERT_PCT, F.lit("HIGH"))
            .when(r > CRITICAL_PCT, F.lit("CRITICAL"))
            .when(r > ALERT_PCT, F.lit("HIGH"))
            .otherwise(F.lit("NONE")))


def anomaly_type(ret="ret") -> Column:
    """Tick anomaly on the unscaled return: |r| > 0.03."""
    r = _col(ret)
    return (F.when(F.abs(r) > ANOMALY_RETURN,
                   F.when(r < 0, F.lit("flash_crash")).otherwise(F.lit("price_spike")))
            .otherwise(F.lit(None).cast("string")))


def risk_level(rate="alert_rate_pct") -> Column:
    """Aggregate: HIGH_RISK if mean rate > 10, MEDIUM_RISK if > 5, else
    NORMAL (a group of NULL rates is NORMAL)."""
    return (F.when(exact_mean_gt(rate, HIGH_RISK_PCT), F.lit("HIGH_RISK"))
            .when(exact_mean_gt(rate, MEDIUM_RISK_PCT), F.lit("MEDIUM_RISK"))
            .otherwise(F.lit("NORMAL")))
