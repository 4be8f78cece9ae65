"""Batch jobs: the hourly quality + marts job.

Order: new batches merged into the store of newest bars → check counts of
the touched days stored → checks added up from them → report row written → staging view → marts' touched days written → NOT NULL tests
→ gate. Only days with new batches are merged, counted and rolled up; the
checks add up the counts of the days in reach of a lookback, the NOT NULL
tests one stored row per day. A job that fails before its end has committed
nothing and does the same days again. The report is stored before the gate,
so a failing hour is recorded with its failed count (the reference's
chain could only ever store zero failures).
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.operators.quality import QualityGateError, check_rows, gate, merged_counts, report
from tickflow.plans.marts import daily_anomalies, hourly_kpis
from tickflow.plans.staging import staging
from tickflow.sinks import materialize, read_reports, write_report
from tickflow.sinks.bar_store import (
    commit, done_up_to, merge_new, new_days, null_counts, read_checks, read_newest, recent_days, replace_days, store_checks,
)


@dataclass
class JobPaths:
    """``bars`` is the root of a version store (``sinks.bar_store``)."""

    bars: str
    reports: str
    marts: str


def hourly_job(spark: SparkSession, as_of: str, paths: JobPaths, ranges: DataFrame,
               lookback: str = "2 hours", coverage_lookback: str = "1 hour", min_symbols: int = 8,
               n_symbols: int = 10, ohlc: str = "tolerant", overlapping: bool = False,
               raise_on_failure: bool = True) -> DataFrame:
    """Run one hour; returns the stored report rows."""
    merge_new(spark, paths.bars)
    # a stream may have merged, too: the job keeps a commit of its own
    touched, up_to = new_days(spark, paths.bars, "job", done_up_to(spark, paths.bars, "newest"))
    if touched:
        store_checks(spark, paths.bars, touched, ranges)
    near = recent_days(spark, paths.bars, as_of, (lookback, coverage_lookback))
    counts = merged_counts(read_checks(spark, paths.bars, near), read_newest(spark, paths.bars, near), as_of, lookback, coverage_lookback, ohlc)
    checks = check_rows(counts, min_symbols, n_symbols)
    rep = report(checks, as_of)
    write_report(rep, paths.reports, as_of[:13].replace("-", "").replace(" ", ""))

    if touched:
        stg = materialize(spark, staging(read_newest(spark, paths.bars, touched)), "stg_ohlcv", "view")
        replace_days(hourly_kpis(stg, overlapping), os.path.join(paths.marts, "mart_market_kpis"), "hour_bucket", ("symbol", "hour_bucket"))
        replace_days(daily_anomalies(stg, overlapping, ordered=False), os.path.join(paths.marts, "mart_anomaly_report"), "trading_day", ("symbol",))
        commit(spark, paths.bars, "job", up_to)

    nn = null_counts(spark, paths.bars)
    failed_cols = [r["column_name"] for r in nn.filter(~F.col("passed")).collect()]  # at most one row per checked column
    if raise_on_failure:
        if failed_cols:
            raise QualityGateError(f"NOT NULL failed on {failed_cols}")
        gate(read_reports(spark, paths.reports)
             .filter(F.col("created_at") == F.lit(as_of).cast("timestamp_ntz")))
    return read_reports(spark, paths.reports)
