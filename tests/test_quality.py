"""Checks, report, gate and the hourly job (FIXTURES.md §3, §4)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tickflow.operators.quality import (
    QualityGateError, check_counts, gate, not_null, report, run_checks, unknown_symbols,
)
from tickflow.plans import registered as R
from tickflow.plans.jobs import JobPaths, hourly_job
from tickflow.plans.staging import staging
from tickflow.session import scratch_path
from tickflow.sinks.bar_store import store_versions
from tickflow.sources.tables import price_ranges, registry

from conftest import SF01, SF001

AS_OF = R.AS_OF


def _counts(spark, sf, lookback):
    c = check_counts(R.stored_bars(spark, sf), price_ranges(spark), AS_OF, lookback, lookback)
    return c.first().asDict()


@pytest.mark.parametrize("sf,lookback,expect", [
    (SF01, "2 hours", dict(fresh=20, bad_volume=0, bad_ohlc=0, symbols=5)),
    (SF01, "240 hours", dict(fresh=2261, bad_price=61, bad_volume=7, bad_ohlc=0, symbols=5)),
    (SF001, "2 hours", dict(fresh=4, bad_volume=0, bad_ohlc=0, symbols=2)),
    (SF001, "240 hours", dict(fresh=537, bad_price=9, bad_volume=4, bad_ohlc=0, symbols=5)),
])
def test_check_counts_match_fixtures(spark, sf, lookback, expect):
    got = _counts(spark, sf, lookback)
    for k, v in expect.items():
        assert got[k] == v, (k, got)


def _bar(ws, symbol="click", o=100.0, h=101.0, l=99.0, c=100.5, v=10, created=None):  # noqa: E741
    ws = dt.datetime.fromisoformat(ws)
    return (ws, ws + dt.timedelta(hours=1), symbol, "stock", o, h, l, c, v, c, 0.1, 0.01, 3, 0, 0.0, 0.0,
            created or ws + dt.timedelta(hours=1))


BAR_DDL = ("window_start timestamp_ntz, window_end timestamp_ntz, symbol string, asset_type string, "
           "open double, high double, low double, close double, volume bigint, vwap double, "
           "avg_realized_vol double, avg_spread double, tick_count bigint, alert_count bigint, "
           "avg_return_pct double, stddev_return_pct double, created_at timestamp_ntz")


def test_ohlc_tolerant_vs_strict_and_edge_bars(spark):
    bars = spark.createDataFrame([
        _bar("2024-01-30 21:00:00"),
        _bar("2024-01-30 21:00:00", symbol="view", h=100.0, l=102.0),     # low > high·1.01
        _bar("2024-01-30 21:30:00", symbol="error", o=105.0),             # open above high
        _bar("2024-01-30 21:30:00", symbol="signup", c=0.0, v=0),         # close 0, no volume
        _bar("2024-01-30 21:30:00", symbol="purchase", c=None),           # NULL never counts
    ], BAR_DDL)
    tol = {r.name: r for r in run_checks(bars, price_ranges(spark), AS_OF, ohlc="tolerant",
                                         min_symbols=4, n_symbols=5).collect()}
    strict = {r.name: r for r in run_checks(bars, price_ranges(spark), AS_OF, ohlc="strict",
                                            min_symbols=4, n_symbols=5).collect()}
    assert not tol["ohlc_consistency"].passed and tol["ohlc_consistency"].detail == "1 OHLC incohérents"
    assert strict["ohlc_consistency"].detail == "3 OHLC incohérents"
    assert not tol["positive_volume"].passed
    assert tol["price_range_validity"].detail == "1 prix hors plage détectés"  # close 0 < 1
    # coverage looks back 1 h: only the three 21:30 bars count
    assert not tol["symbol_coverage"].passed and tol["symbol_coverage"].detail == "3/5 symboles couverts"
    stg = staging(bars)
    assert stg.count() == 2  # close>0, volume>0, high>=low (NULL close dropped too)


def test_empty_table_passes_count_checks(spark):
    empty = spark.createDataFrame([], BAR_DDL)
    res = {r.name: r.passed for r in run_checks(empty, price_ranges(spark), AS_OF).collect()}
    assert res == {"data_freshness": False, "price_range_validity": True, "positive_volume": True,
                   "ohlc_consistency": True, "symbol_coverage": False}


def test_report_and_gate(spark):
    checks = run_checks(R.stored_bars(spark, SF001), price_ranges(spark), AS_OF, "240 hours", "240 hours",
                        min_symbols=4, n_symbols=5)
    rep = report(checks, AS_OF)
    row = rep.first()
    assert row.checks_passed + row.checks_failed == 5
    assert row.report_hour == dt.datetime(2024, 1, 30, 22, 0)
    assert row.details.startswith('{"checks":[{"name":"data_freshness"')
    with pytest.raises(QualityGateError):
        gate(rep)


def test_not_null_and_unknown(spark):
    df = spark.createDataFrame([("a", 1.0), (None, None)], "symbol string, close double")
    res = {r.column_name: (r.null_count, r.passed) for r in not_null(df, ["symbol", "close"]).collect()}
    assert res == {"symbol": (1, False), "close": (1, False)}
    t = spark.createDataFrame([("AAPL",), ("XYZ",)], "symbol string")
    assert [r.symbol for r in unknown_symbols(t, registry(spark, "markets")).collect()] == ["XYZ"]


def test_hourly_job_writes_report_before_gate(spark):
    root = scratch_path(spark, "job-test")
    paths = JobPaths(os.path.join(root, "bars"), os.path.join(root, "reports"), os.path.join(root, "marts"))
    store_versions(R.stored_bars(spark, SF001), 0, paths.bars)
    with pytest.raises(QualityGateError):
        hourly_job(spark, AS_OF, paths, price_ranges(spark), "2 hours", "1 hour", min_symbols=4, n_symbols=5)
    stored = spark.read.parquet(paths.reports).drop("hour").collect()
    assert len(stored) == 1 and stored[0].checks_failed >= 1  # failing hour is recorded
    assert spark.read.parquet(os.path.join(paths.marts, "mart_market_kpis")).count() > 0
