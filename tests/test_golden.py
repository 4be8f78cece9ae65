"""Fixed inputs and results (FIXTURES.md §1) against the real operators."""

import datetime as dt

from pyspark.sql import functions as F

from tickflow.functions.alerts import alert_severity, price_alert
from tickflow.operators.bars import bars, bollinger, ohlc_valid, round_bars
from tickflow.functions.numeric import rnd


# Return in %, alert, severity.
ALERTS = [
    (-10.0, "FLASH_CRASH", "CRITICAL"), (-8.0, "FLASH_CRASH", "HIGH"), (-3.5, "FLASH_CRASH", "HIGH"), (-3.0, None, "NONE"), (-1.5, None, "NONE"),
    (None, None, "NONE"), (0.0, None, "NONE"), (1.5, None, "NONE"), (3.0, None, "NONE"), (3.001, "SPIKE", "HIGH"), (3.5, "SPIKE", "HIGH"),
    (8.0, "SPIKE", "HIGH"), (9.0, "SPIKE", "CRITICAL"),
]
# Prices, volumes, VWAP of the bar.
WEIGHTED = [([100, 101, 102], [1000, 2000, 1500], 101.1111), ([150], [1000], 150.0), ([90, 100, 110], [1000, 1000, 1000], 100.0), ([100], [0], None)]
# VWAP, standard deviation of returns in %, upper and lower band.
BANDS = [(100.0, 2.0, 104.0, 96.0), (100.0, 0.0, 100.0, 100.0)]
# Open, high, low, close, whether they fit together.
CANDLES = [(100.0, 105.0, 95.0, 102.0, True), (100.0, 99.0, 95.0, 102.0, False), (100.0, 105.0, 106.0, 102.0, False), (100.0, 105.0, 95.0, 110.0, False)]


def test_returns_are_classified(spark):
    df = spark.createDataFrame(ALERTS, "returns_pct double, alert string, severity string")
    wrong = df.filter(~price_alert().eqNullSafe(F.col("alert")) | (alert_severity() != F.col("severity")))
    assert wrong.collect() == []


def _ticks(spark, prices, volumes):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [("AAPL", "stock", t0 + dt.timedelta(seconds=i), i, float(p), int(v), 0.0, 0.0, 0.0, None)
            for i, (p, v) in enumerate(zip(prices, volumes))]
    return spark.createDataFrame(
        rows, "symbol string, asset_type string, event_time timestamp_ntz, tick_number bigint, "
              "price double, volume bigint, realized_vol double, spread double, returns_pct double, "
              "price_alert string")


def test_volume_weighted_price_of_a_minute(spark):
    for prices, volumes, want in WEIGHTED:
        bar = round_bars(bars(_ticks(spark, prices, volumes), "1 minute", None)).first()
        assert bar.vwap == want
        assert (bar.open, bar.close, bar.high, bar.low) == (prices[0], prices[-1], max(prices), min(prices))
    assert bars(_ticks(spark, [100], [0]), "1 minute", None, zero_volume=0.0).first().vwap == 0.0


def test_bands_lie_around_the_weighted_price(spark):
    df = spark.createDataFrame([b[:2] for b in BANDS], "vwap double, stddev_return_pct double")
    assert [(r.vwap, r.stddev_return_pct, r.bollinger_upper, r.bollinger_lower) for r in bollinger(df).collect()] == BANDS


def test_candles_that_do_not_fit_are_marked(spark):
    df = spark.createDataFrame([c[:4] for c in CANDLES], "open double, high double, low double, close double")
    assert [r.ohlc_valid for r in ohlc_valid(df).collect()] == [c[4] for c in CANDLES]


def test_rnd_ties(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (2.675,)], "x double")
    got = [r[0] for r in df.select(rnd("x", 2)).collect()]
    assert got == [1.01, -1.01, 2.68]


def test_first_last_by_event_time_not_arrival(spark):
    # rows arrive out of order; open/close follow event time
    t = _ticks(spark, [100, 101, 102], [1, 1, 1])
    shuffled = t.orderBy(F.col("tick_number").desc())
    r = bars(shuffled, "1 minute", None).first()
    assert (r.open, r.close) == (100.0, 102.0)
