"""Mart equivalences and volume invariants."""

from pyspark.sql import functions as F

from tickflow.plans import marts as MT
from tickflow.plans import registered as R
from tickflow.operators.bars import bars

from conftest import SF001


def test_window_form_equals_group_form(spark):
    stg = R.stg(spark, SF001)
    a = MT.hourly_kpis(stg, overlapping=True)
    b = MT.hourly_kpis_window_form(stg, overlapping=True)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_overlap_counts_each_tick_twice(spark):
    t = R.alerted(spark, SF001)
    total = t.agg(F.sum("volume")).first()[0]
    sliding = bars(t, "1 hour", "30 minutes")
    assert sliding.agg(F.sum("volume")).first()[0] == 2 * total
    tumbling = MT.non_overlapping(sliding)
    assert tumbling.agg(F.sum("volume")).first()[0] == total
    assert bars(t, "1 hour", None).agg(F.sum("tick_count")).first()[0] == t.count()


def test_vwap_within_low_high(spark):
    b = bars(R.alerted(spark, SF001), "1 hour", "30 minutes")
    assert b.filter((F.col("vwap") < F.col("low") - 1e-9) | (F.col("vwap") > F.col("high") + 1e-9)).count() == 0


def test_daily_ordering(spark):
    d = MT.daily_anomalies(R.stg(spark, SF001), overlapping=True).collect()
    keys = [(r.trading_day, r.total_anomalies) for r in d]
    assert keys == sorted(keys, key=lambda k: (k[0], k[1]), reverse=True)
