"""Physical-plan properties that matter at scale."""

import os

from pyspark.sql import functions as F

from tickflow.operators import indicators as I
from tickflow.operators.bars import bars
from tickflow.plans import marts as MT
from tickflow.plans import registered as R
from tickflow.plans.staging import staging
from tickflow.session import scratch_path
from tickflow.sinks import write_bars
from tickflow.sources.tables import events_ticks, registry

from conftest import SF001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns(spark):
    p = plan(events_ticks(spark, SF001).select("symbol", "price"))
    assert "ReadSchema: struct<event_type:string,value:double>" in p


def test_registry_join_is_broadcast_by_its_size(spark):
    p = plan(I.with_quote(events_ticks(spark, SF001), registry(spark)))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_bars_are_one_hash_aggregate_with_map_side_combine(spark):
    text = R.sliding_bars(spark, SF001)._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate(keys=[window" in text and "partial_" in text


def test_route_and_movers_read_their_source_once(spark):
    # the ticks are scanned twice (chunk map, windows), their (symbol, chunk) windows run once
    routed = plan(R.q_route_anomalies(spark, SF001))
    movers = plan(R.q_top_movers(spark, SF001))
    assert "Union" not in routed and "Union" not in movers
    assert routed.split("== Initial Plan ==")[-1].count("Scan parquet") <= 2
    # the lists are bounded top-k over one stored row per symbol: no window over all symbols
    assert "Window" not in movers and "TakeOrderedAndProject" in movers and "events.parquet" not in movers


def test_hourly_mart_group_form_has_no_window(spark):
    path = scratch_path(spark, "plan-mart")
    R.stamp(bars(R.alerted(spark, SF001), "1 hour", "30 minutes")).write.parquet(path)
    stg = staging(spark.read.parquet(path))
    group_form = plan(MT.hourly_kpis(stg, overlapping=True))
    window_form = plan(MT.hourly_kpis_window_form(stg, overlapping=True))
    assert "Window" not in group_form and "Window" in window_form
    # both need one exchange (DISTINCT reuses the window's partitioning),
    # but the window form also sorts every bar
    assert "Sort [" not in group_form and "Sort [" in window_form


def test_staging_filter_pushed_to_parquet(spark):
    path = scratch_path(spark, "plan-bars")
    write_bars(R.stamp(bars(R.alerted(spark, SF001), "1 hour", "30 minutes")), path)
    stg = staging(spark.read.parquet(path))
    p = plan(stg)
    pushed = p[p.index("PushedFilters"):]
    assert "GreaterThan(close,0.0)" in pushed and "IsNotNull(volume)" in pushed


def test_date_partition_pruning(spark):
    path = scratch_path(spark, "plan-bars-date")
    write_bars(R.stamp(bars(R.alerted(spark, SF001), "1 hour", "30 minutes")), path)
    df = spark.read.parquet(path).filter(F.col("date") == "2024-01-20")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(date" in p
    assert os.path.isdir(os.path.join(path.removeprefix("file:"), "date=2024-01-20"))
