"""Version store, hours, late ticks, clustered tables and sliced indicators."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tickflow.operators.bars import bars
from tickflow.operators.indicators import ENRICHED_COLUMNS, enrich
from tickflow.operators.versions import latest_version
from tickflow.plans import registered as R
from tickflow.plans.jobs import JobPaths, hourly_job
from tickflow.plans.marts import hourly_kpis
from tickflow.plans.staging import stamp, staging
from tickflow.session import scratch_path
from tickflow.sinks import bar_store as BS
from tickflow.sinks.skipping import files_for, read_clustered, write_clustered
from tickflow.sources.tables import price_ranges, registry
from tickflow.streaming import runner as SR
from tickflow.streaming.indicators import enrich_batch, read_tail, sink_indicators
from tickflow.streaming.late import bars_and_ticks, read_late, sink_bars_and_late
from tickflow.streaming.replay import write_replay

from conftest import SF001

AS_OF = R.AS_OF


def same(a, b):
    a = a.select(*b.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def two_batches(spark):
    """Bars of the ticks up to a time, then the bars that later ticks touch."""
    t = R.alerted(spark, SF001).persist()
    cut = dt.datetime(2024, 1, 20, 12, 10)
    first = stamp(bars(t.filter(F.col("event_time") < cut), "1 hour", "30 minutes"))
    touched = t.filter(F.col("event_time") >= cut).select(F.window("event_time", "1 hour", "30 minutes").alias("w"), "symbol").distinct()
    every = stamp(bars(t, "1 hour", "30 minutes"))
    second = every.join(touched.select(F.col("w.start").alias("window_start"), "symbol"), ["symbol", "window_start"], "left_semi")
    return first.persist(), second.select(*first.columns).persist(), every.persist()


def test_merge_reads_touched_days_only_and_equals_the_full_read(spark, two_batches):
    first, second, every = two_batches
    root = scratch_path(spark, "store-test")
    assert BS.merge_new(spark, root) == []
    BS.store_versions(first, 0, root)
    days = BS.merge_new(spark, root)
    assert days == sorted(r[0] for r in first.select(F.to_date("window_start")).distinct().collect())
    assert BS.merge_new(spark, root) == []  # nothing new
    kept = spark.read.parquet(os.path.join(root, "newest")).filter("date < '2024-01-19'").select(F.input_file_name().alias("f")).distinct().collect()
    BS.store_versions(second, 1, root)
    late = BS.merge_new(spark, root)
    assert late[0] == dt.date(2024, 1, 20) and set(late) < set(days) | set(late)
    again = spark.read.parquet(os.path.join(root, "newest")).filter("date < '2024-01-19'").select(F.input_file_name().alias("f")).distinct().collect()
    assert sorted(kept) == sorted(again)  # the other days' files are the same
    plan = BS.newest_of(BS.read_versions(spark, root), late, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "date#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    full = latest_version(BS.read_versions(spark, root).drop("date"))
    assert same(BS.read_newest(spark, root).drop("date"), full.drop("batch_id"))
    assert same(BS.read_newest(spark, root).drop("date"), every)


def test_replayed_batch_changes_nothing(spark, two_batches):
    first, second, every = two_batches
    root = scratch_path(spark, "store-replay")
    BS.store_versions(first, 0, root)
    BS.store_versions(second, 1, root)
    BS.store_versions(second, 1, root)
    days = BS.merge_new(spark, root)
    BS.roll_hours(spark, root, days)
    BS.roll_hours(spark, root, days)
    want = BS.hour_totals(every)
    assert same(BS.read_hours(spark, root), want)


def test_nulls_are_stored_and_counted_per_day(spark, two_batches):
    first = two_batches[0].limit(20)
    bad = first.withColumn("window_start", F.when(F.col("close") > F.lit(101.0), F.col("window_start"))).withColumn("volume", F.lit(None).cast("long"))
    root = scratch_path(spark, "store-nulls")
    BS.store_versions(bad, 0, root)
    BS.merge_new(spark, root)
    got = {r.column_name: r.null_count for r in BS.null_counts(spark, root).collect()}
    stored = BS.read_newest(spark, root)
    assert got["volume"] == stored.count() and got["window_start"] == stored.filter("window_start IS NULL").count()
    assert BS.NO_DAY in [r.date for r in BS.read_days(spark, root).collect()] or got["window_start"] == 0


def test_hourly_job_by_hour_equals_one_run(spark, two_batches):
    first, second, every = two_batches
    root = scratch_path(spark, "job-steps")
    paths = JobPaths(*(os.path.join(root, x) for x in ("bars", "reports", "marts")))
    run = lambda: hourly_job(spark, AS_OF, paths, price_ranges(spark), "240 hours", "240 hours", min_symbols=4, n_symbols=5,
                             overlapping=True, raise_on_failure=False).collect()
    BS.store_versions(first, 0, paths.bars)
    run()
    BS.store_versions(second, 1, paths.bars)
    stepwise = run()
    whole = R.Q.report(R.Q.run_checks(every, price_ranges(spark), AS_OF, "240 hours", "240 hours", 4, 5), AS_OF)
    assert [r.details for r in stepwise] == [r.details for r in whole.collect()]
    mart = spark.read.parquet(os.path.join(paths.marts, "mart_market_kpis")).drop("date")
    assert same(mart, hourly_kpis(staging(every), overlapping=True))


def test_job_does_days_that_a_stream_has_merged(spark, two_batches):
    """Counts added up equal the checks over all bars, for any lookback and mode."""
    first, second, every = two_batches
    root = scratch_path(spark, "job-merged")
    paths = JobPaths(*(os.path.join(root, x) for x in ("bars", "reports", "marts")))
    BS.store_versions(first, 0, paths.bars)
    BS.store_versions(second, 1, paths.bars)
    BS.merge_new(spark, paths.bars)
    ranges = price_ranges(spark)
    hourly_job(spark, AS_OF, paths, ranges, min_symbols=4, n_symbols=5, overlapping=True, raise_on_failure=False)
    mart = spark.read.parquet(os.path.join(paths.marts, "mart_market_kpis")).drop("date")
    assert same(mart, hourly_kpis(staging(every), overlapping=True))
    for as_of, lookback, coverage, ohlc in ((AS_OF, "2 hours", "1 hour", "tolerant"), (AS_OF, "240 hours", "30 minutes", "strict"), ("2024-01-21 03:15:00", "100 hours", "1 hour", "strict")):
        got = R.Q.merged_counts(BS.read_checks(spark, paths.bars), BS.read_newest(spark, paths.bars), as_of, lookback, coverage, ohlc).first()
        assert got.asDict() == R.Q.check_counts(every, ranges, as_of, lookback, coverage, ohlc).first().asDict()
    assert BS.new_days(spark, paths.bars, "job") == ([], 1)


def test_old_bar_created_lately_is_checked(spark):
    root = scratch_path(spark, "store-recent")
    row = R.stored_bars(spark, SF001).limit(1)
    old = row.withColumns({"window_start": F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"), "window_end": F.lit("2024-01-02 01:00:00").cast("timestamp_ntz"),
                           "created_at": F.lit(AS_OF).cast("timestamp_ntz")})
    older = old.withColumns({"window_start": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "created_at": F.col("window_end")})
    BS.store_versions(old.unionByName(older), 0, root)
    BS.merge_new(spark, root)
    assert BS.recent_days(spark, root, AS_OF, ("2 hours", "1 hour")) == [dt.date(2024, 1, 2)]


def test_late_ticks_are_stored_while_the_stream_runs(spark):
    """Also across a restart from the checkpoint, with the watermark of the batch before."""
    t = R.enriched(spark, SF001)
    root = scratch_path(spark, "late-store")
    dirs, _ = write_replay(t, os.path.join(root, "all"), n_slices=4)
    out, ck, topic = (os.path.join(root, x) for x in ("out", "ck", "topic"))

    def run():
        raw = SR.file_topic(spark, os.path.join(topic, "*"))
        q = SR.start(bars_and_ticks(SR.parse(raw), "1 hour", "30 minutes", "5 minutes"), "late-store", "update", ck,
                     sink_bars_and_late(out, ck, "1 hour", "30 minutes"), {"availableNow": True})
        q.awaitTermination()
        return sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p["stateOperators"])

    dropped = 0
    for i, j in enumerate([2, 3, 0, 1]):
        spark.read.parquet(dirs[j]).write.parquet(os.path.join(topic, f"s{i}"))
        if i % 2:
            dropped += run()
    late = read_late(spark, out)
    assert late.count() == 1040 and dropped > 0
    assert late.filter("window_end > watermark").isEmpty()
    kept = BS.merge_new(spark, out) and BS.read_newest(spark, out)
    ticks_in_bars = kept.agg(F.sum("tick_count")).first()[0]
    assert ticks_in_bars + late.count() == 2 * t.filter("event_time IS NOT NULL AND price IS NOT NULL").count()


@pytest.mark.parametrize("target_rows", [25, 2_000_000])
def test_sliced_indicators_equal_the_batch(spark, target_rows):
    """A hot symbol is cut into chunks of a bounded size; batches hand their last ticks on."""
    t = R.ticks(spark, SF001).withColumn("symbol", F.when(F.col("tick_number") % 3 > 0, F.lit("click")).otherwise(F.col("symbol")))
    t = t.withColumn("event_time", F.col("event_time").cast("timestamp")).persist()
    reg = registry(spark)
    root, got = scratch_path(spark, "sliced"), {}
    store = lambda df, i: got.__setitem__(i, df.collect())
    fn = sink_indicators(root, reg, store, target_rows=target_rows)
    cut1, cut2 = dt.datetime(2024, 1, 10, 12), dt.datetime(2024, 1, 20)
    c = F.col("event_time")
    parts = [t.filter(c < cut1), t.filter((c >= cut1) & (c < cut2)), t.filter(c >= cut2)]
    for i, p in enumerate(parts):
        fn(p, i)
    fn(parts[2], 2)  # a replayed batch
    want = {(r.symbol, r.tick_number): r for r in enrich(t, reg).collect()}
    rows = [r for i in got for r in got[i]]
    assert len(rows) == len(want) and not any(r.late for r in rows)
    assert all(tuple(r[k] for k in ENRICHED_COLUMNS) == tuple(want[(r.symbol, r.tick_number)][k] for k in ENRICHED_COLUMNS) for r in rows)
    assert read_tail(spark, root, 2).groupBy("symbol").count().agg(F.max("count")).first()[0] == 20


def test_sliced_indicators_pass_late_ticks_on(spark):
    t = R.ticks(spark, SF001).filter("symbol = 'click'").withColumn("event_time", F.col("event_time").cast("timestamp")).limit(50).persist()
    reg = registry(spark)
    empty = read_tail(spark, "", -1)
    _, tail = enrich_batch(t, empty, reg)
    out, after = enrich_batch(t, tail, reg)
    rows = out.collect()
    assert len(rows) == t.count() and all(r.late and r.sma5 is None and r.tick_seq is None and r.bid is not None for r in rows)
    assert same(after, tail)


def test_clustered_reads_open_few_files(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abcdefgh") * 3, rng.choice(["stock", "crypto", "forex", None]), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(40_000)), k)
            for k in range(6000)]
    df = spark.createDataFrame(rows, "symbol string, asset_type string, window_start timestamp_ntz, n int")
    path = scratch_path(spark, "curve")
    write_clustered(df, path, ("symbol", "asset_type", "window_start"), files=64)
    stored = spark.read.parquet(path + "-manifest").count()
    lo, hi = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 7)
    for bounds in ({"symbol": ("bbb", "bbb"), "window_start": (lo, hi)}, {"asset_type": ("forex", "forex"), "window_start": (lo, hi)},
                   {"window_start": (lo, hi)}, {"symbol": (None, "aaa")}):
        got, want = read_clustered(spark, path, df.schema, bounds), df
        for k, (low, high) in bounds.items():
            want = want if low is None else want.filter(F.col(k) >= F.lit(low))
            want = want if high is None else want.filter(F.col(k) <= F.lit(high))
        assert same(got, want)
        assert 0 < len(files_for(spark, path, bounds)) < stored / 2
        assert got.select(F.input_file_name()).distinct().count() <= len(files_for(spark, path, bounds))
    assert read_clustered(spark, path, df.schema, {"symbol": ("x", None)}).isEmpty()
    assert spark.read.parquet(path).count() == 6000
