"""Sketches of distinct symbols, running totals, streamed snapshots."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tickflow.operators.market import market_snapshot
from tickflow.operators.sketches import distinct_count, hourly_sketches
from tickflow.plans import registered as R
from tickflow.session import scratch_path
from tickflow.sinks import read_totals, sink_totals
from tickflow.sources.topic import decode_snapshot
from tickflow.streaming import runner as SR
from tickflow.streaming.replay import write_replay
from tickflow.streaming.snapshots import read_snapshots, sink_snapshots

from conftest import SF001, SF01


def test_union_of_hours_agrees_with_the_direct_sketch_and_the_error_is_small(spark):
    """The union estimates from its registers alone, so the two numbers differ a little."""
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select(
        F.col("l_orderkey").alias("symbol"), (F.lit(dt.datetime(2024, 1, 1)) + F.expr("make_dt_interval(0, l_partkey % 24)")).alias("event_time"))
    hours = hourly_sketches(li)
    assert hours.count() == 24
    united = distinct_count(hours).first()["n_symbols"]
    direct = li.agg(F.hll_sketch_estimate(F.hll_sketch_agg("symbol", 12))).first()[0]
    assert abs(united - direct) < 0.01 * direct
    assert united == distinct_count(hours.repartition(7)).first()["n_symbols"]
    exact = li.select("symbol").distinct().count()
    assert exact > 10_000 and abs(united - exact) < 0.05 * exact
    assert distinct_count(hours.limit(0)).first()["n_symbols"] in (0, None)


def _stream(spark, name):
    """Root of a run and a function that sends the next slices and runs the query to its end."""
    root = scratch_path(spark, name)
    t = R.enriched(spark, SF001)
    dirs, _ = write_replay(t, os.path.join(root, "all"), n_slices=4)
    topic, ck = os.path.join(root, "topic"), os.path.join(root, "ck")

    def run(slices, build, sink):
        for i in slices:
            spark.read.parquet(dirs[i]).write.parquet(os.path.join(topic, f"s{i}"))
        q = SR.start(build(SR.parse(SR.file_topic(spark, os.path.join(topic, "*")))), name, "append", ck, sink, {"availableNow": True})
        q.awaitTermination()

    return t, root, ck, run


def test_totals_hold_over_a_restart_and_a_replayed_batch(spark):
    t, root, _, run = _stream(spark, "totals")
    out = os.path.join(root, "out")
    seen = {}

    def sink(df, i):
        sink_totals(out)(df, i)
        sink_totals(out)(df, i)  # the batch comes again
        seen[i] = True

    run((0, 1), lambda x: x, sink)
    run((2, 3), lambda x: x, sink)
    want = R.M.tick_totals(t.filter("event_time IS NOT NULL"))
    assert len(seen) == 4
    assert sorted(map(tuple, read_totals(spark, out).collect())) == sorted(map(tuple, want.collect()))


def test_snapshots_of_a_stream_equal_the_batch_over_a_restart(spark):
    t, root, ck, run = _stream(spark, "snapshots")
    out = os.path.join(root, "out")
    build = lambda x: x.withWatermark("event_time", "5 minutes")
    sink = sink_snapshots(out, ck, "1 hour")
    run((0, 1), build, sink)
    run((2, 3), build, sink)
    flat = lambda s: sorted(((r.snapshot_ts, r.entry_symbol, r.tick_number, r.price) for r in decode_snapshot(s).collect()))
    whole = market_snapshot(t.filter("event_time IS NOT NULL"), "1 hour")
    assert flat(read_snapshots(spark, out, "1 hour")) == flat(whole)
    due = read_snapshots(spark, out, "1 hour", include_open=False)
    assert 0 < due.count() < whole.count()
