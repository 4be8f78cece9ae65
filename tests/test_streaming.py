"""Streaming edge cases: bad records, snapshots, late data, restart,
empty batches, the two-query stream job."""

import datetime as dt
import json
import os

import pandas as pd
from pyspark.sql import functions as F

from tickflow.operators.versions import latest_version
from tickflow.operators.bars import bars, round_bars
from tickflow.plans import registered as R
from tickflow.schemas import TOPIC_RECORD
from tickflow.session import scratch_path
from tickflow.sinks import read_totals, sink_bars, topic_records, topic_write_options, write_batch
from tickflow.sources.topic import decode_snapshot, decode_ticks, split_bad, topic_options
from tickflow.streaming import runner as SR
from tickflow.streaming.replay import write_replay
from tickflow.streaming.runs import run_replay

from conftest import SF001


def _rec(value, ts="2024-01-01 00:00:00"):
    return (b"k", None if value is None else value.encode(), "market.ticks", 0, 0,
            dt.datetime.fromisoformat(ts))


def _tick(symbol="AAPL", ts="2024-01-01T12:00:00+00:00", price=100.0, volume=5, n=1, **kw):
    d = {"symbol": symbol, "asset_type": "stock", "timestamp": ts, "price": price, "volume": volume,
         "tick_number": n, "returns_pct": 0.0}
    d.update(kw)
    return json.dumps(d)


def test_topic_options_cap_only_on_demand():
    o = topic_options("ticks", "broker:9092")
    assert o["subscribe"] == "ticks" and o["kafka.bootstrap.servers"] == "broker:9092"
    assert o["startingOffsets"] == "latest" and o["failOnDataLoss"] == "false"
    assert "maxOffsetsPerTrigger" not in o and "minPartitions" not in o
    o = topic_options("ticks", "b:1", "earliest", max_per_trigger=1000, min_partitions=64)
    assert (o["startingOffsets"], o["maxOffsetsPerTrigger"], o["minPartitions"]) == ("earliest", "1000", "64")
    assert "maxOffsetsPerTrigger" not in topic_options("t", "b:1", max_per_trigger=None)


def test_bad_records_are_quarantined(spark):
    recs = [
        _rec(_tick()),
        _rec('{"symbol": "AAPL", "price": '),                 # malformed
        _rec(_tick(volume=1.5)),                               # wrong type for long
        _rec(None),                                            # no value
        _rec(_tick(ts="not-a-time")),                          # bad timestamp
        _rec(_tick(price=None)),                               # no price
        _rec(json.dumps({"k": 3})),                            # no symbol
    ]
    raw = spark.createDataFrame(recs, TOPIC_RECORD)
    good, bad = split_bad(decode_ticks(raw, keep_corrupt=True))
    assert good.count() == 1
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == sorted(["malformed", "malformed", "null_value", "bad_timestamp", "no_price",
                              "no_symbol"])


def test_snapshot_decode(spark):
    raw = spark.createDataFrame([_rec('{"AAPL":{"price":1.5},"BTC-USD":{"price":2}}')], TOPIC_RECORD)
    rows = {r.entry_symbol: r.price for r in decode_snapshot(raw).collect()}
    assert rows == {"AAPL": 1.5, "BTC-USD": 2.0}


def _write(spark, folder, recs):
    spark.createDataFrame(recs, TOPIC_RECORD).coalesce(1).write.parquet(folder)


def test_late_data_dropped_and_open_window_merged(spark):
    """Late rows are filtered against the watermark of the previous
    micro-batch (the rule that lets stateful operators be chained), so
    the late tick comes in the third batch."""
    root = scratch_path(spark, "late-test")
    topic = os.path.join(root, "topic")
    _write(spark, os.path.join(topic, "s0"), [
        _rec(_tick(ts="2024-01-01T12:00:10+00:00", n=1)),
        _rec(_tick(ts="2024-01-01T12:10:00+00:00", n=2)),
    ])
    _write(spark, os.path.join(topic, "s1"), [_rec(_tick(ts="2024-01-01T12:20:00+00:00", n=3))])
    _write(spark, os.path.join(topic, "s2"), [
        _rec(_tick(ts="2024-01-01T11:00:00+00:00", n=4)),            # behind the watermark
        _rec(_tick(ts="2024-01-01T12:19:40+00:00", n=5, price=90.0)),  # still-open window
    ])
    out = os.path.join(root, "out")
    raw = SR.file_topic(spark, os.path.join(topic, "*"))
    q = SR.start(SR.stream_bars(SR.parse(raw), "1 minute", "30 seconds", "5 minutes"), "late", "update",
                 os.path.join(root, "ck"), sink_bars(out), {"availableNow": True})
    q.awaitTermination()
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped == 2  # one late tick, two sliding windows
    b = latest_version(spark.read.parquet(out).drop("created_at"))
    starts = {r.window_start for r in b.collect()}
    assert dt.datetime(2024, 1, 1, 11, 0) not in starts
    merged = b.filter(F.col("window_start") == dt.datetime(2024, 1, 1, 12, 19, 30)).first()
    assert merged.tick_count == 2 and merged.low == 90.0


def test_restart_from_checkpoint_no_double_rows(spark):
    root = scratch_path(spark, "restart-test")
    topic, out, ck = (os.path.join(root, n) for n in ("topic", "out", "ck"))
    t = R.enriched(spark, SF001)
    dirs, _ = write_replay(t, os.path.join(root, "all"), n_slices=4)

    def run():
        raw = SR.file_topic(spark, os.path.join(topic, "*"))
        q = SR.start(SR.stream_bars(SR.parse(raw), "1 hour", "30 minutes"), "restart", "update", ck,
                     sink_bars(out), {"availableNow": True})
        q.awaitTermination()

    for i in (0, 1):
        spark.read.parquet(dirs[i]).write.parquet(os.path.join(topic, f"s{i}"))
    run()
    n_batches = len([d for d in os.listdir(out.removeprefix("file:")) if d.startswith("batch_id=")])
    run()  # nothing new: no new batch
    assert len([d for d in os.listdir(out.removeprefix("file:")) if d.startswith("batch_id=")]) == n_batches
    for i in (2, 3):
        spark.read.parquet(dirs[i]).write.parquet(os.path.join(topic, f"s{i}"))
    run()
    got = round_bars(latest_version(spark.read.parquet(out).drop("created_at"))).drop("batch_id")
    want = round_bars(bars(R.alerted(spark, SF001), "1 hour", "30 minutes"))
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_empty_batch_and_idempotent_rewrite(spark):
    root = scratch_path(spark, "empty-test")
    empty = spark.createDataFrame([], "a int")
    write_batch(empty, 0, root)
    assert spark.read.parquet(root).count() == 0
    one = spark.createDataFrame([(1,)], "a int")
    write_batch(one, 1, root)
    write_batch(one, 1, root)  # replayed batch replaces, not appends
    assert spark.read.parquet(root).count() == 1


def test_stream_job_two_queries(spark):
    root = scratch_path(spark, "job-stream")
    topic = os.path.join(root, "topic")
    write_replay(R.enriched(spark, SF001), topic, n_slices=2)
    bad = os.path.join(topic, "s99999")
    _write(spark, bad, [_rec('{"oops"'), _rec(None)])
    t = SR.targets_under(os.path.join(root, "out"))
    qs = SR.stream_job(spark, SR.file_topic(spark, os.path.join(topic, "*")), t, "1 hour", "30 minutes",
                       triggers=({"availableNow": True}, {"availableNow": True}))
    for q in qs:
        q.awaitTermination()
        assert q.exception() is None
    n = R.ticks(spark, SF001).count()
    assert spark.read.parquet(t.raw).count() == n
    observed = sum(p["observedMetrics"]["tick_totals"]["sent_ticks"]
                   for p in qs[0].recentProgress if "tick_totals" in p.get("observedMetrics", {}))
    assert observed == n + 2
    assert spark.read.parquet(t.quarantine).count() == 2
    alerts = spark.read.parquet(t.alerts).count()
    assert alerts == R.alerted(spark, SF001).filter("price_alert IS NOT NULL").count()
    assert spark.read.parquet(t.bars).count() > 0
    totals = {r.symbol: r.sent_ticks for r in read_totals(spark, t.totals).collect()}
    assert totals == {r.symbol: r["count"] for r in R.ticks(spark, SF001).groupBy("symbol").count().collect()}


def test_replay_keeps_ticks_without_a_time(spark):
    t = R.ticks(spark, SF001).withColumn("event_time", F.when(F.col("tick_number") % 10 > 0, F.col("event_time")))
    dirs, files = write_replay(t, os.path.join(scratch_path(spark, "null-times"), "topic"), n_slices=3)
    assert files == 1 and sum(spark.read.parquet(d).count() for d in dirs) == t.count()
    assert spark.read.parquet(dirs[0]).filter("timestamp IS NULL").count() == t.filter("event_time IS NULL").count() > 0
    _, two = write_replay(t, os.path.join(scratch_path(spark, "two-files"), "topic"), n_slices=3, files_per_slice=2)
    assert two == 2


def test_a_large_slice_is_spread_over_several_files(spark):
    t = spark.range(0, 60_000, 1, 1).selectExpr("'a' AS symbol", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id) AS event_time",
                                                "id AS tick_number", "1.0D AS price")
    dirs, files = write_replay(t, os.path.join(scratch_path(spark, "large-slice"), "topic"), n_slices=1)
    rows = [r["count"] for r in spark.read.parquet(dirs[0]).groupBy(F.input_file_name()).count().collect()]
    assert files == len(rows) == 3 and sum(rows) == 60_000 and max(rows) < 25_000


def test_topic_output_options_and_records(spark):
    assert topic_write_options("b:1", "alerts") == {"kafka.bootstrap.servers": "b:1", "topic": "alerts"}
    assert topic_write_options("b:1") == {"kafka.bootstrap.servers": "b:1"}
    df = spark.createDataFrame([("k", "v", "t", 1)], "key string, value string, topic string, other int")
    assert topic_records(df).dtypes == [("key", "binary"), ("value", "binary"), ("topic", "string")]
    assert topic_records(df.drop("topic")).columns == ["key", "value"]


def test_late_ticks_are_counted_alike_for_any_number_of_files(spark):
    from tickflow.streaming.runs import late_windows
    counts = set()
    for files in (1, 3):
        folders = []
        _, progress = run_replay(spark, R.enriched(spark, SF001), lambda raw: SR.stream_bars(SR.parse(raw), "1 hour", "30 minutes", "5 minutes"),
                                 mode="update", order=[2, 3, 0, 1], name="late-files", files_per_slice=files, batch_dirs=folders)
        counts.add(late_windows(spark, folders, progress, "1 hour", "30 minutes"))
    assert counts == {1040}


def test_rows_left_out_by_a_standalone_stream_are_counted(spark):
    t = R.ticks(spark, SF001).withColumn("event_time", F.when(F.col("tick_number") % 10 > 0, F.col("event_time")))
    stored, progress = run_replay(spark, t, lambda raw: SR.stream_raw(SR.parse(raw)), name="left-out")
    seen = [p["observedMetrics"]["quarantine"] for p in progress if p["numInputRows"] > 0]
    assert sum(m["records"] for m in seen) == t.count()
    assert sum(m["left_out"] for m in seen) == t.count() - stored.count() == t.filter("event_time IS NULL").count()


def test_idle_symbols_are_forgotten_only_on_request():
    from tickflow.streaming.stateful import _indicators

    class State:
        def __init__(self, out):
            self.hasTimedOut, self.exists, self.calls = out, False, []

        def update(self, value):
            self.exists = True
            self.calls.append(("update", value[3]))

        def remove(self):
            self.calls.append(("remove",))

        def setTimeoutDuration(self, ms):
            self.calls.append(("timeout", ms))

    rows = pd.DataFrame({"symbol": ["a"] * 2, "asset_type": ["x"] * 2, "currency": ["USD"] * 2, "tick_number": [1, 2],
                         "event_time": pd.to_datetime(["2024-01-01", "2024-01-02"]), "price": [1.0, 2.0], "volume": [1, 1]})
    for idle, want in ((None, [("update", 2)]), (500, [("update", 2), ("timeout", 500)])):
        state = State(False)
        out = pd.concat(_indicators(("a",), iter([rows]), state, idle))
        assert state.calls == want and out["tick_seq"].tolist() == [1, 2] and out["hi"].tolist() == [1.0, 2.0]
    gone = State(True)
    assert list(_indicators(("a",), iter([]), gone, 500)) == [] and gone.calls == [("remove",)]
