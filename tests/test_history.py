"""The chunked per-key window equals the one-task-per-key window."""

import datetime as dt
import os

import pandas as pd
from hypothesis import given, settings, strategies as st, HealthCheck
from pyspark.sql import functions as F

from tickflow.operators import indicators as I
from tickflow.operators import market as M
from tickflow.operators.history import over_history, over_key
from tickflow.sources.tables import events_ticks, registry

from conftest import SF001

ORDER = ["event_time", "tick_number"]


def _stages():
    return [
        {"_prev": lambda w: F.lag("price").over(w),
         "_s20": lambda w: F.avg("price").over(w.rowsBetween(-19, 0)),
         "_o5": lambda w: F.first("price").over(w.rowsBetween(-4, 0))},
        {"_ret": lambda w: (F.col("price") - F.col("_prev")) / F.col("_prev")},
        {"_ms": lambda w: F.avg(F.col("_ret") * F.col("_ret")).over(w.rowsBetween(-9, 0))},
    ]


def _rows(df):
    cols = ["symbol", "tick_number", "_prev", "_s20", "_o5", "_ms", "_seq"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def _check(df, target_rows, unit="minute", **kw):
    a = over_history(df, "symbol", ORDER, 19, _stages(), seq_col="_seq",
                     unit=unit, target_rows=target_rows, **kw)
    b = over_key(df, "symbol", ORDER, _stages(), seq_col="_seq")
    assert _rows(a) == _rows(b)


def test_chunked_equals_per_key_on_events(spark):
    t = events_ticks(spark, SF001)
    for target in (20, 37, 250, 10_000):
        _check(t, target)
    _check(t, 25, unit="hour")


def test_chunk_map_shuffled_when_it_is_too_large_to_broadcast(spark):
    # nothing but its size decides: with the threshold off, both sides are shuffled, with the same rows
    t = events_ticks(spark, SF001)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        _check(t, 37)
        plan = over_history(t, "symbol", ORDER, 19, _stages(), target_rows=37)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_a_busy_minute_is_split_over_tasks(spark):
    # 5,000 rows of one symbol in one minute, 100 to a chunk: counted after a real window over (symbol, chunk)
    base = dt.datetime(2024, 1, 1)
    rows = [("hot", base + dt.timedelta(milliseconds=12 * i), i, 100.0 + (i % 13)) for i in range(5000)]
    rows += [("cold", base + dt.timedelta(minutes=i), 10_000 + i, 50.0 + i % 5) for i in range(40)]
    df = spark.createDataFrame(rows, "symbol string, event_time timestamp_ntz, tick_number bigint, price double")
    _check(df, 100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        out = over_history(df, "symbol", ORDER, 19, [{"_prev": lambda w: F.lag("price").over(w)}], target_rows=100)
        # the window's column is used, or it would be pruned together with its exchange
        tasks = out.filter("symbol = 'hot'").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max("_prev"))
        assert "Window" in tasks._jdf.queryExecution().optimizedPlan().toString()
        per_task = [r["n"] for r in tasks.collect()]
        assert sum(per_task) == 5000 and len(per_task) > 20 and max(per_task) < 1000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_folder_that_grows_between_two_reads(spark, tmp_path):
    path = str(tmp_path / "ticks")
    base = dt.datetime(2024, 1, 1)

    def ticks(first):
        rows = [("s", base + dt.timedelta(minutes=i), i, 100.0 + i) for i in range(first, first + 10)]
        return pd.DataFrame(rows, columns=["symbol", "event_time", "tick_number", "price"])

    def read():
        return spark.read.schema("symbol string, event_time timestamp_ntz, tick_number bigint, price double").parquet(path)

    os.makedirs(path)
    ticks(0).to_parquet(os.path.join(path, "a.parquet"), coerce_timestamps="us")
    assert I.with_returns(read()).count() == 10
    registry_rows = spark.createDataFrame([("s", "stock", 100.0), ("silent", "stock", 7.0)], "symbol string, asset_type string, initial_price double")
    assert {(r.symbol, r.price) for r in M.price_board(read(), registry_rows).collect()} == {("s", 109.0), ("silent", 7.0)}
    ticks(10).to_parquet(os.path.join(path, "b.parquet"), coerce_timestamps="us")  # another writer, not this session
    assert I.with_returns(read()).count() == 20
    assert {(r.symbol, r.price) for r in M.price_board(read(), registry_rows).collect()} == {("s", 119.0), ("silent", 7.0)}
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 400),
                          st.floats(1, 200, allow_nan=False)), min_size=1, max_size=120),
       st.integers(20, 60))
def test_chunked_property(spark, rows, target):
    base = dt.datetime(2024, 1, 1)
    data = [(s, base + dt.timedelta(seconds=sec * 17), i, float(p)) for i, (s, sec, p) in enumerate(rows)]
    df = spark.createDataFrame(data, "symbol string, event_time timestamp_ntz, tick_number bigint, price double")
    _check(df, target)


def test_enrich_invariants(spark):
    e = I.enrich(events_ticks(spark, SF001), registry(spark))
    bad = e.filter(~(F.col("bid") < F.col("ask")) | ~(F.col("high") >= F.col("low"))
                   | ~F.col("signal").isin("BUY", "SELL") | ~(F.col("price") > 0)).count()
    assert bad == 0
    rel = (e.groupBy("asset_type").agg(F.avg(F.col("spread") / F.col("price")).alias("r"))
            .collect())
    r = {x.asset_type: x.r for x in rel}
    assert r["forex"] < r["stock"] < r["crypto"]
    firsts = e.filter("tick_seq = 1")
    assert firsts.count() == 5
    assert firsts.filter("returns_pct IS NULL AND realized_vol IS NULL").count() == 5
