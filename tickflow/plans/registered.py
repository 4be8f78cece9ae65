"""Registered queries: one callable (spark, sf_dir) → DataFrame per key.

whole tables, no row caps. ``tickflow.plans.oracle_sql`` holds the
matching DuckDB SQL for the keys that have one.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.operators import alerts as A
from tickflow.operators import bars as B
from tickflow.operators import indicators as I
from tickflow.sources import tables as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BAR_SIZE, BAR_SLIDE = "1 hour", "30 minutes"


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def ticks(spark, sf_dir):
    return S.events_ticks(spark, sf_dir)


def enriched(spark, sf_dir):
    return I.enrich(ticks(spark, sf_dir), S.registry(spark))


def alerted(spark, sf_dir):
    return A.with_alerts(enriched(spark, sf_dir))


def sliding_bars(spark, sf_dir, **kw):
    return B.bars(alerted(spark, sf_dir), BAR_SIZE, BAR_SLIDE, **kw)


# --- indicators ------------------------------------------------------------

@register("returns")
def q_returns(spark, sf_dir):
    return I.with_returns(ticks(spark, sf_dir)).select(
        "symbol", "event_time", "tick_number", "price", "prev_price", "returns_pct")


@register("sma_signal")
def q_sma_signal(spark, sf_dir):
    return I.with_signal(I.with_sma(ticks(spark, sf_dir))).select(
        "symbol", "event_time", "tick_number", "price", "sma5", "sma20", "signal")


@register("realized_vol")
def q_realized_vol(spark, sf_dir):
    return I.with_realized_vol(ticks(spark, sf_dir)).select(
        "symbol", "event_time", "tick_number", "price", "realized_vol")


@register("rolling_ohlc5")
def q_rolling_ohlc5(spark, sf_dir):
    return I.with_rolling_ohlc(ticks(spark, sf_dir)).select(
        "symbol", "event_time", "tick_number", "price", "open", "high", "low")


@register("tick_number")
def q_tick_number(spark, sf_dir):
    return I.with_tick_number(ticks(spark, sf_dir)).select(
        "symbol", "event_time", "tick_number", "tick_seq")


@register("quote_spread")
def q_quote_spread(spark, sf_dir):
    return I.with_quote(ticks(spark, sf_dir), S.registry(spark)).select(
        "symbol", "asset_type", "tick_number", "price", "bid", "ask", "spread")


@register("enriched_ticks")
def q_enriched_ticks(spark, sf_dir):
    return enriched(spark, sf_dir)


# --- alerts ----------------------------------------------------------------

@register("alert_classify")
def q_alert_classify(spark, sf_dir):
    return alerted(spark, sf_dir).select(
        "symbol", "tick_number", "returns_pct", "price_alert", "alert_severity")


@register("alert_messages")
def q_alert_messages(spark, sf_dir):
    msgs = A.alert_messages(alerted(spark, sf_dir))
    fields = "symbol string, asset_type string, timestamp string, price double, " \
             "returns_pct double, volume bigint, price_alert string, alert_severity string"
    return msgs.select("key", F.from_json("value", fields).alias("v")).select("key", "v.*")


@register("alert_severity_counts")
def q_alert_severity_counts(spark, sf_dir):
    return (alerted(spark, sf_dir)
            .groupBy("symbol", "alert_severity")
            .agg(F.count(F.lit(1)).alias("n_ticks"),
                 F.count_if(F.col("price_alert") == "SPIKE").alias("n_spike"),
                 F.count_if(F.col("price_alert") == "FLASH_CRASH").alias("n_crash")))


@register("route_anomalies")
def q_route_anomalies(spark, sf_dir):
    e = enriched(spark, sf_dir)
    routed = A.route(e, {"market.ticks": F.lit(True), "market.anomalies": F.col("is_anomaly")})
    return routed.select("topic", "symbol", "tick_number", "is_anomaly", "anomaly_type")


# --- bars ------------------------------------------------------------------

@register("bars_sliding")
def q_bars_sliding(spark, sf_dir):
    return B.round_bars(sliding_bars(spark, sf_dir))


@register("bars_sliding_1min")
def q_bars_sliding_1min(spark, sf_dir):
    """The reference's own window: one minute, sliding by half a minute."""
    return B.round_bars(B.bars(A.with_alerts(enriched(spark, sf_dir)), "1 minute", "30 seconds"))


@register("bars_sliding_tick_ohlc")
def q_bars_sliding_tick_ohlc(spark, sf_dir):
    return B.round_bars(sliding_bars(spark, sf_dir, source="tick_ohlc"))


@register("bars_tumbling")
def q_bars_tumbling(spark, sf_dir):
    return B.round_bars(B.bars(alerted(spark, sf_dir), BAR_SIZE, None))


@register("bars_bollinger")
def q_bars_bollinger(spark, sf_dir):
    b = B.bollinger(sliding_bars(spark, sf_dir))
    return B.round_bars(b).select("window_start", "symbol", "vwap", "stddev_return_pct",
                                  "bollinger_upper", "bollinger_lower")


@register("bars_ohlc_valid")
def q_bars_ohlc_valid(spark, sf_dir):
    b = B.ohlc_valid(sliding_bars(spark, sf_dir, source="tick_ohlc"))
    return b.select("window_start", "symbol", "open", "high", "low", "close", "ohlc_valid")


# --- stored bars, staging, marts --------------------------------------------

from tickflow.operators import market as M  # noqa: E402
from tickflow.operators import quality as Q  # noqa: E402
from tickflow.operators.versions import latest_version  # noqa: E402
from tickflow.plans import marts as MT  # noqa: E402
from tickflow.plans.staging import stamp, staging  # noqa: E402

AS_OF = "2024-01-30 22:00:00"
VERSION_SPLIT = "2024-01-16 00:00:00"


def stored_bars(spark, sf_dir):
    """Bars as the bar sink stores them (created_at = window_end)."""
    return stamp(sliding_bars(spark, sf_dir))


def stg(spark, sf_dir):
    return staging(stored_bars(spark, sf_dir))


@register("staging_bars")
def q_staging_bars(spark, sf_dir):
    return stg(spark, sf_dir)


@register("mart_hourly")
def q_mart_hourly(spark, sf_dir):
    return MT.hourly_kpis(stg(spark, sf_dir), overlapping=True)


@register("mart_hourly_window_form")
def q_mart_hourly_window_form(spark, sf_dir):
    return MT.hourly_kpis_window_form(stg(spark, sf_dir), overlapping=True)


@register("mart_hourly_nonoverlap")
def q_mart_hourly_nonoverlap(spark, sf_dir):
    return MT.hourly_kpis(stg(spark, sf_dir), overlapping=False)


@register("mart_daily_anomaly")
def q_mart_daily_anomaly(spark, sf_dir):
    return MT.daily_anomalies(stg(spark, sf_dir), overlapping=True)


@register("bars_latest_version")
def q_bars_latest_version(spark, sf_dir):
    """Two update-mode batches: batch 0 emits the bars of the ticks before
    the split; batch 1 re-emits every bar that a later tick touched. Both
    versions come out of one aggregation pass (batch 0's aggregates are
    filtered to the early ticks). The newest version per key must equal
    the bars over all ticks."""
    t = alerted(spark, sf_dir)
    split = F.lit(VERSION_SPLIT).cast("timestamp_ntz")
    early = F.col("event_time") < split
    order = B.default_order(t)
    agg = (t.filter(F.col("price").isNotNull())
            .groupBy(F.window("event_time", BAR_SIZE, BAR_SLIDE).alias("w"), "symbol", "asset_type")
            .agg(F.struct(*B.bar_aggregates(order=order, where=early)).alias("v0"),
                 F.struct(*B.bar_aggregates(order=order)).alias("v1"),
                 F.count_if(early).alias("_n0"), F.max("event_time").alias("_last")))
    versions = (agg.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "symbol", "asset_type",
        F.explode(F.array(
            F.when(F.col("_n0") > 0, F.struct(F.lit(0).alias("batch_id"), "v0.*")),
            F.when(F.col("_last") >= split, F.struct(F.lit(1).alias("batch_id"), "v1.*")))).alias("v"))
        .filter(F.col("v").isNotNull())
        .select("window_start", "window_end", "symbol", "asset_type", "v.*"))
    return B.round_bars(latest_version(versions))


@register("bars_daily_lineitem")
def q_bars_daily_lineitem(spark, sf_dir):
    li = S.lineitem_ticks(spark, sf_dir)
    b = B.bars(li, "1 day", None, order=("event_time", "l_orderkey", "l_linenumber", "price"), full=False)
    return B.round_bars(b, {"vwap": 4})


# --- data quality -------------------------------------------------------------

def _checks(spark, sf_dir, lookback, coverage, ohlc="tolerant"):
    return Q.run_checks(stored_bars(spark, sf_dir), S.price_ranges(spark), AS_OF, lookback, coverage,
                        min_symbols=4, n_symbols=5, ohlc=ohlc)


@register("dq_checks")
def q_dq_checks(spark, sf_dir):
    return _checks(spark, sf_dir, "2 hours", "1 hour")


@register("dq_checks_wide")
def q_dq_checks_wide(spark, sf_dir):
    return _checks(spark, sf_dir, "240 hours", "240 hours")


@register("dq_checks_strict")
def q_dq_checks_strict(spark, sf_dir):
    return _checks(spark, sf_dir, "240 hours", "240 hours", ohlc="strict")


@register("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    return Q.not_null(stored_bars(spark, sf_dir), ["symbol", "window_start", "close", "volume"])


@register("dq_not_null_violated")
def q_dq_not_null_violated(spark, sf_dir):
    """The same checks over a store in which one symbol was lost: the check must fail."""
    bars = sliding_bars(spark, sf_dir).withColumn("symbol", F.nullif("symbol", F.lit("error")))
    return Q.not_null(stamp(bars), ["symbol", "window_start", "close", "volume"])


@register("dq_unknown_symbols")
def q_dq_unknown_symbols(spark, sf_dir):
    unknown = Q.unknown_symbols(ticks(spark, sf_dir), S.registry(spark, "markets"))
    return unknown.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_ticks"))


@register("dq_report")
def q_dq_report(spark, sf_dir):
    return Q.report(_checks(spark, sf_dir, "240 hours", "240 hours"), AS_OF)


# --- market views ---------------------------------------------------------------

@register("price_board")
def q_price_board(spark, sf_dir):
    return M.price_board(ticks(spark, sf_dir), S.registry(spark))


@register("top_movers")
def q_top_movers(spark, sf_dir):
    return M.top_movers(I.with_returns(ticks(spark, sf_dir)))


@register("market_summary")
def q_market_summary(spark, sf_dir):
    """The lists as text, since the compare works on flat columns."""
    names = lambda c: F.array_join(F.transform(c, lambda x: x["symbol"]), ",")
    s = M.market_summary(enriched(spark, sf_dir))
    return (s.withColumn("best_return", F.col("top_gainers")[0]["return_pct"])
            .withColumn("worst_return", F.element_at("top_losers", -1)["return_pct"])
            .withColumn("top_gainers", names("top_gainers")).withColumn("top_losers", names("top_losers"))
            .withColumn("anomalies", F.array_join(F.transform(
                "anomalies", lambda x: F.concat_ws(":", x["symbol"], x["anomaly_type"])), ",")))


@register("assets_by_type")
def q_assets_by_type(spark, sf_dir):
    return M.assets_by_type(ticks(spark, sf_dir))


@register("symbol_filter_latest_n")
def q_symbol_filter_latest_n(spark, sf_dir):
    return M.latest_ticks(ticks(spark, sf_dir), 50, symbol="click").select(
        "symbol", "event_time", "tick_number", "price", "volume")


@register("tick_totals")
def q_tick_totals(spark, sf_dir):
    return M.tick_totals(enriched(spark, sf_dir))


@register("market_snapshot")
def q_market_snapshot(spark, sf_dir):
    from tickflow.sources.topic import decode_snapshot
    snap = M.market_snapshot(enriched(spark, sf_dir), every="1 hour")
    return decode_snapshot(snap).select(
        F.col("snapshot_ts").cast("timestamp_ntz").alias("snapshot_end"), "entry_symbol",
        "tick_number", "price", "returns_pct", "volume")


# --- streaming (run to completion over a replay of the table) ------------------

from tickflow.streaming import runner as SR  # noqa: E402
from tickflow.streaming import stateful as ST  # noqa: E402
from tickflow.sinks import bar_store as BS  # noqa: E402
from tickflow.streaming import indicators as SI  # noqa: E402
from tickflow.streaming import late as LT  # noqa: E402
from tickflow.streaming import snapshots as SN  # noqa: E402
from tickflow.streaming.runs import checkpoint_of, run_replay  # noqa: E402
from tickflow.operators import sketches as SK  # noqa: E402
from tickflow.sinks import read_totals, sink_bars, sink_totals, write_batch  # noqa: E402


def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@register("stream_bars")
def q_stream_bars(spark, sf_dir):
    """Update-mode bar stream, 5 min watermark, newest version per bar."""
    stored, _ = run_replay(
        spark, enriched(spark, sf_dir),
        lambda raw: SR.stream_bars(SR.parse(raw), BAR_SIZE, BAR_SLIDE, "5 minutes"),
        mode="update", sink=lambda out: sink_bars(out), name="stream-bars")
    return B.round_bars(latest_version(stored.drop("created_at"))).drop("batch_id")


@register("stream_alerts")
def q_stream_alerts(spark, sf_dir):
    stored, _ = run_replay(spark, enriched(spark, sf_dir),
                           lambda raw: SR.stream_alerts(SR.parse(raw)), name="stream-alerts")
    fields = "symbol string, asset_type string, timestamp string, price double, " \
             "returns_pct double, volume bigint, price_alert string, alert_severity string"
    return stored.select("key", F.from_json("value", fields).alias("v")).select("key", "v.*")


@register("stream_raw_ticks")
def q_stream_raw_ticks(spark, sf_dir):
    stored, _ = run_replay(spark, enriched(spark, sf_dir),
                           lambda raw: SR.stream_raw(SR.parse(raw)), name="stream-raw")
    return _ntz(stored, "event_time").select(
        "symbol", "tick_number", "event_time", "price", "volume", "returns_pct",
        "price_alert", "alert_severity")


@register("stream_indicators")
def q_stream_indicators(spark, sf_dir):
    """Indicators computed on the stream from plain ticks (keyed state)."""
    stored, _ = run_replay(spark, ticks(spark, sf_dir),
                           lambda raw: ST.stream_indicators(SR.parse(raw), S.registry(spark)), name="stream-ind")
    return _ntz(stored, "event_time").select(*I.ENRICHED_COLUMNS, "late")


@register("stream_indicators_sliced")
def q_stream_indicators_sliced(spark, sf_dir):
    """The same with symbols cut into chunks and the last ticks handed from batch to batch."""
    stored, _ = run_replay(
        spark, ticks(spark, sf_dir), SR.parse, name="stream-sliced", read=lambda s, out: s.read.parquet(os.path.join(out, "ticks")),
        sink=lambda out: SI.sink_indicators(out, S.registry(spark), lambda df, i: write_batch(df, i, os.path.join(out, "ticks"))))
    return _ntz(stored, "event_time").select(*I.ENRICHED_COLUMNS, "late")


@register("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """Every tick is sent twice; the stream keeps one copy per key."""
    stored, _ = run_replay(spark, ticks(spark, sf_dir),
                           lambda raw: ST.dedup(SR.parse(raw)), resend=True, name="stream-dedup")
    return _ntz(stored, "event_time").select("symbol", "asset_type", "event_time", "tick_number",
                                             "price", "volume")


def _late_run(spark, sf_dir):
    """Slices replayed out of order (the second half first) into a store of bars and late ticks; its root."""
    roots: list[str] = []
    run_replay(
        spark, enriched(spark, sf_dir), lambda raw: LT.bars_and_ticks(SR.parse(raw), BAR_SIZE, BAR_SLIDE, "5 minutes"),
        mode="update", sink=lambda out: LT.sink_bars_and_late(out, checkpoint_of(out), BAR_SIZE, BAR_SLIDE), order=[2, 3, 0, 1],
        name="stream-late", read=lambda _, out: roots.append(out))
    return roots[0]


@register("stream_late_data")
def q_stream_late_data(spark, sf_dir):
    """Ticks behind the watermark are dropped from the bars; the number of
    their window assignments, as the stream stored them, stands next to each bar."""
    root = _late_run(spark, sf_dir)
    BS.merge_new(spark, root)
    dropped = LT.read_late(spark, root).agg(F.count(F.lit(1)).alias("dropped_window_rows"))  # one row
    bars_ = BS.read_newest(spark, root).drop("created_at", "date")
    return B.round_bars(bars_).join(F.broadcast(dropped))


@register("stream_late_ticks")
def q_stream_late_ticks(spark, sf_dir):
    """The late ticks themselves, one row per window they missed."""
    late = LT.read_late(spark, _late_run(spark, sf_dir))
    return _ntz(late, "event_time", "window_start", "window_end").drop("watermark", "batch_id")


@register("stream_hourly_rollup")
def q_stream_hourly_rollup(spark, sf_dir):
    """Hours of half-hour bars, kept up while the stream runs; the hours that are still open at its end, too."""
    hours, _ = run_replay(
        spark, enriched(spark, sf_dir), lambda raw: SR.stream_bars(SR.parse(raw), "30 minutes", None, "5 minutes"),
        mode="update", sink=lambda out: BS.sink_versions(out, merge=True), name="stream-rollup", read=BS.read_hours)
    return hours


@register("stream_market_snapshot")
def q_stream_market_snapshot(spark, sf_dir):
    """Snapshots as the stream emits them behind the watermark, and those of the buckets open at its end."""
    from tickflow.sources.topic import decode_snapshot
    snap, _ = run_replay(
        spark, enriched(spark, sf_dir), lambda raw: SR.parse(raw).withWatermark("event_time", "5 minutes"), name="stream-snapshots",
        sink=lambda out: SN.sink_snapshots(out, checkpoint_of(out), "1 hour"), read=lambda s, out: SN.read_snapshots(s, out, "1 hour"))
    return decode_snapshot(snap).select(
        F.col("snapshot_ts").cast("timestamp_ntz").alias("snapshot_end"), "entry_symbol",
        "tick_number", "price", "returns_pct", "volume")


@register("stream_tick_totals")
def q_stream_tick_totals(spark, sf_dir):
    """Ticks and anomalies per symbol over the stream's whole life."""
    totals, _ = run_replay(spark, enriched(spark, sf_dir), SR.parse, sink=sink_totals, name="stream-totals", read=read_totals)
    return totals


@register("stream_distinct_symbols")
def q_stream_distinct_symbols(spark, sf_dir):
    """Distinct symbols per day, from hourly sketches that a stream keeps up (newest version per hour)."""
    stored, _ = run_replay(spark, ticks(spark, sf_dir), lambda raw: SK.hourly_sketches(SR.parse(raw).withWatermark("event_time", "5 minutes")),
                           mode="update", name="stream-sketches")
    newest = latest_version(stored, keys=("hour_start",))
    return SK.distinct_count(newest, F.date_format("hour_start", "yyyy-MM-dd").alias("day"))


# --- topic codec, quarantine, store layout, hourly job ------------------------------

from tickflow.plans.jobs import JobPaths, hourly_job  # noqa: E402
from tickflow.session import scratch_path  # noqa: E402
from tickflow.sinks import write_bars, write_report  # noqa: E402
from tickflow.sinks.skipping import read_clustered, write_clustered  # noqa: E402
from tickflow.sources.topic import decode_ticks, encode_ticks, iso_utc, split_bad  # noqa: E402


@register("tick_decode_json")
def q_tick_decode_json(spark, sf_dir):
    """Encode enriched ticks as topic records and decode them back."""
    rec = encode_ticks(enriched(spark, sf_dir))
    d = decode_ticks(rec)
    return _ntz(d, "event_time", "kafka_ts").select(
        "symbol", "asset_type", "currency", "event_time", "kafka_ts", "tick_number", "price", "volume",
        "open", "high", "low", "bid", "ask", "spread", "returns_pct", "sma5", "sma20", "realized_vol",
        "is_anomaly", "anomaly_type", "signal")


@register("tick_bad_records")
def q_tick_bad_records(spark, sf_dir):
    """A tick topic that also carries misrouted payloads (the events'
    props objects: valid JSON, no symbol) and ticks whose volume is a
    decimal (wrong type for a long). Every row is counted once, either
    good or under its quarantine reason."""
    ev = S.read_table(spark, sf_dir, "events")
    good = encode_ticks(ticks(spark, sf_dir))
    misrouted = ev.select(F.lit(None).cast("binary").alias("key"),
                          F.col("props").cast("binary").alias("value"),
                          F.col("ts").cast("timestamp").alias("timestamp"))
    wrong_type = ev.select(
        F.col("event_type").cast("binary").alias("key"),
        F.to_json(F.struct(F.col("event_type").alias("symbol"),
                           iso_utc(F.col("ts")).alias("timestamp"),
                           (F.lit(100.0) + F.col("value") / F.lit(20.0)).alias("price"),
                           F.col("value").alias("volume"))).cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"))
    topic = good.unionByName(misrouted).unionByName(wrong_type)
    ok, bad = split_bad(decode_ticks(topic, keep_corrupt=True))
    return (ok.select(F.lit("ok").alias("reason")).unionByName(bad.select("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


@register("bars_partitioned_read")
def q_bars_partitioned_read(spark, sf_dir):
    """Bars written by day (partitioned, sorted by symbol and start) and
    read back through the date-partitioned layout."""
    path = scratch_path(spark, "bars-by-date")
    write_bars(B.round_bars(sliding_bars(spark, sf_dir)), path)
    return spark.read.parquet(path).drop("date")


ACCESS_FROM, ACCESS_TO = "2024-01-10 00:00:00", "2024-01-12 00:00:00"


@register("bars_access_paths")
def q_bars_access_paths(spark, sf_dir):
    """Bars by (symbol, window_start) and by (asset_type, window_start), hours by (symbol, hour_bucket), the
    report of an hour: each read opens only the files that may hold its rows."""
    root = scratch_path(spark, "access")
    bars_, marts, reports = (os.path.join(root, x) for x in ("bars", "mart_market_kpis", "reports"))
    stored = stored_bars(spark, sf_dir)
    write_clustered(stored, bars_, ("symbol", "asset_type", "window_start"), files=32)
    hours = MT.hourly_kpis(staging(spark.read.schema(stored.schema).parquet(bars_)), overlapping=True)
    write_clustered(hours, marts, ("symbol", "hour_bucket"), files=16)
    write_report(Q.report(_checks(spark, sf_dir, "240 hours", "240 hours"), AS_OF), reports, "2024013022")
    span = tuple(dt.datetime.fromisoformat(x) for x in (ACCESS_FROM, ACCESS_TO))
    summed = lambda name, df, n: df.agg(F.lit(name).alias("access_path"), F.count(F.lit(1)).alias("n_rows"), F.sum(n).cast("bigint").alias("total"))
    out = summed("symbol, window_start", read_clustered(spark, bars_, stored.schema, {"symbol": ("click", "click"), "window_start": span}), "volume")
    for name, df, n in (
            ("asset_type, window_start", read_clustered(spark, bars_, stored.schema, {"asset_type": ("crypto", "crypto"), "window_start": span}), "volume"),
            ("symbol, hour_bucket", read_clustered(spark, marts, hours.schema, {"symbol": ("click", "click"), "hour_bucket": span}), "hour_volume"),
            ("report_hour", spark.read.parquet(reports).filter(F.col("hour") == 2024013022), "checks_passed")):
        out = out.unionByName(summed(name, df, n))
    return out


@register("hourly_job_report")
def q_hourly_job_report(spark, sf_dir):
    """The hourly job over stored bar versions; returns the report."""
    root = scratch_path(spark, "hourly-job")
    paths = JobPaths(os.path.join(root, "bars"), os.path.join(root, "reports"), os.path.join(root, "marts"))
    BS.store_versions(stamp(sliding_bars(spark, sf_dir)), 0, paths.bars)
    return hourly_job(spark, AS_OF, paths, S.price_ranges(spark), "2 hours", "1 hour",
                      min_symbols=4, n_symbols=5, raise_on_failure=False)
