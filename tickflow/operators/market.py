"""Market views over ticks: price board, movers, summary, assets by
type, latest ticks, totals and the periodic whole-market snapshot.

Every view first reduces to one row per symbol (or per bucket and
symbol) with ``max_by`` on the order key, partially on the map side, so
the per-symbol lists and the final small sorts are bounded by the number
of symbols, never by the number of ticks. (A ``max_by`` of several
columns at once is sort-based; see ``latest_per_symbol``.)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.functions.numeric import rnd
from tickflow.operators.joins import with_dimension
from tickflow.schemas import TICK
from tickflow.session import scratch_path

ORDER_KEY = ("event_time", "tick_number")


def latest_per_symbol(df: DataFrame, order=ORDER_KEY, two_pass: bool = True) -> DataFrame:
    """Newest tick per symbol.

    A ``max_by`` over a struct of columns has a variable-width buffer, so
    Spark aggregates it sort-based. Over a plain scan that would sort
    every input partition; ``two_pass`` avoids it: (1) ``max(event_time)``
    per symbol — a fixed-width hash aggregate; (2) a semi join with that
    small table (AQE broadcasts it) keeps only the rows at that time
    (ties), and the struct ``max_by`` runs on those few rows. Both passes
    are one plan over the same files; nothing is cached. Over indicator output (``enrich``), rows already come
    sorted by symbol from the window stage, so the single sort-based
    aggregate needs no extra sort and ``two_pass=False`` is cheaper than
    evaluating the windows twice.
    """
    if not two_pass:
        others = [c for c in df.columns if c != "symbol"]
        return (df.groupBy("symbol")
                  .agg(F.max_by(F.struct(*others), F.struct(*[F.col(c) for c in order])).alias("t"))
                  .select("symbol", "t.*"))
    ts = order[0]
    newest = df.groupBy(F.col("symbol").alias("_s")).agg(F.max(ts).alias("_newest"))
    cand = df.join(newest, (F.col("symbol") == F.col("_s")) & (F.col(ts) == F.col("_newest")), "left_semi")
    others = [c for c in df.columns if c != "symbol"]
    return (cand.groupBy("symbol")
                .agg(F.max_by(F.struct(*others), F.struct(*[F.col(c) for c in order])).alias("t"))
                .select("symbol", "t.*"))


def price_board(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Per registry symbol: latest price, type, initial price and
    PnL % = round((price / initial − 1)·100, 2). A symbol without a tick
    stands at its initial price."""
    latest = latest_per_symbol(df.select("symbol", "event_time", "tick_number", "price"))
    b = registry.select("symbol", "asset_type", "initial_price").join(
        latest.select("symbol", F.col("price").alias("_price")), "symbol", "left")
    b = b.withColumn("price", F.coalesce("_price", "initial_price"))
    return b.select("symbol", "asset_type", "price", "initial_price",
                    rnd((F.col("price") / F.col("initial_price") - F.lit(1.0)) * F.lit(100.0), 2)
                    .alias("pnl_pct"))


def _ends(latest: DataFrame, k: int) -> DataFrame:
    """One row: how many symbols, the k best and the k worst of one descending order (ties by symbol, NULL returns last).

    Each list is a bounded top-k: every task keeps k rows, k rows are merged.
    """
    one = F.struct("symbol", F.col("returns_pct").alias("return_pct"))

    def side(name: str, *order) -> DataFrame:
        top = latest.select("symbol", "returns_pct").orderBy(*order).limit(k)
        ranked = F.sort_array(F.collect_list(F.struct(F.col("returns_pct").isNull(), -F.col("returns_pct"), F.col("symbol"), one.alias("one"))))
        return top.agg(F.transform(ranked, lambda x: x["one"]).alias(name))

    best = side("best", F.col("returns_pct").desc_nulls_last(), F.col("symbol"))
    worst = side("worst", F.col("returns_pct").asc_nulls_first(), F.col("symbol").desc())
    n = latest.agg(F.count(F.lit(1)).alias("n"))
    return n.join(F.broadcast(best)).join(F.broadcast(worst))  # one row each


def _stored(latest: DataFrame) -> DataFrame:
    """One row per symbol, written once: the ticks behind it are read once, not for every list."""
    spark = latest.sparkSession
    path = scratch_path(spark, "latest-per-symbol")
    latest.write.parquet(path)
    return spark.read.schema(latest.schema).parquet(path)


def top_movers(df: DataFrame, k: int = 3, two_pass: bool = False) -> DataFrame:
    """Top-k gainers and bottom-k losers by returns_pct over the latest
    tick of each symbol. Both lists come from one descending order
    (ties by symbol, NULL returns last); losers are its last k rows, in
    that order (worst last). rank is the position in the descending list."""
    latest = _stored(latest_per_symbol(df.select("symbol", "event_time", "tick_number", "returns_pct"),
                                       two_pass=two_pass))
    sides = F.concat(
        F.transform("best", lambda x, i: F.struct(F.lit("gainer").alias("side"), (i + 1).cast("int").alias("rank"), x.alias("x"))),
        F.transform("worst", lambda x, i: F.struct(F.lit("loser").alias("side"), (F.col("n") - F.size("worst") + i + 1).cast("int").alias("rank"), x.alias("x"))))
    return _ends(latest, k).select(F.explode(sides).alias("m")).select("m.side", "m.rank", "m.x.symbol", "m.x.return_pct")


def market_summary(df: DataFrame, two_pass: bool = False, k: int = 3) -> DataFrame:
    """Time of the newest tick, total volume, advancers, mood (BULLISH iff
    strictly more than half of the symbols rose), the k best and k worst
    symbols in one descending order (ties by symbol, NULL returns last)
    and the current anomalies (symbol, anomaly_type), over each symbol's
    latest tick. Only the list of anomalies grows, with their number."""
    latest = _stored(latest_per_symbol(df.select("symbol", "event_time", "tick_number", "returns_pct",
                                                 "volume", "is_anomaly", "anomaly_type"), two_pass=two_pass))
    n = F.count(F.lit(1))
    up = F.count_if(F.col("returns_pct") > 0)
    totals = latest.agg(
        F.max("event_time").alias("timestamp"),
        F.sum("volume").alias("total_volume"),
        n.alias("n_symbols"),
        up.alias("n_advancing"),
        F.when(up > n / F.lit(2.0), F.lit("BULLISH")).otherwise(F.lit("BEARISH")).alias("market_mood"),
        F.sort_array(F.collect_list(F.when(F.col("is_anomaly"), F.struct("symbol", "anomaly_type"))))
        .alias("anomalies"))
    ends = _ends(latest, k).select(F.col("best").alias("top_gainers"), F.col("worst").alias("top_losers"))
    return totals.join(F.broadcast(ends))


def assets_by_type(df: DataFrame) -> DataFrame:
    """Symbols per asset type, sorted, comma-joined."""
    return (df.select("asset_type", "symbol").groupBy("asset_type")
              .agg(F.count_distinct("symbol").alias("n_symbols"),
                   F.array_join(F.sort_array(F.collect_set("symbol")), ",").alias("symbols")))


def latest_ticks(df: DataFrame, n: int, symbol: str | None = None) -> DataFrame:
    """Newest n ticks (optionally of one symbol; the filter is pushed to
    the scan). A top-k: one bounded TakeOrderedAndProject."""
    src = df.filter(F.col("symbol") == F.lit(symbol)) if symbol else df
    return src.orderBy(F.col("event_time").desc(), F.col("tick_number").desc()).limit(n)


def tick_totals(df: DataFrame) -> DataFrame:
    """Ticks and anomalies sent, per symbol (the producer's counters)."""
    return df.groupBy("symbol").agg(F.count(F.lit(1)).alias("sent_ticks"),
                                     F.count_if(F.col("is_anomaly")).alias("sent_anomalies"))


def market_snapshot(df: DataFrame, every: str = "10 seconds", until: dt.datetime | None = None) -> DataFrame:
    """Whole-market snapshot per time bucket: the latest tick of every
    symbol as of the bucket's end, as one JSON object symbol → tick (a
    Kafka-shaped record with key 'snapshot'). A symbol that is silent in
    a bucket keeps its last known tick, from its first tick to the last
    bucket of the data (or to the one that starts at ``until``); a bucket
    without any tick has its snapshot too."""
    fields = [f.name for f in TICK.fields if f.name in df.columns or f.name == "timestamp"]
    src = df if "timestamp" in df.columns else df.withColumn(
        "timestamp", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))
    per = (src.groupBy(F.window("event_time", every).alias("w"), "symbol")
              .agg(F.max_by(F.struct(*[F.col(c) for c in fields]),
                            F.struct(*[F.col(c) for c in ORDER_KEY])).alias("t")))
    # carry each tick forward to the bucket before the symbol's next one
    step = F.expr(f"INTERVAL {every}")
    per = per.select(F.col("w.start").alias("b"), "symbol", "t")
    ends = F.lead("b").over(Window.partitionBy("symbol").orderBy("b")) - step
    per = per.withColumn("_until", ends)
    if until is None:
        per = per.join(F.broadcast(per.agg(F.max("b").alias("_last"))))  # one row
    else:
        per = per.withColumn("_last", F.lit(until))
    per = per.withColumn(
        "b", F.explode(F.sequence("b", F.coalesce("_until", "_last"), step)))
    snap = per.groupBy("b").agg(F.map_from_entries(F.collect_list(F.struct("symbol", "t"))).alias("m"))
    return snap.select(F.lit("snapshot").cast("binary").alias("key"),
                       F.to_json("m").cast("binary").alias("value"),
                       (F.col("b") + step).cast("timestamp").alias("timestamp"),
                       F.col("b").alias("snapshot_start"))
