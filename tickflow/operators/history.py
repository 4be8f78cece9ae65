"""Row-frame window functions per key without one task per key.

``Window.partitionBy(symbol)`` sends every tick of a symbol to a single
task; with ten symbols and one of them holding a third of the data that
is one task over a third of the table. ``over_history`` keeps the exact
semantics of backward row frames (``lag``, ``rowsBetween(-k, 0)``,
running counts) while partitioning by (key, chunk):

1. Count rows per (key, time bucket) — a narrow scan with a map-side
   partial aggregate; the result is bounded by keys × time span / unit,
   not by the number of rows. A bucket with more than ``target_rows``
   rows is split into buckets of ``hot_unit`` (a busy minute into its
   seconds); other buckets stay whole, so the table stays small.
2. On that small table, number rows cumulatively per key and cut the key
   into chunks of about ``target_rows`` rows (chunks follow bucket
   boundaries, so a chunk is a contiguous time range). All of it runs in
   one key-partitioned window pass over the bucket table.
3. Every bucket that holds one of the last ``lookback`` rows before a
   later chunk is also sent to that chunk as *carry* rows (found with a
   look-ahead frame of ``lookback`` buckets, so the list is bounded).
   Bucket → chunk assignments (own and carry) form a small map table,
   part of the same plan as the ticks (nothing is cached, so a later read
   of a grown folder sees its new files). The ticks are left-joined to it
   on (key, bucket) without a hint: AQE broadcasts the map while it is
   small and otherwise shuffles both sides. A tick without a bucket
   would be an error in the plan and fails the job; it is never dropped.
4. One shuffle by (key, chunk), one sort, the user's window columns over
   ``partitionBy(key, chunk).orderBy(order)``, then carry rows are
   dropped. ``_seq`` (1-based row number within the key) comes from the
   chunk's starting offset plus a running count of own rows.

Restriction: window columns may only look backwards, at most
``lookback`` rows (lag ≤ lookback, frames ``rowsBetween(-k, 0)`` with
k ≤ lookback). A column built on another window column (e.g. a frame
over returns that need ``lag``) needs ``lookback`` ≥ the total depth.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

Stage = dict[str, Callable[[WindowSpec], Column]]


def over_history(df: DataFrame, key: str, order: Sequence[str], lookback: int,
                 stages: Sequence[Stage], seq_col: str | None = None,
                 unit: str = "minute", target_rows: int = 2_000_000, hot_unit: str = "second") -> DataFrame:
    """Add backward-looking window columns computed per ``key``.

    ``order[0]`` must be the event-time column. ``stages`` are applied in
    turn; each maps column name → f(window_spec) → Column, so a later
    stage may use an earlier stage's columns.
    """
    if lookback < 0 or target_rows <= lookback:
        raise ValueError("need 0 <= lookback < target_rows")
    ts = order[0]
    fb, sub = F.date_trunc(unit, F.col(ts)), F.date_trunc(hot_unit, F.col(ts))

    # 1-2. bucket statistics and chunking (small tables only): one
    # aggregate exchange, then everything stays partitioned by key
    stats = df.groupBy(F.col(key).alias("_k"), fb.alias("_fb"), sub.alias("_sub")).agg(F.count(F.lit(1)).alias("_n"))
    hot = F.sum("_n").over(Window.partitionBy("_k", "_fb")) > target_rows
    stats = (stats.withColumn("_hot", hot)
             .withColumn("_sub", F.when(F.col("_hot"), F.col("_sub")).otherwise(F.col("_fb")))
             .groupBy("_k", "_fb", "_sub", "_hot").agg(F.sum("_n").alias("_n")))
    by_key = Window.partitionBy("_k").orderBy("_sub")
    stats = (stats
             .withColumn("_before", F.coalesce(
                 F.sum("_n").over(by_key.rowsBetween(Window.unboundedPreceding, -1)),
                 F.lit(0)).cast("bigint"))
             .withColumn("_after", F.col("_before") + F.col("_n"))
             .withColumn("_chunk", F.floor(F.col("_before") / F.lit(target_rows)).cast("bigint")))
    # chunk start = first offset of the chunk (partitioning by key already
    # clusters (key, chunk): a sort, no exchange)
    stats = stats.withColumn("_start", F.min("_before").over(Window.partitionBy("_k", "_chunk")))

    # 3. carry: bucket b feeds chunk c when start(c) ∈ [after(b), after(b)+lookback-1];
    # such a chunk starts within the next `lookback` buckets (each holds ≥ 1 row),
    # so a bounded look-ahead frame finds every target
    own = F.array(F.struct(F.col("_chunk").alias("p"), F.col("_start").alias("s"), F.lit(True).alias("o")))
    if lookback > 0:
        starts_ahead = F.collect_list(
            F.when(F.col("_before") == F.col("_start"),
                   F.struct(F.col("_chunk").alias("p"), F.col("_start").alias("s"), F.lit(False).alias("o")))
        ).over(by_key.rowsBetween(1, lookback))
        stats = stats.withColumn("_ahead", starts_ahead)
        targets = F.filter("_ahead", lambda x: x["s"] <= F.col("_after") + F.lit(lookback - 1))
        assignments = F.concat(own, targets)
    else:
        assignments = own
    assign = (stats.select("_k", "_fb", "_sub", "_hot", F.explode(assignments).alias("a"))
                   .select("_k", F.col("_fb").alias("_kfb"), F.col("_sub").alias("_ksub"), "_hot",
                           F.col("a.p").alias("_part"), F.col("a.s").alias("_start"), F.col("a.o").alias("_own")))

    # 4. one shuffle by (key, chunk); carry rows precede own rows in time
    keyed = df.withColumn("_fb", fb).withColumn("_sub", sub)
    cond = (F.col(key).eqNullSafe(F.col("_k")) & F.col("_fb").eqNullSafe(F.col("_kfb"))
            & (~F.col("_hot") | F.col("_sub").eqNullSafe(F.col("_ksub"))))
    joined = keyed.join(assign, cond, "left").drop("_k", "_kfb", "_ksub", "_hot", "_sub")
    joined = joined.withColumn("_part", F.coalesce(
        F.col("_part"), F.raise_error(F.lit("a tick has no history chunk")).cast("bigint")))
    w = Window.partitionBy(key, "_part").orderBy(*order)
    stages = [dict(s) for s in stages] or [{}]
    if seq_col:
        # same partitioning and order as the first stage: one Window operator
        stages[0][seq_col] = lambda w: F.col("_start") + F.sum(F.col("_own").cast("bigint")).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = joined
    for stage in stages:
        if stage:
            out = out.withColumns({name: fn(w) for name, fn in stage.items()})
    return out.filter("_own").drop("_fb", "_part", "_start", "_own")


def over_key(df: DataFrame, key: str, order: Sequence[str],
             stages: Sequence[Stage], seq_col: str | None = None) -> DataFrame:
    """Plain ``partitionBy(key)`` form of ``over_history`` (reference
    semantics, one task per key) — used to check the chunked form."""
    w = Window.partitionBy(key).orderBy(*order)
    out = df
    for stage in stages:
        out = out.withColumns({name: fn(w) for name, fn in stage.items()})
    if seq_col:
        out = out.withColumn(seq_col, F.row_number().over(w).cast("bigint"))
    return out
