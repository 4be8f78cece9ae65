"""Data-quality checks over stored bars, the report row and the gate.

All five checks are one aggregate over the bars (a single scan, one
tiny shuffle), unpivoted with ``stack`` into one row per check:
``name, passed, detail``. ``as_of`` is explicit, so results are
reproducible. NULLs never count as bad, and an empty table passes the
count-of-bad checks (freshness and coverage catch emptiness).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.functions.numeric import since, trunc_ts
from tickflow.operators.bars import ohlc_valid_expr
from tickflow.operators.joins import with_dimension
from tickflow.schemas import CHECK_MESSAGES


def message(name: str, *values: Column) -> Column:
    """Detail text from the fixed template of check ``name``."""
    parts = CHECK_MESSAGES[name].split("{}")
    out: list[Column] = []
    for i, p in enumerate(parts):
        if p:
            out.append(F.lit(p))
        if i < len(values):
            out.append(values[i].cast("string"))
    return F.concat(*out)


def check_counts(bars: DataFrame, ranges: DataFrame, as_of: str, lookback: str = "2 hours",
                 coverage_lookback: str = "1 hour", ohlc: str = "tolerant") -> DataFrame:
    """One row of raw counts: fresh, bad_price, bad_volume, bad_ohlc, symbols."""
    b = bars.filter(F.col("window_start") <= F.lit(as_of).cast("timestamp_ntz"))
    b = with_dimension(b, ranges.select("symbol", "lo", "hi"), "symbol", "left")
    recent = since("created_at", as_of, lookback)
    if ohlc == "tolerant":
        bad_ohlc = F.col("low") > F.col("high") * F.lit(1.01)
    elif ohlc == "strict":
        bad_ohlc = ~ohlc_valid_expr()
    else:
        raise ValueError(f"unknown ohlc mode {ohlc!r}")
    return b.agg(
        F.count_if(since("window_start", as_of, lookback)).alias("fresh"),
        F.count_if(recent & ((F.col("close") < F.col("lo")) | (F.col("close") > F.col("hi"))))
         .alias("bad_price"),
        F.count_if(recent & (F.col("volume") <= 0)).alias("bad_volume"),
        F.count_if(recent & bad_ohlc).alias("bad_ohlc"),
        F.count_distinct(F.when(since("window_start", as_of, coverage_lookback), F.col("symbol")))
         .alias("symbols"),
    )


def partial_counts(bars: DataFrame, ranges: DataFrame) -> DataFrame:
    """Counts of the checks per (date, window_start, created_at): what any ``as_of`` and lookback can be added up from.

    A stream stamps a micro-batch with one ``created_at``, so a day has a
    row per bar window and micro-batch, not one per symbol.
    """
    b = with_dimension(bars, ranges.select("symbol", "lo", "hi"), "symbol", "left")
    return b.groupBy("date", "window_start", "created_at").agg(
        F.count(F.lit(1)).alias("bars"),
        F.count_if((F.col("close") < F.col("lo")) | (F.col("close") > F.col("hi"))).alias("bad_price"),
        F.count_if(F.col("volume") <= 0).alias("bad_volume"),
        F.count_if(F.col("low") > F.col("high") * F.lit(1.01)).alias("bad_tolerant"),
        F.count_if(~ohlc_valid_expr()).alias("bad_strict"))


def merged_counts(partials: DataFrame, bars: DataFrame, as_of: str, lookback: str = "2 hours",
                  coverage_lookback: str = "1 hour", ohlc: str = "tolerant") -> DataFrame:
    """The row of ``check_counts``, added up from ``partial_counts``.

    Distinct symbols cannot be added up: they are counted on ``bars``, of
    which only those started within ``coverage_lookback`` matter.
    """
    if ohlc not in ("tolerant", "strict"):
        raise ValueError(f"unknown ohlc mode {ohlc!r}")
    until = F.col("window_start") <= F.lit(as_of).cast("timestamp_ntz")
    fresh, recent = since("window_start", as_of, lookback), since("created_at", as_of, lookback)
    total = lambda name, when: F.coalesce(F.sum(F.when(when, F.col(name))), F.lit(0)).cast("bigint")
    counts = partials.filter(until).agg(
        total("bars", fresh).alias("fresh"), total("bad_price", recent).alias("bad_price"),
        total("bad_volume", recent).alias("bad_volume"), total(f"bad_{ohlc}", recent).alias("bad_ohlc"))
    seen = bars.filter(until & since("window_start", as_of, coverage_lookback)).agg(F.count_distinct("symbol").alias("symbols"))
    return counts.join(F.broadcast(seen))  # one row each


def run_checks(bars: DataFrame, ranges: DataFrame, as_of: str, lookback: str = "2 hours",
               coverage_lookback: str = "1 hour", min_symbols: int = 8, n_symbols: int = 10,
               ohlc: str = "tolerant") -> DataFrame:
    """Five checks → rows (name, passed, detail)."""
    return check_rows(check_counts(bars, ranges, as_of, lookback, coverage_lookback, ohlc), min_symbols, n_symbols)


def check_rows(c: DataFrame, min_symbols: int = 8, n_symbols: int = 10) -> DataFrame:
    """The row of counts → rows (name, passed, detail)."""
    rows = [
        ("data_freshness", F.col("fresh") > 0, message("data_freshness", F.col("fresh"))),
        ("price_range_validity", F.col("bad_price") == 0,
         message("price_range_validity", F.col("bad_price"))),
        ("positive_volume", F.col("bad_volume") == 0, message("positive_volume", F.col("bad_volume"))),
        ("ohlc_consistency", F.col("bad_ohlc") == 0, message("ohlc_consistency", F.col("bad_ohlc"))),
        ("symbol_coverage", F.col("symbols") >= min_symbols,
         message("symbol_coverage", F.col("symbols"), F.lit(n_symbols))),
    ]
    return c.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), p.alias("passed"), d.alias("detail")) for n, p, d in rows
    ])).alias("c")).select("c.*")


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NOT NULL test per column → rows (column_name, null_count, passed)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"),
                 (F.col(c) == 0).alias("passed")) for c in cols
    ])).alias("t")).select("t.*")


def unknown_symbols(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows whose symbol is not in the registry."""
    return df.join(registry.select("symbol"), "symbol", "left_anti")


def report(checks: DataFrame, as_of: str) -> DataFrame:
    """One report row: hour, tallies, details JSON, created_at.

    details = {"checks": [...sorted by name...], "passed": n, "failed": m}
    (the list holds one entry per check, so collecting it is bounded).
    """
    agg = checks.agg(
        F.sort_array(F.collect_list(F.struct("name", "passed", "detail"))).alias("checks"),
        F.count_if(F.col("passed")).alias("checks_passed"),
        F.count_if(~F.col("passed")).alias("checks_failed"),
    )
    return agg.select(
        trunc_ts("hour", F.lit(as_of).cast("timestamp_ntz")).alias("report_hour"),
        "checks_passed", "checks_failed",
        F.to_json(F.struct("checks", F.col("checks_passed").alias("passed"),
                           F.col("checks_failed").alias("failed"))).alias("details"),
        F.lit(as_of).cast("timestamp_ntz").alias("created_at"),
    )


class QualityGateError(RuntimeError):
    pass


def gate(report_df: DataFrame) -> None:
    """Raise when the (one-row) report has failed checks."""
    row = report_df.select("checks_failed", "details").first()
    if row is not None and row["checks_failed"] > 0:
        raise QualityGateError(f"{row['checks_failed']} check(s) failed: {row['details']}")
