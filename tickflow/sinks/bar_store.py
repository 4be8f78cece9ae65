"""Store of bar versions that is merged day by day.

Folders under one root, all parquet:

* ``versions/batch_id=N/date=D`` what micro-batch N emitted; a replayed
  batch replaces its own folder;
* ``newest/date=D`` the newest version of every bar of a day;
* ``days/date=D`` one row per day: bars, latest ``created_at``, NULLs per
  checked column;
* ``hours/date=D`` hour totals of the newest bars;
* ``checks/date=D`` counts of the quality checks per bar window and batch;
* ``commits/X`` the batches that consumer X (the merge, the job) has done.

``merge_new`` reads the days that new batches touch and no others: which
they are stands in the partition columns, and the day filter prunes the
scan. The touched days are overwritten partition by partition from the
versions, which stay, so a merge that fails half way is simply run again;
the commit is written last. A bar without a start (a NOT NULL violation
that the checks must see) is kept under ``NO_DAY``.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.operators.quality import partial_counts
from tickflow.operators.versions import latest_version
from tickflow.schemas import BAR, BAR_NOT_NULL
from tickflow.sinks import BatchFn

NO_DAY = dt.date(1900, 1, 1)
CHECKED = [*BAR_NOT_NULL, "close", "volume"]

_DATE = T.StructField("date", T.DateType())
_NEWEST = T.StructType([f for f in BAR.fields if f.name != "batch_id"] + [_DATE])
_VERSION = T.StructType([*BAR.fields, _DATE])
_DAY = T.StructType([T.StructField("bars", T.LongType()), T.StructField("last_created", T.TimestampNTZType()),
                     *[T.StructField(f"null_{c}", T.LongType()) for c in CHECKED], _DATE])
_HOUR = T.StructType([T.StructField("hour_start", T.TimestampNTZType()), T.StructField("symbol", T.StringType()), T.StructField("asset_type", T.StringType()),
                      *[T.StructField(c, T.LongType()) for c in ("hour_volume", "hour_ticks", "hour_alerts", "n_bars")], _DATE])
_CHECKS = T.StructType([T.StructField("window_start", T.TimestampNTZType()), T.StructField("created_at", T.TimestampNTZType()),
                        *[T.StructField(c, T.LongType()) for c in ("bars", "bad_price", "bad_volume", "bad_tolerant", "bad_strict")], _DATE])
_COMMIT = T.StructType([T.StructField("batch_id", T.LongType())])


def day_of(start: Column) -> Column:
    return F.coalesce(F.to_date(start), F.lit(NO_DAY))


def store_versions(df: DataFrame, batch_id: int, root: str) -> None:
    """The bars of one micro-batch (columns of ``schemas.BAR`` without batch_id)."""
    (df.withColumn("date", day_of(F.col("window_start"))).drop("batch_id")
       .write.mode("overwrite").partitionBy("date").parquet(os.path.join(root, "versions", f"batch_id={batch_id}")))


def sink_versions(root: str, merge: bool = False) -> BatchFn:
    """Micro-batches into the store; ``merge=True`` also merges each batch and rolls up its hours."""
    def fn(df: DataFrame, batch_id: int) -> None:
        store_versions(df.withColumn("created_at", F.current_timestamp().cast("timestamp_ntz")), batch_id, root)
        if merge:
            roll_hours(df.sparkSession, root, merge_new(df.sparkSession, root))
    return fn


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_VERSION).parquet(os.path.join(root, "versions"))


def _read_days(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[dt.date] | None) -> DataFrame:
    """A date-partitioned table, or of it the given days only (a partition filter); empty before its first day."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(path)
    return df if days is None else df.filter(F.col("date").isin(list(days)))


def read_newest(spark: SparkSession, root: str, days: Sequence[dt.date] | None = None) -> DataFrame:
    """Newest version of every bar, of all days or of ``days``."""
    return _read_days(spark, os.path.join(root, "newest"), _NEWEST, days)


def read_days(spark: SparkSession, root: str) -> DataFrame:
    return _read_days(spark, os.path.join(root, "days"), _DAY, None)


def _overwrite_days(df: DataFrame, path: str, *order: str) -> None:
    """Replace the days that ``df`` holds. A busy day is cut at range bounds into several files."""
    if order:
        df = df.repartitionByRange("date", *order).sortWithinPartitions("date", *order)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def replace_days(df: DataFrame, path: str, time: str, order: Sequence[str]) -> None:
    """Write a mart's days anew, by the day of its column ``time``; within a file rows lie in ``order``.

    A day without a row in ``df`` is left as it was.
    """
    _overwrite_days(df.withColumn("date", day_of(F.col(time))), path, *order)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def done_up_to(spark: SparkSession, root: str, consumer: str) -> int:
    path = os.path.join(root, "commits", consumer)
    if not _exists(spark, path):
        return -1
    last = spark.read.schema(_COMMIT).parquet(path).agg(F.max("batch_id")).first()[0]
    return -1 if last is None else last


def commit(spark: SparkSession, root: str, consumer: str, up_to: int) -> None:
    """``consumer`` has done all batches up to ``up_to``."""
    spark.createDataFrame([(up_to,)], _COMMIT).coalesce(1).write.mode("append").parquet(os.path.join(root, "commits", consumer))


def new_days(spark: SparkSession, root: str, consumer: str, at_most: int | None = None) -> tuple[list[dt.date], int]:
    """Days that batches touch which ``consumer`` has not done (up to batch ``at_most``), in order, and the last such batch."""
    done = done_up_to(spark, root, consumer)
    if not _exists(spark, os.path.join(root, "versions")):
        return [], done
    fresh = read_versions(spark, root).filter(F.col("batch_id") > done)
    if at_most is not None:
        fresh = fresh.filter(F.col("batch_id") <= at_most)
    # only partition columns are read; one row per day comes back
    touched = fresh.groupBy("date").agg(F.max("batch_id").alias("b")).collect()
    return sorted(r["date"] for r in touched), max((r["b"] for r in touched), default=done)


def newest_of(versions: DataFrame, days: Sequence[dt.date], up_to: int) -> DataFrame:
    """Newest versions of the bars of ``days``, batches up to ``up_to``."""
    kept = versions.filter(F.col("date").isin(list(days)) & (F.col("batch_id") <= up_to))
    return latest_version(kept.drop("date")).drop("batch_id").withColumn("date", day_of(F.col("window_start")))


def merge_new(spark: SparkSession, root: str) -> list[dt.date]:
    """Merge the batches since the last merge; returns the days they touch, in order."""
    days, up_to = new_days(spark, root, "newest")
    if not days:
        return []
    _overwrite_days(newest_of(read_versions(spark, root), days, up_to), os.path.join(root, "newest"), "symbol", "window_start")
    stats = read_newest(spark, root, days).groupBy("date").agg(
        F.count(F.lit(1)).alias("bars"), F.max("created_at").alias("last_created"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in CHECKED])
    _overwrite_days(stats.coalesce(1), os.path.join(root, "days"))
    commit(spark, root, "newest", up_to)
    return days


def store_checks(spark: SparkSession, root: str, days: Sequence[dt.date], ranges: DataFrame) -> None:
    """The check counts of ``days`` anew, from their newest bars."""
    _overwrite_days(partial_counts(read_newest(spark, root, days), ranges).coalesce(1), os.path.join(root, "checks"))


def read_checks(spark: SparkSession, root: str, days: Sequence[dt.date] | None = None) -> DataFrame:
    return _read_days(spark, os.path.join(root, "checks"), _CHECKS, days)


def null_counts(spark: SparkSession, root: str) -> DataFrame:
    """NOT NULL test per checked column over the whole store, from one row per day: (column_name, null_count, passed)."""
    total = read_days(spark, root).agg(*[F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(c) for c in CHECKED])
    return total.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"), (F.col(c) == 0).alias("passed")) for c in CHECKED
    ])).alias("t")).select("t.*")


def recent_days(spark: SparkSession, root: str, as_of: str, lookbacks: Sequence[str]) -> list[dt.date]:
    """Days that may hold a bar started or created within the longest of ``lookbacks`` before ``as_of``.

    Bars created lately can be old ones (a late re-emission), so the days'
    latest ``created_at`` counts beside their date. One row per such day.
    """
    since = F.least(*[F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {x}") for x in lookbacks], F.lit(as_of).cast("timestamp_ntz"))
    found = read_days(spark, root).filter((F.col("date") >= F.to_date(since)) | (F.col("last_created") >= since)).select("date")
    return sorted(r["date"] for r in found.collect())


def hour_totals(bars: DataFrame, size: str = "1 hour") -> DataFrame:
    """Totals of bars per hour (of a bar's last instant), symbol and asset type."""
    w = F.window(F.col("window_end") - F.expr("INTERVAL 1 MICROSECOND"), size)
    return (bars.groupBy(w.alias("h"), "symbol", "asset_type")
                .agg(F.sum("volume").alias("hour_volume"), F.sum("tick_count").alias("hour_ticks"),
                     F.sum("alert_count").alias("hour_alerts"), F.count(F.lit(1)).alias("n_bars"))
                .select(F.col("h.start").cast("timestamp_ntz").alias("hour_start"), "symbol", "asset_type",
                        "hour_volume", "hour_ticks", "hour_alerts", "n_bars"))


def roll_hours(spark: SparkSession, root: str, days: Sequence[dt.date]) -> None:
    """Write the hours that bars of ``days`` fall into anew, open ones too.

    A bar (shorter than a day) ends on its own day or on the next one, so
    both days' hours are made, from the bars of the day before as well.
    """
    one = dt.timedelta(days=1)
    real = [d for d in days if d != NO_DAY]
    if not real:
        return
    into = sorted(set(real) | {d + one for d in real})
    source = sorted(set(into) | {d - one for d in into})
    hours = hour_totals(read_newest(spark, root, source)).withColumn("date", F.to_date("hour_start"))
    _overwrite_days(hours.filter(F.col("date").isin(into)), os.path.join(root, "hours"), "symbol", "hour_start")


def read_hours(spark: SparkSession, root: str) -> DataFrame:
    """Hour totals as of the last merge; an hour that is still open holds what has arrived."""
    return _read_days(spark, os.path.join(root, "hours"), _HOUR, None).drop("date")
