"""Kafka-shaped topics: subscribe, decode, quarantine, encode, snapshot.

The job accepts any DataFrame with the Kafka record shape (key, value,
timestamp, ...): a live ``readStream.format("kafka")`` source on a
cluster, or parquet files of the same shape in tests and replays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.schemas import BAR, TICK, TICK_FIELDS

CORRUPT = "_corrupt_record"


def topic_options(topic: str, servers: str, starting: str = "latest",
                  max_per_trigger: int | None = None,
                  min_partitions: int | None = None) -> dict[str, str]:
    """Options of the tick subscription: latest offsets, tolerate loss.

    ``max_per_trigger`` caps the records of one micro-batch
    (``maxOffsetsPerTrigger``); there is no cap unless the caller sets
    one, since a capped reader that falls behind the topic's retention
    loses records. ``min_partitions`` splits large topic partitions
    across more read tasks."""
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if max_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(int(max_per_trigger))
    if min_partitions is not None:
        opts["minPartitions"] = str(int(min_partitions))
    return opts


def read_topic(spark: SparkSession, topic: str, servers: str,
               starting: str = "latest", **limits) -> DataFrame:
    """Streaming subscription to a topic (needs the Kafka connector).
    ``limits`` go to ``topic_options`` (max_per_trigger, min_partitions)."""
    return (spark.readStream.format("kafka")
            .options(**topic_options(topic, servers, starting, **limits)).load())


def decode_ticks(df: DataFrame, schema: T.StructType = TICK, keep_corrupt: bool = False) -> DataFrame:
    """JSON value → flat tick columns + kafka_ts + event_time.

    ``event_time`` is ``try_cast(timestamp AS TIMESTAMP)``: a bad string
    becomes NULL instead of failing the batch (ANSI mode is on).
    """
    sch = schema
    opts = {}
    if keep_corrupt:
        sch = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
        opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = df.select(
        F.from_json(F.col("value").cast("string"), sch, opts).alias("d"),
        F.col("timestamp").alias("kafka_ts"),
        F.col("value").isNull().alias("_null_value"),
    ).select("d.*", "kafka_ts", "_null_value")
    out = parsed.withColumn("event_time", F.expr("try_cast(timestamp AS TIMESTAMP)"))
    if not keep_corrupt:
        out = out.drop("_null_value")
    return out


def is_bad() -> F.Column:
    """The quarantine's predicate over ``decode_ticks(..., keep_corrupt=True)``."""
    return (F.col("_null_value") | F.col(CORRUPT).isNotNull()
            | F.col("symbol").isNull() | F.col("event_time").isNull()
            | F.col("price").isNull())


def split_bad(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) from ``decode_ticks(..., keep_corrupt=True)``.

    Bad: NULL value, unparsable or wrongly typed JSON, no symbol, no
    usable event time or no price. Both halves are plain filters over the
    same projection, so a sink can write them in one pass.
    """
    bad_cond = is_bad()
    reason = (F.when(F.col("_null_value"), F.lit("null_value"))
              .when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))
              .when(F.col("symbol").isNull(), F.lit("no_symbol"))
              .when(F.col("event_time").isNull(), F.lit("bad_timestamp"))
              .otherwise(F.lit("no_price")))
    good = decoded.filter(~bad_cond).drop(CORRUPT, "_null_value")
    bad = decoded.filter(bad_cond).withColumn("reason", reason).drop("_null_value")
    return good, bad


def iso_utc(ts_col) -> F.Column:
    """ISO-8601 UTC text of a timestamp, microsecond precision."""
    return F.date_format(ts_col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def encode_ticks(df: DataFrame) -> DataFrame:
    """Tick rows → (key = symbol bytes, value = JSON bytes, timestamp).

    NULL fields are kept in the JSON (``ignoreNullFields=false``), as a
    Python ``json.dumps`` of the tick dict would do.
    """
    cols = []
    for name in TICK_FIELDS:
        if name == "timestamp":
            c = iso_utc(F.col("event_time")) if "timestamp" not in df.columns else F.col("timestamp")
        elif name in df.columns:
            c = F.col(name)
        else:
            c = F.lit(None)
        cols.append(c.cast(TICK[name].dataType).alias(name))
    return df.select(
        F.col("symbol").cast("binary").alias("key"),
        F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        F.col("event_time").cast("timestamp").alias("timestamp"),
    )


def decode_snapshot(df: DataFrame, schema: T.StructType = TICK) -> DataFrame:
    """Snapshot records (JSON object symbol → tick) → one row per entry."""
    m = F.from_json(F.col("value").cast("string"), T.MapType(T.StringType(), schema))
    return (df.select(F.col("timestamp").alias("snapshot_ts"), F.explode(m).alias("entry_symbol", "t"))
              .select("snapshot_ts", "entry_symbol", "t.*"))


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """Stored bars (all versions) by the declared schema; see ``latest_version`` for the newest."""
    return spark.read.schema(BAR).parquet(path)


__all__ = ["read_topic", "decode_ticks", "split_bad", "encode_ticks",
           "decode_snapshot", "read_bars", "topic_options"]
