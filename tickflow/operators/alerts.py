"""Alert classification, alert messages and topic routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.functions.alerts import alert_severity, price_alert
from tickflow.schemas import ALERT_FIELDS
from tickflow.sources.topic import iso_utc


def with_alerts(df: DataFrame) -> DataFrame:
    """price_alert (FLASH_CRASH / SPIKE / NULL) and alert_severity
    (CRITICAL / HIGH / NONE) from returns_pct."""
    return (df.withColumn("price_alert", price_alert("returns_pct"))
              .withColumn("alert_severity", alert_severity("returns_pct")))


def alert_rows(df: DataFrame) -> DataFrame:
    """Alerting ticks with the 8 alert fields as columns."""
    src = df if "timestamp" in df.columns else df.withColumn("timestamp", iso_utc(F.col("event_time")))
    return src.filter(F.col("price_alert").isNotNull()).select(*ALERT_FIELDS)


def alert_messages(df: DataFrame) -> DataFrame:
    """Alerting ticks → (key = symbol, value = JSON of the 8 fields)."""
    return alert_rows(df).select(
        F.col("symbol").alias("key"),
        F.to_json(F.struct(*ALERT_FIELDS)).alias("value"))


def route(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Copy each row to every topic whose predicate holds (one ``topic``
    column). One pass: the rows' topics are an array that is exploded, so
    the input, be it a stream, is read once."""
    topics = F.array_compact(F.array(*[F.when(pred, F.lit(topic)) for topic, pred in rules.items()]))
    return df.withColumn("topic", F.explode(topics))
