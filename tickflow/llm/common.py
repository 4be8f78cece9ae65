"""What several operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.session import scratch_path

#: A key is hot when it holds more than one row in this many, so there are never more hot keys than this.
HOT_SHARE = 1000
#: Rows of fixed small width that may be broadcast; a larger side is shuffled instead.
BROADCAST_ROWS = 500_000


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def columns(df: DataFrame, **wanted: str) -> DataFrame:
    """``df`` cut down to the given columns, cast: ``columns(df, doc_id="long")``.

    Extra columns of ``df`` never reach an operator's own names that way.
    """
    return df.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in wanted.items()])


#: Rows that a function of ``map_arrow`` gets at a time.
ROWS = 512


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with batches of at most ROWS rows, so that what ``fn`` makes of a batch stays small."""
    return df.mapInArrow(lambda batches: fn(b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)), schema)


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def limit_batches(spark: SparkSession) -> str:
    """Arrow batches of at most ROWS rows from here on, so that neither side of a task holds thousands of whole texts; the limit before."""
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, str(min(ROWS, int(before)) if int(before) > 0 else ROWS))
    return before


@contextmanager
def small_batches(spark: SparkSession):
    """``limit_batches`` for plans run inside."""
    before = limit_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def batch(schema: pa.Schema, cols: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def texts(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def id_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``: the fold that the contracts name. A null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def join_by_share(left: DataFrame, right: DataFrame, on: list[str], rows: Column, total: int) -> DataFrame:
    """Left join of ``left`` with ``right`` (unique on ``on``) where a key may hold much of ``left``.

    ``rows`` is the number of rows of ``left`` under each key of ``right``.
    Keys above 1/HOT_SHARE of ``total`` (at most HOT_SHARE of them) are
    broadcast, so their rows stay where they are; the rest is shuffled.
    """
    is_hot = rows * F.lit(HOT_SHARE) > F.lit(total)
    hot, cold = right.filter(is_hot), right.filter(~is_hot)
    return (left.join(F.broadcast(hot), on, "inner")
            .unionByName(left.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on, "left")))

