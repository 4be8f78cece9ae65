"""Tables that are read by several keys: rows along a space-filling curve, a manifest of file bounds.

A table sorted by one key serves only that key: every file holds all values
of the others. Here each key is cut into 2^BITS ranges of about equal rows,
the bits of the ranges are interleaved, and rows are range-partitioned and
sorted by that number, so that every file covers a small box in all keys. A
manifest beside the table holds the least and greatest value of each key per
file. A read looks the wanted bounds up there and opens only files whose box
meets them; the same bounds filter the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ranges of a key: 2^BITS.
BITS = 5
_FILE = "__file"


def _number(field: T.StructField) -> Column:
    """A number in the key's order; of text, the first seven bytes count."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("double")
    if isinstance(field.dataType, T.TimestampNTZType | T.DateType):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_micros(c).cast("double")
    return c.cast("double")


def curve_key(df: DataFrame, keys: Sequence[str]) -> Column:
    """Interleaved ranges of ``keys``. The range bounds come from one aggregate: 2^BITS - 1 numbers a key."""
    n = 1 << BITS
    number = {k: _number(df.schema[k]) for k in keys}
    cuts = df.agg(*[F.percentile_approx(c, [i / n for i in range(1, n)]).alias(k) for k, c in number.items()]).first()
    ranges = []
    for k, c in number.items():
        above = [(c > F.lit(float(x))).cast("int") for x in sorted(set(cuts[k] or []))]
        total = F.lit(0)
        for a in above:
            total = total + a
        ranges.append(F.coalesce(total, F.lit(0)))  # NULLs lie in the first range
    out = F.lit(0).cast("long")
    for bit in range(BITS):
        for j, r in enumerate(ranges):
            one = F.shiftright(r, bit).bitwiseAND(F.lit(1)).cast("long")
            out = out.bitwiseOR(F.shiftleft(one, bit * len(ranges) + (len(ranges) - 1 - j)))
    return out


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], files: int | None = None) -> None:
    """Write ``df`` along the curve through ``keys`` and its manifest to ``path`` + "-manifest".

    ``files`` is the number of range partitions; by default the session's
    number of shuffle partitions.
    """
    z = "__curve"
    keyed = df.withColumn(z, curve_key(df, keys))
    dealt = keyed.repartitionByRange(*([files] if files else []), z, *keys)
    dealt.sortWithinPartitions(z, *keys).drop(z).write.mode("overwrite").parquet(path)
    bounds = [f(F.col(k)).alias(f"{name}_{k}") for k in keys for name, f in (("min", F.min), ("max", F.max))]
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    (stored.groupBy(F.input_file_name().alias(_FILE)).agg(F.count(F.lit(1)).alias("rows"), *bounds)
           .coalesce(1).write.mode("overwrite").parquet(path + "-manifest"))


def files_for(spark: SparkSession, path: str, bounds: Mapping[str, tuple]) -> list[str]:
    """Files of ``path`` that may hold a row within ``bounds`` {key: (least, greatest)}; None leaves a side open."""
    keep = F.lit(True)
    for k, (low, high) in bounds.items():
        if low is not None:
            keep = keep & (F.col(f"max_{k}") >= F.lit(low))
        if high is not None:
            keep = keep & (F.col(f"min_{k}") <= F.lit(high))
    return sorted(r[_FILE] for r in spark.read.parquet(path + "-manifest").filter(keep).select(_FILE).collect())


def read_clustered(spark: SparkSession, path: str, schema: T.StructType, bounds: Mapping[str, tuple]) -> DataFrame:
    """Rows of ``path`` within ``bounds``, from the files that the manifest names."""
    chosen = files_for(spark, path, bounds)
    df = spark.read.schema(schema).parquet(*chosen) if chosen else spark.createDataFrame([], schema)
    for k, (low, high) in bounds.items():
        df = df if low is None else df.filter(F.col(k) >= F.lit(low))
        df = df if high is None else df.filter(F.col(k) <= F.lit(high))
    return df
