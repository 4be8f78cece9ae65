"""Replay a table as a time-ordered Kafka-shaped file stream.

Rows are encoded exactly as the producer publishes them (key = symbol,
value = JSON tick) and written in ``n_slices`` consecutive event-time
slices, one write per slice, so file modification order follows event
time and a stream with ``maxFilesPerTrigger`` sees the slices in order.
Slice bounds come from one min/max aggregate; each slice write is a
filtered scan, never a collect.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.sources.topic import encode_ticks

#: Rows of one replay file, about: what one task writes and one read task gets.
FILE_ROWS = 25_000


def time_bounds(df: DataFrame, col: str = "event_time"):
    row = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return row["lo"], row["hi"]


def slice_filters(df: DataFrame, n_slices: int, col: str = "event_time"):
    lo, hi = time_bounds(df, col)
    if lo is None:
        return [F.lit(True)]
    step = (hi - lo) / n_slices
    edges = [lo + step * i for i in range(n_slices)] + [None]
    out = []
    for i in range(n_slices):
        c = F.col(col) >= F.lit(edges[i]) if i else F.lit(True)
        if edges[i + 1] is not None:
            c = c & (F.col(col) < F.lit(edges[i + 1]))
        # rows without a time go into the first slice, for the quarantine to see
        out.append(c if i else c | F.col(col).isNull())
    return out


def write_replay(ticks: DataFrame, path: str, n_slices: int = 4, files_per_slice: int | None = None,
                 resend: bool = False, encoded: bool = False) -> tuple[list[str], int]:
    """Write ``ticks`` as Kafka-shaped parquet slices under ``path``.

    ``resend=True`` puts every tick twice into its slice (an
    at-least-once producer retrying its sends). Slices are written as
    ``files_per_slice`` files, by default as many as their rows need.
    Returns the slice folders in write order and the files of each.
    """
    src = ticks if encoded else encode_ticks(ticks)
    # encode once (lineage cut next to the replay folder), slice by filters
    staged = path.rstrip("/") + "-encoded"
    src.write.mode("overwrite").parquet(staged)
    src = src.sparkSession.read.parquet(staged)
    if files_per_slice is None:
        files_per_slice = max(1, -(-src.count() * (2 if resend else 1) // (n_slices * FILE_ROWS)))
    written = []
    for i, cond in enumerate(slice_filters(src, n_slices, "timestamp")):
        part = src.filter(cond)
        if resend:
            part = part.unionByName(part)
        d = os.path.join(path, f"s{i:05d}")
        part.repartition(files_per_slice).write.mode("overwrite").parquet(d)
        written.append(d)
    return written, files_per_slice
