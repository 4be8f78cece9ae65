"""Exact duplicates: 128-bit hash groups, the newest id stays, bytes decide.

1. One scan hashes each whole normalised text (sha-256; its first 128 bits
   are the group key). Only ids and hashes are kept.
2. Hashes are counted with map-side combine; most occur once and are done.
3. A second scan sends the texts of repeated hashes, and no others, to an
   aggregate by (hash, text). Grouping by the text itself is the byte
   comparison, and the map side folds a large group of copies into one row
   per task before anything is shuffled.
4. Ids get their group back by hash; groups above 1/1000 of all rows are
   broadcast (at most 1000 of them), so no task collects a large group.
   Hashes that two different texts share are told apart by the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.common import BROADCAST_ROWS, batch, columns, join_by_share, map_arrow, materialise, texts


def _hashed(with_text: bool):
    fields = [("doc_id", pa.int64()), ("sha", pa.binary())] + [("norm", pa.binary())] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            norm = [t.lower() for t in texts(b.column("text"))]  # bytes.lower() changes A-Z only
            sha = [hashlib.sha256(t).digest() for t in norm]
            yield batch(pa.schema(fields), [b.column("doc_id"), sha] + [norm] * with_text)

    return run


def exact_groups(docs: DataFrame, hash_bits: int = 128) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty. Texts are equal when identical after
    lower-casing A-Z. The largest doc_id of a group stays; rows that repeat
    that id and text are the same document and are all marked kept. Rows
    without an id count in group_size, and stay only if no row of their
    group has an id (keep_id is then null). An empty table gives no rows.
    ``hash_bits`` (a multiple of 8) is there to test collisions.
    """
    docs = columns(docs, doc_id="long", text="string")
    key: Column = F.substring(F.col("sha"), 1, hash_bits // 8).alias("h")
    ids = materialise(map_arrow(docs, _hashed(False), "doc_id long, sha binary").select("doc_id", "sha", key), "dedup-ids")
    counts = materialise(ids.groupBy("h").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep_id"))
                         .filter("n > 1"), "dedup-counts")
    repeated = counts.select("h")
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)

    def same_text() -> DataFrame:
        rows = map_arrow(docs, _hashed(True), "doc_id long, sha binary, norm binary").select("doc_id", key, "norm")
        return rows.join(repeated, "h", "left_semi")

    by_text = same_text().groupBy("h", "norm").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep_id"))
    checked = materialise(by_text.select("h", "n", "keep_id"), "dedup-checked")
    shared = materialise(checked.groupBy("h").agg(F.count("*").alias("texts")).filter("texts > 1").select("h"), "dedup-shared")
    collided = not shared.isEmpty()
    groups = checked.join(shared, "h", "left_anti") if collided else checked
    total = ids.count()
    plain = ids.join(shared, "h", "left_anti") if collided else ids
    out = join_by_share(plain, groups, ["h"], F.col("n"), total).select("doc_id", "sha", "n", "keep_id")
    if collided:
        apart = map_arrow(docs, _hashed(True), "doc_id long, sha binary, norm binary").select("doc_id", "sha", key, "norm")
        apart = apart.join(shared, "h", "left_semi")
        own = by_text.join(shared, "h", "left_semi")
        out = out.unionByName(apart.join(own, ["h", "norm"]).select("doc_id", "sha", "n", "keep_id"))
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select(
        "doc_id", keep.alias("keep_id"), F.coalesce(F.col("n"), F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` drops, all columns kept.

    A document that occurs several times under the same id and text is kept
    once. Rows without an id are kept, once per text, unless a row with an
    id has their text.
    """
    verdict = materialise(exact_groups(docs).select("doc_id", "text_sha256", "kept"), "dedup-verdict")
    dropped = verdict.filter(~F.col("kept")).select("doc_id", "text_sha256").distinct()
    again = materialise(verdict.filter("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("rows"))
                        .filter("rows > 1").select("doc_id", "text_sha256"), "dedup-again")
    sha = "__sha"
    while sha in docs.columns:
        sha += "_"
    shown = map_arrow(docs, _with_sha(sha), T.StructType([*docs.schema.fields, T.StructField(sha, T.StringType())]))

    def of(side: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        side = side.select(F.col("doc_id").alias("__d"), F.col("text_sha256").alias("__s"))
        side = F.broadcast(side) if side.count() <= BROADCAST_ROWS else side
        return rows.join(side, rows["doc_id"].cast("long").eqNullSafe(F.col("__d")) & (rows[sha] == F.col("__s")), how)

    out = of(dropped, "left_anti", shown)
    if not again.isEmpty():
        out = of(again, "left_anti", out).unionByName(of(again, "left_semi", out).dropDuplicates(["doc_id", sha]))
    return out.drop(sha)


def _with_sha(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sha = [hashlib.sha256(t.lower()).hexdigest() for t in texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sha, pa.string())], [*b.schema.names, name])

    return run
