"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length into buckets (quantiles of the norm), long
ones first, and a bucket that holds many vectors, be they copies of one,
is split by hash into blocks of bounded size. Queries form blocks too, and
every query block meets every vector block of its dimension in a cell of a
grid, which one task handles.

A first pass over one block per dimension gives each query a score that
its k-th best cannot fall below. Cells whose block is too short for all
queries of the cell are left out before any vector is moved. In the others
a query has a local cosine threshold t = score / (|q| longest of the
block): above 1 the block is out for it; from COORDINATE on, vectors are pruned by coordinates (a vector
with cosine t to q must lie in a known interval on q's strongest
coordinates); below, by length (|p| >= score / |q|). What is left is
verified by exact integer products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.common import batch, map_arrow, materialise

SCALE = 64
#: Most vectors and queries of a block; a smaller table has blocks of a SPLIT-th of it, but of LEAST vectors.
BLOCK, QUERY_BLOCK = 16384, 4096
SPLIT, LEAST = 16, 1024
#: Queries whose products with a block are in memory at once.
STRIPE = 256
BUCKETS = 32
#: Local cosine threshold from which coordinates prune better than lengths, and how many coordinates are used.
COORDINATE, FOCUS = 0.6, 3
_NONE = np.iinfo(np.int64).min


def _scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """floor(SCALE * x) of every usable vector as 64-bit integers, with its dimension and squared length."""
    schema = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("norm2", pa.float64()), ("vec", pa.binary())])
    for b in batches:
        out: list[tuple] = []
        for i, v in zip(b.column("vec_id").to_pylist(), b.column("embedding").to_pylist(), strict=True):
            if i is None or v is None or any(x is None for x in v):
                continue
            f = np.array(v, np.float64)
            if not np.isfinite(f).all():
                continue
            f = np.clip(np.floor(f * SCALE), -2.0**62, 2.0**62)
            out.append((i, len(f), float(f @ f), f.astype(np.int64).tobytes()))
        yield batch(schema, list(zip(*out, strict=True)) if out else [[], [], [], []])


def _packed(key: tuple, table: pa.Table) -> pa.Table:
    """A block as one row: ids and vectors, longest first."""
    norms = table.column("norm2").to_numpy()
    order = np.argsort(-norms, kind="stable")
    vecs = table.column("vec").to_pylist()
    return pa.table({"dim": [key[0].as_py()], "block": [key[1].as_py()], "longest": [float(np.sqrt(norms.max()))],
                     "ids": [table.column("vec_id").to_numpy()[order].tobytes()], "vecs": [b"".join(vecs[k] for k in order)]},
                    schema=pa.schema([("dim", pa.int32()), ("block", pa.int64()), ("longest", pa.float64()), ("ids", pa.binary()), ("vecs", pa.binary())]))


def _products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Integer inner products: by floating point where that is exact, else in 64-bit integers; what does not fit is the nearest that does."""
    most = float(np.abs(q).max()) * float(np.abs(p).max()) * q.shape[1] if q.size and p.size else 0.0
    if most < 2.0**53:
        return (q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    scores = q @ p.T  # right if the sum fits, whatever wraps on the way
    if most >= 2.0**62:
        reach = np.abs(q.astype(np.float64)) @ np.abs(p.astype(np.float64)).T
        for i, j in np.argwhere(reach >= 2.0**62).tolist():
            exact = sum(x * y for x, y in zip(q[i].tolist(), p[j].tolist(), strict=True))
            scores[i, j] = min(max(exact, _NONE), np.iinfo(np.int64).max)
    return scores


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of one query: highest score, then smallest id; rows under the query's own id are left out."""
    other = ids != own
    scores, ids = scores[other], ids[other]
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = scores >= cut
        scores, ids = scores[near], ids[near]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _search(q_ids: np.ndarray, q: np.ndarray, least: np.ndarray, ids: np.ndarray, p: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its best of one block, among those that reach ``least``."""
    q_len, p_len = (np.sqrt((x.astype(np.float64)**2).sum(1)) for x in (q, p))
    longest = p_len[0] if len(p_len) else 0.0
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(least > 0, least / (q_len * longest), -1.0) * (1 - 1e-9)
    t[np.isnan(t)] = 2.0  # a positive score is out of reach of a zero vector
    by_length = np.flatnonzero(t < COORDINATE)
    if len(by_length):
        # longest first, so the vectors long enough for the least demanding query are a prefix
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(least[by_length] > 0, least[by_length] / q_len[by_length] * (1 - 1e-9), 0.0)
        upto = len(p_len) - np.searchsorted(p_len[::-1], need, "left")
        for at in range(0, len(by_length), STRIPE):
            part, n_part = by_length[at:at + STRIPE], upto[at:at + STRIPE]
            scores = _products(q[part], p[:n_part.max()])
            for row, n, i in zip(scores, n_part, part, strict=True):
                yield i, *_best(row[:n], ids[:n], q_ids[i], k)
    by_coordinate = np.flatnonzero((t >= COORDINATE) & (t <= 1))
    if len(by_coordinate):
        unit = np.ascontiguousarray((p / np.maximum(p_len, 1e-300)[:, None]).T)
        for i in by_coordinate:
            c = q[i] / q_len[i]
            # cosines as the length of each vector demands: at least t of the longest
            maybe = np.ones(len(ids), bool)
            for f in np.argsort(-np.abs(c))[:FOCUS]:
                middle, reach = c[f] * t[i], np.sqrt(max(0.0, (1 - t[i]**2) * (1 - c[f]**2))) + 1e-9
                # cos(p, q) >= t: the coordinate of p is within the cap's shadow, open where the cap holds the axis itself
                low = -1.0 if -c[f] >= t[i] else middle - reach
                high = 1.0 if c[f] >= t[i] else middle + reach
                maybe &= (unit[f] >= low - 1e-9) & (unit[f] <= high + 1e-9)
            left = np.flatnonzero(maybe)
            if len(left):
                yield i, *_best(_products(q[i:i + 1], p[left])[0], ids[left], q_ids[i], k)


def _read(dim: int, ids: bytes, vecs: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = np.frombuffer(ids, np.int64)
    return n, np.frombuffer(vecs, np.int64).reshape(len(n), dim)


def _floor_scores(k: int):
    """Per query block the k-th best score of each query in the first block: what the k-th best overall cannot fall below.

    ``need`` is the length below which a vector can serve none of the queries.
    """
    schema = pa.schema([("dim", pa.int32()), ("qblock", pa.int64()), ("least", pa.binary()), ("need", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                q_ids, q = _read(r["dim"], r["q_ids"], r["q_vecs"])
                ids, p = _read(r["dim"], r["ids"], r["vecs"])
                least = np.full(len(q), float(_NONE))
                for i, scores, _ in _search(q_ids, q, least.copy(), ids, p, k):
                    if len(scores) == k:
                        least[i] = float(scores[-1])
                q_len = np.maximum(np.sqrt((q.astype(np.float64)**2).sum(1)), 1e-300)
                need = float(np.where(least > 0, least / q_len, 0.0).min()) * (1 - 1e-9)
                yield batch(schema, [[r["dim"]], [r["qblock"]], [least.tobytes()], [need]])

    return run


def _cell_scores(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                q_ids, q = _read(r["dim"], r["q_ids"], r["q_vecs"])
                ids, p = _read(r["dim"], r["ids"], r["vecs"])
                least = np.frombuffer(r["least"], np.float64)
                got: list[tuple[np.ndarray, ...]] = []
                for i, scores, found in _search(q_ids, q, least, ids, p, k):
                    good = scores >= least[i]
                    got.append((np.full(good.sum(), q_ids[i]), found[good], scores[good]))
                yield batch(schema, [np.concatenate(x) for x in zip(*got, strict=True)] if got else [[], [], []])

    return run


def top_k(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of every row whose vec_id is divisible by ``every``, against all others.

    ``vectors`` has vec_id and embedding. Rows whose id or vector is null, or
    whose vector holds a null or non-finite component, take no part. Only
    vectors of one dimension meet. Rows under the query's own id are its own;
    several of them ask once, with the least of their vectors. Repeated rows
    are candidates as often as they occur. Scores are 64-bit integers; a
    component beyond 2^62 counts as 2^62, a sum beyond the range as the end of
    the range. Ties go to the smaller vec_id. An empty table gives no
    rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = materialise(map_arrow(rows, _scaled, "vec_id long, dim int, norm2 double, vec binary"), "topk-vectors")
    total = rows.count()
    block, query_block = (min(most, max(min(LEAST, most), total // SPLIT)) for most in (BLOCK, QUERY_BLOCK))
    cuts = rows.agg(F.percentile_approx("norm2", [i / BUCKETS for i in range(1, BUCKETS)], 10_000).alias("c")).first()["c"] or []
    cuts = sorted(set(cuts))[::-max(1, BUCKETS * block // max(1, total))]  # no more buckets than blocks
    bucket = sum((F.when(F.col("norm2") < c, 1).otherwise(0) for c in cuts), F.lit(0))
    rows = rows.withColumn("bucket", bucket.cast("int"))
    sizes = rows.groupBy("dim", "bucket").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / block)).alias("salts"))
    dealt = rows.join(F.broadcast(sizes) if len(cuts) else sizes, ["dim", "bucket"]).withColumn(
        "block", F.col("bucket") * F.lit(1 << 40) + F.pmod(F.xxhash64("vec_id"), "salts"))
    packed = "dim int, block long, longest double, ids binary, vecs binary"
    blocks = materialise(dealt.groupBy("dim", "block").applyInArrow(_packed, packed), "topk-blocks")
    asked = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("dim", "vec", "norm2")).alias("s")).select("vec_id", "s.*")
    parts = max(1, -(-asked.count() // query_block))
    queries = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("long")).groupBy("dim", "block").applyInArrow(_packed, packed)
    queries = materialise(queries.select("dim", F.col("block").alias("qblock"), F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs")), "topk-queries")
    first = blocks.groupBy("dim").agg(F.min("block").alias("block"))
    grid = queries.select("dim", "qblock").join(blocks.select("dim", "block"), "dim")
    seeds = queries.join(grid.join(first, ["dim", "block"]), ["dim", "qblock"]).join(blocks, ["dim", "block"])
    least = materialise(map_arrow(seeds, _floor_scores(k), "dim int, qblock long, least binary, need double"), "topk-least")
    grid = grid.join(blocks.select("dim", "block", "longest"), ["dim", "block"]).join(least.select("dim", "qblock", "need"), ["dim", "qblock"])
    grid = grid.filter("longest >= need").select("dim", "qblock", "block")
    cells = queries.join(least, ["dim", "qblock"]).join(grid, ["dim", "qblock"]).join(blocks, ["dim", "block"]).repartition("dim", "qblock", "block")
    found = map_arrow(cells, _cell_scores(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
