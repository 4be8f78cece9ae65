import numpy as np
import pytest

import tickflow.llm.topk as topk
from tickflow.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score string, dim int"


def brute(rows, every, k):
    usable = [(i, np.floor(np.array(v, np.float64) * 64).astype(np.int64)) for i, v, *_ in rows
              if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    out = []
    for i in sorted({i for i, _ in usable if i % every == 0}):
        q = min((v for j, v in usable if j == i), key=lambda v: (len(v), v.tobytes()))
        best = sorted(((-int(q @ v), j) for j, v in usable if j != i and len(v) == len(q)))[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def rows_of(seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(300):
        v = centres[i % 6] + rng.normal(size=8) * 0.15
        v *= (0.1 if i % 7 == 0 else 1.0 if i % 3 else 4.0) / np.linalg.norm(v)
        rows.append((i, v.astype(np.float32).tolist()))
    rows += [(1000 + i, rows[5][1]) for i in range(80)]  # copies
    rows += [(2000, [0.0] * 8), (2001, [0.0] * 8), (2020, None), (2040, [1.0] * 7 + [None]), (2060, [1.0] * 7 + [float("nan")]), (2080, [float("inf")] + [0.0] * 7),
             (2100, [1.0, 2.0]), (2101, [1.0, 2.5]), (2120, []), (2121, []), (None, [1.0] * 8), (20, rows[20][1]), (2140, [-1.0] * 8), (2160, [40_000_000.0] * 8), (-20, rows[3][1])]
    return [(i, v, 0, "s", 1) for i, v in rows]


@pytest.mark.parametrize("seed,block,coordinate", [(1, 4096, 0.6), (2, 32, 0.6), (3, 16, 0.05), (4, 64, 2.0)])
def test_equals_brute_force(spark, monkeypatch, seed, block, coordinate):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", max(4, block // 8))
    monkeypatch.setattr(topk, "STRIPE", 3)
    monkeypatch.setattr(topk, "COORDINATE", coordinate)
    rows = rows_of(seed)
    got = top_k(spark.createDataFrame(rows, SCHEMA).repartition(3), every=20, k=7)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20, 7)


def test_fewer_rows_than_k_and_empty_table(spark):
    few = spark.createDataFrame([(0, [1.0, 0.5], 1, "", 0), (1, [0.5, 1.0], 1, "", 0), (20, [1.0, 1.0], 1, "", 0)], SCHEMA)
    assert sorted(map(tuple, top_k(few).collect())) == [(0, 1, 20, 6144), (0, 2, 1, 4096), (20, 1, 0, 6144), (20, 2, 1, 6144)]
    assert top_k(spark.createDataFrame([], SCHEMA)).count() == 0
    assert top_k(spark.createDataFrame([(1, [1.0], 1, "", 0)], SCHEMA)).count() == 0


def test_sums_beyond_64_bits_are_the_end_of_the_range(spark):
    top, low = 2**63 - 1, -2**63
    rows = [(0, [1e30, 1.0]), (1, [1e30, 1.0]), (2, [-1e30, 1.0]), (3, [0.0, 1.0]), (4, [1e17, -1e17]), (20, [1e17, 1e17]), (40, [3e7, 2e7])]
    got = {(r.query_id, r.vec_id): r.score for r in top_k(spark.createDataFrame([(i, v, 0, "", 0) for i, v in rows], "vec_id long, embedding array<double>, a int, b string, c int")).collect()}
    scaled = {i: [max(-2**62, min(2**62, int(x * 64))) for x in v] for i, v in rows}
    for (q, i), score in got.items():
        assert score == max(low, min(top, sum(a * b for a, b in zip(scaled[q], scaled[i], strict=True))))
    assert got[0, 1] == top and got[0, 2] == low and got[0, 3] == 4096 and got[20, 4] == 0


def test_coordinates_prune_only_what_cannot_reach(spark):
    rng = np.random.default_rng(7)
    p = rng.integers(-64, 64, (500, 8))
    p = p[np.argsort(-(p**2).sum(1), kind="stable")]
    q = rng.integers(-64, 64, (60, 8))
    least = np.sort(q @ p.T, axis=1)[:, -5].astype(float)
    got = {i: s for i, s, _ in topk._search(np.full(60, -1), q, least, np.arange(500), p, 5)}
    for i in range(60):
        want = np.sort(q[i] @ p.T)[::-1][:5]
        assert (got[i] == want).all()
