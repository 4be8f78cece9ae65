import hashlib

import pytest

from tickflow.llm.exact_dedup import exact_dedup, exact_groups

SCHEMA = "doc_id long, text string, n int, keep_id string"
ROWS = [(1, "Same Text", 0, "x"), (5, "same text", 0, "y"), (3, "SAME TEXT", 0, "z"), (7, "other", 1, None), (8, None, 1, None),
        (9, "", 1, None), (10, "Ärger", 2, "a"), (11, "ärger", 2, "a"), (None, "other", 3, None), (None, "alone", 3, None),
        (12, "x" * 300_000, 4, None), (13, "X" * 300_000, 4, None)]


def lower(t):
    return (t or "").encode().lower()


def brute(rows):
    out = []
    for i, t, *_ in rows:
        group = [r for r in rows if lower(r[1]) == lower(t)]
        keep = max((r[0] for r in group if r[0] is not None), default=None)
        out.append((i, keep, len(group), i == keep, hashlib.sha256(lower(t)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [128, 8])
def test_groups_equal_brute_force_also_when_hashes_collide(spark, bits):
    rows = ROWS + [(100 + k, f"filler {k % 40}", 0, None) for k in range(80)]
    got = exact_groups(spark.createDataFrame(rows, SCHEMA), hash_bits=bits)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_dedup_keeps_all_columns_and_one_of_repeated_rows(spark):
    rows = ROWS + [(7, "other", 1, None)]
    got = exact_dedup(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "text", "n", "keep_id"]
    assert sorted((r.doc_id or 0) for r in got.collect()) == [0, 5, 7, 9, 10, 11, 13]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_groups(empty).count() == 0
    assert exact_dedup(empty).count() == 0
