import random

import numpy as np
import pytest

import tickflow.llm.ngram_join as join
from tickflow.llm.graph import components
from tickflow.llm.ngram_join import similar_groups

SCHEMA = "doc_id long, text string, node long, cid string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def token_set(t, width):
    words = lower(t).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for w in words if w]
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k:k + width]) for k in range(len(words) - width + 1))


def brute(rows, width, percent):
    """All pairs, for rows with distinct ids."""
    sets = {i: token_set(t, width) for i, t, *_ in rows}
    label = {i: i for i in sets}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                moved = True
    return sorted((i, len(sets[i]), label[i]) for i in ids)


def corpus(seed, copies=60):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)] + ["É", "ß", "的"]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage, line = text(60), text(9)
    bases = [text(rng.choice([6, 12, 30, 80, 200, 330])) for _ in range(12)]
    out = [" ".join(b) for b in bases]
    for _ in range(copies):  # edited copies around the threshold, of every length
        b = list(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 1, 2, 3, max(1, len(b) // 40), max(1, len(b) // 25)])):
            k = rng.randrange(len(b))
            b[k:k + rng.choice([0, 1, 1])] = [rng.choice(vocab)]
        out.append(" ".join(b))
    big = text(90)
    for _ in range(copies):  # one large group
        b = list(big)
        for _ in range(rng.randrange(5)):
            b[rng.randrange(len(b))] = rng.choice(vocab)
        out.append(" ".join(b))
    out += [" ".join(text(rng.randrange(20, 60)) + passage + text(rng.randrange(20))) for _ in range(copies // 2)]
    out += [" ".join(line + text(rng.randrange(4))) for _ in range(copies // 2)]
    out += ["one", "ONE", "one two", "One  two ", "one two three", "", "   ", "a b c d", "a\tb\nc d", "a b c d e"]
    rng.shuffle(out)
    return [(k * 3, t, k % 2, "x") for k, t in enumerate(out)]


@pytest.mark.parametrize("seed,width,percent,tight", [(1, 4, 85, False), (2, 4, 85, True), (3, 5, 80, True)])
def test_equals_brute_force(spark, monkeypatch, seed, width, percent, tight):
    if tight:  # small limits, so that every path runs: pairs of frequent tokens, large keys, several chunks
        for k, v in {"FREQUENT": 4, "SMALL": 3, "COMBINED": 90, "CHUNK_SETS": 8}.items():
            monkeypatch.setattr(join, k, v)
    rows = corpus(seed, 60 if not tight else 36)
    got = similar_groups(spark.createDataFrame(rows, SCHEMA).repartition(3), width, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect())) == brute(rows, width, percent)


def test_nulls_repeats_long_texts_and_empty_table(spark):
    long = " ".join(f"t{k}" for k in range(30_000))
    rows = [(1, None, None, None), (None, "a b c d e", None, None), (2, "a b c d e", None, None), (2, "a b c d e", None, None),
            (3, long, 0, ""), (4, long + " end", 0, ""), (5, "", 0, ""), (5, "words of another kind", 0, ""), (5, "a b c d e", 0, "")]
    got = similar_groups(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, 0, 1), (None, 2, None), (2, 2, 2), (2, 2, 2), (3, 29_997, 3), (4, 29_998, 3), (5, 0, 5), (5, 1, 5), (5, 2, 2)], key=repr)
    assert similar_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_compare_counts_exactly():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))) for _ in range(40)]
    left, right = np.arange(0, 25), np.arange(15, 40)
    got = join._compare(sets, left, right, 50)
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            x, y = set(sets[a]), set(sets[b])
            assert got[i, j] == (2 * len(x & y) >= len(x | y))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(1000, k) for k in range(900, 990)] + [(5, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {**{k: 1 for k in range(1, 61)}, **{k: 900 for k in [*range(900, 990), 1000]}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("seed", [4, 5])
def test_open_sets_meet_all_others_of_their_block(spark, monkeypatch, seed):
    """Chains of edits away from a text: only some sets are similar to the hub, the rest are reached through others."""
    for k, v in {"FREQUENT": 4, "SMALL": 2, "COMBINED": 20, "CHUNK_SETS": 4, "HUB_SETS": 4}.items():
        monkeypatch.setattr(join, k, v)
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    base, out = [rng.choice(words) for _ in range(120)], []
    for _ in range(14):
        step = list(base)
        for _ in range(rng.randrange(1, 9)):
            out.append(" ".join(step))
            k = rng.randrange(len(step) - 2)
            step[k:k + 2] = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 9]))]
    rows = [(k, t, 0, "") for k, t in enumerate(out)]
    got = similar_groups(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 85)


def test_rows_of_a_large_group_of_near_copies_grow_with_the_group(spark, monkeypatch):
    made, cells = [], join._cells

    def counted(*args):
        out = cells(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(join, "_cells", counted)
    n, rng = 20_000, random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(110)]
    rows = [(0, " ".join(base))]
    for k in range(1, n):
        words = list(base)
        for _ in range(3 if k % 64 == 0 else 1 + k % 2):  # three edits are too far from the text, so those sets stay open
            words[rng.randrange(110)] = f"x{rng.randrange(10**9)}"
        rows.append((k, " ".join(words)))
    groups = similar_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).toPandas()
    sizes = groups.component_id.value_counts()
    assert sizes.iloc[0] > n * 0.98 and sizes.index[0] == 0
    assert 0 < made[0] <= 6 * n


def test_large_group_of_long_texts(spark):
    base = [f"w{k}" for k in range(3000)]
    rows = [(k, " ".join([*base[:70 * k], f"x{k}", *base[70 * k + 1:]])) for k in range(40)]
    got = similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == [(k, 2997, 0) for k in range(40)]


def test_texts_reach_the_shingling_in_small_batches(spark, monkeypatch):
    from tickflow.llm.common import ROWS

    most = ROWS
    calls = []

    def strict(df, fn, schema):
        def small(batches):
            for b in batches:
                assert b.num_rows <= most
                yield b

        calls.append(fn)
        return df.mapInArrow(lambda batches: fn(small(batches)), schema)

    monkeypatch.setattr(join, "map_arrow", strict)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(0, 3000, 1, 1).selectExpr(
        "id AS doc_id", "concat_ws(' ', transform(sequence(1, 60), j -> concat('w', id div 2, 'x', j)), concat('end', id)) AS text")
    got = {r.doc_id: r.component_id for r in similar_groups(docs).collect()}
    assert got == {i: i - i % 2 for i in range(3000)}
    assert len(calls) == 2  # the scan, and the full sets of the candidates
    assert spark.conf.get(name) == before
