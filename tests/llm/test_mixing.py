import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import tickflow.llm.common as common
import tickflow.llm.mixing as mixing
from tickflow.llm.mixing import mix, mixture

SCHEMA = "doc_id long, text string, source string, epoch string, block int"


def rows_of(seed):
    rng = random.Random(seed)
    rows = []
    for k in range(400):
        source = rng.choices(["big", "mid", "small", None, "tiny"], [60, 25, 10, 4, 1])[0]
        rows.append((k, " ".join(["w"] * rng.randint(1, 30)), source, "e", 1))
    rows += [(900, "one", "only", "", 0), (901, None, "empty", "", 0), (902, "", "empty", "", 0), (903, None, "big", "", 0), (None, "x y", "mid", "", 0),
             (5, "again again", "small", "", 0), (5, "again again", "small", "", 0)]
    return rows


def brute(spark, rows, repetition, entropy, block_tokens):
    """Uses of each row by plain Python; only the hashes are Spark's."""
    tokens = defaultdict(int)
    for _, t, s, *_ in rows:
        tokens[s] += len((t or "").split())
    shares = {s: n / sum(tokens.values()) for s, n in tokens.items() if n}

    def weights(a):
        z = sum(p**a for p in shares.values())
        return {s: p**a / z for s, p in shares.items()}

    def good(a):
        w = weights(a)
        if entropy is not None:
            return -sum(x * math.log(x) for x in w.values()) <= entropy
        use = [w[s] / shares[s] for s in shares]
        return max(use) / min(use) <= repetition

    lo, hi = 0.0, 1.0
    if good(0.0):
        hi = 0.0
    elif entropy is not None and not good(1.0):
        lo = hi = 1.0
    for _ in range(80):
        m = (lo + hi) / 2
        lo, hi = (lo, m) if good(m) else (m, hi)
    w = weights(hi)
    least = min(w[s] / shares[s] for s in shares)
    key = lambda c: "-" if c is None else "+" + c
    df = spark.createDataFrame([(k, i, key(s), len((t or "").split())) for k, (i, t, s, *_) in enumerate(rows)], "k long, doc_id long, src string, tokens long")
    use = {s: w[s] / shares[s] / least if s in shares else 1.0 for s in tokens}
    passes = {s: int(u + 1e-9) for s, u in use.items()}
    blocks = {s: max(1, -(-tokens[s] // block_tokens)) for s in tokens}
    info = spark.createDataFrame([(key(s), passes[s], blocks[s]) for s in tokens], "src string, passes int, blocks long")
    df = df.join(info, "src").withColumn("key", F.xxhash64("doc_id")).withColumn("block", F.pmod(F.xxhash64("key", F.lit(mixing.SEED)), F.col("blocks"))).withColumn(
        "order", F.xxhash64("src", "block", "passes", F.lit(mixing.SEED)))
    uses = {}
    by_source = defaultdict(list)
    for r in df.collect():
        by_source[r.src].append(r)
    for s in tokens:
        left = int((use[s] - passes[s]) * tokens[s] + 1e-6)
        own, before = by_source[key(s)], 0
        uses.update({r.k: passes[s] for r in own})
        for _, block in sorted({(r.order, r.block) for r in own}):
            inside = sorted((r for r in own if r.block == block), key=lambda r: r.key)
            if before >= left:
                break
            for h in sorted({r.key for r in inside}):
                if before + sum(r.tokens for r in inside if r.key <= h) <= left:
                    for r in inside:
                        if r.key == h:
                            uses[r.k] += 1
            before += sum(r.tokens for r in inside)
    return uses, w


@pytest.mark.parametrize("repetition,entropy,block", [(2.0, None, 200), (3.5, None, 1 << 20), (1.0, None, 50), (None, 1.2, 100), (None, 9.0, 100), (None, 0.1, 100)])
def test_equals_brute_force(spark, repetition, entropy, block):
    rows = rows_of(4)
    uses, weights = brute(spark, rows, repetition, entropy, block)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = mixture(docs, repetition, entropy, block).collect()
    assert Counter((r.doc_id, r.source, r.n_tokens) for r in got) == sum((Counter({(i, s, len((t or "").split())): uses[k]}) for k, (i, t, s, *_) in enumerate(rows)), Counter())
    for r in got:
        assert abs(r.weight - weights.get(r.source, 0.0)) < 1e-6
    if repetition:
        most = Counter(r.doc_id for r in got if r.doc_id not in (5, None))
        assert max(most.values()) <= math.ceil(repetition) and set(most) == {r[0] for r in rows} - {5, None}


def test_every_pass_has_its_own_block_order(spark, monkeypatch):
    docs = spark.createDataFrame(rows_of(4), SCHEMA)
    plain = mixture(docs, 3.5, None, 50).collect()
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    got = mixture(docs, 3.5, None, 50).collect()
    assert Counter(plain) == Counter(got)
    key = lambda s: "-" if s is None else "+" + s
    hashed = spark.createDataFrame({(key(r.source), r.block, e) for r in got for e in range(6)}, "src string, block long, epoch int")
    hashes = {tuple(r[:3]): r[3] for r in hashed.select("*", F.xxhash64("src", "block", "epoch", F.lit(mixing.SEED))).collect()}
    orders = defaultdict(dict)
    for r in got:
        assert orders[r.source, r.epoch].setdefault(r.block, r.position) == r.position
    for (source, epoch), at in orders.items():
        assert len(set(at.values())) == len(at)
        assert sorted(at, key=at.get) == sorted(at, key=lambda b: (hashes[key(source), b, epoch], b))  # noqa: B023
        first = orders[source, 0]
        if epoch and (source, epoch + 1) not in orders:  # the partial pass has the first blocks of its order, as far as they have rows
            by_hash = sorted(first, key=lambda b: (hashes[key(source), b, epoch], b))
            assert len(at) == len(first) or set(at) <= set(by_hash[:len(at) + 1])
    many = [(s, e) for s, e in orders if e and len(orders[s, e]) > 5]
    assert many and all(sorted(orders[k], key=orders[k].get) != sorted(orders[k], key=orders[k[0], 0].get) for k in many)


def test_mix_keeps_columns_and_agrees_with_mixture(spark, monkeypatch):
    docs = spark.createDataFrame(rows_of(9), SCHEMA)
    want = Counter(r.doc_id for r in mixture(docs, block_tokens=100).collect())
    got = mix(docs, block_tokens=100)
    assert got.columns == docs.columns and Counter(r.doc_id for r in got.collect()) == want
    for module in (mixing, common):
        monkeypatch.setattr(module, "BROADCAST_ROWS", 0)  # the shuffled way gives the same
    monkeypatch.setattr(common, "HOT_SHARE", 3)
    assert Counter(r.doc_id for r in mix(docs, block_tokens=100).collect()) == want


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixture(empty).count() == 0 and mix(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None, "", 0), (2, "", "a", "", 0)], SCHEMA)
    assert sorted(r.doc_id for r in mix(blank).collect()) == [1, 2]


def test_evenness_sets_the_entropy_of_the_weights(spark):
    docs = spark.createDataFrame(rows_of(3), SCHEMA)
    for evenness in (0.0, 0.5, 1.0):
        got = {r.source: r.weight for r in mixture(docs, evenness=evenness, block_tokens=64).select("source", "weight").distinct().collect() if r.weight > 0}
        tokens = Counter()
        for _, t, s, *_ in rows_of(3):
            tokens[s] += len((t or "").split())
        shares = [n / tokens.total() for n in tokens.values() if n]
        own = -sum(p * math.log(p) for p in shares)
        want = own + evenness * (math.log(len(shares)) - own)
        assert abs(-sum(w * math.log(w) for w in got.values()) - want) < 1e-6


def test_registered_run_bisects_and_orders_blocks(spark):
    from tickflow.llm.registered import op5_source_mixing
    got = op5_source_mixing(spark, "/root/testdata/sf0.01")
    weights = [r.weight for r in got.select("source", "weight").distinct().collect()]
    assert max(weights) > 1.001 * min(weights)
    assert got.agg(F.max("position")).first()[0] > 0
    moved = got.filter("block <> position").limit(1).count()
    assert moved == 1
