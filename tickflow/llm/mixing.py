"""Mixing sources to target weights by temperature.

A source with token share p gets a weight proportional to p^a. The
exponent a in [0, 1] is bisected: for a repetition limit, to the smallest
at which no source is repeated more than that while every document is used
at least once; for a target entropy, to the one whose weights have it.

The weights become whole passes over a source and one last, partial pass
that ends within the token budget. Documents are dealt to blocks of about
BLOCK_TOKENS by hash; a pass takes the blocks of its source in an order of
its own, and the last one stops inside a block, at a document. Which
documents a pass takes thus depends on (source, block) and a hash alone:
running sums go over blocks, not documents, and over the documents of one
block per source. ``mixture`` tells the place of every block in its pass;
``mix`` returns the selection alone, its rows in no order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.common import BROADCAST_ROWS, columns, join_by_share, materialise

BLOCK_TOKENS = 1 << 20
REPETITION = 2.0
#: Steps of the bisection that one pass over the sources answers (2^5 - 1 exponents), and passes.
LEVELS, PASSES = 5, 8
SEED = 17


def n_tokens(text: Column) -> Column:
    """Words of a whole text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _source(c: Column) -> Column:
    """Rows without a source form a source of their own."""
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), c))


def exponent_for_repetition(low: float, high: float, limit: float) -> float:
    """Smallest exponent in [0, 1] at which the rarest source (share ``low``) is used at most ``limit`` times as often as the largest."""
    if low <= 0 or (high / low) <= limit:
        return 0.0
    a, b = 0.0, 1.0
    for _ in range(60):
        mid = (a + b) / 2
        a, b = (a, mid) if (high / low) ** (1 - mid) <= limit else (mid, b)
    return b


def exponent_for_entropy(shares: DataFrame, entropy: float) -> float:
    """Exponent in [0, 1] whose weights have ``entropy`` (nats); 1 if the shares themselves have it or more, 0 if equal weights have less.

    The entropy falls as the exponent grows. Each pass over ``shares``
    evaluates LEVELS steps of the bisection at once.
    """
    a, b = 0.0, 1.0
    parts = 1 << LEVELS
    for _ in range(PASSES):
        at = [a + (b - a) * k / parts for k in range(parts + 1)]
        p = F.col("share")
        row = shares.agg(*[e for k, x in enumerate(at) for e in (F.sum(F.pow(p, F.lit(x))).alias(f"z{k}"), F.sum(F.pow(p, F.lit(x)) * x * F.log(p)).alias(f"s{k}"))]).first()
        have = [math.log(row[f"z{k}"]) - row[f"s{k}"] / row[f"z{k}"] for k in range(parts + 1)]
        inside = [k for k in range(parts) if have[k] >= entropy]
        if not inside:
            return a
        a, b = at[inside[-1]], at[inside[-1] + 1]
    return b if have[-1] >= entropy else a


def entropy_towards_even(shares: DataFrame, evenness: float) -> float:
    """The entropy (nats) that lies ``evenness`` of the way from that of the shares to that of equal weights."""
    row = shares.agg(F.sum(-F.col("share") * F.log("share")).alias("own"), F.count("*").alias("n")).first()
    return row["own"] + evenness * (math.log(row["n"]) - row["own"])


def plan(rows: DataFrame, repetition: float | None = REPETITION, entropy: float | None = None, block_tokens: int = BLOCK_TOKENS,
         evenness: float | None = None) -> tuple[DataFrame, DataFrame, int]:
    """(sources, cuts, rows) for ``rows`` (source key ``src``, ``key`` hash, ``tokens``).

    sources: src, rows, tokens, weight, use (how often the source is used), passes (whole ones), blocks.
    cuts: src, block, rank, upto: the blocks of the last pass in its order, each up to a document hash.
    """
    counted = materialise(rows.groupBy("src").agg(F.count("*").alias("rows"), F.sum("tokens").alias("tokens")), "mix-sources")
    total = counted.agg(F.sum("tokens").alias("t"), F.sum("rows").alias("r"), F.count("*").alias("n")).first()
    all_tokens, n_rows = total["t"] or 0, total["r"] or 0
    shares = counted.withColumn("share", F.col("tokens") / F.lit(float(max(1, all_tokens))))
    some = shares.filter("tokens > 0")
    ends = some.agg(F.min("share").alias("low"), F.max("share").alias("high")).first()
    if ends["low"] is None:
        a = 1.0
    elif entropy is not None or evenness is not None:
        a = exponent_for_entropy(some, entropy if entropy is not None else entropy_towards_even(some, evenness))
    else:
        a = exponent_for_repetition(ends["low"], ends["high"], repetition or 1.0)
    norm = some.agg(F.sum(F.pow("share", F.lit(a)))).first()[0] or 1.0
    # the largest source is used once, so that every document is used
    use = F.when(F.col("tokens") > 0, F.pow(F.col("share") / F.lit(ends["high"] or 1.0), F.lit(a - 1.0))).otherwise(1.0)
    sources = shares.select("src", "rows", "tokens", F.when(F.col("tokens") > 0, F.pow("share", F.lit(a)) / F.lit(norm)).otherwise(0.0).alias("weight"),
                            F.greatest(F.lit(1.0), use).alias("use"))
    sources = materialise(sources.withColumn("passes", F.floor(F.col("use") + 1e-9).cast("int")).withColumn(
        "blocks", F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(block_tokens))).cast("long")).withColumn(
        "left", F.greatest(F.lit(0), F.floor((F.col("use") - F.col("passes")) * F.col("tokens") + 1e-6)).cast("long")), "mix-plan")
    dealt = _with_source(rows, sources.filter("left > 0"), n_rows, "inner").withColumn("block", block_of(F.col("key")))
    sizes = dealt.groupBy("src", "block", "left", "passes").agg(F.sum("tokens").alias("tokens"))
    order = Window.partitionBy("src").orderBy(F.xxhash64("src", "block", "passes", F.lit(SEED)), "block")
    running = sizes.withColumn("before", F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn(
        "rank", F.row_number().over(order).cast("long") - 1).filter("before < left")
    running = materialise(running, "mix-blocks")
    last = running.filter(F.col("before") + F.col("tokens") > F.col("left")).select("src", "block", (F.col("left") - F.col("before")).alias("room"))
    inside = Window.partitionBy("src", "block").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    upto = dealt.join(last, ["src", "block"]).withColumn("sum", F.sum("tokens").over(inside)).filter("sum <= room").groupBy("src", "block").agg(F.max("key").alias("upto"))
    whole = running.filter(F.col("before") + F.col("tokens") <= F.col("left")).select("src", "block", "rank", F.lit((1 << 63) - 1).alias("upto"))
    cuts = whole.unionByName(running.join(upto, ["src", "block"]).select("src", "block", "rank", "upto"))
    return sources, materialise(cuts, "mix-cuts"), n_rows


def block_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(SEED)), F.col("blocks"))


def _with_source(rows: DataFrame, sources: DataFrame, n_rows: int, how: str = "left") -> DataFrame:
    if sources.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(sources.drop("rows", "tokens", "weight")), "src", how)
    joined = join_by_share(rows, sources.withColumnRenamed("rows", "n").drop("tokens", "weight"), ["src"], F.col("n"), n_rows).drop("n")
    return joined if how == "left" else joined.filter("blocks IS NOT NULL")


def draw(rows: DataFrame, sources: DataFrame, cuts: DataFrame, n_rows: int) -> DataFrame:
    """``rows`` (with ``src`` and ``key``), each as often as its source's passes take it, with ``epoch`` and ``block``."""
    dealt = _with_source(rows, sources, n_rows).withColumn("block", block_of(F.col("key")))
    cuts = F.broadcast(cuts) if cuts.count() <= BROADCAST_ROWS else cuts
    dealt = dealt.join(cuts.select("src", "block", "upto"), ["src", "block"], "left")
    times = F.col("passes") + F.when(F.col("key") <= F.col("upto"), 1).otherwise(0)
    return dealt.withColumn("epoch", F.explode(F.sequence(F.lit(0), times - 1)))


def block_order(sources: DataFrame) -> DataFrame:
    """src, block, epoch, position: the place of every block in every pass of its source, the partial one included."""
    passes = sources.select("src", "passes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")).select(
        "src", "block", F.explode(F.sequence(F.lit(0), F.col("passes"))).alias("epoch"))
    # the hash that plan() orders the last pass by
    order = Window.partitionBy("src", "epoch").orderBy(F.xxhash64("src", "block", "epoch", F.lit(SEED)), "block")
    return passes.withColumn("position", F.row_number().over(order).cast("long") - 1)


def mixture(docs: DataFrame, repetition: float | None = REPETITION, entropy: float | None = None, block_tokens: int = BLOCK_TOKENS,
            evenness: float | None = None) -> DataFrame:
    """One row per use of a document: doc_id, source, epoch, block, n_tokens, weight, position.

    Every row of ``docs`` is used at least once; sources below their target
    weight are repeated, the last pass ending within the budget. Rows of
    the same id share their place in every pass, so repeats of a row go
    together. Null text has no tokens and is used in whole passes and
    wherever the budget stands. Rows without a source form one source. An
    empty table gives no rows. Ties in a pass are broken by hash, equal
    hashes go together. A target ``entropy``, or the ``evenness`` of the way
    from the shares' own entropy to the greatest one, replaces the limit of
    ``repetition``. ``position`` is the place of the block among the
    blocks of its source in that pass, from 0.
    """
    rows = columns(docs, doc_id="long", source="string", text="string").select(
        "doc_id", "source", _source(F.col("source")).alias("src"), F.xxhash64("doc_id").alias("key"), n_tokens(F.col("text")).alias("tokens"))
    rows = materialise(rows, "mix-rows")
    sources, cuts, n = plan(rows, repetition, entropy, block_tokens, evenness)
    weights = sources.select("src", "rows", "weight")
    out = draw(rows, sources, cuts, n)
    out = out.join(F.broadcast(weights.drop("rows")), "src") if weights.count() <= BROADCAST_ROWS else \
        join_by_share(out, weights.withColumnRenamed("rows", "n"), ["src"], F.col("n"), n)
    order = materialise(block_order(sources), "mix-order")
    out = out.join(F.broadcast(order) if order.count() <= BROADCAST_ROWS else order, ["src", "block", "epoch"])
    return out.select("doc_id", "source", "epoch", "block", F.col("tokens").alias("n_tokens"), "weight", "position")


def mix(docs: DataFrame, repetition: float | None = REPETITION, entropy: float | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``docs``, all columns, every row as often as ``mixture`` uses it."""
    light = columns(docs, doc_id="long", source="string", text="string").select(
        _source(F.col("source")).alias("src"), F.xxhash64("doc_id").alias("key"), n_tokens(F.col("text")).alias("tokens"))
    sources, cuts, n = plan(materialise(light, "mix-rows"), repetition, entropy, block_tokens)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _source(F.col("source").cast("string")).alias("src"),
                        F.xxhash64(F.col("doc_id").cast("long")).alias("key"))
    return draw(whole, sources, cuts, n).select("row.*")
