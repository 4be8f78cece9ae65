"""N-gram Jaccard join: token-combination prefixes, exact groups of similar texts.

A document is the set of its word shingles (tokens, 64-bit hashes). Two
sets with Jaccard at least p share a token among the first e + 1 of either
(e = n - ceil(p n)) in any fixed order of tokens. The order used here puts
a fixed hash range U first, by document frequency, and the rest after it:

1. One scan hashes every whole text and emits, per set, its tokens in U
   (a little more than e of them; small sets are topped up to e + 2).
   Equal sets have one identity, so copies are one node from here on.
2. Frequencies in U are counted over all sets. A token of one set only
   cannot lead to a partner; a set with more than e of them has none.
   The others keep the rarest part of their prefix.
3. Rare tokens are index keys by themselves. For token class "frequent"
   (more than FREQUENT sets), sets of up to COMBINED tokens extend the
   prefix by one, share at least two tokens in it, and are indexed under
   every pair of them. Longer sets would give too many pairs and use
   single tokens; sizes in between use both, so that any two similar sets
   have a kind in common.
4. Keys of up to SMALL sets give candidate pairs. The tokens in U bound
   each overlap from above; survivors are verified on their full sets.
5. Larger keys never give pairs. The sets that such keys hold are grouped
   by hub (the set that stands for most of the keys), and every set of a
   group meets one of them, the closest to what most of the group holds:
   that links most edited copies of one text with two rows for each. Keys
   whose sets are connected by then are done. The sets that the others
   connect form blocks; only sets outside the largest group of their block
   ("open") still need partners. They are dealt by size band and chunk
   against the sets of the block, to tasks of bounded size that compare
   sets by matrix products and return spanning links. Sets of the largest
   group are not compared with each other, so a block whose sets reach its
   middle is linear in rows; open sets cost a row of the block for every
   CHUNK_SETS of them.
6. Connected components of the links give the groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.common import BROADCAST_ROWS, batch, columns, join_by_share, map_arrow, materialise, small_batches, texts
from tickflow.llm.graph import components

#: Share of the hash range that is U, in units of 1 - p.
SPREAD = 1.45
FREQUENT = 32
COMBINED = 64
SMALL = 32
#: A chunk of a block has about so many sets and tokens at most.
CHUNK_SETS, CHUNK_TOKENS = 1024, 600_000
#: So many sets, about, meet one copy of their hub's set in a task.
HUB_SETS = 1024
#: Sets of a hub's group, about, that show which tokens most of the group holds.
HUB_SAMPLE = 64
#: Emitted tokens after which a task looks for tokens that it has met HEAVY times.
FLUSH, HEAVY = 2_000_000, 32
_TOP = np.uint64(1 << 63)


def shingles(text: bytes, width: int) -> np.ndarray:
    """Distinct shingle hashes of a text, ascending. Fewer words than ``width`` are one shingle; no word, none."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if len(words) < width:
        if not words:
            return np.empty(0, np.int64)
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64).view(np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = len(words) - width + 1
    s = h[:k] * np.uint64(0x9E3779B97F4A7C15)
    for j in range(1, width):
        s = (s ^ (s >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[j:j + k]
    s = (s ^ (s >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    s ^= s >> np.uint64(30)
    return np.unique((s ^ _TOP).view(np.int64))


def _identity(s: np.ndarray) -> int:
    x = xxhash.xxh3_64_intdigest(s.tobytes())
    return x - (1 << 64) if x >> 63 else x


_SETS = pa.schema([("doc_id", pa.int64()), ("cid", pa.int64()), ("nm", pa.int64()), ("tokens", pa.list_(pa.int64())), ("heavy", pa.bool_())])


def _scan(batches: Iterator[pa.RecordBatch], width: int, percent: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Per row: identity, size and emitted tokens of its set (once per set and task); besides, tokens that a task meets often."""
    seen: set[tuple[int, int]] = set()
    met: list[np.ndarray] = []
    held = 0

    def heavy() -> pa.RecordBatch:
        tokens, times = np.unique(np.concatenate(met), return_counts=True) if met else (np.empty(0, np.int64), np.empty(0, np.int64))
        return batch(_SETS, [[None], [None], [None], [tokens[times >= HEAVY]], [True]])

    for b in batches:
        cids, sizes, emitted = [], [], []
        for t in texts(b.column("text")):
            s = shingles(t, width)
            n = len(s)
            if not n:
                cids.append(None), sizes.append(0), emitted.append(None)
                continue
            errors, partners = n - -(-percent * n // 100), (100 - percent) * n // percent
            in_u = int(np.searchsorted(s, limit)) if partners else 0
            cid, nm = _identity(s), n << 32 | in_u
            cids.append(cid), sizes.append(nm)
            if not partners or (cid, nm) in seen:
                emitted.append(None)
                continue
            seen.add((cid, nm))
            emitted.append(s[:max(in_u, min(n, errors + 2))])
            met.append(emitted[-1])
            held += len(met[-1])
        yield batch(_SETS, [b.column("doc_id"), cids, sizes, emitted, [False] * len(cids)])
        if held > FLUSH:
            yield heavy()
            met, held = [], 0
    yield heavy()


def _index(sets: DataFrame, percent: int, limit: int) -> DataFrame:
    """Index keys of every set that may have a partner: sig, cid, nm, and how many rare tokens it has."""
    rows = sets.filter("NOT heavy AND tokens IS NOT NULL").select("cid", "nm", F.explode("tokens").alias("tok"))
    often = materialise(sets.filter("heavy").select(F.explode("tokens").alias("tok")).distinct(), "ngram-heavy")
    fits = often.count() <= BROADCAST_ROWS
    often = F.broadcast(often) if fits else often
    df = [F.count("*").alias("df"), F.min("cid").alias("lo"), F.max("cid").alias("hi")]
    # tokens that many sets share are counted with map-side combine and their rows stay in place; the rest is dealt once
    heavy = rows.join(often, "tok", "left_semi")
    known = heavy.groupBy("tok").agg(*df).filter("lo <> hi").select("tok", "df")
    light = rows.join(often, "tok", "left_anti").repartition("tok")
    counted = light.groupBy("tok").agg(*df).filter("lo <> hi").select("tok", "df")
    shared = heavy.join(F.broadcast(known) if fits else known, "tok").unionByName(
        light.join(counted.hint("shuffle_hash"), "tok"))
    n, in_u = F.shiftright("nm", 32), F.col("nm").bitwiseAND(0xFFFFFFFF)
    errors = n - F.expr(f"({percent} * shiftright(nm, 32) + 99) div 100")
    token = F.struct((F.col("tok") >= F.lit(limit)).alias("rest"), "df", "tok")
    own = shared.groupBy("cid", "nm").agg(F.sort_array(F.collect_set(token)).alias("all"))
    own = own.select("cid", "nm", n.alias("n"), F.filter("all", lambda t: ~t["rest"]).alias("u"),
                     F.filter("all", lambda t: t["rest"]).alias("rest"), in_u.alias("in_u"), errors.alias("errors"))
    # how many places of the prefix are left after the tokens of this set alone
    own = own.withColumn("left", F.greatest(F.lit(0), F.col("errors") + 1 - (F.col("in_u") - F.size("u"))).cast("int"))
    frequent = lambda t: t["df"] > F.lit(FREQUENT)
    short, both = F.col("n") <= COMBINED, F.col("n") <= COMBINED * 100 // percent + 1
    own = own.withColumn("first", F.slice("u", F.lit(1), F.col("left")))
    extended = both & F.exists("first", frequent)
    own = own.withColumn("prefix", F.when(extended, F.slice("u", F.lit(1), F.col("left") + 1)).otherwise(F.col("first")))
    own = own.withColumn("often", F.transform(F.filter("prefix", frequent), lambda t: t["tok"]))
    single = F.transform(F.concat(F.filter("prefix", lambda t: ~(frequent(t) & short)), "rest"), lambda t: t["tok"])
    pairs = F.flatten(F.transform("often", lambda t, i: F.transform(
        F.slice(F.col("often"), i + 2, F.size("often")), lambda s: F.xxhash64(t, s))))
    keys = F.concat(single, F.when(both, pairs).otherwise(F.array().cast("array<bigint>")))
    rare = F.col("in_u") - F.size(F.filter("u", frequent))
    return own.select("cid", "nm", rare.cast("long").alias("rare"), F.explode(keys).alias("sig"))


def _enough(common: Column, a: Column, b: Column, percent: int) -> Column:
    return common * (100 + percent) >= (a + b) * percent


def _compare(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which sets of ``left`` (indices) are similar to which of ``right``: overlaps by matrix products over shared tokens."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[token] > 1
    number = np.cumsum(times > 1) - 1
    token, owner = number[token[shared]], owner[shared]
    by_token = np.argsort(token, kind="stable")
    token, owner = token[by_token], owner[by_token]
    common = np.zeros((len(left), len(right)), np.float32)
    row, col = np.full(len(sets), -1), np.full(len(sets), -1)
    row[left], col[right] = np.arange(len(left)), np.arange(len(right))
    for at in range(0, int(token[-1]) + 1 if len(token) else 0, 2048):
        a, b = np.searchsorted(token, [at, at + 2048])
        t, o = token[a:b] - at, owner[a:b]
        x, y = np.zeros((len(left), 2048), np.float32), np.zeros((len(right), 2048), np.float32)
        x[row[o[row[o] >= 0]], t[row[o] >= 0]] = 1
        y[col[o[col[o] >= 0]], t[col[o] >= 0]] = 1
        common += x @ y.T
    return common * (100 + percent) >= percent * (sizes[left][:, None] + sizes[right][None, :])


def _block_links(key: tuple, table: pa.Table, percent: int) -> pa.Table:
    """Spanning links of one cell (one chunk against another) of a block's grid."""
    _, s1, i1, s2, i2 = (k.as_py() for k in key)
    nodes, slot, chunk = (table.column(c).to_numpy() for c in ("node", "slot", "chunk"))
    sets = [np.asarray(x, np.int64) for x in table.column("full").to_numpy()]
    left, right = np.flatnonzero((slot == s1) & (chunk == i1)), np.flatnonzero((slot == s2) & (chunk == i2))
    u = v = np.empty(0, np.int64)
    if len(left) and len(right) and len(nodes) > 1:
        linked, none = _compare(sets, left, right, percent), np.iinfo(np.int64).max
        label = nodes.copy()
        while True:  # least label over the links, until nothing moves
            old = label.copy()
            label[left] = np.minimum(label[left], np.where(linked, label[right][None, :], none).min(1))
            label[right] = np.minimum(label[right], np.where(linked, label[left][:, None], none).min(0))
            if (label == old).all():
                break
        u, v = nodes[label != nodes], label[label != nodes]
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _full_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.int64()), ("full", pa.list_(pa.int64()))])
    for b in batches:
        found = [shingles(t, width) for t in texts(b.column("text"))]
        yield batch(schema, [[_identity(s) if len(s) else None for s in found], found])


def similar_groups(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Texts link when their sets of ``width``-word shingles have a Jaccard
    similarity of at least ``percent`` in a hundred; component_id is the
    smallest doc_id that links reach. Words are split at ASCII white space
    after lower-casing A-Z. Null, empty or blank text has no shingle and is
    its own component. An id that occurs several times has a component for
    each of its texts. Rows without an id link nothing and have no
    component. An empty table gives no rows.
    """
    out = _grouped(columns(docs, doc_id="long", text="string"), width, percent)
    return out.select("doc_id", F.shiftright("nm", 32).alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, all columns, with one document of every group that ``similar_groups`` finds: the one with the smallest id.

    Rows without an id and texts without a word stay. An id that occurs
    several times goes row by row: the rows of its texts outside the group
    stay, and of equal rows one.
    """
    groups = materialise(_grouped(columns(docs, doc_id="long", text="string"), width, percent).filter(
        "doc_id IS NOT NULL AND cid IS NOT NULL").select("doc_id", "cid", "grp", "component_id"), "ngram-groups")
    again = groups.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    own, key = "__id", "__cid"
    while {own, key} & set(docs.columns):
        own, key = own + "_", key + "_"
    if again.isEmpty():
        dropped = materialise(groups.filter("doc_id <> component_id").select(F.col("doc_id").alias(own)), "ngram-dropped")
        return docs.join(_listed(dropped), F.col("doc_id").cast("long") == F.col(own), "left_anti")
    first = groups.filter("doc_id = component_id").groupBy("grp").agg(F.min("cid").alias("first"))
    kept = groups.join(first, "grp").filter("doc_id = component_id AND cid = first").select(
        F.col("doc_id").alias(own), F.col("cid").alias(key + "k")).distinct()
    shown = map_arrow(docs, partial(_with_identity, width=width, name=key), T.StructType([*docs.schema.fields, T.StructField(key, T.LongType())]))
    grouped = F.col("doc_id").isNotNull() & F.col(key).isNotNull()
    chosen = shown.filter(grouped).join(kept, (F.col("doc_id").cast("long") == F.col(own)) & (F.col(key) == F.col(key + "k")), "left_semi")
    return shown.filter(~grouped).unionByName(chosen.dropDuplicates(["doc_id", key])).drop(key)


def _with_identity(batches: Iterator[pa.RecordBatch], width: int, name: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [shingles(t, width) for t in texts(b.column("text"))]
        cids = pa.array([_identity(s) if len(s) else None for s in found], pa.int64())
        yield pa.RecordBatch.from_arrays([*b.columns, cids], [*b.schema.names, name])


def _grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Row by row: doc_id, cid and nm (identity and size of the set, null and 0 without a word), grp (its group) and component_id."""
    limit = int(min(1.0, SPREAD * (100 - percent) / 100) * 2**64) - 2**63
    with small_batches(docs.sparkSession):
        sets = materialise(map_arrow(docs, partial(_scan, width=width, percent=percent, limit=limit),
                                     "doc_id long, cid long, nm long, tokens array<bigint>, heavy boolean"), "ngram-sets")
    rows = sets.filter("NOT heavy").select("doc_id", "cid", "nm")
    # a node of the graph is a set, by its identity; ``id`` is the smallest id that has it
    classes = materialise(rows.filter("cid IS NOT NULL").groupBy("cid", "nm").agg(
        F.min("doc_id").alias("id"), F.count("*").alias("rows")).withColumn("node", F.col("cid")), "ngram-classes")
    keys = _index(sets, percent, limit).join(classes.filter("id IS NOT NULL").select("cid", "nm", "node"), ["cid", "nm"])
    keys = materialise(keys.select("sig", "node", F.shiftright("nm", 32).alias("n"), "rare"), "ngram-keys")
    # the set with the fewest rare tokens stands for a key: in a group of edited copies, the original
    order = F.shiftleft(F.least("rare", F.lit(65535)), 47).bitwiseOR(F.shiftrightunsigned(F.xxhash64("node"), 17))
    buckets = materialise(keys.groupBy("sig").agg(F.count("*").alias("members"), F.min("node").alias("lo"), F.max("node").alias("hi"),
                                                  F.min_by("node", order).alias("hub"), F.min_by("n", order).alias("hub_n"))
                          .filter("lo <> hi").drop("lo", "hi"), "ngram-buckets")
    links = _links(docs, sets, classes, keys, buckets, width, percent)
    linked = components(links).join(classes.select("node", "id"), "node")
    linked = linked.join(linked.groupBy("label").agg(F.min("id").alias("least")), "label").select("node", "label", "least")
    known = classes.join(linked, "node", "left").select("cid", "nm", "rows", F.coalesce("label", "node").alias("grp"),
                                                        F.coalesce("least", "id").alias("component_id"))
    out = join_by_share(rows.filter("cid IS NOT NULL"), known, ["cid", "nm"], F.col("rows"), rows.count())
    out = out.select("doc_id", "cid", "nm", "grp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
    bare = rows.filter("cid IS NULL").select("doc_id", "cid", "nm", F.lit(None).cast("long").alias("grp"), F.col("doc_id").alias("component_id"))
    return out.unionByName(bare)


def _listed(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast if its (materialised) rows are few enough, else to be shuffled."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _candidate_pairs(keys: DataFrame, buckets: DataFrame, percent: int) -> DataFrame:
    """Pairs x, y that share a key of at most SMALL sets; keys with the same members count once."""
    small = buckets.filter(F.col("members") <= SMALL).select("sig")
    groups = keys.join(small, "sig").groupBy("sig").agg(F.sort_array(F.collect_set(F.struct("node", "n"))).alias("g")).select("g").distinct()
    partners = lambda a, i: F.transform(
        F.filter(F.slice(F.col("g"), i + 2, F.size("g")),
                 lambda b: F.least(a["n"], b["n"]) * 100 >= F.greatest(a["n"], b["n"]) * percent),
        lambda b: F.struct(a["node"].alias("x"), b["node"].alias("y"), a["n"].alias("nx"), b["n"].alias("ny")))
    return groups.select(F.explode(F.flatten(F.transform("g", partners))).alias("p")).select("p.*").filter("x <> y").distinct()


def _possible(pairs: DataFrame, sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose overlap in U, with all other tokens of the smaller rest, could be enough."""
    wanted = materialise(pairs.select(F.col("x").alias("node")).unionByName(pairs.select(F.col("y").alias("node"))).distinct()
                         .join(classes.select("cid", "nm", "node"), "node"), "ngram-wanted")
    in_u = F.col("nm").bitwiseAND(0xFFFFFFFF).cast("int")
    part = sets.filter("NOT heavy AND tokens IS NOT NULL").join(_listed(wanted), ["cid", "nm"]).select(
        "node", F.slice("tokens", F.lit(1), in_u).alias("u"), (F.shiftright("nm", 32) - in_u).alias("more")).dropDuplicates(["node"])
    part = materialise(part, "ngram-part")
    side = lambda c: part.select(F.col("node").alias(c), F.col("u").alias("u" + c), F.col("more").alias("more" + c))
    common = F.size(F.array_intersect("ux", "uy")) + F.least("morex", "morey")
    return pairs.join(side("x"), "x").join(side("y"), "y").filter(_enough(common, F.col("nx"), F.col("ny"), percent)).select("x", "y").distinct()


def _hub_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Per set that large keys hold, one hub to meet (x the set, y the hub): the one of most of its keys, of a size that allows a link."""
    fits = F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent
    met = members.filter(F.col("node") != F.col("hub")).filter(fits).groupBy("node", "hub").agg(F.count("*").alias("keys"))
    order = F.shiftleft("keys", 40).bitwiseOR(F.shiftrightunsigned(F.xxhash64("hub"), 24))
    return met.groupBy(F.col("node").alias("x")).agg(F.max_by("hub", order).alias("y"))


def _meet(met: DataFrame, full: DataFrame, hubs: DataFrame, copies: DataFrame) -> DataFrame:
    """Overlaps of sets (x) with the set ``fy`` of their hub (y), which is copied once for every HUB_SETS of them."""
    dealt = met.join(copies, "y").select("x", "y", F.pmod(F.xxhash64("x"), "k").cast("int").alias("copy"))
    hubs = hubs.join(copies, "y").select("y", "fy", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("copy"))
    pairs = dealt.join(full.select(F.col("node").alias("x"), F.col("full").alias("fx")), "x").join(hubs, ["y", "copy"])
    return pairs.select("x", "y", F.size("fx").alias("a"), F.size("fy").alias("b"), F.size(F.array_intersect("fx", "fy")).alias("common"))


def _hub_links(members: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) of sets with the middle of their hub's group.

    A hub may itself be a copy with an edit, too far from the others. The
    tokens that most of about HUB_SAMPLE sets of its group hold are those
    of the text that the copies were made from; the set of the group
    closest to them takes the hub's place. The sample only decides which
    sets are compared early, not what is found.
    """
    met = _hub_pairs(members, percent)
    met = materialise(met.unionByName(met.select(F.col("y").alias("x"), "y").distinct()), "ngram-hub-pairs")
    sizes = met.groupBy("y").agg(F.count("*").alias("sets"))
    sizes = sizes.select("y", F.ceil(F.col("sets") / HUB_SETS).cast("int").alias("k"), F.ceil(F.col("sets") / HUB_SAMPLE).cast("int").alias("one_in"))
    sizes = _listed(materialise(sizes, "ngram-hubs"))
    copies = sizes.select("y", "k")
    sample = met.join(sizes, "y").filter(F.pmod(F.xxhash64("x"), "one_in") == 0).select("x", "y")
    sample = materialise(sample.join(full.withColumnRenamed("node", "x"), "x").select("y", "full"), "ngram-hub-sample")
    counted = sample.select("y", F.explode("full").alias("tok")).groupBy("y", "tok").agg(F.count("*").alias("held"))
    most = counted.join(sample.groupBy("y").agg(F.count("*").alias("of")), "y").filter("held * 2 > of")
    middle = materialise(most.groupBy("y").agg(F.collect_list("tok").alias("fy")), "ngram-hub-middle")
    share = (F.col("common").cast("double") / (F.col("a") + F.col("b")) * F.lit(1 << 20)).cast("long")
    close = F.shiftleft(share, 40).bitwiseOR(F.shiftrightunsigned(F.xxhash64("x"), 24))
    closest = _meet(met, full, middle, copies).groupBy("y").agg(F.max_by("x", close).alias("next"))
    closest = _listed(materialise(copies.join(closest, "y", "left").select("y", F.coalesce("next", "y").alias("next")), "ngram-closest"))
    chosen = closest.join(full, F.col("next") == F.col("node")).select("y", F.col("full").alias("fy"))
    found = _meet(met, full, chosen, copies).filter(_enough(F.col("common"), F.col("a"), F.col("b"), percent))
    return found.join(closest, "y").select(F.col("x").alias("u"), F.col("next").alias("v"))


def _open_blocks(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Sets of the large keys whose sets are not all in one group yet: node, block, and whether the set is outside its block's largest group."""
    labelled = materialise(members.join(groups, "node", "left").select(
        "sig", "node", "hub", F.coalesce("label", "node").alias("label")), "ngram-labelled")
    undone = materialise(labelled.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("sig"),
                         "ngram-undone")
    labelled = labelled.join(_listed(undone), "sig", "left_semi")
    blocks = components(labelled.filter("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v"))).withColumnRenamed("label", "block")
    nodes = materialise(blocks.join(labelled.select("node", "label").distinct(), "node"), "ngram-blocks")
    order = F.shiftleft("sets", 24).bitwiseOR(F.shiftrightunsigned(F.xxhash64("label"), 40))
    largest = nodes.groupBy("block", "label").agg(F.count("*").alias("sets")).groupBy("block").agg(F.max_by("label", order).alias("largest"))
    largest = _listed(materialise(largest, "ngram-largest"))
    return nodes.join(largest, "block").select("node", "block", (F.col("label") != F.col("largest")).alias("open"))


def _cells(blocks: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Each set of a block with the cells of the block's grid that compare it.

    A slot is a size band and whether its sets are open. Cells compare
    chunks of open sets with chunks of open and other sets of the same and
    the neighbouring bands.
    """
    n = F.shiftright("nm", 32)
    band = F.floor(F.log(n) / F.lit(1.001 * float(np.log(100 / percent)))).cast("int")
    nodes = materialise(blocks.join(classes.select("node", n.alias("n"), band.alias("band")), "node"), "ngram-banded")

    def chunks(where: Column) -> Column:
        return F.greatest(F.ceil(F.count_if(where) / CHUNK_SETS), F.ceil(F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0)) / CHUNK_TOKENS)).cast("int")

    sizes = materialise(nodes.groupBy("block", "band").agg(chunks(F.col("open")).alias("o"), chunks(~F.col("open")).alias("c")), "ngram-bands")
    near = sizes
    for side, step in (("above", -1), ("below", 1)):
        near = near.join(sizes.select("block", (F.col("band") + step).alias("band"), F.col("o").alias("o_" + side), F.col("c").alias("c_" + side)),
                         ["block", "band"], "left")
    near = _listed(materialise(near.fillna(0).filter("o + o_above + o_below > 0"), "ngram-near"))
    dealt = nodes.join(near, ["block", "band"]).withColumn("slot", F.col("band") * 2 + F.col("open").cast("int")).withColumn(
        "chunk", F.pmod(F.xxhash64("node"), F.when(F.col("open"), F.col("o")).otherwise(F.col("c"))).cast("int"))
    upto = lambda k: F.when(F.col(k) > 0, F.sequence(F.lit(0), F.col(k) - 1)).otherwise(F.array().cast("array<int>"))
    cell = lambda s1, i1, s2, i2: F.struct(s1.alias("s1"), i1.alias("i1"), s2.alias("s2"), i2.alias("i2"))
    s, i = F.col("slot"), F.col("chunk")
    of_open = F.concat(  # the slot of open sets one band above is s + 2, that of the others in this band s - 1
        F.transform(upto("o"), lambda j: cell(s, F.least(i, j), s, F.greatest(i, j))),
        F.transform(upto("o_above"), lambda j: cell(s, i, s + 2, j)),
        F.transform(upto("o_below"), lambda j: cell(s - 2, j, s, i)),
        F.transform(upto("c"), lambda j: cell(s, i, s - 1, j)),
        F.transform(upto("c_above"), lambda j: cell(s, i, s + 1, j)),
        F.transform(upto("c_below"), lambda j: cell(s, i, s - 3, j)))
    of_others = F.concat(
        F.transform(upto("o"), lambda j: cell(s + 1, j, s, i)),
        F.transform(upto("o_above"), lambda j: cell(s + 3, j, s, i)),
        F.transform(upto("o_below"), lambda j: cell(s - 1, j, s, i)))
    return dealt.select("node", "block", "slot", "chunk", F.explode(F.when(F.col("open"), of_open).otherwise(of_others)).alias("cell")).select(
        "node", "block", "slot", "chunk", "cell.*")


def _links(docs: DataFrame, sets: DataFrame, classes: DataFrame, keys: DataFrame, buckets: DataFrame, width: int, percent: int) -> DataFrame:
    """Verified links (u, v): all pairs under small keys, spanning links of the sets that large keys connect."""
    classes = classes.filter("id IS NOT NULL")
    pairs = materialise(_candidate_pairs(keys, buckets, percent), "ngram-pairs")
    pairs = materialise(_possible(pairs, sets, classes, percent), "ngram-possible")
    members = materialise(keys.join(buckets.filter(F.col("members") > SMALL).select("sig", "hub", "hub_n"), "sig").select(
        "sig", "node", "n", "hub", "hub_n"), "ngram-members")
    wanted = pairs.select(F.col("x").alias("node")).unionByName(pairs.select(F.col("y").alias("node"))).unionByName(
        members.select("node")).distinct()
    wanted = _listed(materialise(wanted.join(classes.select("node", "id"), "node"), "ngram-full-ids"))
    rows = docs.join(wanted.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    full = map_arrow(rows, partial(_full_sets, width=width), "node long, full array<bigint>")
    with small_batches(docs.sparkSession):
        full = materialise(full.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "ngram-full")
    side = lambda c: full.select(F.col("node").alias(c), F.col("full").alias("f" + c))
    common = F.size(F.array_intersect("fx", "fy"))
    by_pair = pairs.join(side("x"), "x").join(side("y"), "y").filter(_enough(common, F.size("fx"), F.size("fy"), percent)).select(
        F.col("x").alias("u"), F.col("y").alias("v"))
    groups = materialise(components(by_pair.unionByName(_hub_links(members, full, percent))), "ngram-linked")
    cells = materialise(_cells(_open_blocks(members, groups), classes, percent), "ngram-cells")
    by_block = cells.join(full, "node").groupBy("block", "s1", "i1", "s2", "i2").applyInArrow(
        lambda key, table: _block_links(key, table, percent), "u long, v long")
    return groups.select(F.col("node").alias("u"), F.col("label").alias("v")).unionByName(by_block)
