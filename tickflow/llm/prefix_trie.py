"""Trie of conversation prefixes: a broadcast skeleton of splitter paths, sorted shards for the rest.

1. Every turn becomes an item of 24 bytes: 128 bits of a hash of role and
   text, and the text's length in bytes. Texts go no further.
2. Turns are sorted by range, so that a conversation of any length is split
   over tasks; a turn's place is its place in its task plus what earlier
   tasks hold of its conversation (a small table, broadcast). A rebuilt
   conversation takes its first turns from the first of its five and its
   others from itself.
3. A conversation becomes paths of at most SEGMENT items. Those after the
   first begin with a hash of all that came before. Equal paths fold into
   one row with their number and least id before they are sorted.
4. Splitter paths deal the sorted paths into shards. Only a prefix of a
   splitter can have members in two shards; these prefixes, the skeleton, are
   a trie that is broadcast. Each shard walks its paths in order with a
   stack and finishes all other nodes; of the skeleton's it gives partial
   aggregates, which are reduced per node and added up along the skeleton.
5. Segments are done from the last to the first, as a node at a segment's
   end needs what lies below. Only prefixes that several conversations share
   go on to a further segment; a lone conversation's turns are nodes as they are.

``ends_sha256`` is fed in the order of ids from chunks that many tasks join,
so a large group of equal conversations is never held as a list.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.common import batch, columns, join_by_share, map_arrow, materialise

FAMILY = 5
LENT = 9
ITEM = 24
#: Items of a path, 24 KB.
SEGMENT = 1024
#: Items of a shard, about; there are at most MAX_SHARDS.
SHARD_ITEMS = 200_000
MAX_SHARDS = 4096
#: Paths looked at for each splitter.
SAMPLE = 16
#: Ids joined into one chunk before they are hashed.
CHUNK = 4096

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_NONE = "CAST('' AS BINARY)"


def _h(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % F.lit(LENT)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place of each turn within this task's part of its conversation."""
    schema = pa.schema([("conv_id", pa.int64()), ("item", pa.binary()), ("part", pa.int32()), ("place", pa.int64())])
    now, place = None, 0
    for b in batches:
        places = []
        for c in b.column("conv_id").to_pylist():
            now, place = c, place + 1 if c == now else 1
            places.append(place)
        yield batch(schema, [b.column("conv_id"), b.column("item"), b.column("part"), places])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, item, pos): the turns of each conversation from 1, in order of turn (null first), then of the hash of role and text."""
    turns = columns(conversations, conv_id="long", turn="long", role="string", text="string").filter("conv_id IS NOT NULL")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    size = F.octet_length(text).cast("long")
    items = turns.select(
        "conv_id", "turn", F.concat(F.substring(F.unhex(F.sha2(whole, 256)), 1, 16), F.unhex(F.lpad(F.hex(size), 16, "0"))).alias("item"),
        F.monotonically_increasing_id().alias("any"))  # spreads rows that are equal in all else
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("item"), F.col("any")]
    laid = materialise(map_arrow(
        items.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "item", F.spark_partition_id().alias("part")),
        _places, "conv_id long, item binary, part int, place long"), "trie-turns")
    held = laid.groupBy("conv_id", "part").agg(F.max("place").alias("n"))
    # only the conversations at the ends of tasks have several parts: at most one for each task
    several = held.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("parts")).filter(F.size("parts") > 1)
    before = several.select("conv_id", F.explode(F.transform("parts", lambda p: F.struct(p["part"].alias("part"), F.aggregate(
        F.filter("parts", lambda o: o["part"] < p["part"]), F.lit(0).cast("long"), lambda s, o: s + o["n"]).alias("before")))).alias("p"))
    before = F.broadcast(before.select("conv_id", "p.part", "p.before"))
    return laid.join(before, ["conv_id", "part"], "left").select(
        "conv_id", "item", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) of every rebuilt conversation, and its turns (conv_id, depth, item)."""
    turns = materialise(numbered_turns(conversations), "trie-numbered")
    first = lambda c: c - c % F.lit(FAMILY)
    sizes = materialise(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "trie-sizes")
    lenders = sizes.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("lender"), F.col("n").alias("has"))
    h = _h(F.col("conv_id"))
    roster = sizes.withColumn("lender", first(F.col("conv_id"))).join(lenders, "lender", "left").select(
        "conv_id", "n", "lender", h.alias("h"), F.least(h, F.coalesce("has", F.lit(0))).alias("lent"))
    roster = materialise(roster, "trie-roster")
    moved = join_by_share(turns.filter(F.col("pos") > h), roster.select("conv_id", "n", "h", "lent"), ["conv_id"], F.col("n"), turns.count())
    own = moved.select("conv_id", (F.col("pos") - F.col("h") + F.col("lent")).alias("depth"), "item")
    heads = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < LENT)).select(F.col("conv_id").alias("lender"), "pos", "item")
    lent = roster.join(heads, "lender").filter(F.col("pos") <= F.col("lent")).select("conv_id", F.col("pos").alias("depth"), "item")
    members = roster.select("conv_id", (F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return members, own.unionByName(lent)


_CHAIN = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("before", pa.binary())])


def _chain(table: pa.Table) -> pa.Table:
    """Hash of all segments before each one of a conversation, and of all of them for the segment after a full last one."""
    conv, rows = table.column("conv_id")[0].as_py(), sorted(zip(table.column("segment").to_pylist(), table.column("own").to_pylist(), strict=True))
    out, now = [], b""
    for segment, own in rows:
        now = hashlib.sha256(now + own).digest()[:16]
        out.append((conv, segment + 1, now))
    return pa.table([list(c) for c in zip(*out, strict=True)], schema=_CHAIN)


def _paths(members: DataFrame, turns: DataFrame, segment: int) -> DataFrame:
    """(conv_id, segment, path, length): items of each conversation, ``segment`` at a time; the first segment of turnless ones is empty."""
    at = F.floor((F.col("depth") - 1) / segment).cast("long")
    cut = turns.groupBy("conv_id", at.alias("segment")).agg(F.collect_list(F.struct("depth", "item")).alias("items"))
    path = F.unhex(F.array_join(F.transform(F.array_sort("items"), lambda x: F.hex(x["item"])), ""))
    none = members.filter("length = 0").select("conv_id", F.lit(0).cast("long").alias("segment"), F.expr(_NONE).alias("path"))
    return cut.select("conv_id", "segment", path.alias("path")).unionByName(none)


class Skeleton:
    """Trie of the splitter paths: ``splits`` in order, ``ids[k][d]`` the node of the first d items of ``splits[k]``."""

    def __init__(self, splits: list[bytes]):
        self.splits, self.ids = splits, []
        self.parent: list[int] = [-1]
        self.length: list[int] = [0]
        for k, s in enumerate(splits):
            row = [0]
            if k:
                row = self.ids[-1][:_common(splits[k - 1], s) + 1]
            for d in range(len(row), len(s) // ITEM + 1):
                self.parent.append(row[-1])
                self.length.append(int.from_bytes(s[d * ITEM - 8:d * ITEM], "big"))
                row.append(len(self.parent) - 1)
            self.ids.append(row)


def _common(x: bytes, y: bytes) -> int:
    """Items that two paths begin with alike."""
    n = min(len(x), len(y)) // ITEM
    if x[:n * ITEM] == y[:n * ITEM]:
        return n
    low, high = 0, n  # the first low items are equal, the first high are not
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if x[low * ITEM:mid * ITEM] == y[low * ITEM:mid * ITEM] else (low, mid)
    return low


def splitters(sample: list[tuple[bytes, int]], shards: int) -> list[bytes]:
    """At most ``shards`` - 1 paths that deal the sampled (path, items) evenly, each cut after its first new item."""
    sample = sorted(sample)
    total = sum(n for _, n in sample)
    out, seen, last = [], 0, b""
    for path, n in sample:
        if seen * shards >= total * (len(out) + 1) and path != last and len(out) < shards - 1:
            cut = path[:(_common(last, path) + 1) * ITEM]
            if not out or cut > out[-1]:
                out.append(cut)
        seen, last = seen + n, path
    return out


_SHARD = pa.schema([
    ("node", pa.int64()), ("up", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("end", pa.binary())])


class _Walk:
    """Paths of one shard in order; finished nodes go to ``out`` as rows of _SHARD.

    A row with ``node`` is a partial aggregate of a skeleton node: what its
    own ends and its children outside the skeleton add to it. Other rows are
    finished nodes; ``up`` is the parent if that is of the skeleton, whose
    least id is not yet known here. ``end`` is filled where a path ends.
    """

    def __init__(self, skeleton: Skeleton, shard: int):
        self.left, self.left_ids = (skeleton.splits[shard - 1], skeleton.ids[shard - 1]) if shard else (b"", [0])
        self.right, self.right_ids = (skeleton.splits[shard], skeleton.ids[shard]) if shard < len(skeleton.splits) else (b"", [0])
        self.out: list[tuple] = []
        self.path = b""
        self.stack = [self._node(0, 0, 0)]

    @staticmethod
    def _node(depth: int, size: int, skeleton: int) -> list:
        # depth, bytes of the last text, skeleton node or -1, least id, members, children, leaves, saved, end of a path, children that wait
        return [depth, size, skeleton, None, 0, 0, 0, 0, None, []]

    def add(self, path: bytes, end: bytes, n: int, low: int, children: int, leaves: int, saved: int) -> None:
        """The conversations of one path; children, leaves and saved: what lies below its end, beyond the segment."""
        common = _common(self.path, path)
        self._close(common)
        items = len(path) // ITEM
        in_left, in_right = _common(path, self.left), _common(path, self.right)
        for d in range(common + 1, items + 1):
            node = self.left_ids[d] if d <= in_left else self.right_ids[d] if d <= in_right else -1
            self.stack.append(self._node(d, int.from_bytes(path[d * ITEM - 8:d * ITEM], "big"), node))
        top = self.stack[-1]
        top[3], top[4], top[8] = low if top[3] is None else min(top[3], low), top[4] + n, end
        top[5], top[6], top[7] = top[5] + children, top[6] + leaves, top[7] + saved
        self.path = path

    def _close(self, depth: int) -> None:
        while len(self.stack) > depth + 1:
            d, size, skeleton, low, n, children, leaves, saved, end, waiting = self.stack.pop()
            up = self.stack[-1]
            if skeleton >= 0:  # its parent is of the skeleton, too
                self.out.append((skeleton, None, low, d, None, n, children, leaves, saved, end))
                continue
            leaves, saved = leaves if children else 1, saved + (n - 1) * size
            self.out.extend((None, None, c, d + 1, low, *rest) for c, *rest in waiting)
            up[3], up[4] = low if up[3] is None else min(up[3], low), up[4] + n
            up[5], up[6], up[7] = up[5] + 1, up[6] + leaves, up[7] + saved
            row = (low, n, children, leaves, saved, end)
            if up[2] >= 0:
                self.out.append((None, up[2], low, d, None, *row[1:]))
            else:
                up[9].append(row)

    def finish(self) -> None:
        self._close(0)
        _, _, skeleton, low, n, children, leaves, saved, end, _ = self.stack[0]
        self.out.append((skeleton, None, low, 0, None, n, children, leaves, saved, end))


def _shards(skeleton: Skeleton, rows_out: int = 4096):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, shard = None, None

        def ready(all_rows: bool) -> Iterator[pa.RecordBatch]:
            while walk and walk.out and (all_rows or len(walk.out) >= rows_out):
                rows, walk.out = walk.out[:rows_out], walk.out[rows_out:]
                yield batch(_SHARD, [list(c) for c in zip(*rows, strict=True)])

        for b in batches:
            for k, *row in zip(*(b.column(c).to_pylist() for c in ("shard", "path", "end", "n", "low", "children", "leaves", "saved")), strict=True):
                if k != shard:
                    if walk:
                        walk.finish()
                        yield from ready(True)
                    walk, shard = _Walk(skeleton, k), k
                walk.add(*row)
            yield from ready(False)
        if walk:
            walk.finish()
            yield from ready(True)

    return run


def _dealt(skeleton: Skeleton):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard = [bisect.bisect_right(skeleton.splits, p) for p in b.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard, pa.int32())], [*b.schema.names, "shard"])

    return run


def trie(paths: DataFrame, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """Nodes (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, end) of distinct paths.

    ``paths``: path (items of 24 bytes), end (names it), n, low, children,
    leaves, saved; see ``_Walk.add``. The root has depth 0. ``end`` is null
    where no path ends.
    """
    paths = materialise(paths.select("path", "end", "n", "low", "children", "leaves", "saved"), "trie-paths")
    items = F.floor(F.octet_length("path") / ITEM) + 1
    total = paths.agg(F.sum(items).alias("n")).first()["n"] or 0
    shards = int(min(MAX_SHARDS, -(-total // shard_items))) or 1
    sample = []
    if shards > 1:  # those of the smallest hashes; they only say where to cut
        chosen = paths.select("path", items.alias("n")).orderBy(F.xxhash64("path"), "path").limit(shards * SAMPLE)
        sample = [(bytes(r["path"]), r["n"]) for r in chosen.collect()]
    skeleton = Skeleton(splitters(sample, shards))
    dealt = map_arrow(paths, _dealt(skeleton), T.StructType([*paths.schema.fields, T.StructField("shard", T.IntegerType())]))
    walked = map_arrow(dealt.repartition("shard").sortWithinPartitions("shard", "path"), _shards(skeleton),
                       "node long, up long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                       "n_leaves long, saved_tokens long, end binary")
    walked = materialise(walked, "trie-walked")
    fields = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end"]
    # one row per skeleton node, of which there are at most MAX_SHARDS paths
    parts = walked.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("conv_id").alias("low"), F.max("depth").alias("depth"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max("end").alias("end"))
    rows = {r["node"]: r.asDict() for r in parts.collect()}
    for k in range(len(skeleton.parent) - 1, -1, -1):  # children come after their parents
        if k not in rows:
            continue
        r = rows[k]
        if r["n_children"] == 0:
            r["n_leaves"] = 1
        r["saved_tokens"] += (r["n_convs"] - 1) * skeleton.length[k]
        up = rows.get(skeleton.parent[k])
        if up:
            up["low"] = r["low"] if up["low"] is None else min(up["low"], r["low"]) if r["low"] is not None else up["low"]
            up["n_children"] += 1
            for c in ("n_convs", "n_leaves", "saved_tokens"):
                up[c] += r[c]
    done = [(k, r["low"], r["depth"], rows[skeleton.parent[k]]["low"] if k else None, r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"],
             None if r["end"] is None else bytes(r["end"])) for k, r in rows.items()]
    spark = paths.sparkSession
    top = spark.createDataFrame(done, "node long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                                      "n_leaves long, saved_tokens long, end binary")
    lows = F.broadcast(top.select(F.col("node").alias("up"), F.col("conv_id").alias("above")))
    rest = walked.filter("node IS NULL").join(lows, "up", "left").withColumn("parent_conv_id", F.coalesce("above", "parent_conv_id"))
    return top.select(*fields).unionByName(rest.select(*fields))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of this task, joined per path, at most CHUNK at a time."""
    schema = pa.schema([("end", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])
    end, held = None, []
    row = lambda: batch(schema, [[end], [held[0]], [len(held)], [",".join(map(str, held))]])
    for b in batches:
        for e, c in zip(b.column("end").to_pylist(), b.column("conv_id").to_pylist(), strict=True):
            if held and (e != end or len(held) == CHUNK):
                yield row()
                held = []
            end = e
            held.append(c)
    if held:
        yield row()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("end", pa.binary()), ("ends_sha256", pa.string())])
    end, sha = None, None
    for b in batches:
        done: tuple[list, list] = ([], [])
        for e, ids in zip(b.column("end").to_pylist(), b.column("ids").to_pylist(), strict=True):
            if sha and e == end:
                sha.update(b"," + ids.encode())
                continue
            if sha:
                done[0].append(end)
                done[1].append(sha.hexdigest())
            end, sha = e, hashlib.sha256(ids.encode())
        yield batch(schema, list(done))
    if sha:
        yield batch(schema, [[end], [sha.hexdigest()]])


def _ends(ended: DataFrame) -> DataFrame:
    """(end, ends_sha256) of rows (end, conv_id); an end of many ids is cut at range bounds and into chunks before it is hashed."""
    ids = ended.repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id")
    chunks = map_arrow(ids, _joined, "end binary, first long, n long, ids string")
    return map_arrow(chunks.repartition("end").sortWithinPartitions("end", "first"), _hashed, "end binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, segment: int = SEGMENT, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """One row per distinct prefix of the rebuilt ``conversations`` (conv_id, turn, role, text).

    conv_id (least member), depth, parent_conv_id (null for the root),
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Turns are in
    order of turn, null first; turns that tie or repeat count each, in order
    of the hash of role and text. Null role or text counts as empty; rows
    without a conv_id belong to no conversation and are left out. Extra
    columns are ignored, an empty table gives no rows. Conversations and
    texts of any length are read whole.
    """
    members, turns = rebuilt(conversations)
    members = materialise(members, "trie-members")
    cut = materialise(_paths(members, turns, segment), "trie-cut")
    last = F.floor(F.col("length") / segment)  # a conversation that ends with its segment has an empty one after it
    cut = cut.join(members, "conv_id").withColumn("last", last) if not members.filter(F.col("length") >= segment).isEmpty() else \
        cut.withColumn("length", F.floor(F.octet_length("path") / ITEM)).withColumn("last", F.lit(0).cast("long"))
    long = cut.filter("last > 0")
    nothing = cut.sparkSession.createDataFrame([], "conv_id long, segment long, before binary")
    chain = nothing if long.isEmpty() else materialise(
        long.filter(F.octet_length("path") == segment * ITEM).select("conv_id", "segment", F.unhex(F.sha2("path", 256)).alias("own"))
        .groupBy("conv_id").applyInArrow(_chain, nothing.schema), "trie-chain")
    shared = materialise(chain.groupBy("segment", "before").agg(F.count("*").alias("n")).filter("n > 1"), "trie-shared")
    deepest = shared.agg(F.max("segment").alias("d")).first()["d"] or 0

    whole = cut.join(chain, ["conv_id", "segment"], "left").withColumn("before", F.coalesce("before", F.expr(_NONE)))
    empty_last = chain.join(members, "conv_id").filter(F.col("segment") * segment == F.col("length")).select(
        "conv_id", "segment", F.expr(_NONE).alias("path"), "length", F.col("segment").alias("last"), "before")
    whole = whole.select("conv_id", "segment", "path", "length", "last", "before").unionByName(empty_last)
    full = F.octet_length("path") == segment * ITEM
    own = F.unhex(F.sha2("path", 256))
    after = F.when(full, F.substring(F.unhex(F.sha2(F.concat("before", own), 256)), 1, 16))  # as in _chain
    end = F.unhex(F.sha2(F.when(full, after).otherwise(F.concat("before", "path")), 256))
    whole = materialise(whole.withColumn("after", after).withColumn("end", end), "trie-segments")
    hashes = materialise(_ends(whole.filter("segment = last").select("end", "conv_id")), "trie-ends")

    nodes: list[DataFrame] = []
    below = None  # what lies below ``after``, in the next segment
    for s in range(deepest, -1, -1):
        rows = whole.filter(F.col("segment") == s)
        if s:
            rows = rows.join(shared.filter(F.col("segment") == s).select("before"), "before", "left_semi")
        # the hash of what came before stands as a first item, without a text
        key = F.concat(F.col("before"), F.unhex(F.lit("0" * 16)), F.col("path")) if s else F.col("path")
        folded = rows.groupBy(key.alias("path"), "end", "after").agg(
            F.count("*").alias("n"), F.min("conv_id").alias("low"),
            F.max(F.when(F.col("length") > (s + 1) * segment, 1).otherwise(0)).cast("long").alias("children"))
        folded = folded.select("*", F.col("children").alias("leaves"), F.lit(0).cast("long").alias("saved"))
        if below is not None:
            folded = folded.join(below, "after", "left").select(
                "path", "end", "n", "low", F.coalesce("c", "children").alias("children"),
                F.when(F.coalesce("c", "children") > 0, F.coalesce("l", "leaves")).otherwise(0).alias("leaves"), F.coalesce("s", "saved").alias("saved"))
        got = materialise(trie(folded, shard_items), "trie-nodes")
        if s:
            below = got.filter("depth = 1").join(
                rows.groupBy("before").agg(F.min("conv_id").alias("conv_id")), "conv_id").select(
                F.col("before").alias("after"), F.col("n_children").alias("c"), F.col("n_leaves").alias("l"), F.col("saved_tokens").alias("s"))
            got = got.filter("depth > 1").withColumn("depth", F.col("depth") + (s * segment - 1))
        nodes.append(got)
    return _finish(nodes, whole, shared, hashes, segment)


def _finish(nodes: list[DataFrame], whole: DataFrame, shared: DataFrame, hashes: DataFrame, segment: int) -> DataFrame:
    fields = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    known = nodes[0]
    for more in nodes[1:]:
        known = known.unionByName(more)
    out = known.join(hashes, "end", "left").select(*fields, F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
    # segments that a conversation shares with no other: every turn is a node of its own
    lone = whole.filter("segment > 0 AND length > segment * " + str(segment)).join(shared.select("segment", "before"), ["segment", "before"], "left_anti")
    turn = F.explode(F.sequence(F.lit(1).cast("long"), F.floor(F.octet_length("path") / ITEM))).alias("k")
    alone = lone.select("conv_id", "segment", "length", turn).withColumn("depth", F.col("segment") * segment + F.col("k"))
    is_last = F.col("depth") == F.col("length")
    return out.unionByName(alone.select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        F.when(is_last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(is_last, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(EMPTY_SHA).alias("ends_sha256")))


def trie_sql() -> str:
    """The same in DuckDB SQL: all prefixes of all rebuilt conversations, subtrees by a join of nodes with members."""
    return r"""
        WITH t AS MATERIALIZED (SELECT list(v ORDER BY i) AS crc FROM (SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) AS r(i))),
             turns AS (SELECT conv_id, octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '') AS whole, turn,
                   octet_length(encode(coalesce(text, ''))) AS size FROM conversations WHERE conv_id IS NOT NULL),
             pos AS MATERIALIZED (SELECT conv_id, sha256(whole) AS item, size,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(sha256(whole), 1, 32), size) AS pos FROM turns),
             ids AS MATERIALIZED (SELECT conv_id, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: unicode(c)::BIGINT),
                   lambda a, x: xor(a >> 8, t.crc[(xor(a, x) & 255) + 1])), 4294967295) % 9 AS h FROM (SELECT DISTINCT conv_id FROM pos), t),
             line AS (SELECT c.conv_id, 0 AS own, p.pos, p.item, p.size FROM ids AS c JOIN pos AS p ON p.conv_id = c.conv_id - c.conv_id % 5 AND p.pos <= c.h
                   UNION ALL SELECT c.conv_id, 1, p.pos, p.item, p.size FROM ids AS c JOIN pos AS p ON p.conv_id = c.conv_id AND p.pos > c.h),
             deep AS (SELECT conv_id, item, size, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth FROM line),
             step AS MATERIALIZED (SELECT conv_id, depth, size, sha256(string_agg(item, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM deep
                   UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
             ends AS (SELECT conv_id, max(depth) AS ends FROM step GROUP BY conv_id),
             node AS MATERIALIZED (SELECT depth, node, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends = depth), '')) AS ends_sha256
                   FROM step JOIN ends USING (conv_id) GROUP BY depth, node),
             up AS MATERIALIZED (SELECT n.depth, n.node, p.node AS up FROM node AS n LEFT JOIN step AS p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
             kids AS (SELECT depth - 1 AS depth, up AS node, count(*) AS n FROM up WHERE up IS NOT NULL GROUP BY ALL),
             below AS (SELECT a.depth, a.node, CAST(sum((d.n_convs - 1) * d.size) AS BIGINT) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
                   FROM step AS a JOIN node AS d ON d.conv_id = a.conv_id AND d.depth >= a.depth
                   LEFT JOIN kids AS k ON k.depth = d.depth AND k.node = d.node GROUP BY a.depth, a.node)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, b.leaves AS n_leaves, b.saved AS saved_tokens, n.ends_sha256
        FROM node AS n JOIN up AS u ON u.depth = n.depth AND u.node = n.node LEFT JOIN node AS p ON p.depth = n.depth - 1 AND p.node = u.up
        LEFT JOIN kids AS k ON k.depth = n.depth AND k.node = n.node JOIN below AS b ON b.depth = n.depth AND b.node = n.node
    """
