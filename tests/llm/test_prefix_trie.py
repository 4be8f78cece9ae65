import hashlib
import random
import zlib

import pytest

from tickflow.llm.prefix_trie import ITEM, Skeleton, numbered_turns, prefix_trie, splitters

SCHEMA = "conv_id long, turn long, role string, text string, depth int, path string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def whole(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            key = (turn is not None, turn or 0, whole(role, text)[:16], len((text or "").encode()))
            convs.setdefault(c, []).append((*key, (role or "", text or "")))
    convs = {c: [t[-1] for t in sorted(ts)] for c, ts in convs.items()}
    line = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (c % 5 if c >= 0 else -(-c % 5))
        line[c] = tuple(convs.get(first, [])[:h] + own[h:])
    nodes = {p[:d] for p in line.values() for d in range(len(p) + 1)}
    members = {p: [c for c in line if line[c][:len(p)] == p] for p in nodes}
    kids = {p: [q for q in nodes if len(q) == len(p) + 1 and q[:-1] == p] for p in nodes}

    def below(p):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        under = [below(q) for q in kids[p]]
        return sum(x for x, _ in under) or (not under), own + sum(s for _, s in under)

    out = []
    for p in nodes:
        leaves, saved = below(p)
        ends = ",".join(str(c) for c in sorted(members[p]) if len(line[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), int(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(seed):
    rng = random.Random(seed)
    rows = []
    for c in list(range(-12, 60)):
        if rng.random() < 0.15:
            continue
        for t in range(rng.choice([1, 2, 3, 6, 12])):
            rows.append((c, t, rng.choice(["user", "assistant", None]) if t % 4 == 3 else "user", rng.choice(["a", "é", "", None]) if t > 2 else "hello", 1, "x"))
    rows += [(100 + 5 * k, t, "user", f"long {t}", None, None) for k in range(4) for t in range(30)]  # equal, and long
    rows += [(200, None, "b", "x", 0, ""), (200, None, None, None, 0, ""), (200, 1, "b", "x" * 100_000, 0, ""), (200, 1, "b", "x", 0, ""), (200, 1, "b", "x", 0, "")]
    rows += [(None, 0, "user", "nobody", 0, "")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("segment", "shard_items"), [(1024, 20), (2, 5)])
def test_nodes_equal_brute_force_for_any_segment_and_shard(spark, segment, shard_items):
    rows = table(segment)
    got = prefix_trie(spark.createDataFrame(rows, SCHEMA), segment, shard_items)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_hot_conversation_is_numbered_over_tasks(spark):
    rows = [(1, k, "user", str(k), 0, "") for k in range(2000)] + [(2, None, "user", "same", 0, "")] * 2000 + [(3, 0, "user", "x", 0, "")]
    got = numbered_turns(spark.createDataFrame(rows, SCHEMA)).select("conv_id", "pos").collect()
    for c, n in ((1, 2000), (2, 2000), (3, 1)):
        assert sorted(r.pos for r in got if r.conv_id == c) == list(range(1, n + 1))


def test_many_equal_conversations_keep_their_digest(spark):
    rows = [(5 * k, 0, "user", "same", 0, "") for k in range(9000)]
    got = {r.depth: r for r in prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[1].n_convs, got[1].n_leaves, got[0].saved_tokens, got[0].n_children) == (9000, 1, 8999 * 4, 1)
    assert got[1].ends_sha256 == hashlib.sha256(",".join(str(5 * k) for k in range(9000)).encode()).hexdigest()


def test_skeleton_holds_every_prefix_of_a_splitter_once():
    item = lambda x: bytes([x]) * 16 + (x).to_bytes(8, "big")
    paths = [(b"".join(map(item, p)), 1) for p in [(1,), (1, 2), (1, 2, 3), (1, 2, 4), (2,), (2, 1, 1)]]
    splits = splitters(paths, 4)
    assert splits == sorted(set(splits)) and len(splits) <= 3
    k = Skeleton(splits)
    named = {s[:d * ITEM]: row[d] for s, row in zip(k.splits, k.ids, strict=True) for d in range(len(s) // ITEM + 1)}
    assert sorted(set(named.values())) == list(range(len(k.parent)))
    assert len(set(named.values())) == len(named)
    assert all(named[p[:-ITEM]] == k.parent[i] for p, i in named.items() if p)


def test_empty_table(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
