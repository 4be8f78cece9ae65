"""Spelling variants: words that differ by one letter, found on a bit-sliced position index.

1. One scan counts the words of every document; a task folds its own counts
   before anything is shuffled.
2. The vocabulary is dealt into blocks. A block (m, a, b, first, last) holds
   the words of m and m + 1 letters that begin with the ``a`` letters
   ``first`` and end with the ``b`` letters ``last``; at first a and b are 0.
   A block that is too large is dealt anew by the first or by the second half
   of the letters in between: of two words one edit apart, one half is equal,
   so no pair is lost. With one letter left in between a block holds at most
   a word per letter, or per two letters, of the alphabet. So no block grows
   with the data, and nothing is compared outside a block.
3. In a block every (position, letter) has a bitset over the block's words.
   A query word runs through its letters with three sets at once, 64 words an
   operation: those without an error, those with one letter replaced, and
   those with one letter inserted, whose bitsets are read one position on.
4. A pair that several blocks hold is reported by one of them: the first half
   decides where it is equal, so a block dealt by a second half reports only
   pairs that differ within the letters in between or before.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import BROADCAST_ROWS, batch, columns, join_by_share, map_arrow, materialise, texts

_RUN = re.compile(r"[a-zÀ-ÿ]+")  # after lower-casing A-Z
#: One distinct run in this many loses a letter (planted variants).
PLANTED = 97
LEAST_LETTERS = 5
LEAST_N = 3
#: A form occurs at least so many times as often as its variant.
FORM_FACTOR = 2
#: Words of a block before it is dealt anew.
BLOCK_WORDS = 2048
#: Words of small blocks that share one index, and query words that run together.
INDEX_WORDS = 1024
QUERY_WORDS = 256
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 200_000

_BLOCK = ["m", "a", "b", "first", "last"]


def words_of(doc_id: int | None, text: bytes) -> Counter:
    """Words of one text with their numbers of occurrences; of planted runs one letter is missing."""
    seed = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
    out: Counter = Counter()
    # bytes.lower() changes A-Z only
    for run, n in Counter(m.group() for m in _RUN.finditer(text.lower().decode("utf-8", "replace"))).items():
        h = zlib.crc32(run.encode(), seed)
        if h % PLANTED == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1:]
        if len(run) >= LEAST_LETTERS:
            out[run] += n
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    held: Counter = Counter()
    for b in batches:
        for i, t in zip(b.column("doc_id").to_pylist(), texts(b.column("text")), strict=True):
            held.update(words_of(i, t))
            if len(held) > HELD_WORDS:
                yield batch(schema, [list(held.keys()), list(held.values())])
                held = Counter()
    if held:
        yield batch(schema, [list(held.keys()), list(held.values())])


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text) that occur often enough."""
    counts = map_arrow(columns(docs, doc_id="long", text="string"), _counted, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_N)


def near_pairs(words: list[str], m: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (i, j) of all pairs one edit apart, word i of m letters and word j of m or m + 1 letters."""
    length = np.array([len(w) for w in words])
    letters = np.zeros((len(words), m + 1), np.uint8)
    for row, w in zip(letters, words, strict=True):
        row[:len(w)] = np.frombuffer(w.encode("latin-1"), np.uint8)
    wide = -(-len(words) // 64) * 64  # whole 64-bit numbers

    def bits(flags: np.ndarray) -> np.ndarray:
        padded = np.zeros((*flags.shape[:-1], wide), bool)
        padded[..., :len(words)] = flags
        return np.packbits(padded, axis=-1).view(np.uint64)

    def sliced(position: int) -> tuple[np.ndarray, np.ndarray]:
        """Row of each letter, and the rows: which words have that letter at this position. Row 0: none."""
        present = np.unique(letters[:, position])
        row = np.zeros(256, np.intp)
        row[present] = np.arange(1, len(present) + 1)
        none = np.zeros((1, wide // 64), np.uint64)
        return row, np.vstack([none, bits(letters[:, position][None, :] == present[:, None])])

    queries = np.flatnonzero(length == m)
    index = [sliced(p) for p in range(m + 1)]
    same, longer = bits(length == m), bits(length == m + 1)
    found = []
    for at in range(0, len(queries), QUERY_WORDS):
        q = queries[at:at + QUERY_WORDS]
        exact = np.repeat(bits(np.ones(len(words), bool))[None, :], len(q), 0)
        replaced, inserted = np.zeros_like(exact), exact.copy()  # inserted: the word is one letter further
        for p in range(m):
            letter = letters[q, p]
            here, ahead = (rows[row[letter]] for row, rows in (index[p], index[p + 1]))
            replaced = (replaced & here) | (exact & ~here)
            exact &= here
            inserted = (inserted & ahead) | exact
        hit = np.unpackbits(((replaced & same) | (inserted & longer)).view(np.uint8), axis=1)[:, :len(words)]
        i, j = np.nonzero(hit)
        found.append((q[i], j))
    if not found:
        return np.zeros(0, np.intp), np.zeros(0, np.intp)
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _near_in(rows: list[tuple], m: int) -> pa.RecordBatch:
    """What the blocks in ``rows`` (block number, b, word, n), all of one m, know of each word's near words."""
    words = [r[2] for r in rows]
    group, after = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    i, j = near_pairs(words, m)
    mine = group[i] == group[j]
    i, j = i[mine], j[mine]
    out: dict[int, tuple[int, int, str]] = {}

    def add(x: int, y: int) -> None:
        n, word = rows[y][3], words[y]
        seen, best_n, best = out.get(x, (0, -1, ""))
        out[x] = (seen + 1, n, word) if (-n, word) < (-best_n, best) else (seen + 1, best_n, best)

    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        v, w = words[x], words[y]
        if after[x]:
            equal = next((k for k in range(m) if v[k] != w[k]), m)
            if equal >= m - after[x]:
                continue  # a block dealt by the first half has it
        add(x, y)
        if len(w) > m:
            add(y, x)
    at = list(out)
    return batch(_NEAR, [[words[x] for x in at], *([out[x][k] for x in at] for k in range(3))])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks arrive one after the other; small ones of one m share an index."""
    held: list[tuple] = []  # whole blocks
    block: list[tuple] = []  # the block that is arriving
    key, number = None, 0

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal held, block
        if len(block) > 1:
            if held and len(held) + len(block) > INDEX_WORDS:
                yield _near_in(held, key[0])
                held = []
            held += block
        block = []

    for b in batches:
        for *k, word, n in zip(*(b.column(c).to_pylist() for c in [*_BLOCK, "word", "n"]), strict=True):
            if k != key:
                yield from close()
                if held and k[0] != key[0]:
                    yield _near_in(held, key[0])
                    held = []
                key, number = k, number + 1
            block.append((number, k[2], word, n))
    yield from close()
    if held:
        yield _near_in(held, key[0])


def blocks(vocab: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows (m, a, b, first, last, word, n): the vocabulary in blocks of at most ``block_words``, or one letter in between.

    Only blocks that are too large are dealt anew, in as many passes as a
    word can be halved; the list of such blocks has at most a row for every
    ``block_words`` rows.
    """
    size = F.char_length("word")
    todo = vocab.select("word", "n", F.explode(F.array(size, size - 1)).alias("m"), F.lit(0).alias("a"), F.lit(0).alias("b"))
    todo = todo.filter(F.col("m") >= LEAST_LETTERS)
    done: DataFrame | None = None
    while True:
        todo = materialise(todo.select(
            "m", "a", "b", F.expr("left(word, a)").alias("first"), F.expr("right(word, b)").alias("last"), "word", "n"), "spelling-blocks")
        large = materialise(todo.filter(F.col("m") - F.col("a") - F.col("b") > 1).groupBy(*_BLOCK)
                            .agg(F.count("*").alias("size")).filter(F.col("size") > block_words).drop("size"), "spelling-large")
        n = large.count()
        if not n:
            return todo if done is None else done.unionByName(todo)
        if n <= BROADCAST_ROWS:
            large = F.broadcast(large)
        small = todo.join(large, _BLOCK, "left_anti")
        done = small if done is None else done.unionByName(small)
        rest, half = F.col("m") - F.col("a") - F.col("b"), F.floor((F.col("m") - F.col("a") - F.col("b")) / 2).cast("int")
        todo = todo.join(large, _BLOCK, "left_semi").select("word", "n", "m", F.explode(F.array(
            F.struct((F.col("a") + half).alias("a"), "b"), F.struct("a", (F.col("b") + rest - half).alias("b")))).alias("at"))
        todo = todo.select("word", "n", "m", "at.a", "at.b")


def near_words(vocab: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of every word of ``vocab`` (word, n) that has a near word; best: of largest n, first in order."""
    dealt = blocks(vocab, block_words).repartition(*_BLOCK).sortWithinPartitions(*_BLOCK)
    parts = map_arrow(dealt, _near, "word string, n_near long, best_n long, best string")
    out = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("top"))
    return out.select("word", "n_near", (-F.col("top.n")).alias("best_n"), F.col("top.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form): forms followed to the last, each pass twice as far.

    The number of occurrences at least doubles from a word to its form, so
    there is no circle and no way of more than 63 steps.
    """
    now = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        rows = now.groupBy("root").agg(F.count("*").alias("rows"))
        ahead = materialise(now.select(F.col("word").alias("root"), F.col("root").alias("further")).join(rows, "root"), "spelling-ahead")
        if ahead.isEmpty():
            return now
        now = materialise(join_by_share(now, ahead, ["root"], F.col("rows"), now.count())
                          .select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")


def spelling_groups(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per word of ``docs`` (doc_id, text): word, form, root, n, n_near, form_n.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, only A-Z lower-cased,
    of at least 5 letters and 3 occurrences; null text has none, a null id
    counts as the empty string, repeated rows count each. Whole texts are
    read, however long. ``form`` is the near word of largest n (ties: the
    first in code-point order) if its n is at least twice the word's, else
    null; ``root`` follows forms to the last, the word itself if it has none.
    Extra columns are ignored, an empty table gives no rows.
    """
    vocab = materialise(vocabulary(docs), "spelling-words")
    near = near_words(vocab, block_words)
    has = F.col("best_n") >= F.col("n") * FORM_FACTOR
    known = materialise(vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")), "spelling-known")
    ends = roots(known.filter("form IS NOT NULL"))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_sql() -> str:
    """The same in DuckDB SQL: pairs by deleted letters, roots by a recursive walk."""
    return r"""
        WITH RECURSIVE t AS (SELECT list(v ORDER BY i) AS crc FROM (SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) AS r(i))),
             runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
             own AS (SELECT d, run, count(*) AS n FROM runs GROUP BY d, run),
             hashed AS (SELECT run, n, xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(d || ':' || run, ''),
                   lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, (unicode(c) - 64)::BIGINT] END)),
                   lambda a, x: xor(a >> 8, t.crc[(xor(a, x) & 255) + 1])), 4294967295) AS h FROM own, t),
             cut AS (SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                   ELSE run END AS word FROM hashed),
             v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
             holes AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM v, unnest(range(1, length(word) + 1)) AS u(i)),
             links AS (SELECT x.word, y.word AS near, y.n FROM holes AS x JOIN holes AS y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
                   UNION SELECT x.word, y.word, y.n FROM holes AS x JOIN v AS y ON x.rest = y.word
                   UNION SELECT y.word, x.word, x.n FROM holes AS x JOIN v AS y ON x.rest = y.word),
             best AS (SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, encode(near)) AS near, max(n) AS near_n FROM links GROUP BY word),
             f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * v.n THEN near END AS form,
                   CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n FROM v LEFT JOIN best USING (word)),
             walk AS (SELECT word, word AS root, form AS ahead FROM f
                      UNION ALL SELECT w.word, f.word, f.form FROM walk AS w JOIN f ON w.ahead = f.word)
        SELECT f.word, f.form, walk.root, f.n, f.n_near, f.form_n FROM f JOIN walk ON walk.word = f.word AND walk.ahead IS NULL
    """
