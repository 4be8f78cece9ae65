"""Best-fit packing of tokenised documents into fixed-length sequences.

Bulk-synchronous best fit, by runs. All documents of one length are
interchangeable, and so are all open sequences with the same gap: each forms
a run. A super-step takes the longest run of documents left, sweeps the gaps
upwards from that length (successor search), gives the k-th document of the
run to the k-th place found (conflicts go by rank), updates the gaps, and
repeats. All documents of one length move at once, so there are at most
``size`` super-steps whatever the input, and the number of sequences is that
of best-fit decreasing over the whole table, however it is partitioned.

The super-steps work on one row per length and are run by the driver. All that
grows with the table is done by the tasks: documents are counted and ranked
within (length, salt), the ranks of a length are continued from salt to salt,
and every rank looks its place up in the part of the plan that its own salt
needs. The number of salts grows with the table and does not show in the
result.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.common import batch, columns, map_arrow, materialise, small_batches, texts

SEQUENCE = 2048
#: Pieces of a salt, about, if all had one length; there are at least SALTS.
SALT_ROWS = 100_000
SALTS = 16
#: Words whose ids a worker keeps at hand, as Arrow arrays of about 5 MB.
WORD_CACHE = 100_000
#: Longer words, in bytes, are not kept.
WORD_BYTES = 64
#: Words that go to the tokenizer in one call.
CALL = 1024
#: The same for plain words.
PLAIN_CALL = 8192

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64())])
_PLAN = "length long, lo long, hi long, first long, per long, at long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_NOTHING = pa.array([], pa.large_binary())


class _Kept:
    """Words and their ids, and which of the words were met again since some last went."""

    def __init__(self) -> None:
        self.words, self.ids, self.again = _NOTHING, _NOTHING, np.zeros(0, bool)

    def add(self, words: pa.Array, ids: pa.Array) -> None:
        self.words, self.ids = pa.concat_arrays([self.words, words]), pa.concat_arrays([self.ids, ids])
        self.again = np.concatenate([self.again, np.zeros(len(words), bool)])
        if len(self.words) > WORD_CACHE:
            often = pa.array(self.again)
            self.words, self.ids = self.words.filter(often), self.ids.filter(often)
            self.again = np.zeros(len(self.words), bool)


def _slices(column: pa.Array) -> list[bytes]:
    """The values of a large binary array without nulls."""
    _, at, raw = column.buffers()
    ends = np.frombuffer(at, "<i8", len(column) + 1, 8 * column.offset).tolist() if len(column) else [0]
    raw = memoryview(raw or b"")[ends[0]:ends[-1]].tobytes()
    return [raw[a - ends[0]:b - ends[0]] for a, b in pairwise(ends)]


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = {t.content: k for k, t in tokenizer.get_added_tokens_decoder().items() if t.special}
    return tokenizer, special, _Kept()


@lru_cache(maxsize=2)
def _plain_tokenizer(path: str):
    """The same model without normalizer, for plain words between spaces; which of its ids end a word."""
    from tokenizers import Tokenizer, pre_tokenizers

    whole, _, _ = _tokenizer(path)
    tokenizer = Tokenizer(whole.model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    last = np.zeros(whole.get_vocab_size(), bool)
    last[[k for t, k in whole.get_vocab(with_added_tokens=False).items() if t.endswith(whole.model.end_of_word_suffix)]] = True
    return tokenizer, last


def _encode_words(tokenizer, special: dict[str, int], words: list[str]) -> Iterator[bytes]:
    """Ids of each word: many in one call, a special token between them; words that hold one go alone."""
    between, cut = next(iter(special.items()), (None, None))
    alone = [between is None or any(s in w for s in special) for w in words]
    joined = "".join(w + between for w, one in zip(words, alone, strict=True) if not one)
    ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
    raw, at = ids.tobytes(), 0
    ends = iter((4 * np.flatnonzero(ids == cut)).tolist())
    for w, one in zip(words, alone, strict=True):
        if one:
            yield np.array(tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
        else:
            end = next(ends)
            yield raw[at:end]
            at = end + 4


#: ASCII punctuation at the end of a word, which the vocabulary takes apart from the letter or digit before it.
#: Begins with the punctuation itself, which is quickly found; the letter before it is looked at then.
_TAIL = re.compile(rb"[^a-z0-9\s\x80-\xff](?<=[a-z0-9].)[^a-z0-9\s\x80-\xff]*(?=\s|\Z)", re.DOTALL)
#: Words of the letters a-z, ß-ö and ø-ÿ, in UTF-8: the normalizer leaves them alone, the pre-tokenizer does not cut them.
_PLAIN = r"^(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+$"


def _split(text: bytes) -> bytes:
    """The text as words between white space whose ids are those of the text: lower case, punctuation after a word apart.
    Near special tokens nothing is changed."""
    return text if b"<|" in text else _TAIL.sub(rb" \g<0>", text.lower())


def _encode_plain(path: str, words: pa.Array) -> pa.Array:
    """Ids of each word, all of them plain, in one call."""
    tokenizer, last = _plain_tokenizer(path)
    text = b" ".join(_slices(words)).decode()
    ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
    ends = np.concatenate([[0], 4 * np.flatnonzero(last[ids]) + 4]).astype("<i8")
    return pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(ids)])


def _encode_distinct(path: str, words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The words, plain ones first, and the ids of each."""
    tokenizer, special, _ = _tokenizer(path)
    is_plain = pc.match_substring_regex(words, _PLAIN)
    plain, other = words.filter(is_plain), words.filter(pc.invert(is_plain))
    ids = [_encode_plain(path, plain.slice(k, PLAIN_CALL)) for k in range(0, len(plain), PLAIN_CALL)]
    for k in range(0, len(other), CALL):
        part = [w.decode("utf-8", "replace") for w in _slices(other.slice(k, CALL))]
        ids.append(pa.array(_encode_words(tokenizer, special, part), pa.large_binary()))
    return pa.concat_arrays([plain, other]), pa.concat_arrays([_NOTHING, *ids])


def _word_ids(path: str, words: pa.Array) -> pa.Array:
    """Ids of each word of an array without repeats.

    Words met before are kept. When they get too many, those not met again
    since the last time go, so common words stay.
    """
    kept = _tokenizer(path)[2]
    at = pc.index_in(words, value_set=kept.words)
    kept.again[at.drop_null().to_numpy()] = True
    new, new_ids = _encode_distinct(path, words.filter(at.is_null()))
    place = pc.coalesce(at, pc.add(pc.index_in(words, value_set=new), len(kept.words)))
    found = pa.concat_arrays([kept.ids, new_ids]).take(place)
    short = pc.less_equal(pc.binary_length(new), WORD_BYTES)
    kept.add(new.filter(short), new_ids.filter(short))
    return found


def encode(path: str, docs: list[bytes]) -> list[bytes]:
    """Token ids of each text as little-endian unsigned 32-bit integers.

    The vocabulary lower-cases, and its pre-tokenizer never joins across
    white space nor letters with punctuation. So the ids of a text are
    those of its words in order, and a word's ids are looked up once per
    call rather than once per use.
    """
    split = pc.ascii_split_whitespace(pa.array(map(_split, docs), pa.large_binary()).view(pa.large_string()))
    coded = split.flatten().dictionary_encode()
    if not len(coded):
        return [b""] * len(docs)
    ids = _word_ids(path, coded.dictionary.view(pa.large_binary())).take(coded.indices)
    _, at, raw = ids.buffers()
    raw = memoryview(raw or b"")
    ends = np.frombuffer(at, "<i8", len(ids) + 1)[split.offsets.to_numpy()].tolist()
    return [bytes(raw[a:b]) for a, b in pairwise(ends)]


def _cut(batches: Iterator[pa.RecordBatch], path: str, size: int) -> Iterator[pa.RecordBatch]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    for b in batches:
        ids, all_texts = b.column("doc_id").to_pylist(), texts(b.column("text"))
        rows: list[tuple] = []
        for doc, found in zip(ids, encode(path, all_texts), strict=True):
            found += b"\0\0\0\0"
            for k, start in enumerate(range(0, len(found), 4 * size)):
                piece = found[start:start + 4 * size]
                rows.append((doc, k, start // 4, len(piece) // 4, zlib.crc32(piece)))
        yield batch(_PIECES, list(zip(*rows, strict=True)))


def cut(docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE) -> DataFrame:
    """The pieces of every whole text: its ids, then id 0, cut only beyond ``size`` tokens. Null text is empty."""
    run = partial(_cut, path=tokenizer or default_tokenizer(), size=size)
    return map_arrow(columns(docs, doc_id="long", text="string"), run, PIECES)


def sweep(runs: list[tuple[int, int]], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over runs (length, documents): (length, lo, hi, first, per, at).

    The documents ranked lo..hi-1 of that length go ``per`` to a sequence,
    from sequence ``first`` on, the first of each at offset ``at``.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, number)
    sizes: list[int] = []
    out: list[tuple[int, int, int, int, int, int]] = []
    opened = 0

    def add(gap: int, first: int, number: int) -> None:
        if gap and number:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((first, number))

    for length, n in sorted(runs, reverse=True):
        done = 0
        while done < n:
            k = bisect.bisect_left(sizes, length)
            if k < len(sizes):
                gap = sizes[k]
                first, number = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[k]
            else:
                gap, first, number = size, opened, -(-(n - done) // (size // length))
                opened += number
            per = gap // length
            full, rest = divmod(min(n - done, number * per), per)
            if full:
                out.append((length, done, done + full * per, first, per, size - gap))
                add(gap - per * length, first, full)
            if rest:
                out.append((length, done + full * per, done + full * per + rest, first + full, rest, size - gap))
                add(gap - rest * length, first + full, 1)
            used = full + bool(rest)
            add(gap, first + used, number - used)
            done += full * per + rest
    return out


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Give each row of ``pieces`` (1 <= length <= size) a sequence_id and an offset, gapless from 0.

    Rows that are equal in every column are interchangeable; ties need no
    order. An empty table stays empty.
    """
    salts = max(SALTS, -(-pieces.count() // SALT_ROWS))
    key = [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    dealt = pieces.select(*pieces.columns, F.pmod(F.xxhash64(*key), F.lit(salts)).cast("int").alias("salt"))
    runs = materialise(dealt.groupBy("length", "salt").agg(F.count("*").alias("n")), "pack-runs")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("begin", F.coalesce(F.sum("n").over(before), F.lit(0)))
    lengths = [(r["length"], r["n"]) for r in runs.groupBy("length").agg(F.sum("n").alias("n")).collect()]  # at most ``size`` rows
    plan = F.broadcast(pieces.sparkSession.createDataFrame(sweep(lengths, size), _PLAN))
    # the part of the plan that a salt's ranks need, in ranks of that salt
    cells = runs.join(plan, "length").filter("lo < begin + n AND hi > begin").select(
        "length", "salt", (F.greatest("lo", "begin") - F.col("begin")).alias("lo"), (F.least(F.col("hi"), F.col("begin") + F.col("n")) - F.col("begin")).alias("hi"),
        "first", "per", "at", F.greatest(F.lit(0), F.col("begin") - F.col("lo")).alias("skip"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = dealt.withColumn("rank", F.row_number().over(order).cast("long") - 1)
    placed = ranked.join(cells, ["length", "salt"]).filter("rank >= lo AND rank < hi")
    nth = F.col("rank") - F.col("lo") + F.col("skip")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.expr("(rank - lo + skip) div per")).cast("long").alias("sequence_id"),
        (F.col("at") + (nth % F.col("per")) * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE) -> DataFrame:
    """Tokenise, cut and pack every row of ``docs``: one row per piece.

    Null and empty texts are the single id 0. Repeated rows are packed as
    often as they occur. Rows without an id are packed, their doc_id null.
    """
    with small_batches(docs.sparkSession):
        pieces = materialise(cut(docs, tokenizer, size), "pack-pieces")
    return pack(pieces, size)
