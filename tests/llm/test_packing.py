import bisect
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickflow.llm.packing import cut, default_tokenizer, encode, pack, pack_documents, sweep

SCHEMA = "doc_id long, text string, piece int, grp string"
WHOLE = Tokenizer.from_file(default_tokenizer())


def best_fit(lengths, size):
    gaps, n = [], 0
    for x in sorted(lengths, reverse=True):
        k = bisect.bisect_left(gaps, x)
        gap = gaps.pop(k) if k < len(gaps) else size
        n += gap == size
        bisect.insort(gaps, gap - x)
    return n


@given(st.lists(st.integers(1, 40), max_size=120))
@settings(max_examples=60, deadline=None)
def test_sweep_uses_as_many_sequences_as_best_fit_decreasing(lengths):
    runs = {}
    for x in lengths:
        runs[x] = runs.get(x, 0) + 1
    fill = {}
    for length, lo, hi, first, per, at in sweep(list(runs.items()), 40):
        for r in range(hi - lo):
            fill.setdefault(first + r // per, []).append((at + r % per * length, length))
    for places in fill.values():
        places.sort()
        assert [a for a, _ in places] == [sum(x for _, x in places[:k]) for k in range(len(places))]
        assert sum(x for _, x in places) <= 40
    assert sum(map(len, fill.values())) == len(lengths)
    assert len(fill) == best_fit(lengths, 40)


def test_word_by_word_ids_equal_those_of_the_whole_text():
    tok = Tokenizer.from_file(default_tokenizer())
    odd = ["", "  ", "It's we'll\x85now\xa0then x \x1fy", "a <|endoftext|> b<|startoftext|>c", "é ́e İΣς ǅ", "12345 ½ ☃☃ 你好 end.",
           "tab\tline\nfeed\x0b\x0c\r ", "'s 'T", "nul\x00byte", "x" * 5000, "﻿bom ​zero"]
    got = encode(default_tokenizer(), [t.encode() for t in odd])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [e.ids for e in tok.encode_batch(odd, add_special_tokens=False)]


@given(st.text(st.sampled_from(list("aAbZ'sTtreLL09 .,!?<|>_-$\t\n\x0b\x1c\x85\xa0éÉ\u0301\u0307Iİßſ的K½²")), max_size=40), st.integers(0, 40),
       st.sampled_from(["", "<|endoftext|>", "<|ENDOFTEXT|>"]))
@settings(max_examples=500, deadline=None)
def test_ids_of_any_text_equal_those_of_the_whole_text(text, at, special):
    text = text[:at] + special + text[at:]
    got = encode(default_tokenizer(), [text.encode()])[0]
    assert np.frombuffer(got, "<u4").tolist() == WHOLE.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("salt_rows", [100_000, 3])
def test_pack_is_a_gapless_round_trip(spark, salt_rows, monkeypatch):
    import tickflow.llm.packing as packing

    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("the of and to in was word more".split()) for _ in range(rng.randint(0, 90))), 0, "g") for k in range(240)]
    rows += [(1000 + k, "same text here", 0, "g") for k in range(120)] + [(None, None, 0, None), (None, "", 0, None), (7, "again", 1, None), (7, "again", 1, None)]
    rows += [(2000, "long " * 1000, 0, "g")]
    monkeypatch.setattr(packing, "SALT_ROWS", salt_rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3 if salt_rows == 3 else 1)
    got = pack_documents(docs, size=64).toPandas()
    tok = Tokenizer.from_file(default_tokenizer())
    want = []
    for i, t, *_ in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for p, s in enumerate(range(0, len(ids), 64)):
            part = ids[s:s + 64]
            want.append((i, p, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    have = [tuple(None if x != x else int(x) for x in r) for r in got[cols].itertuples(index=False)]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part["offset"].tolist() == [0, *part["length"].cumsum().tolist()[:-1]] and part["length"].sum() <= 64
    assert got["sequence_id"].nunique() == best_fit([w[3] for w in want], 64)


def test_whole_table_packs_as_best_fit_decreasing(spark):
    pieces = cut(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).persist()
    assert pack(pieces).select("sequence_id").distinct().count() == best_fit([r.length for r in pieces.select("length").collect()], 2048)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pack_documents(empty).count() == 0
    assert pack(cut(empty)).count() == 0


def test_words_kept_are_few_and_short_and_the_common_ones(monkeypatch):
    import tickflow.llm.packing as packing

    monkeypatch.setattr(packing, "WORD_CACHE", 500)
    path = default_tokenizer()
    packing._tokenizer.cache_clear()
    letters = "abcdefghijklmnopqrstuvwxyz"
    rare = iter(a + b + c + d for a in letters for b in letters for c in letters for d in "äöxyz")
    for _ in range(30):
        docs = [("common Word " + " ".join(next(rare) for _ in range(9)) + " and " + next(rare) * 5000 + ".").encode() for _ in range(10)]
        got = encode(path, docs)
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [e.ids for e in WHOLE.encode_batch([d.decode() for d in docs], add_special_tokens=False)]
    kept = packing._tokenizer(path)[2]
    assert {b"common", b"word", b"and"} <= set(kept.words.to_pylist())
    assert len(kept.words) == len(kept.ids) == len(kept.again) <= 500
    assert kept.words.nbytes + kept.ids.nbytes < 50_000
    packing._tokenizer.cache_clear()


def test_texts_reach_the_tokenizer_in_small_batches(spark, monkeypatch):
    import pyarrow as pa

    import tickflow.llm.packing as packing
    from tickflow.llm.common import ROWS

    def sizes(docs, tokenizer=None, size=0):
        return docs.select("doc_id").mapInArrow(
            lambda batches: (pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())}) for b in batches), "n long")

    seen = []
    monkeypatch.setattr(packing, "cut", sizes)
    monkeypatch.setattr(packing, "pack", lambda pieces, size: seen.extend(r.n for r in pieces.collect()))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    pack_documents(spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "'a' AS text"))
    assert sum(seen) == 3000 and max(seen) <= ROWS
    assert spark.conf.get(name) == before
