import zlib

import numpy as np
import pytest

import tickflow.llm.langid as langid
from tickflow.llm.langid import fit, grams, identify, keep_identified

SCHEMA = "doc_id long, text string, lang string, score double"


def presence(text):
    out = set()
    t = text.lower()
    for n in (1, 2, 3):
        for k in range(len(t) - n + 1):
            h = 0
            for j, c in enumerate(t[k:k + n]):
                h = (h * 0x01000193 & 0xFFFFFFFF) ^ (ord(c) + j)
            out.add((h * 0x9E3779B1 & 0xFFFFFFFF) >> 18)
    return out


@pytest.mark.parametrize("text", ["", "a", "ab", "Über ßx", "的 x 😀y"])
def test_presence_equals_plain_loops(text):
    row = np.zeros(langid.BUCKETS, np.uint8)
    grams(text, row)
    assert set(np.flatnonzero(row)) == presence(text)


def test_held_out_accuracy_and_repeatability(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify(docs).toPandas().set_index("doc_id")
    lang = docs.select("doc_id", "lang").toPandas().set_index("doc_id")["lang"].reindex(got.index)
    assert len(got) == len(lang)
    assert all(got["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.index])
    assert (got["lang_pred"] == lang)[got["held_out"]].mean() >= 0.98
    assert got["score"].between(0, 1).all()
    again = identify(docs.repartition(5)).toPandas().set_index("doc_id").reindex(got.index)
    assert (again["lang_pred"] == got["lang_pred"]).all()


def test_labels_of_held_out_rows_and_other_columns_are_no_input(spark):
    rows = [(k, ("der die das und nicht " if k % 2 else "the and with this that ") * 3 + str(k), "de" if k % 2 else "en", 0.0) for k in range(80)]
    other = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, 1.0) for i, t, lang, _ in rows]
    a, b = (sorted(map(tuple, identify(spark.createDataFrame(r, SCHEMA)).collect())) for r in (rows, other))
    assert a == b and {x[2] for x in a} == {"de", "en"}


def test_nulls_empty_long_and_no_labels(spark):
    rows = [(k, "the and with this that words", "en", None) for k in range(20)] + [
        (100, None, "en", None), (101, "", None, None), (102, "123 !? ", "en", None), (None, "the and", None, None),
        (103, "the and with " * 60_000, None, None), (103, "the and", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {(r.doc_id, r.lang_pred) for r in identify(docs).collect()}
    assert {(100, "und"), (101, "und"), (102, "und"), (None, "en"), (103, "en")} <= got
    kept = keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == 23
    bare = spark.createDataFrame([(1, "words", None, None)], SCHEMA)
    assert [tuple(r)[2:] for r in identify(bare).collect()] == [("und", 0.0)]
    empty = spark.createDataFrame([], SCHEMA)
    assert identify(empty).count() == 0 and keep_identified(empty).count() == 0 and fit(empty).languages == []
