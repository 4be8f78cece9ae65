from collections import Counter

import pytest

import corpus_pipeline
from tickflow.llm.langid import LEAST_SCORE, identify
from tickflow.llm.ngram_join import keep_one

from test_exact_dedup import lower
from test_ngram_join import brute as similar
from test_ngram_join import corpus

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, own string"


@pytest.fixture(scope="module")
def docs(spark):
    base = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").limit(60).collect()]
    extra = [(5000 + i, t, "en", "src1", None) for i, t, *_ in corpus(8, 15)]
    odd = [(9000, None, "en", "src1", 0), (9001, "123 ...", "en", None, 0), (9002, base[0][1].upper(), "fr", None, 0), (9002, base[0][1].upper(), "fr", None, 0),
           (None, "no id here but words enough", "en", "src2", 0)]
    return spark.createDataFrame([(*r, "x") for r in base + extra + odd], SCHEMA)


def test_stages_against_brute_force(spark, docs, tmp_path):
    names = [name for name, _ in corpus_pipeline.STAGES]
    now, tables = docs, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, "")
        if k < len(names) - 1:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        before = [tuple(r) for r in now.collect()]
        now = spark.read.parquet(str(tmp_path / str(k)))
        tables[k] = (before, [tuple(r) for r in now.collect()])
    # language: the verdict of the operator itself, row by row
    good = Counter((r.doc_id, r.lang_pred) for r in identify(docs).collect() if r.score >= LEAST_SCORE)
    assert Counter(r[0] for r in tables[0][1]) == sum((Counter({i: n}) for (i, _), n in good.items()), Counter())
    # exact: the largest id of each text, once
    before, after = tables[1]
    keep = {}
    for r in before:
        keep[lower(r[1])] = max(keep.get(lower(r[1]), -1), -1 if r[0] is None else r[0])
    assert Counter(lower(r[1]) for r in after) == Counter(list(keep)) and all((-1 if r[0] is None else r[0]) == keep[lower(r[1])] for r in after)
    # near: the smallest id of each component
    before, after = tables[2]
    rows = [r for r in before if r[0] is not None]
    want = {i for i, _, label in similar(rows, 5, 80) if i == label}
    assert {r[0] for r in after} - {None} == want and len(after) == len(want) + sum(r[0] is None for r in before)
    # mixing: all of them, at most twice
    before, after = tables[3]
    uses = Counter(after)
    assert set(uses) == set(before) and set(uses.values()) <= {1, 2}
    # packing: every token once
    before, after = tables[4]
    assert Counter(r[0] for r in after if r[1] == 0) == Counter(r[0] for r in before)


def test_repeated_ids_go_row_by_row(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text + " a", "", "", 0, ""), (2, text + " b", "", "", 0, ""), (2, "quite another text of more than five words", "", "", 0, ""),
            (2, "quite another text of more than five words", "", "", 0, ""), (3, "", "", "", 0, ""), (None, text, "", "", 0, "")]
    got = keep_one(spark.createDataFrame(rows, SCHEMA))
    assert sorted(((r.doc_id, r.text[:5]) for r in got.collect()), key=repr) == sorted([(1, "w0 w1"), (2, "quite"), (3, ""), (None, "w0 w1")], key=repr)


def test_run_equals_the_stages_and_takes_empty_tables(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 0
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("stage", [corpus_pipeline.language_id, corpus_pipeline.exact_duplicates])
def test_stages_get_texts_in_small_batches(spark, docs, stage):
    from tickflow.llm.common import ROWS

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "10000")
    try:
        stage(spark, docs, "")
        assert int(spark.conf.get(name)) == ROWS
    finally:
        spark.conf.set(name, before)
