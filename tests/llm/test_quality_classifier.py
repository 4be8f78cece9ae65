import zlib

import numpy as np

import tickflow.llm.quality as quality
from tickflow.llm.quality import Model, features, score

SCHEMA, LABELS = "doc_id long, text string, score double, quality string", "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = score(docs, labels).toPandas().set_index("doc_id")
    assert len(got) == docs.count()
    assert all(got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.index])
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all()
    held = labels.toPandas().set_index("doc_id").join(got[got["held_out"]], how="inner")
    good, bad = held[held["quality"] == 1], held[held["quality"] == 0]
    assert (good["predicted"] == 1).mean() >= 0.98 and (bad["predicted"] == 0).mean() >= 0.95


def test_features_of_a_long_text_do_not_depend_on_the_stride(monkeypatch):
    text = ("some words words repeat ünd so weiter " * 40).encode()
    whole = np.sort(np.concatenate(list(features(text))))
    for stride in (7, 64, 1000):
        monkeypatch.setattr(quality, "STRIDE", stride)
        assert (np.sort(np.concatenate(list(features(text)))) == whole).all()
    words, n = text.split(), len(text)
    assert len(whole) == len(words) + len(words) - 1 + sum(n - k + 1 for k in (3, 4, 5))


def test_labels_of_the_held_out_fold_are_not_used(spark):
    rows = [(k, ("GOOD plain prose here " if k % 2 else "$$$ ### !!! ") * 5, None, None) for k in range(120)]
    truth = [(k, k % 2, 0) for k in range(120)]
    lies = [(k, q if zlib.crc32(str(k).encode()) % 5 else 1 - q, t) for k, q, t in truth]
    docs = spark.createDataFrame(rows, SCHEMA)
    a, b = (sorted(map(tuple, score(docs, spark.createDataFrame(x, LABELS)).collect())) for x in (truth, lies))
    assert a == b and [x[3] for x in a] == [k % 2 for k in range(120)]


def test_nulls_empty_long_repeated_and_empty_tables(spark):
    rows = [(k, ("fine words " if k % 2 else "### ") * 9, 0.5, "q") for k in range(40)] + [
        (100, None, None, None), (101, "", None, None), (None, "fine words", None, None), (102, "fine words " * 200_000, None, None),
        (103, "fine", None, None), (103, "fine", None, None)]
    labels = [(k, k % 2, None) for k in range(40)] + [(None, 1, 0), (7, None, 1), (8, 5, 0), (900, 0, 0)]
    docs, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    got = {r.doc_id: r.score for r in score(docs, marks).collect()}
    assert len(got) == 45 and got[100] == got[101] and got[102] > 0.5
    assert score(docs, spark.createDataFrame([], LABELS)).select("score").distinct().collect()[0][0] == 0.5
    assert score(spark.createDataFrame([], SCHEMA), marks).count() == 0


def test_score_is_the_softmax_of_the_mean_vector(spark):
    rng = np.random.default_rng(1)
    model = Model(rng.normal(size=1 << quality.BITS).astype(np.float32), 0.25)
    text = "Ünder a test, a test"
    f = np.concatenate(list(features(text.encode())))
    want = 1 / (1 + np.exp(-(model.per_feature[f].astype(float).mean() + 0.25)))
    docs = spark.createDataFrame([(1, text, 0.0, "")], SCHEMA)
    assert abs(score(docs, docs, model).first()["score"] - want) < 1e-9
