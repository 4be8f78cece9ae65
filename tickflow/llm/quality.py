"""Quality classifier: supervised subword embeddings.

A text is the average of learned vectors for its hashed features: words,
pairs of neighbouring words (a word after itself is one feature of its
own) and character n-grams (3 to 5 bytes). A softmax over two classes is
trained with it by stochastic gradient descent in numpy, on a bounded
sample of labelled rows. Averaging and the output layer are both linear,
so scoring needs one number per feature: its vector times the output
weights. Every whole text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import batch, columns, id_remainder, map_arrow, texts

FOLDS, HELD_OUT = 5, 0
#: Labelled rows to learn from, about; texts are whole.
SAMPLE = 1600
BITS = 16
WIDTH, EPOCHS, RATE, VECTOR_RATE = 8, 5, 1.0, 30.0
ORDERS = (3, 4, 5)
THRESHOLD = 0.3
#: Bytes of text whose features are in memory at once.
STRIDE = 1 << 20


@dataclass
class Model:
    per_feature: np.ndarray
    bias: float


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def features(text: bytes) -> Iterator[np.ndarray]:
    """All feature buckets of a whole text, a stretch at a time."""
    words = text.split()
    if words:
        h = np.fromiter(map(xxhash.xxh32_intdigest, words), np.uint32, len(words))
        yield _bucket(h)
        yield _bucket(np.where(h[1:] == h[:-1], np.uint32(1), h[1:] * np.uint32(0x85EBCA6B) ^ h[:-1]))
    most = max(ORDERS)
    for at in range(0, len(text), STRIDE):
        b = np.frombuffer(text[at:at + STRIDE + most - 1], np.uint8).astype(np.uint32)
        h = np.zeros(len(b), np.uint32)
        for n in range(1, most + 1):
            if len(b) < n:
                break
            h = (h[:len(b) - n + 1] * np.uint32(0x01000193)) ^ (b[n - 1:] + np.uint32(n))
            if n in ORDERS:
                yield _bucket(h[:STRIDE])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of each text as (bucket, share) pairs: at most one per bucket, whatever the length."""
    schema = pa.schema([("doc_id", pa.int64()), ("quality", pa.int64()), ("buckets", pa.binary()), ("shares", pa.binary())])
    for b in batches:
        buckets, shares = [], []
        for t in texts(b.column("text")):
            n = np.zeros(1 << BITS, np.int64)
            for f in features(t):
                n += np.bincount(f, minlength=1 << BITS)
            u = np.flatnonzero(n)
            buckets.append(u.astype(np.uint16).tobytes())
            shares.append((n[u] / max(1, n.sum())).astype(np.float32).tobytes())
        yield batch(schema, [b.column("doc_id"), b.column("quality"), buckets, shares])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from about SAMPLE labelled rows outside the held-out fold, chosen by hash of the id.

    Labels other than 0 and 1 and rows of ``labels`` without an id are left
    out; an id with several labels counts once for each distinct one. No
    labelled row at all gives a model that scores 0.5.
    """
    known = columns(labels, doc_id="long", quality="long").filter(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT)).distinct()
    total = known.count()
    if not total:
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30)) < F.lit(min(1.0, SAMPLE / total) * (1 << 30)))
    rows = columns(docs, doc_id="long", text="string").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
    got = map_arrow(rows, _counted, "doc_id long, quality long, buckets binary, shares binary").toPandas()
    got = got.sort_values(["doc_id", "quality", "buckets"], kind="stable")
    x = [(np.frombuffer(u, np.uint16), np.frombuffer(s, np.float32)) for u, s in zip(got["buckets"], got["shares"], strict=True)]
    return _descend(x, got["quality"].to_numpy())


def _descend(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> Model:
    rng = np.random.default_rng(0)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BITS, WIDTH)).astype(np.float32)
    out, bias = np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32)
    steps, done = EPOCHS * len(x), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(x)):
            u, share = x[k]
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            mean = share @ vectors[u]
            z = mean @ out + bias
            miss = np.exp(z - z.max())
            miss /= miss.sum()
            miss[y[k]] -= 1
            back = out @ miss
            out -= rate * np.outer(mean, miss)
            bias -= np.float32(0.01) * rate * miss
            vectors[u] -= rate * np.float32(VECTOR_RATE) * share[:, None] * back
    return Model(vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]))


def _score(model: Model):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = []
            for t in texts(b.column("text")):
                total, n = 0.0, 0
                for f in features(t):
                    total += float(model.per_feature[f].sum(dtype=np.float64))
                    n += len(f)
                scores.append(1 / (1 + np.exp(-np.clip(total / max(1, n) + model.bias, -50, 50))))
            yield batch(schema, [b.column("doc_id"), scores])

    return run


def score(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 from THRESHOLD on).

    Null text counts as empty; a text without features scores by the bias
    alone. doc_id, lang and source are no inputs: equal texts score alike.
    A null id counts as the empty string for the fold. An empty table gives
    no rows.
    """
    out = map_arrow(columns(docs, doc_id="long", text="string"), _score(model or fit(docs, labels)), "doc_id long, score double")
    return out.select("doc_id", (id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
