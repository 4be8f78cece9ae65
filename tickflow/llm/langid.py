"""Language ID by string kernels.

The blended-spectrum presence kernel of two texts counts the character
n-grams (1 to 3, hashed) that both contain, divided by the root of how many
each contains. Nyström landmarks turn it into a linear problem: one-versus-
rest kernel ridge regression is solved on a bounded, labelled sample, and
every whole text is scored by two matrix products per batch (presence x
landmarks, kernel x weights).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import batch, columns, id_remainder, map_arrow, texts

FOLDS, HELD_OUT = 4, 2
#: Labelled rows to learn from, about, spread evenly over the languages; texts are whole.
SAMPLE = 1600
LANDMARKS = 128
ORDERS = 3
BUCKETS = 1 << 14
RIDGE = 1e-3
SHARPNESS = 4.0
ROWS = 128
UNKNOWN = "und"
#: A document goes from the pipeline when no language reaches this score.
LEAST_SCORE = 0.3

_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # presence bits, packed
    weights: np.ndarray  # landmarks x languages, for kernel values


def grams(text: str, row: np.ndarray) -> None:
    """Mark the buckets of all n-grams of ``text`` in ``row``."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    h = np.zeros(len(c), np.uint32)
    for n in range(ORDERS):
        if len(c) <= n:
            return
        h = (h[:len(c) - n] * np.uint32(0x01000193)) ^ (c[n:] + np.uint32(n))
        row[(h * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14)] = 1


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("bits", pa.binary())])
    for b in batches:
        rows = np.zeros((b.num_rows, BUCKETS), np.uint8)
        for row, t in zip(rows, texts(b.column("text")), strict=True):
            grams(t.decode("utf-8", "replace"), row)
        yield batch(schema, [b.column("lang"), [x.tobytes() for x in np.packbits(rows, axis=1)]])


def _kernel(x: np.ndarray, z: np.ndarray) -> np.ndarray:
    size = lambda a: np.sqrt(np.maximum(a.sum(1), 1))
    return (x @ z.T) / size(x)[:, None] / size(z)[None, :]


def fit(docs: DataFrame) -> Model:
    """Learn from rows of ``docs`` (doc_id, text, lang) outside the held-out fold, lang not null, text with a letter.

    About SAMPLE of them, chosen by hash of the id at one rate per language,
    give presence bits on the executors; only those bits (2 KB a row) come
    to the driver. No such row: a model without languages.
    """
    rows = columns(docs, doc_id="long", text="string", lang="string").filter(
        (id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model([], np.zeros((0, BUCKETS // 8), np.uint8), np.zeros((0, 0), np.float32))
    rate = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, SAMPLE / len(counts) / n))])
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(1 << 30)) < rate[F.col("lang")] * F.lit(1 << 30))
    got = map_arrow(chosen.select("lang", "text"), _presence, "lang string, bits binary").toPandas()
    return _solve(got["lang"].tolist(), got["bits"].tolist())


def _solve(langs: list[str], bits: list[bytes]) -> Model:
    order = sorted(range(len(langs)), key=lambda k: (bits[k], langs[k]))  # as collected, rows come in any order
    langs, packed = [langs[k] for k in order], np.array([np.frombuffer(bits[k], np.uint8) for k in order], np.uint8)
    x = np.unpackbits(packed, axis=1).astype(np.float32)
    languages = sorted(set(langs))
    y = np.array([[1.0 if a == b else -1.0 for b in languages] for a in langs])
    rng = np.random.default_rng(0)
    own = {a: rng.permutation([k for k, b in enumerate(langs) if b == a]) for a in languages}
    share = max(1, LANDMARKS // len(languages))
    picked = np.sort(np.concatenate([own[a][:share] for a in languages]))
    z = x[picked]
    values, vectors = np.linalg.eigh(_kernel(z, z).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    phi = _kernel(x, z) @ root
    bias = np.hstack([phi, np.ones((len(phi), 1))])
    weight = np.array([1.0 / len(own[a]) for a in langs])[:, None]  # languages count alike
    w = np.linalg.solve(bias.T @ (weight * bias) + RIDGE * np.eye(bias.shape[1]), bias.T @ (weight * y))
    return Model(languages, packed[picked], np.vstack([root @ w[:-1], w[-1:]]).astype(np.float32))


def _predict(model: Model):
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = np.unpackbits(model.landmarks, axis=1).astype(np.float32)
        x = np.zeros((ROWS, BUCKETS), np.float32)
        for b in batches:
            names, scores = [], []
            all_texts = [t.decode("utf-8", "replace") for t in texts(b.column("text"))]
            for at in range(0, len(all_texts), ROWS):
                part = all_texts[at:at + ROWS]
                x.fill(0)
                for row, t in zip(x, part, strict=False):
                    grams(t, row)
                if model.languages:
                    f = _kernel(x[:len(part)], z) @ model.weights[:-1] + model.weights[-1]
                    p = np.exp(SHARPNESS * (f - f.max(1, keepdims=True)))
                    best, p = f.argmax(1), (p / p.sum(1, keepdims=True)).max(1)
                for k, t in enumerate(part):
                    known = bool(model.languages) and _LETTER.search(t) is not None
                    names.append(model.languages[best[k]] if known else UNKNOWN)
                    scores.append(float(p[k]) if known else 0.0)
            yield batch(schema, [b.column("doc_id"), names, scores])

    return run


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score (0 to 1).

    ``und`` with score 0 where text is null, empty or without a letter, or
    where no language could be learned. Equal texts get equal answers;
    doc_id, lang and source play no part in them. A null id counts as the
    empty string for the fold. An empty table gives no rows.
    """
    model = model or fit(docs)
    out = map_arrow(columns(docs, doc_id="long", text="string"), _predict(model), "doc_id long, lang_pred string, score double")
    return out.select("doc_id", (id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")


def _keep(model: Model):
    predict = _predict(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = pa.array([0] * b.num_rows, pa.int64())
            verdict = next(predict(iter([pa.RecordBatch.from_arrays([ids, b.column("text")], ["doc_id", "text"])])))
            good = [n != UNKNOWN and s >= LEAST_SCORE for n, s in zip(*(verdict.column(c).to_pylist() for c in ("lang_pred", "score")), strict=True)]
            yield b.filter(pa.array(good, pa.bool_()))

    return run


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, without rows whose language no score of LEAST_SCORE tells (among them texts without a letter)."""
    return map_arrow(docs, _keep(fit(docs)), docs.schema)
