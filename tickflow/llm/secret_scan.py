"""Secrets in texts: fixed patterns, and runs that look random to a pair of character Markov models.

Two first-order Markov models over the characters of keys and identifiers are
trained from labelled samples. Random: values that the patterns find in a
sample of documents, and strings drawn at random from the alphabets keys
are written in. Ordinary: all other runs of that sample, also as identifiers
are written (upper case, capitalised, two joined). A run that no pattern has
found is a secret when the log-likelihood ratio of the two models, summed
over its characters, is high enough.

Bigrams are counted by the executors; the driver gets at most one row per
label and pair of characters. The patterns and the models read whole texts.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import batch, columns, map_arrow, texts

# The patterns of the contract, in its order. Lengths are checked after matching.
_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
KINDS = ("assign", "access", "hex", "markov")

_RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
_LETTER, _DIGIT_OR_UPPER = re.compile(r"[A-Za-z]"), re.compile(r"[0-9A-Z]")
#: Documents, about, that the models learn from, chosen by hash of the id.
SAMPLE = 1000
#: Runs of an ordinary text that are long enough to teach how identifiers look.
LEAST_TAUGHT = 3
#: Characters of a run that the models judge.
LEAST_RUN = 16
#: Numbers that identifiers of the ordinary samples are given are below this.
NUMBERS = 3000
#: Bits a run must be likelier under the random model, and bits per character.
LEAST_BITS, LEAST_BITS_EACH = 32.0, 2.0
#: Random strings, and the alphabets they are drawn from.
DRAWN, DRAWN_LETTERS = 4000, 40
ALPHABETS = (string.hexdigits[:16], string.digits + "ABCDEF", string.ascii_letters + string.digits, string.ascii_uppercase + string.digits,
             string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "-_")
#: Weight of a character in any place before anything is counted.
SMOOTHING = 0.5

_CHARS = string.ascii_letters + string.digits + "+/_=-"
_CODE = np.full(128, len(_CHARS), np.intp)  # a blank: no character
_CODE[[ord(c) for c in _CHARS]] = np.arange(len(_CHARS))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, in order; code points, end exclusive, kind a place in KINDS."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]
    return sorted(found)


def _outside(text: str, spans: list[tuple[int, int, int]], least: int) -> Iterator[re.Match]:
    """Runs of at least ``least`` characters that no span touches."""
    at, reach = 0, 0  # the furthest end of the spans before ``at``
    for m in _RUN.finditer(text):
        if m.end() - m.start() < least:
            continue
        while at < len(spans) and spans[at][0] < m.end():
            reach, at = max(reach, spans[at][2]), at + 1
        if reach <= m.start():
            yield m


def pairs(runs: Iterable[str]) -> np.ndarray:
    """Counts of neighbouring characters in ``runs``: rows are the first of two (the last row: none before), columns the second."""
    n = len(_CHARS)
    code = _CODE[np.frombuffer((" " + " ".join(runs)).encode(), np.uint8)]
    before, after = code[:-1], code[1:]
    inside = after < n
    return np.bincount(before[inside] * n + after[inside], minlength=(n + 1) * n).reshape(n + 1, n)


def identifiers(words: list[str]) -> Iterator[str]:
    """The words as identifiers are written: in other cases, numbered, joined with the word before."""
    last = "x"
    for w in words:
        number = str(zlib.crc32(w.encode()) % NUMBERS)
        joined = f"{w}_{last}"
        yield from (w, w.lower(), w.upper(), w.capitalize(), w + last.capitalize(), joined, f"{w}-{last}", f"{w}/{last}", joined.upper(),
                    w + number + last.capitalize(), f"{w}_{number}_{last}", f"{number}-{number}")
        last = w if w.isalpha() else last


def labelled(text: str) -> tuple[np.ndarray, np.ndarray]:
    """``pairs`` of a text's ordinary runs (each once, as identifiers) and of the secrets that the patterns find."""
    spans = base_spans(text)
    words = list(dict.fromkeys(m.group() for m in _outside(text, spans, LEAST_TAUGHT)))
    values = (_ASSIGN.match(text, start).group(2) if kind == 0 else text[start:end] for start, kind, end in spans)
    keys = [m.group() for v in values if _LETTER.search(v) for m in _RUN.finditer(v)]  # a number alone is no key
    return pairs(identifiers(words)), pairs(keys)


_COUNTS = pa.schema([("secret", pa.bool_()), ("pair", pa.int32()), ("n", pa.int64())])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ordinary, secret = pairs([]), pairs([])
    for b in batches:
        for t in texts(b.column("text")):
            more = labelled(t.decode("utf-8", "replace"))
            ordinary, secret = ordinary + more[0], secret + more[1]
    for label, mine in enumerate((ordinary.ravel(), secret.ravel())):
        at = np.flatnonzero(mine)
        if len(at):
            yield batch(_COUNTS, [[bool(label)] * len(at), at.tolist(), mine[at].tolist()])


def drawn(seed: int = 0) -> np.ndarray:
    """``pairs`` of random strings: labelled by the way they are made."""
    rng = random.Random(seed)
    return pairs("".join(rng.choices(ALPHABETS[k % len(ALPHABETS)], k=DRAWN_LETTERS)) for k in range(DRAWN))


class Ratio:
    """Bits by which a run is likelier under the random model than under the ordinary one."""

    def __init__(self, ordinary: np.ndarray, secret: np.ndarray):
        logs = [np.log2((x + SMOOTHING) / (x + SMOOTHING).sum(1, keepdims=True)) for x in (secret, ordinary)]
        self.bits_of = logs[0] - logs[1]

    def bits(self, run: str) -> float:
        code = _CODE[np.frombuffer((" " + run).encode(), np.uint8)]
        return float(self.bits_of[code[:-1], code[1:]].sum())

    def secret(self, run: str) -> bool:
        """Runs of one case and no digit are words, runs without a letter numbers or rules."""
        if not (_LETTER.search(run) and _DIGIT_OR_UPPER.search(run)):
            return False
        return self.bits(run) >= max(LEAST_BITS, LEAST_BITS_EACH * len(run))


def train(docs: DataFrame) -> Ratio:
    """Models from about SAMPLE rows of ``docs`` (doc_id, text), whole texts; without any, nothing looks random."""
    rows = columns(docs, doc_id="long", text="string").filter("text IS NOT NULL")
    rate = min(1.0, SAMPLE / max(1, rows.count()))
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("secrets")), F.lit(1 << 30)) < int(rate * (1 << 30)))
    got = map_arrow(chosen.select("text"), _counted, "secret boolean, pair int, n long").groupBy("secret", "pair").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((2, (len(_CHARS) + 1) * len(_CHARS)))
    for r in got:
        counts[int(r["secret"]), r["pair"]] = r["n"]
    ordinary, secret = counts.reshape(2, len(_CHARS) + 1, len(_CHARS))
    return Ratio(ordinary, secret + drawn()) if ordinary.any() else Ratio(ordinary, ordinary)


def spans_of(text: str, ratio: Ratio) -> tuple[list, list]:
    """Spans of the patterns, and all spans: those and the models'."""
    base = base_spans(text)
    more = [(m.start(), 3, m.end()) for m in _outside(text, base, LEAST_RUN) if ratio.secret(m.group())]
    return base, sorted(base + more)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("n_markov", pa.int64()),
                  ("base_sha256", pa.string()), ("spans", pa.string())])


def _scanned(ratio: Ratio, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for i, t in zip(b.column("doc_id").to_pylist(), texts(b.column("text")), strict=True):
            base, both = spans_of(t.decode("utf-8", "replace"), ratio)
            kinds = Counter(kind for _, kind, _ in both)
            shown = [",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in s) for s in (base, both)]
            rows.append((i, *(kinds[k] for k in range(4)), hashlib.sha256(shown[0].encode()).hexdigest(), shown[1]))
        if rows:
            yield batch(_OUT, [list(c) for c in zip(*rows, strict=True)])


def secret_spans(docs: DataFrame, ratio: Ratio | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans.

    ``spans`` lists kind:start:end of every span, in order of start, then
    kind as in KINDS; start and end count code points, end exclusive, and an
    assignment's span is its whole match. ``base_sha256`` is the hash of the
    same list without the models' spans. The models judge runs of at least
    LEAST_RUN characters that touch no span of a pattern. Null text counts as
    empty: no spans, the hash of the empty string. Repeated rows give a row
    each, a null id stays null, extra columns are ignored, an empty table
    gives no rows.
    """
    return map_arrow(columns(docs, doc_id="long", text="string"), partial(_scanned, ratio or train(docs)),
                     "doc_id long, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string")
