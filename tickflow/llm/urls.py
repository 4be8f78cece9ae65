"""URL filter: domain rules first, then a weighted vocabulary.

A rule (host suffix and path prefix) that fits decides; the longest wins.
Every other URL is read by an Aho-Corasick automaton over the terms of a
vocabulary, each with a weight. A hit counts only between boundaries (no
letter or digit of any script next to it), each term once. A URL is blocked
when its distinct hits weigh THRESHOLD: strict terms weigh that alone, of
soft terms several are needed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import batch, columns, map_arrow


@dataclass(frozen=True)
class Rule:
    text: str  # host and path prefix: ``example.com/en/``
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        host, slash, rest = self.text.partition("/")
        return slash + rest


RULES = (Rule("com/", "allow"), Rule("example.com/en/", "block"), Rule("www.example.com/en/", "allow"),
         Rule("net/es/", "block"), Rule("net/fr/", "block"))

#: Weight from which a URL is blocked, and of a soft term.
THRESHOLD, SOFT_WEIGHT = 100, 50
# A small default vocabulary. Terms that block alone:
STRICT = ("spam", "spam-farm", "cheap-pills", "porn", "xxx", "hentai", "escort", "escorts", "viagra", "cialis", "casino", "warez",
          "malware", "phishing", "payday-loans")
# Terms of which two different ones block:
SOFT = ("adult", "bet", "betting", "bonus", "cheap", "crack", "dating", "discount", "download", "farm", "free", "gambling", "keygen",
        "loan", "loans", "lottery", "nude", "pharmacy", "pills", "poker", "sex", "sexy", "slots", "torrent", "win")
VOCABULARY = tuple((t, THRESHOLD) for t in STRICT) + tuple((t, SOFT_WEIGHT) for t in SOFT)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def _fits(rule: Rule) -> Column:
    host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
    return host & F.col("path").startswith(rule.path)


def _boundary(text: str, at: int) -> bool:
    return not (0 <= at < len(text) and text[at].isalnum())


def _hits(terms: list[str]):
    """Places of the distinct ``terms`` that a string holds between boundaries."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for k, term in enumerate(terms):
        automaton.add_word(term, (k, len(term)))
    automaton.make_automaton()
    return lambda text: {k for end, (k, n) in automaton.iter(text) if _boundary(text, end + 1) and _boundary(text, end - n)}


def _judge(vocabulary: list[tuple[str, int]], threshold: int):
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("by_rule", pa.string()),
                        ("strict_hits", pa.int32()), ("soft_hits", pa.int32()), ("weight", pa.int64())])
    weights = [w for _, w in vocabulary]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = _hits([t for t, _ in vocabulary]) if vocabulary else lambda text: set()
        for b in batches:
            found = [[weights[k] for k in hits((u or "").lower())] for u in b.column("url").to_pylist()]
            strict = [sum(w >= threshold for w in f) for f in found]
            yield batch(schema, [*(b.column(c) for c in schema.names[:5]), strict, [len(f) - n for f, n in zip(found, strict, strict=True)], [sum(f) for f in found]])

    return run


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, vocabulary: DataFrame | tuple[tuple[str, int], ...] = VOCABULARY,
          threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, strict_hits, soft_hits.

    ``rule`` is the longest rule that fits, null if none does; then the
    vocabulary decides over the whole URL, lower-cased. ``vocabulary`` has
    terms and whole-number weights, or is a table (term, weight); every
    worker holds it, so it must be a word list, not a corpus. Terms are
    lower-cased; of a term that repeats the greatest weight counts, null and
    empty terms and terms without a weight are left out. Strict hits are
    those of at least ``threshold``. A null or empty URL has no host, no rule
    and no hit, and is allowed. Rows that repeat are judged alike; an empty
    table gives no rows.
    """
    rows = columns(pages, page_id="long", url="string").select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    first = [(_fits(r), r) for r in sorted(rules, key=lambda r: (-len(r.text), r.text))]
    pick = lambda value: F.coalesce(*[F.when(fits, F.lit(value(r))) for fits, r in first], F.lit(None).cast("string"))
    rows = rows.withColumn("rule", pick(lambda r: r.text)).withColumn("by_rule", pick(lambda r: r.verdict))
    if isinstance(vocabulary, DataFrame):
        vocabulary = tuple(map(tuple, columns(vocabulary, term="string", weight="long").collect()))
    terms: dict[str, int] = {}
    for t, w in vocabulary:
        if t and w is not None:
            terms[t.lower()] = max(w, terms.get(t.lower(), w))
    rows = map_arrow(rows, _judge(sorted(terms.items()), threshold),
                     "page_id long, host string, path string, rule string, by_rule string, strict_hits int, soft_hits int, weight long")
    method = F.when(F.col("weight") >= threshold, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), "strict_hits", "soft_hits")


def judge_sql() -> str:
    """DuckDB SQL for ``judge`` with its defaults, over ``pages``."""
    def hits(terms: tuple[str, ...]) -> str:
        return " + ".join(f"(regexp_matches(low, '(^|[^\\p{{L}}\\p{{N}}]){t}([^\\p{{L}}\\p{{N}}]|$)'))::INTEGER" for t in terms)

    ordered = sorted(RULES, key=lambda r: (-len(r.text), r.text))

    def case(value) -> str:
        return "CASE " + " ".join(f"WHEN (host = '{r.host}' OR suffix(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{value(r)}'"
                                  for r in ordered) + " END"

    return f"""
        WITH u AS (SELECT page_id, lower(coalesce(url, '')) AS low,
                          translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{_UPPER}', '{_LOWER}') AS host,
                          regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
             h AS (SELECT page_id, host, path, {case(lambda r: r.text)} AS rule, {case(lambda r: r.verdict)} AS by_rule,
                          {hits(STRICT)} AS strict_hits, {hits(SOFT)} AS soft_hits FROM u)
        SELECT page_id, host, path, rule,
               coalesce(by_rule, CASE WHEN strict_hits * {THRESHOLD} + soft_hits * {SOFT_WEIGHT} >= {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict,
               strict_hits, soft_hits FROM h
    """
