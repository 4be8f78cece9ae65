"""Licence scan: text segments against licence templates by Dice over word bigrams.

DataFrame functions only. A text is normalised (lower case, every run of
other than letters and digits a blank) and cut into segments: its lines,
its blocks of consecutive lines, and the whole. The Dice is that of the sets
of bigrams. A segment with a distinct bigrams can reach Dice t with a template
of b distinct ones only if b t / (2 - t) <= a. As a segment has at least as
many bigrams as distinct ones, that bounds its bigrams from below; from above,
a segment may have (2 - t) / t times the bigrams of the template, repeats
counted in both. Those bounds choose the templates that a segment is compared
to, and most segments meet none. Before that, a text must hold one of a few
words without which no template can be reached. Everything happens
within a row: nothing is exploded or shuffled, so no key can be hot.

``notices`` finds what shares its line with other text: it weighs every span
of words against every template, by the Dice of their sets of bigrams.
Trimming a span to the first and last bigram that it shares with the template
never lowers its Dice, so only those spans are made.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import columns

DICE = 0.8
LICENSES = "array<struct<license: string, dice: double, segment: string>>"

# Short notices and standard headers of common licences.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License, see the LICENSE file for details."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
                   "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
                   "KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
                "file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
            "are met:"),
    ("BSD", "Licensed under the BSD 3-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
            "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
            "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
            "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
            "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
            "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
            "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
            "THIS SOFTWARE."),
    *[(name, f"SPDX-License-Identifier: {name}") for name in (
        "MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "ISC", "CC0-1.0", "CC-BY-4.0", "Unlicense")],
)


def _words(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def _bigrams(text: str) -> list[str]:
    w = _words(text)
    return [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def _index(templates: tuple[tuple[str, str], ...], dice: float) -> list[tuple[str, list[str], int, float, float]]:
    """Licence, distinct bigrams, their number, least and most bigrams (repeats counted) of a segment that can match."""
    out = []
    for name, text in sorted(templates):
        grams = _bigrams(text)
        if grams:
            own = sorted(set(grams))
            out.append((name, own, len(own), len(own) * dice / (2 - dice), len(grams) * (2 - dice) / dice))
    return out


def _anchors(templates: tuple[tuple[str, str], ...], dice: float) -> list[str]:
    """Words of which every text with a match has one.

    Of a template with b distinct bigrams, k of them without such a word, a
    text without any can share k bigrams at most: a Dice of 2 k / (k + b).
    Words are added until that is below ``dice`` for all: those of six letters
    or more that many bigrams have, then short ones that few templates use.
    """
    often = Counter(w for _, t in templates for w in _words(t))
    left = [(set(zip(w, w[1:], strict=False)), len(set(zip(w, w[1:], strict=False)))) for w in (_words(t) for _, t in templates) if len(w) > 1]
    chosen: list[str] = []
    while True:
        left = [(grams, b) for grams, b in left if len(grams) * (2 - dice) >= dice * b - 1e-9]
        if not left:
            return sorted(chosen)
        counts = Counter(w for grams, _ in left for g in grams for w in set(g))
        best = min(counts, key=lambda w: (len(w) < 6, -counts[w] if len(w) >= 6 else often[w], -counts[w], w))
        chosen.append(best)
        left = [({g for g in grams if best not in g}, b) for grams, b in left]


def _may_match(text: Column, templates: tuple[tuple[str, str], ...], dice: float) -> Column:
    """Whether a text holds one of ``_anchors`` as a word: what has none is read no further."""
    words = "|".join(map(re.escape, _anchors(templates, dice)))
    return F.coalesce(F.lower(text).rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{words})(?![\p{{L}}\p{{N}}])"), F.lit(False))


def segments(text: Column) -> Column:
    """Distinct normalised lines, blocks and whole of a text; a line without letter or digit ends a block."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1),
                        lambda s: F.trim(F.regexp_replace(F.lower(s), r"[^\p{L}\p{N}]+", " ")))
    blocks = F.transform(F.split(F.array_join(lines, "\n"), "\n\n+", -1), lambda s: F.trim(F.translate(s, "\n", " ")))
    whole = F.array_join(F.filter(lines, lambda s: s != ""), " ")
    return F.array_distinct(F.concat(lines, blocks, F.array(whole)))


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, dice: float = DICE) -> DataFrame:
    """One row per row of ``docs``: doc_id, license, dice, segment, n_matches.

    ``license`` is that of the best match of any segment, null if none has
    a Dice of at least ``dice``: twice the distinct bigrams in common, by
    the distinct bigrams of both. A segment of more than (2 - dice) / dice
    times the bigrams of a template, repeats counted, is not one of its
    notices. Ties go to the licence, then to the segment, that
    sorts first. n_matches counts matching segments. Null and empty texts,
    and segments of one word, match nothing. Repeated rows are scanned
    alike; an empty table gives no rows.
    """
    index = _index(templates, dice)
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.array(*[F.lit(g) for g in grams]).alias("grams"), F.lit(n).alias("n"),
                               F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for name, grams, n, lo, hi in index])
    least, most = min(x[3] for x in index), max(x[4] for x in index)
    pairs_in = lambda s: F.length(s) - F.length(F.translate(s, " ", ""))  # noqa: E731  blanks of a normalised segment
    found = F.filter(segments(F.col("text")), lambda s: (s != "") & pairs_in(s).between(least, most))

    def grams_of(s: Column) -> Column:
        w = F.split(s, " ", -1)
        return F.array_distinct(F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b)))

    shown = F.transform(found, lambda s: F.struct(s.alias("s"), pairs_in(s).alias("n"), grams_of(s).alias("grams")))

    def best(s: Column) -> Column:
        fit = F.filter(table, lambda t: s["n"].between(t["lo"], t["hi"]))
        marks = F.transform(fit, lambda t: F.struct(
            (-(F.size(F.array_intersect(s["grams"], t["grams"])) * 2.0 / (F.size(s["grams"]) + t["n"]))).alias("less"), t["name"].alias("name"), s["s"].alias("s")))
        return F.array_min(marks)

    hits = F.filter(F.transform(shown, best), lambda m: m.isNotNull() & (m["less"] <= -dice))
    hits = F.coalesce(F.when(_may_match(F.col("text"), templates, dice), hits), F.array().cast("array<struct<less: double, name: string, s: string>>"))
    out = columns(docs, doc_id="long", text="string").select("doc_id", hits.alias("hits"))
    top = F.array_min("hits")
    return out.select("doc_id", top["name"].alias("license"), F.coalesce(-top["less"], F.lit(0.0)).alias("dice"), top["s"].alias("segment"),
                      F.size("hits").alias("n_matches"))


def _let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _greedy(marks: Column, clash: Callable[[Column, Column], Column]) -> Column:
    """``marks``, smallest first, without those that clash with one kept before."""
    return F.aggregate(F.array_sort(marks), F.slice(marks, 1, 0),
                       lambda kept, m: F.when(F.exists(kept, lambda k: clash(k, m)), kept).otherwise(F.concat(kept, F.array(m))))


def _spans(grams: Column, at: Column, name: str, text: str, dice: float) -> Column:
    """Best span from each start that matches one template: (less, more, name, at), -more bigrams from the one at ``at``.

    ``at`` are the places of all bigrams that any template has.
    """
    own = _bigrams(text)
    of = sorted(set(own))
    # 2k / (a + b) >= t with a >= k; as long as the largest segment that ``scan`` compares
    least, reach = max(1, math.ceil(len(of) * dice / (2 - dice) - 1e-9)), max(1, int(len(own) * (2 - dice) / dice + 1e-9))

    def best(p: Column) -> Column:
        rest = F.slice(grams, p + 1, F.lit(reach))
        # a span that ends at the first place of the m-th distinct bigram has m of them
        return _let(F.array_distinct(rest), lambda d: _let(
            F.array_min(F.transform(F.array_compact(F.transform(d, lambda g, m: F.when(g.isin(of), m + 1))),
                                    lambda m, k: F.struct((-((k + 1) * 2.0 / (m + len(of)))).alias("less"), m.alias("m")))),
            lambda x: F.struct(x["less"].alias("less"), (-F.array_position(rest, F.get(d, x["m"] - 1)).cast("int")).alias("more"),
                               F.lit(name).alias("name"), p.alias("at"))))

    def from_hits(hits: Column) -> Column:
        starts = F.transform(hits, lambda p, j: F.when(F.get(hits, j + (least - 1)) - p < reach, p))
        return F.filter(F.transform(F.array_compact(starts), best), lambda m: m["less"] <= -dice)

    return _let(F.filter(at, lambda i: F.get(grams, i).isin(of)), from_hits)


def notices(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, dice: float = DICE) -> DataFrame:
    """One row per row of ``docs``: doc_id, license, dice, segment, n_matches, licenses.

    A notice is a span of words, anywhere in a line or across lines, whose
    Dice with a template is at least ``dice``: twice the distinct bigrams in
    common, by the distinct bigrams of both. A span has at most (2 - dice) /
    dice times the bigrams of the template, repeats counted. Of spans that
    share a word the better one counts, ties going to the longer one, then to
    the licence that sorts first, then to the earlier one. n_matches counts the
    notices left, ``license``, ``dice`` and ``segment`` (its normalised
    words) are those of the best, null, 0 and null without any. ``licenses``
    has (license, dice, segment) of the best notice of every licence, best
    first, and is empty without any. Repeated rows are scanned alike; an
    empty table gives no rows.
    """
    known = sorted((name, text) for name, text in templates if _bigrams(text))
    every = sorted({g for _, text in known for g in _bigrams(text)})
    words = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ", -1)
    words = F.when(_may_match(F.col("text"), templates, dice), words).otherwise(F.array(F.lit("")))
    out = columns(docs, doc_id="long", text="string").select("doc_id", words.alias("w"))
    w = F.col("w")
    out = out.withColumn("grams", F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b)))
    out = out.withColumn("at", F.array_compact(F.transform("grams", lambda g, i: F.when(g.isin(every), i))))
    marks = F.concat(*[_spans(F.col("grams"), F.col("at"), name, text, dice) for name, text in known])
    out = out.select("doc_id", "w", F.when(F.size("at") > 0, marks).alias("marks"))
    shares = lambda a, b: (a["at"] <= b["at"] - b["more"]) & (b["at"] <= a["at"] - a["more"])  # noqa: E731  a span of n bigrams has n + 1 words
    out = out.select("doc_id", "w", F.when(F.size("marks") > 0, _greedy(F.col("marks"), shares)).alias("kept"))
    each = F.transform(_greedy(F.col("kept"), lambda a, b: a["name"] == b["name"]), lambda m: F.struct(
        m["name"].alias("license"), (-m["less"]).alias("dice"), F.array_join(F.slice("w", m["at"] + 1, 1 - m["more"]), " ").alias("segment")))
    out = out.select("doc_id", F.coalesce(F.size("kept"), F.lit(0)).alias("n_matches"), F.coalesce(each, F.array().cast(LICENSES)).alias("licenses"))
    top = F.get("licenses", F.lit(0))
    return out.select("doc_id", top["license"].alias("license"), F.coalesce(top["dice"], F.lit(0.0)).alias("dice"), top["segment"].alias("segment"),
                      "n_matches", "licenses")


def scan_sql() -> str:
    """DuckDB SQL for ``scan`` with its defaults, over ``documents``."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(name)}, [{', '.join(map(quoted, grams))}], {n}, CAST({lo!r} AS DOUBLE), CAST({hi!r} AS DOUBLE))"
                     for name, grams, n, lo, hi in _index(TEMPLATES, DICE))
    return f"""
        WITH t(name, grams, n, lo, hi) AS (VALUES {rows}),
             l AS (SELECT row_number() OVER () AS r, doc_id, list_transform(string_split(coalesce(text, ''), chr(10)),
                          lambda s: trim(regexp_replace(lower(s), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))) AS lines FROM documents),
             s AS (SELECT r, unnest(list_distinct(list_concat(lines,
                          list_transform(string_split_regex(array_to_string(lines, chr(10)), '\\n\\n+'), lambda s: trim(replace(s, chr(10), ' '))),
                          [array_to_string(list_filter(lines, lambda s: s <> ''), ' ')]))) AS s FROM l),
             w AS (SELECT r, s, string_split(s, ' ') AS w FROM s WHERE s <> ''),
             g AS (SELECT r, s, len(w) - 1 AS a, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams FROM w),
             m AS (SELECT r, s, name, len(list_intersect(g.grams, t.grams)) * CAST(2.0 AS DOUBLE) / (len(g.grams) + n) AS dice
                   FROM g JOIN t ON a >= lo AND a <= hi),
             b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r, s ORDER BY dice DESC, name) AS k FROM m) WHERE k = 1 AND dice >= {DICE}),
             d AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY dice DESC, name, s) AS k2, count(*) OVER (PARTITION BY r) AS n_matches FROM b)
        SELECT doc_id, name AS license, coalesce(dice, 0.0) AS dice, s AS segment, CAST(coalesce(n_matches, 0) AS INTEGER) AS n_matches
        FROM l LEFT JOIN (SELECT * FROM d WHERE k2 = 1) AS d USING (r)
    """
