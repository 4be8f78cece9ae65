import re

import pytest

from tickflow.llm.licenses import DICE, TEMPLATES, notices

from test_licenses import SCHEMA, TEXTS


def brute(text):
    """(license, dice, segment, number of notices): every span of words against every template."""
    grams = lambda w: list(zip(w, w[1:], strict=False))
    words = lambda s: re.sub(r"[\W_]+", " ", s.lower()).split()
    w = words(text or "")
    all_grams, marks = grams(w), []
    for name, t in TEMPLATES:
        own = grams(words(t))
        for p in range(len(all_grams)):
            best, seen = None, set()
            if all_grams[p] not in own:
                continue
            for n in range(1, int(len(own) * (2 - DICE) / DICE + 1e-9) + 1):
                if p + n > len(all_grams):
                    break
                seen.add(all_grams[p + n - 1])
                mark = (-2 * len(seen & set(own)) / (len(seen) + len(set(own))), name, p, n)
                best = min(best or mark, mark)
            if best[0] <= -DICE:
                marks.append((best[0], -best[3], name, p))
    kept = []
    for m in sorted(marks):
        if all(m[3] > k[3] - k[1] or k[3] > m[3] - m[1] for k in kept):
            kept.append(m)
    return [(name, round(-less, 9), " ".join(w[p:p - more + 1])) for less, more, name, p in kept]


def found(spark, texts):
    got = notices(spark.createDataFrame([(k, t, 1, "x") for k, t in enumerate(texts)], SCHEMA).repartition(3))
    assert got.columns[:5] == ["doc_id", "license", "dice", "segment", "n_matches"]
    return {r[0]: (r[1], round(r[2], 9), r[3], r[4]) for r in got.collect()}


MORE = [TEXTS[0].replace("\n", " "), "Copyright 2024 Jane Doe. Released under the MIT License.", "Released under the MIT License. See LICENSE.",
        "Licensed under CC BY 4.0 and, in parts, licensed under the BSD 3-Clause License. Released under the MIT License.",
        "the software the software " * 40 + TEMPLATES[3][1] + " " + TEMPLATES[5][1], "of the License " * 60, "word " * 300 + TEMPLATES[5][1].replace("either ", "whether ") + " word" * 300]


def test_equals_all_spans(spark):
    texts = TEXTS + MORE
    have = found(spark, texts)
    for k, t in enumerate(texts):
        want = brute(t)
        assert have[k] == ((*want[0], len(want)) if want else (None, 0.0, None, 0)), t and t[:80]


@pytest.mark.parametrize("text,name", [
    ("Released under the MIT License. See LICENSE.", "MIT"), ("Copyright 2024 Jane Doe. Released under the MIT License.", "MIT"),
    ("Some words before it, and then this work is licensed under a Creative Commons Attribution 4.0 International License, with more after it. " * 1, "CC-BY-4.0"),
    ("prose " * 200 + "Licensed under the Apache License, Version 2.0. " + "prose " * 200, "Apache-2.0"),
    ("(c) Jane Doe. Released under\nthe MIT License. All else is\nnot.", "MIT")])
def test_notice_that_shares_its_line(spark, text, name):
    license_, dice, segment, n = found(spark, [text])[0]
    assert (license_, dice, n) == (name, 1.0, 1) and segment in re.sub(r"[\W_]+", " ", text.lower())


APACHE = TEMPLATES[5][1]


SETS = (TEMPLATES[3], TEMPLATES[5])


@pytest.mark.parametrize("text,name,dice", [
    (TEMPLATES[3][1], "MIT", 1.0), (APACHE, "Apache-2.0", 1.0),
    (APACHE.replace("You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 ", ""), "Apache-2.0", 0.89)])
def test_dice_of_sets(spark, text, name, dice):
    """Bigrams that a notice repeats count once on both sides."""
    for given in (text, "before it " + text + " after it"):
        row = notices(spark.createDataFrame([(1, given)], "doc_id long, text string"), SETS).first()
        assert (row.license, row.n_matches) == (name, 1) and abs(row.dice - dice) < 0.005
    assert found(spark, [text])[0][:2] == (name, 1.0)


def test_every_licence_of_a_document(spark):
    texts = ["Released under the MIT License.\nThis work is licensed under the GNU General Public License, version 3.", "Released under the MIT License. " + APACHE + " Released under the MIT License.",
             TEMPLATES[6][1], "none", None] + MORE
    got = {r.doc_id: r for r in notices(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [[x.license for x in got[k].licenses] for k in range(5)] == [["GPL-3.0", "MIT"], ["Apache-2.0", "MIT"], ["GPL-3.0"], [], []]
    for k, t in enumerate(texts):
        first = {}
        for x in brute(t):
            first.setdefault(x[0], x)
        assert [(x.license, round(x.dice, 9), x.segment) for x in got[k].licenses] == list(first.values())
        assert (got[k].license, got[k].segment) == ((got[k].licenses[0].license, got[k].licenses[0].segment) if first else (None, None))


def test_plan_is_one_narrow_pass_without_python(spark):
    plan = notices(spark.createDataFrame([(1, "a", 1, "")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Pandas|Join", plan)


def test_empty_table(spark):
    assert notices(spark.createDataFrame([], SCHEMA)).count() == 0
