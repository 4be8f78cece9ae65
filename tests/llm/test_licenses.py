import re

from tickflow.llm.licenses import _anchors, DICE, TEMPLATES, scan

SCHEMA = "doc_id long, text string, license int, dice string"


def brute(text):
    grams = lambda w: list(zip(w, w[1:], strict=False))
    words = lambda s: re.sub(r"[\W_]+", " ", s.lower()).split()
    lines = [" ".join(words(s)) for s in (text or "").split("\n")]
    blocks = [" ".join(x.split()) for x in re.split("\n\n+", "\n".join(lines))]
    best, n = None, 0
    for s in {*lines, *blocks, " ".join(x for x in lines if x)} - {""}:
        a = grams(s.split())
        marks = [(-2 * len(set(a) & set(b)) / (len(set(a)) + len(set(b))), name) for name, t in TEMPLATES
                 if (b := grams(words(t))) and a and len(a) <= len(b) * (2 - DICE) / DICE]
        marks = [m for m in marks if m[0] <= -DICE]
        if marks:
            n += 1
            best = min(best or (0,), (*min(marks), s))
    return (best[1], round(-best[0], 9), best[2], n) if best else (None, 0.0, None, 0)


MIT = TEMPLATES[3][1]
TEXTS = ["Some prose.\nReleased under the MIT License.\nMore prose.", "released UNDER the mit license", "Released under a MIT License today", None, "", " \n\n ", "License",
         "Licensed under CC BY-NC 4.0.\n\nLicensed under CC BY 4.0.", "\n".join(MIT[k:k + 60] for k in range(0, len(MIT), 60)), "x\n***\n" + MIT.replace(", ", ",\n") + "\n***\ny",
         "prose " * 50_000 + "\nLicensed under the Apache License, Version 2.0.", "Licensed under the Apache License Version 2.0 indeed", "the the the the", MIT + " " + MIT,
         "Ünder the MIT Lizenz freigegeben", "This work is licensed under the GNU General Public License, version 3.\nThis work is licensed under the GNU General Public License, version 2."]


def test_equals_brute_force(spark):
    rows = [(k, t, 1, "x") for k, t in enumerate(TEXTS)] + [(None, TEXTS[0], None, None), (1, TEXTS[1], None, None)]
    got = scan(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got.columns == ["doc_id", "license", "dice", "segment", "n_matches"]
    have = sorted(((r[0], r[1], round(r[2], 9), r[3], r[4]) for r in got.collect()), key=repr)
    assert have == sorted(((i, *brute(t)) for i, t, *_ in rows), key=repr)


def test_no_match_without_an_anchor():
    """The most that a text without the anchors can share with a template is less than the Dice wanted."""
    anchors = _anchors(TEMPLATES, DICE)
    assert 0 < len(anchors) < 40
    for _, t in TEMPLATES:
        w = re.sub(r"[\W_]+", " ", t.lower()).split()
        grams = set(zip(w, w[1:], strict=False))
        k = sum(not set(g) & set(anchors) for g in grams)
        assert 2 * k / (k + len(grams)) < DICE


def test_verbatim_templates_have_a_dice_of_one(spark):
    rows = [(k, f"intro\n\n{t}\n\nrest", 1, "") for k, (_, t) in enumerate(TEMPLATES)]
    got = {r.doc_id: (r.license, r.dice) for r in scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {k: (name, 1.0) for k, (name, _) in enumerate(TEMPLATES)}


def test_plan_is_one_narrow_pass_without_python(spark):
    plan = scan(spark.createDataFrame([(1, "a", 1, "")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Pandas|Join", plan)


def test_empty_table(spark):
    assert scan(spark.createDataFrame([], SCHEMA)).count() == 0
