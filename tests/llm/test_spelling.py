import random
import zlib
from collections import Counter

import pytest

from tickflow.llm.spelling import blocks, near_pairs, roots, spelling_groups, vocabulary, words_of

SCHEMA = "doc_id long, text string, word string, n int"


def one_edit(v, w):
    if len(v) == len(w):
        return sum(a != b for a, b in zip(v, w, strict=True)) == 1
    if abs(len(v) - len(w)) != 1:
        return False
    short, long = sorted((v, w), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def brute(rows):
    counts = Counter()
    for i, text, *_ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        runs = "".join(c if "a" <= c <= "z" or "À" <= c <= "ÿ" else " " for c in low).split(" ")
        for run in filter(None, runs):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 3}
    form, out = {}, []
    for w, n in counts.items():
        near = sorted((-counts[v], v) for v in counts if one_edit(v, w))
        if near and -near[0][0] >= 2 * n:
            form[w] = near[0][1]
        out.append([w, form.get(w), None, n, len(near), counts[form[w]] if w in form else None])
    for r in out:
        r[2] = r[0]
        while r[2] in form:
            r[2] = form[r[2]]
    return sorted(map(tuple, out))


def test_near_pairs_equal_brute_force():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.choice((6, 7)))) for _ in range(500)})
    i, j = near_pairs(words, 6)
    want = {(a, b) for a in range(len(words)) for b in range(len(words)) if len(words[a]) == 6 and one_edit(words[a], words[b])}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want and len(i) == len(want)
    assert len(near_pairs(["abcdefg"], 6)[0]) == 0


@pytest.mark.parametrize("block_words", [1, 4, 2048])
def test_groups_equal_brute_force_for_any_size_of_block(spark, block_words):
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abÉé") for _ in range(rng.randint(4, 8))) for _ in range(120)]
    rows = [(k, " ".join(rng.choices(vocab, k=60)).replace("a ", "A\n"), "x", 1) for k in range(60)]
    rows += [(None, "Straße straße STRASSE×÷ Straße", None, None), (None, None, "y", 2), (70, "", None, 3), (70, "abcde " * 200_000, None, 3)]
    rows += [rows[0]] * 3  # repeated rows count each
    got = spelling_groups(spark.createDataFrame(rows, SCHEMA), block_words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_hot_first_letters_are_dealt_anew(spark):
    rng = random.Random(7)
    words = sorted({"prefix" + "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)})
    vocab = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    sizes = blocks(vocab, 100).filter("m = 12").groupBy("m", "a", "b", "first", "last").count()
    large = sizes.filter("count > 100 AND m - a - b > 1")
    assert large.isEmpty() and sizes.count() > 1


def test_chain_of_forms_and_words_of_a_text(spark):
    chain = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(20)], "word string, form string")
    assert {r.root for r in roots(chain).collect()} == {"w20"}
    assert words_of(1, "Ab xÄÖ ABCDEF abcdef".encode()).total() <= 2
    assert words_of(1, b"\xff\xfe abcde").total() <= 1


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vocabulary(empty).count() == 0
    assert spelling_groups(empty).count() == 0
