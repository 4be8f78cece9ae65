import html
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from tickflow.llm import layouts
from tickflow.llm.dom import read
from tickflow.llm.main_text import _SIDE_TOKENS, boost, extract, log_odds, main_text, train

SCHEMA = "page_id long, url string, html string, text int, n_chars string"


@pytest.fixture(scope="module")
def sample(spark):
    return [r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()]


@pytest.fixture(scope="module")
def model(sample):
    return train(sample)


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)[^>]*>", " ", inner))).split())


def test_every_page_of_the_table_gives_its_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in main_text(pages).collect()}
    want = {r.page_id: (r.url, article(r.html), len(article(r.html))) for r in pages.collect()}
    assert got == want


def test_unseen_layouts(model, sample):
    rng = random.Random(2024)
    vocab = [w for h in sample[:30] for w in re.sub(r"<[^>]*>", " ", h).split()]
    right, exact = 0.0, 0
    for _ in range(200):
        page = layouts.page(rng, vocab)
        p = read(page)
        main = [0] * len(p.tags)
        for k in range(1, len(p.tags)):
            main[k] = int(p.marks[k]) if p.marks[k] else main[p.parents[k]]
        want = " ".join("".join(t for n, t in p.pieces if n < 0 or main[n]).split())
        got = extract(model, [read(re.sub(' data-y="."', "", page))])[0]
        a, b = Counter(want.split()), Counter(got.split())
        right += 2 * sum((a & b).values()) / max(1, len(want.split()) + len(got.split()))
        exact += got == want
    assert right / 200 >= 0.95 and exact / 200 >= 0.88


PAGE = """<html><body><div class="cookie-notice">We use cookies</div><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
<div class="content"><h1>Title &amp; more</h1><p>First <b>bold</b>text,<br>next line &#233; &nbsp; here goes a long enough sentence, with words.
<p>Second paragraph that is never closed, and has a <a href="x">link</a> in it.<ul><li>one item of it<li>two items of it</ul>
<script>if (a < b) document.write("<p>no</p>")</script><style>p { x: "</p>" }</style><!-- <p>no</p> --></div>
<div id="comments"><p>A reader says this is a nice article, and writes quite a lot about it.</p></div>
<form><p>Sign up</p><input><button>Go</button></form><aside><p>Related story that is a bit longer</p></aside><footer>&copy; site</footer></body></html>"""


def test_markup_of_all_kinds(model):
    assert extract(model, [read(PAGE, _SIDE_TOKENS)])[0] == ("Title & more First boldtext, next line é here goes a long enough sentence, with words. "
                                               "Second paragraph that is never closed, and has a link in it. one item of it two items of it")


@pytest.mark.parametrize("text", ["", "<", "<<<>>>", "a < b > c", "</p></div>", "<p", "<p class='x", "<script>alert(1)", "<!-- open", "&#xD800; &#0; &bogus; &amp",
                                  "<div>" * 3000 + "deep", "<p>" * 3000, "<a b=\"c>d</a>", "\x00<p>\x00</p>", "<table><tr><td>a<td>b<tr><td>c</table>", "<svg/><path/><p>x"])
def test_broken_markup_does_not_stop_it(model, text):
    got = extract(model, [read(text, _SIDE_TOKENS)])
    assert len(got) == 1 and isinstance(got[0], str)
    got[0].encode("utf-8")


SLOW = ["<a ", "<b>", "</i>", "<b></i>", '<a "> ', "<a '\"> ", '<a ">" ', "<!", "<!-", "<?", "<a<", "<div>", "<p><table><b>", "<b><div></div>", "</p>", "<a class=\"", "<li>", "<td><b>", "&", "<"]


@pytest.mark.parametrize("part", SLOW)
def test_a_megabyte_of_broken_markup_is_read_in_time(model, part):
    n = 1_000_000 // len(part)
    for text in (part * n, part * n + '">"', part * (n // 2) + "</i>" * (n // 4)):
        at = time.process_time()
        page = read(text, _SIDE_TOKENS)
        if text == part * n:
            extract(model, [page])
        assert time.process_time() - at < 5


def test_levels_and_single_steps_agree(model, monkeypatch):
    import tickflow.llm.main_text as M
    rng = random.Random(6)
    pages = [read(layouts.page(rng, ["word", "text,", "and."] * 5), _SIDE_TOKENS) for _ in range(20)]
    plain = extract(model, pages)
    monkeypatch.setattr(M, "DEEP", 0)
    assert extract(model, pages) == plain


def test_adverts_in_a_line_formulas_and_plain_text(model):
    body = "A paragraph of the article, with enough words in it to be one, and more. " * 4
    page = f"""<html><body><nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{body}<span class='advert'>Buy now cheap</span></p>
<p>{body}<math><mi>x</mi><mo>=</mo><mn>2</mn></math> <span class="date">today</span></p></article></body></html>"""
    got = extract(model, [read(page, _SIDE_TOKENS)])[0]
    assert "Buy now" not in got and "x=2 today" in got and got.startswith("Title A paragraph")
    assert extract(model, [read("plain text, no tag &amp; all", _SIDE_TOKENS)])[0] == "plain text, no tag & all"


def test_a_kept_node_has_kept_ancestors(model):
    from tickflow.llm.main_text import _Nodes
    nodes = _Nodes([read(PAGE)])
    assert (nodes.parent[1:] < np.arange(1, len(nodes.parent))).all()
    assert nodes.below(nodes.chars)[0] == nodes.chars.sum()


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    trees = boost(x[:1500], y[:1500], np.ones(1500))
    assert ((log_odds(trees, x[1500:]) > 0) == y[1500:]).mean() > 0.95


def test_nulls_repeats_long_pages_and_empty_tables(spark):
    long = "<article><p>" + "many words here, " * 80_000 + "</p></article>"
    rows = [(1, None, None, 1, "x"), (2, "u", "", 1, "x"), (None, None, PAGE, None, None), (3, "v", PAGE, 1, ""), (3, "v", PAGE, 1, ""), (4, "w", long, 1, "")]
    got = main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 6 and {(r.page_id, r.text, r.n_chars) for r in got if r.page_id in (1, 2)} == {(1, "", 0), (2, "", 0)}
    assert [r.n_chars for r in got if r.page_id == 4] == [80_000 * 17 - 1]
    assert len({r.text for r in got if r.url == "v" or r.page_id is None}) == 1
    assert main_text(spark.createDataFrame([], SCHEMA)).count() == 0
