"""Random page layouts with known main text, to train and test the extractor.

Attribute names and structures vary as on real sites; the words are those
of sampled pages. ``data-y`` marks which parts are main text.
"""

from __future__ import annotations

import random

# Words that sites commonly use in class and id attributes.
MAIN = "content main post article entry story body text page single prose copy".split()
SIDE = {
    "menu": "nav menu navbar navigation breadcrumb topnav links toc tabs pagination pager".split(),
    "header": "header masthead top branding logo banner site".split(),
    "footer": "footer bottom copyright colophon legal foot".split(),
    "sidebar": "sidebar aside widget related rail recommended popular secondary trending complementary".split(),
    "notice": "cookie notice consent alert gdpr popup modal message banner privacy warning".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo promoted adsense banner outbrain".split(),
    "form": "form search login subscribe newsletter signup contact".split(),
    "comments": "comments comment reply replies discussion respond disqus feedback reader".split(),
    "share": "share social sharing follow tags meta byline author".split(),
}
PLAIN = "row col container wrapper inner box block section grid left right large clearfix".split()


def _words(rng: random.Random, vocab: list[str], n: int) -> str:
    return " ".join(rng.choice(vocab) for _ in range(n))


def _attrs(rng: random.Random, names: list[str], sure: float) -> str:
    tokens = [rng.choice(names)] if rng.random() < sure else []
    tokens += [rng.choice(PLAIN) for _ in range(rng.randint(0, 1))]
    if len(tokens) > 1 and rng.random() < 0.5:
        tokens = [rng.choice("-_ ").join(tokens)]
    if not tokens:
        return ""
    return f' {rng.choice(["class", "class", "id"])}="{" ".join(tokens)}"'


def _paragraph(rng: random.Random, vocab: list[str], low: int, high: int) -> str:
    text = _words(rng, vocab, rng.randint(low, high))
    if rng.random() < 0.2:
        words = text.split(" ")
        k = rng.randrange(len(words))
        words[k] = rng.choice([f'<a href="/x">{words[k]}</a>', f"<b>{words[k]}</b>", f"<em>{words[k]}"])
        text = " ".join(words)
    return text


def _main(rng: random.Random, vocab: list[str]) -> str:
    out = []
    if rng.random() < 0.7:
        out.append(f"<h1>{_words(rng, vocab, rng.randint(3, 14))}</h1>")
    for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 14])):
        kind, low = rng.random(), rng.choice([3, 10, 30])
        end = "</p>" if rng.random() < 0.85 else ""
        if kind < 0.75:
            out.append(f"<p>{_paragraph(rng, vocab, low, low * 3)}{end}")
        elif kind < 0.82:
            out.append(f"<h2>{_words(rng, vocab, rng.randint(2, 8))}</h2>")
        elif kind < 0.9:
            out.append("<ul>" + "".join(f"<li>{_paragraph(rng, vocab, 4, 15)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
        elif kind < 0.95:
            out.append(f"<blockquote><p>{_paragraph(rng, vocab, 5, 30)}</p></blockquote>")
        else:
            out.append("<table>" + "".join(f"<tr><td>{_words(rng, vocab, 2)}<td>{_words(rng, vocab, 3)}" for _ in range(3)) + "</table>")
    return "".join(out)


def _side(rng: random.Random, vocab: list[str], kind: str) -> str:
    link = lambda n: f'<a href="/{rng.choice(vocab)}">{_words(rng, vocab, n)}</a>'
    if kind == "menu":
        return "<ul>" + "".join(f"<li>{link(rng.randint(1, 3))}</li>" for _ in range(rng.randint(3, 9))) + "</ul>"
    if kind == "sidebar":
        return f"<h3>{_words(rng, vocab, 2)}</h3>" + rng.choice([
            "<ul>" + "".join(f"<li>{link(rng.randint(3, 9))}</li>" for _ in range(rng.randint(2, 6))) + "</ul>",
            f"<p>{_paragraph(rng, vocab, 5, 40)}</p>"])
    if kind == "comments":
        return "".join(f'<div class="{rng.choice(["comment", "reply", "item", "body"])}"><p>{_paragraph(rng, vocab, 3, 50)}</p></div>' for _ in range(rng.randint(1, 5)))
    if kind == "form":
        return f'<form action="/s"><label>{_words(rng, vocab, 2)}</label><input name="q"><p>{_words(rng, vocab, rng.randint(1, 8))}</p></form>'
    if kind == "share":
        return " ".join(link(1) for _ in range(rng.randint(2, 4)))
    text = _words(rng, vocab, rng.randint(3, 30))
    return rng.choice([text, f"<p>{text}</p>", text + " " + link(2), f"&copy; {text} &middot; {_words(rng, vocab, 3)}"])


_TAGS = {"menu": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "sidebar": ["aside", "div", "section"],
         "notice": ["div", "section", "p"], "ad": ["div", "aside", "section"], "form": ["div", "section"], "comments": ["div", "section", "ol"], "share": ["div", "p"]}


def page(rng: random.Random, vocab: list[str]) -> str:
    """One page with its main text under ``data-y="1"`` and everything else under ``data-y="0"``."""
    def part(kind: str) -> str:
        tag = rng.choice(_TAGS[kind])
        # a plain element is named for what it is; one with a tag of its own need not be
        return f'<{tag}{_attrs(rng, SIDE[kind], 0.5 if tag in ("nav", "header", "footer", "aside") else 0.95)} data-y="0">{_side(rng, vocab, kind)}</{tag}>'

    tag = rng.choice(["article", "article", "main", "div", "div", "section", "td"])
    inner = _main(rng, vocab)
    for kind in ("ad", "share", "notice", "form", "comments"):
        if rng.random() < 0.2:  # boilerplate inside the article
            inner += part(kind)
    main = f'<{tag}{_attrs(rng, MAIN, 0.3 if tag in ("article", "main") else 0.8)} data-y="1">{inner}</{tag}>'
    main = f"<table><tr>{main}</tr></table>" if tag == "td" else main
    before = [part(k) for k in ("header", "menu", "notice", "ad", "form") if rng.random() < 0.55]
    after = [part(k) for k in ("share", "comments", "sidebar", "ad", "notice", "form", "footer") if rng.random() < 0.45]
    rng.shuffle(before), rng.shuffle(after)
    if rng.random() < 0.25 and after:
        before.append(after.pop())
    body = "".join([*before, main, *after])
    for _ in range(rng.randint(0, 2)):
        body = f"<div{_attrs(rng, PLAIN, 0.7)}>{body}</div>"
    return f"<!DOCTYPE html><html><head><title>t</title></head><body>{body}</body></html>"
