"""HTML extraction on literal sites: comments, notices, menus; the tree against a plain one."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from storelens.llm import site_tree
from storelens.llm.frames import checkpointed
from storelens.llm.html_tree import Branch, parse
from tests.llm.cases import prose

PAGES = "page_id int, url string, html string"


def article(i, n=None):
    rng = random.Random(i)
    return [" ".join(prose(10_000 + 50 * i + k, rng.randint(8, 25)).split()) for k in range(n or rng.randint(2, 6))]


def said(i, n, words=15):
    rng = random.Random(i)
    return [(rng.choice(["Ann", "Bob Lee", "Zoë"]), f"{rng.randint(1, 28)} May 202{rng.randint(0, 6)}",
             prose(90_000 + 20 * i + k, words)) for k in range(n)]


def paragraphs(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def card(who, when, text, label="c7"):
    return f'<div class="{label}"><span>{who}</span> <i>{when}</i><p>{text}</p></div>'


NAV = '<div class="m1"><a href=/>Home</a> <a href=/n>News</a> <a href=/s>Sport {}</a></div>'
LAYOUTS = {
    # comments longer than the article, in it, beside it, under a name of a list or a service
    "section of comments in the article": lambda i, a: f'<article>{paragraphs(a)}<section class="comments">'
        f'{"".join(card(*c) for c in said(i, 30))}</section></article>',
    "comments beside a post": lambda i, a: f'<div class="post">{paragraphs(a)}</div><div class="comments">'
        f'{"".join(card(*c) for c in said(i, 30))}</div>',
    "a service's thread": lambda i, a: f'<article>{paragraphs(a)}<div id="disqus_thread" class="user-comments"><p>first! '
        f'{prose(i, 9)}</p></div></article>',
    "a notice in every article": lambda i, a: f'<article>{paragraphs(a)}<div class="newsletter-signup">Get our weekly letter, it is '
        'free and you can leave whenever you like.</div></article>',
    # classes that say nothing
    "an unnamed notice in every article": lambda i, a: f'<article>{paragraphs(a[:1])}<div class="k2">Only for members: join us '
        f'now and read on without end.</div>{paragraphs(a[1:])}</article>',
    "an unnamed thread in the article": lambda i, a: f'<article>{paragraphs(a)}<div class="z1"><p>{2 + i % 3} voices</p>'
        f'{"".join(card(*c) for c in said(i, 2 + i % 3))}</div></article>',
    "an unnamed thread, sometimes of one": lambda i, a: f'<article>{paragraphs(a)}<div class="z1">'
        f'{"".join(card(*c) for c in said(i, 1 + i % 4))}</div></article>',
    "an unnamed thread beside an unnamed article": lambda i, a: f'{NAV.format(i)}<div class="q4"><h1>{a[0]}</h1>'
        f'{paragraphs(a[1:])}</div><div class="z1">{"".join(card(*c) for c in said(i, 2 + i % 5))}</div>',
    "times as elements": lambda i, a: f'<main>{paragraphs(a)}<ol class="z">' + "".join(
        f"<li><b>{w}</b> <time>{d}</time><div>{t}</div></li>" for w, d, t in said(i, 3)) + "</ol></main>",
    "times ago": lambda i, a: f'<main>{paragraphs(a)}</main><div class=x>' + "".join(
        f"<div><p>{w}, {k + 2} hours ago</p><p>{t}</p></div>" for k, (w, _, t) in enumerate(said(i, 3))) + "</div>",
    "an unnamed menu of changing links": lambda i, a: '<div class="m9">' + "".join(
        f"<a href=/{k}>{prose(i * 9 + k, 2)}</a> " for k in range(6)) + f'</div><div class="q4">{paragraphs(a)}</div>',
    "an unnamed footer": lambda i, a: f'<div class="q4">{paragraphs(a)}</div><div class="q5">All rights with us, since 1999</div>',
    "an unnamed header and footer around a table": lambda i, a: '<table><tr><td class=h>The daily paper of the town</td></tr><tr><td '
        f'class=b>{paragraphs(a)}</td></tr><tr><td class=f>Imprint and contact, call us</td></tr></table>',
    "a strip between paragraphs": lambda i, a: f'<main>{paragraphs(a[:1])}<p>Our shop has what you need, order today and pay later.</p>'
        f'{paragraphs(a[1:])}</main>',
    "names that only speak of comments": lambda i, a: f'<body class="no-sidebar comments-open"><div class="post has-comments">'
        f'{paragraphs(a)}</div></body>',
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_literal_sites_give_the_article_alone(spark, name):
    rows, want = [], {}
    for i in range(40):
        a = article(i)
        rows.append((i, f"http://site.org/{i}", f"<html><body>{LAYOUTS[name](i, a)}</body></html>"))
        want[i] = "\n\n".join(a)
    got = {r.page_id: r.text for r in site_tree.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == want


def test_articles_copied_within_a_host_stay(spark):
    """Copies, near copies and passages that some pages share are no notices."""
    same, other = article(1, 5), article(2, 5)
    rows = [(i, f"http://a.org/{i}", f"<article>{paragraphs(same)}</article>") for i in range(30)]
    rows += [(100 + i, f"http://b.org/{i}", f"<article>{paragraphs([f'Part {i}', *other])}</article>") for i in range(30)]
    shared = "a passage that a third of the pages quote word for word"
    rows += [(200 + i, f"http://c.org/{i}", f"<article>{paragraphs([*article(300 + i), *[shared] * (i % 3 == 0)])}</article>")
             for i in range(30)]
    got = {r.page_id: r.text for r in site_tree.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[i] == "\n\n".join(same) for i in range(30))
    assert all(got[100 + i] == "\n\n".join([f"Part {i}", *other]) for i in range(30))
    assert all(got[200 + i].endswith(shared) == (i % 3 == 0) for i in range(30))


def test_sections_and_timelines_are_no_comments(spark):
    a = article(7, 6)
    html = ("<article>" + "".join(f"<section><h2>Part {i}, 3 May 2020</h2><p>{t}</p></section>" for i, t in enumerate(a))
            + "".join(f"<div><p>{1990 + i}-05-01</p><p>{t} again</p></div>" for i, t in enumerate(a)) + "</article>")
    got = site_tree.extract(spark.createDataFrame([(1, "http://a.org/", html)], PAGES)).first().text
    want = [x for i, t in enumerate(a) for x in (f"Part {i}, 3 May 2020", t)]
    assert got == "\n\n".join(want + [x for i, t in enumerate(a) for x in (f"{1990 + i}-05-01", f"{t} again")])


def test_more_keys_than_fit_a_broadcast(spark, monkeypatch):
    rows = []
    for k, name in enumerate(LAYOUTS):
        for i in range(25):
            rows.append((100 * k + i, f"http://s{k}.org/{i}", f"<body>{LAYOUTS[name](i, article(i))}</body>"))
    rows += [rows[3], rows[3], (None, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 as site_host", "2 as Text", "3 as row", "4 as times", "5 as HTML_")
    want = sorted(map(tuple, site_tree.extract(df).collect()), key=repr)
    monkeypatch.setattr(site_tree, "SMALL", 3)
    got = site_tree.extract(df)
    assert got.columns == ["page_id", "url", "site_host", "row", "times", "HTML_", "text", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=repr) == want and len(want) == len(rows)


def plain_importance(roots, decay):
    """The style tree by recursion over merged nodes: {path: importance}."""
    out = {}

    def below(b):
        return [c for c in b.children if isinstance(c, Branch)]

    def content(b):
        return "\n".join(c if isinstance(c, str) else content(c) for c in b.children)

    def node(path, merged):
        m = len(merged)
        styles, leaves = {}, []
        for b in merged:
            decided = b.kind == "noise" or b.kind == "main" and not b.asks
            if decided or not below(b):
                leaves.append(content(b))
            else:
                styles.setdefault(tuple(c.label for c in below(b)), []).append(b)
        inner = []
        for labels, some in styles.items():
            for i, label in enumerate(labels):
                inner += node((*path, labels, i, label), [below(b)[i] for b in some])
        counts = [len(x) for x in styles.values()]
        texts = Counter(leaves)
        if m == 1:
            own = 1.0
        elif leaves:            # contents and styles of one place count as its features
            features = [*texts.values(), *counts]
            own = 1 - sum(math.log(n) for n in features) / len(features) / math.log(m)
        else:
            own = -sum(n / m * math.log(n / m, m) for n in counts)
        kinds = len(texts) + len(counts)
        if leaves:
            mine = [(m, own)]
            out[path] = own
        else:
            mine = []
            weight = sum(w for w, _ in inner)
            out[path] = (1 - decay ** kinds) * own + decay ** kinds * (sum(w * x for w, x in inner) / weight if weight else 0)
        return mine + inner

    node((), roots)
    return out


def test_importance_equals_a_plain_tree(spark):
    rng = random.Random(6)

    def block(depth):
        if depth == 0 or rng.random() < 0.3:
            return f"<div class={rng.choice('xy')}>{rng.choice(['same text', 'other text', prose(rng.randint(0, 99), 3)])}</div>"
        return f"<div class={rng.choice('xy')}>{''.join(block(depth - 1) for _ in range(rng.randint(1, 3)))}</div>"

    htmls = [f"<body>{block(2)}<div class=z>foot</div></body>" for _ in range(60)]
    roots = [parse(h) for h in htmls]
    rows = [("h", p, s, c, a) for r in roots for p, s, c, a in site_tree.places(r)]
    seen = spark.createDataFrame(rows, "host string, place bigint, style bigint, content bigint, above array<bigint>")
    counted = checkpointed(seen.groupBy("host", "place", "style", "content").agg(
        F.count("*").alias("n"), F.first("above").alias("above")))
    got = {r.place: r.importance for r in site_tree.branch_importance(counted, decay=0.9, few=1).collect()}
    want = {}
    for path, value in plain_importance(roots, 0.9).items():
        place = 0
        for k in range(0, len(path), 3):
            place = site_tree._hash(place, site_tree._hash(*path[k]), path[k + 1], path[k + 2])
        want[place] = value
    assert got.keys() == want.keys() and len(want) > 30
    assert all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)
    assert 0 < sum(v < site_tree.THRESHOLD for v in want.values()) < len(want)


def test_place_key_is_sparks_hash(spark):
    rows = [("a.org", 5), ("", -(1 << 63)), ("ü.de", (1 << 63) - 1)]
    df = spark.createDataFrame(rows, "h string, p bigint").select("h", "p", F.xxhash64(F.xxhash64("h"), "p").alias("k"))
    assert all(site_tree.place_key(r.h, r.p) == r.k for r in df.collect())
