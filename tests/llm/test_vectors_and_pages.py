"""Vectors against brute force, and pages."""

import numpy as np
import pytest

from tidemill.llm import extract, forest

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def links(rows, least=0.98):
    sound = {
        i: np.array(e, float)
        for i, (_, e, label) in enumerate(rows)
        if label is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)
    }
    near = {i: set() for i in range(len(rows))}
    for i, a in sound.items():
        for j, b in sound.items():
            if i < j and rows[i][2] == rows[j][2] and len(a) == len(b):
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= least:
                    near[i].add(j)
                    near[j].add(i)
    out = {}
    for i, (own, *_) in enumerate(rows):
        group, waiting = {i}, [i]
        while waiting:
            for j in near[waiting.pop()] - group:
                group.add(j)
                waiting.append(j)
        component = min(rows[j][0] for j in group)
        out[own] = (len(near[i]), component, component == own)
    return out


def vectors(count=400, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(count):
        if i % 4 and rows:
            base = np.array(rows[rng.integers(len(rows))][1])
            noise = rng.standard_normal(32) * rng.choice([0.0, 0.01, 0.03, 0.05])
            v = base / np.linalg.norm(base) + noise
        else:
            v = rng.standard_normal(32)
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 3)))
    return rows


@pytest.mark.parametrize("block", [1_000, 16])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(forest, "BLOCK", block)
    rows = vectors()
    nan, inf = float("nan"), float("inf")
    rows += [(900, None, 1), (901, [0.0] * 32, 1), (902, [nan] * 32, 1), (903, [None] * 32, 1), (904, [inf] * 32, 1)]
    rows += [(905, rows[0][1], None), (906, [], 1), (907, [1.0], 1), (908, [2.0], 1)]
    found = forest.near_vectors(spark.createDataFrame(rows, SCHEMA), leaf=20)
    expected = links(rows)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found.collect()}
    right = sum(got[i] == expected[i] for i in expected)
    assert len(got) == len(rows) and right >= 0.99 * len(rows)
    assert all(got[i][0] <= expected[i][0] for i in expected)
    assert sum(v[0] for v in got.values()) >= 0.98 * sum(v[0] for v in expected.values())


def test_no_vectors(spark):
    assert forest.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a="</p>";</script></head><body>
<nav><ul><li><a href=/a>Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Title &amp; more</h1><p>First   paragraph<br>
goes on.<p>Second <b>one</b></p><ul><li>item</ul><div class="ad">Buy</div>
<section id="comments"><p>Nice!</p></section></article><aside>Side</aside><footer>&copy; x</footer></body></html>"""


def test_main_text(spark):
    text = "Title & more\nFirst paragraph goes on.\nSecond one\nitem"
    rows = [(1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<nav>only</nav>"), (1, "u", PAGE), (4, "x", "plain words")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = sorted((r.page_id or 0, r.text, r.n_chars) for r in extract.extract(pages).collect())
    assert found == [(0, "", 0), (1, text, len(text)), (1, text, len(text)), (2, "", 0), (3, "", 0), (4, "plain words", 11)]
    assert extract.extract(pages.limit(0)).count() == 0


def test_page_without_article():
    body = "".join(f"<p>{'word ' * 40}{i}</p>" for i in range(6))
    menu = "".join(f"<div><a href=/{i}>link</a></div>" for i in range(12))
    found = extract.main_text(f"<html><body><div>{menu}</div><div>{body}<p>short</p></div></body></html>")
    assert found.split("\n") == [f"{'word ' * 40}{i}" for i in range(6)] + ["short"]


LONG = "A sentence of the article with quite a number of words in it, as articles have them."
ARTICLE = f"<article><h1>Title</h1><p>{LONG}</p><p>{LONG} Again.</p></article>"
TEXT = f"Title\n{LONG}\n{LONG} Again."


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="layout has-sidebar">{ARTICLE}</div>',
        f'<form id="aspnetForm"><div>{ARTICLE}</div></form>',
        f"<p>x<noscript>{ARTICLE}",
        f'<noscript><img src=x>Enable scripts.</noscript><div class="page-header">Site</div>{ARTICLE}',
        ARTICLE.replace("<h1>", '<div class="post-header"><h1>').replace("</h1>", "</h1></div>"),
        ARTICLE.replace("<h1>", '<h1 class="section-header" id="notice">'),
        ARTICLE.replace("<p>", '<p id="related-work">', 1),
        ARTICLE.replace("<p>", '<p class="dialog">', 1),
        f"{ARTICLE}<section><h2>3 Comments</h2>" + f"<article><p>{LONG * 3} I think.</p></article>" * 4 + "</section>",
        f"<main>{ARTICLE[9:-10]}</main><section><h2>Comments</h2><article><p>Nice!</p></article></section>",
        ARTICLE.replace("</article>", f'<div class="comments"><p>{LONG * 9}</p></div></article>'),
        ARTICLE.replace(LONG, LONG.replace(" of", '<span class="ad">Buy <span>now</span> cheap</span> of'), 1),
        ARTICLE.replace(LONG, LONG.replace(" of", "<svg><text>no</text></svg> of"), 1),
        ARTICLE.replace(LONG, LONG.replace(" of", "<noscript>no <b>script</b></noscript> of"), 1),
        f'<nav class="menu"><a href=/>Home</a></nav>{ARTICLE}<footer>(c)</footer><div class="newsletter">Subscribe!</div>',
        f'{ARTICLE}<div hidden><p>{LONG * 5}</p></div>',
        f"<div>{ARTICLE[9:-10]}</div><div><a href=/1>One</a> <a href=/2>Two</a></div><div>© 2024 All rights reserved.</div>",
        f"<div><h1>Title</h1><p>{LONG}</p></div><div><p>{LONG} Again.</p></div>",
    ],
)
def test_main_text_of_other_markup(page):
    assert extract.main_text(f"<html><head><title>t</title></head><body>{page}</body></html>") == TEXT


def test_formulas_quotes_and_short_ends_stay():
    page = f"<div><p>{LONG}</p><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p></div>"
    assert extract.main_text(page) == f"{LONG}\nSo x=1 holds."
    page = ARTICLE.replace("</article>", '<blockquote class="reply">He said so.</blockquote></article>')
    assert extract.main_text(page) == f"{TEXT}\nHe said so."
    page = f"<div><div><h1>Title</h1><p>{LONG}</p><p>{LONG} Again.</p></div><div><p>The end.</p></div></div>"
    assert extract.main_text(page) == f"{TEXT}\nThe end."


def test_pages_with_very_many_elements_take_linear_time():
    import time

    body = "".join(f'<div class="menu ad"><a href=/{i}>link {i}</a></div><p>{LONG} {i}</p>' for i in range(4_000))
    begin = time.perf_counter()
    text = extract.main_text(f"<body><article>{body}</article></body>")
    assert text.count("\n") == 3_999 and time.perf_counter() - begin < 20
    assert extract.main_text("<div>" * 3_000 + "deep") == "deep"
