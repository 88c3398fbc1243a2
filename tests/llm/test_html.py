"""Main text of pages: labelled layouts, measured precision and recall, ratios by brute force."""

import html as entities
import math
import re
import time
from collections import Counter

import pytest

from leafmill.llm import html_text

LONG = "A long paragraph tells what happened, when it happened, and why; it has marks, words and more words. It goes on for a while. "
P = [f"{LONG}Number {i} of them, with its own end." for i in range(6)]
STORY = "".join(f"<p>{p}</p>" for p in P[:4])
TEXT = "\n\n".join(P[:4])
MENU = "<ul>" + "".join(f"<li><a href=/{w}>{w}</a></li>" for w in ("Home", "News", "Sport", "About us, and more")) + "</ul>"

PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav><div class="cookie-notice">We use cookies, a lot.</div>
<article><h1>Head &amp; more</h1><p>First text,  with marks. And more of it, here.<p><b>Second text.<br></b>It goes
on, for long.</p><p>End.</p><section class="comments"><p>Nice article, thanks. I liked it, really.</p></section></article><footer>&copy; us</footer></body></html>"""

#: name -> (page, expected text)
LAYOUTS = {
    "semantic": (PAGE, "Head & more\n\nFirst text, with marks. And more of it, here.\n\nSecond text. It goes on, for long.\n\nEnd."),
    "class of the only article is a mark": (f'<body><div>Hi</div><div class="side-story">{STORY}</div></body>', TEXT),
    "classes of the article are marks": (f'<body><div class="post banner-free related-work">{STORY}</div></body>', TEXT),
    "article in an aside": (f"<body><div>Hi there</div><aside>{STORY}</aside></body>", TEXT),
    "page in a form": (f'<body><form id="aspnetForm"><div class="nav">{MENU}</div><div>{STORY}</div></form></body>', TEXT),
    "menus in main": (f'<body><main><div class="x"><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></div><div><a href=4>Four</a></div><div><a href=5>Five</a></div>{STORY}<div><a href=6>Older</a> <a href=7>Newer</a></div></main></body>', TEXT),
    "divs only": (f'<body><div id="top">Site name</div>{MENU}<div class="story"><h1>The title</h1>{STORY}<h2>Part two</h2><p>Short.</p><ul><li>one item</li><li>another</li></ul><p>{P[4]}</p></div><div class="sidebar"><p>Buy this, now. It is good.</p></div><div class="footer">All rights reserved, by us. Call us.</div></body>', f"The title\n\n{TEXT}\n\nPart two\n\nShort.\n\none item\n\nanother\n\n{P[4]}"),
    "sections": (f'<body><nav>{MENU}</nav><div class="s"><p>{P[0]}</p></div><div class="s"><h3>Short part</h3><p>Tiny.</p></div><div class="s"><p>{P[1]}</p></div></body>', f"{P[0]}\n\nShort part\n\nTiny.\n\n{P[1]}"),
    "promotion inside": (f'<article><h1>T</h1><p>{P[0]}</p><div class="promo"><p>Subscribe now, it is cheap.</p></div><p>{P[1]}</p><div class="share"><a href=1>Share</a></div></article>', f"T\n\n{P[0]}\n\n{P[1]}"),
    "comments as long as the article": (f'<article><h1>T</h1>{STORY}<div id="comments">{STORY}{STORY}</div></article>', f"T\n\n{TEXT}"),
    "header of the article": (f"<header><p>Site, of ours.</p></header><article><header><h1>T</h1><p>By A. Writer</p></header>{STORY}</article>", f"T\n\nBy A. Writer\n\n{TEXT}"),
    "headings before": (f"<body><div class=nav>{MENU}</div><h1>Title here</h1><div><p>{P[0]}</p><p>{P[1]}</p></div></body>", f"Title here\n\n{P[0]}\n\n{P[1]}"),
    "odd quotes": (f'<article><p title="5" tall">{P[0]}</p><p class=\'a">b\'>{P[1]}</p></article>', f"{P[0]}\n\n{P[1]}"),
    "other script": ("<nav><a href=1>首页</a></nav><div class=c><p>今天天气很好，我们去公园。很多人在那里。</p><p>他们说：明天也好。</p></div><footer>版权</footer>", "今天天气很好，我们去公园。很多人在那里。\n\n他们说：明天也好。"),
    "one div": ("<body><div><p>Only text, in a div.</p><p>More text.</p></div><aside>no</aside>", "Only text, in a div.\n\nMore text."),
    "cut off": ("<article><p>cut &am", "cut &am"),
    "cut off in a tag": ("<article><p>cut here. <a hr", "cut here."),
    "unclosed inline": ("<article><h1>Ab.</h1><p><b>Ab.<br><p>Cd, ef.</p></article><div class=ad>In in oredble ea.</div>", "Ab.\n\nAb.\n\nCd, ef."),
    "short article, long advert": ("<body><nav><a href=1>x</a></nav><div class=ad>Nicht aulich für sch erüver enau sch der.</div><article><h1>Be.</h1><p>Be.</p></article><footer>&copy; m.example.net &middot; Ist der die einütz eine von.</footer>", "Be.\n\nBe."),
    "link in a paragraph": (f"<article><p>{P[0]}</p><p><a href=1>The whole report</a></p><p>{P[1]}</p></article>", f"{P[0]}\n\nThe whole report\n\n{P[1]}"),
    "list of sources": (f'<nav>{MENU}</nav><article><p>{P[0]}</p><p>{P[1]}</p><ul><li><a href=1>First source</a></li><li><a href=2>Second source</a></li></ul></article>', f"{P[0]}\n\n{P[1]}\n\nFirst source\n\nSecond source"),
    "marked list of links": (f'<article><p>{P[0]}</p><p>{P[1]}</p><ul class="related"><li><a href=1>Another story</a></li><li><a href=2>One more</a></li></ul></article>', f"{P[0]}\n\n{P[1]}"),
    "correction and quotation": (f'<article><p>{P[0]}</p><p class="notice">Correction: it was nine.</p><blockquote class="related-quote">They said so, twice.</blockquote><p class="advert">Buy this.</p><p>{P[1]}</p></article>', f"{P[0]}\n\nCorrection: it was nine.\n\nThey said so, twice.\n\n{P[1]}"),
    "short article, long aside": (f"<article><h1>T</h1><p>It is so, they say.</p></article><aside>{STORY}</aside>", "T\n\nIt is so, they say."),
    "article of links only, story in a marked div": (f'<article><a href=1>Read on</a></article><div class="side-story">{STORY}</div>', TEXT),
    "menu only": ("<nav>a</nav>", ""),
    "links only": (f"<body>{MENU}</body>", ""),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layout(name):
    page, want = LAYOUTS[name]
    assert html_text.main_text(page) == want


def test_no_page():
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p>") == ""


def test_precision_and_recall():
    """Words of the article element of every page, found without the operator's reader."""
    import pandas as pd

    right = found = wanted = 0
    for page in pd.read_parquet("/root/testdata/sf0.01/pages.parquet").html:
        article = re.search(r"<article>(.*?)</article>", page, re.S)
        want = Counter(entities.unescape(re.sub(r"<[^>]*>", " ", article[1])).split() if article else ())
        got = Counter(html_text.main_text(page).split())
        right, found, wanted = right + sum((want & got).values()), found + sum(got.values()), wanted + sum(want.values())
    assert right >= 0.99 * found and right >= 0.99 * wanted


def brute_scores(blocks):
    """Fused ratios of (path, text, linked, factor) blocks by the definition."""
    n = len(blocks)
    length, signs = [], []
    for path, *_ in blocks:
        same = [b for b in blocks if b[0] == path]
        length.append(sum(max(0, len(t) - 2 * k) for _, t, k, _ in same) / len(same))
        signs.append(sum(sum(c in ".,;:!?…。，、；：！？" for c in t) for _, t, k, _ in same if 2 * k < len(t)) / len(same) + 0.5)
    weight = [math.exp(-0.5 * d * d) for d in range(-2, 3)]
    smooth = lambda r, i: sum(w * r[min(max(i + d, 0), n - 1)] for d, w in zip(range(-2, 3), weight)) / sum(weight)
    return [f * length[i] ** 0.6 * smooth(length, i) ** 0.4 * signs[i] ** 0.6 * smooth(signs, i) ** 0.4 for i, (*_, f) in enumerate(blocks)]


def test_ratios_by_brute_force():
    page = html_text.read_page("<body><div class=a1><h1>Head</h1><p>One, two.</p><p>Three <a>four five</a>.</p></div><div class=a2><p>Six.</p></div><nav><ul><li><a>seven, eight</a></li></ul></nav></body>")
    blocks = [("body/a/h1", "Head", 0, 1), ("body/a/p", "One, two.", 0, 1), ("body/a/p", "Three four five.", 9, 1), ("body/a/p", "Six.", 0, 1), ("nav/li", "seven, eight", 12, 0.05)]
    assert page.text == [b[1] for b in blocks] and page.linked == [b[2] for b in blocks]
    assert html_text.scores(page).tolist() == pytest.approx(brute_scores(blocks))


def test_deep_nesting_takes_linear_time():
    def seconds(depth):
        began = time.perf_counter()
        assert html_text.main_text("<div>" * depth + f"<p>{P[0]}</p>" + "<ul><p>x</b></i>" * depth + "</div>" * depth).startswith(P[0])
        return time.perf_counter() - began

    seconds(100)
    assert seconds(8000) < 20 * seconds(1000) + 0.2


def test_pages(spark):
    from pyspark.sql import functions as F

    long = "<article>" + "".join(f"<p>{LONG}{i}</p>" for i in range(12000)) + "</article>"  # over 1 MiB
    rows = spark.createDataFrame([(1, "u", PAGE), (None, None, None), (1, "u", PAGE), (2, "", long), (3, "v", "")], "page_id long, url string, html string")
    got = html_text.html_text(rows.withColumns({"text": F.lit("own"), "n_chars": F.lit(-1), "path": F.lit(0)})).collect()
    assert len(long) > 1 << 20 and [r.page_id for r in got] == [1, None, 1, 2, 3]
    assert got[0] == got[2] and got[1].n_chars == got[4].n_chars == 0 and all(r.n_chars == len(r.text) for r in got)
    assert got[3].text.count("\n\n") == 11999
    assert html_text.html_text(rows.limit(0)).count() == 0
