"""Operator 2: whole pages by structure, boilerplate by suffix arrays, arrays against counting."""

import random
import time
from collections import defaultdict

import numpy as np
import pytest

from acreage.llm.html_text import main_text, page_blocks, shared_runs
from tests.llm.conftest import frame

SHAPE = "page_id bigint, url string, html string, id string, host string, key int, text string, tokens int"


def _pages(spark, rows):
    return frame(spark, [(*r, "x", "x", 1, "x", 1) for r in rows], SHAPE)


def _text(html):
    return "\n\n".join(t for t, kind in page_blocks(html) if kind == 2)


ARTICLE = "<article><h1>Title</h1><p>One  &amp;\n two&nbsp;<b>bold</b> x<i>y</i>z.</p><p>Next<br>line</p></article>"


@pytest.mark.parametrize("extra", [
    "<nav><ul><li><a href='/x'>Menu</a></li></ul></nav>", "<header>Site <h1>name</h1></header>", "<footer><p>&copy; x</p></footer>",
    "<aside>Side</aside>", "<div class='ad-banner'>Buy</div>", "<div id=cookieNotice><p>Cookies</p></div>", "<form><label>Mail</label><input></form>",
    "<script>var t='<p>no</p>';</script>", "<style>p{margin:0}</style>", "<!-- <p>comment</p> -->", "<div class=\"comments\"><article><p>first!</p></article></div>",
    "<section id='reader-comments'><p>nice</p></section>", "<div role='navigation'>Go</div>", "<noscript>Enable</noscript>", "<div hidden>secret</div>",
    "<template><p>t</p></template>", "<select><option>a<option>b</select>", "<p>loose</p>", "<div class='sidebar widget'><p>w</p></div>", "<svg><text>v</text></svg>",
])
def test_what_surrounds_an_article_is_dropped(extra):
    want = "Title\n\nOne & two bold xyz.\n\nNext line"
    for html in (f"<html><head><title>t</title></head><body>{extra}{ARTICLE}{extra}</body></html>", ARTICLE + extra, extra + ARTICLE):
        assert _text(html) == want
    inside = ARTICLE.replace("</article>", extra + "</article>")
    if "loose" not in extra and "<header" not in extra:
        assert _text(f"<body>{inside}</body>") == want


@pytest.mark.parametrize("html, want", [
    ("<body><article id='ad-hoc-networks'><p>One</p></article><div>x</div>", ["One"]),
    ("<body><div class='page menu-open'><p>Two</p><nav>a</nav></div>", ["Two"]),
    ("<body><form id='aspnetForm'><nav>n</nav><article><h1>T</h1><p>Three</p><form>f</form></article></form>", ["T", "Three"]),
    ("<body><div class='page nav'><div><article><p>In</p><div class='comments'>c</div></article><div>o</div></div></div>", ["In"]),
    ("<body><article><div class='article-header'><h1>H</h1></div><section id='social-history'><p>S</p></section><section id='comments'>c</section></article>", ["H", "S"]),
    ("<body><article class='teaser'>t</article><div class='content'>Main text</div>", ["Main text"]),
    ("<body><aside><article>t</article></aside><div>Main text</div>", ["Main text"]),
    ("<body><div class='related'><article>t</article></div><div>Main text</div>", ["Main text"]),
])
def test_names_drop_no_article(html, want):
    assert [t for t, kind in page_blocks(html) if kind] == want


def test_unmatched_end_tags_cost_no_walk():
    n = 50_000
    start = time.monotonic()
    assert page_blocks("<span>" * n + "x" + "</b>" * n) == [("x", 1)]
    assert page_blocks("<i><article>" + "<span>" * n + "x" + "</i>" * n) == [("x", 2)]
    assert time.monotonic() - start < 20


def test_broken_markup():
    assert _text("<article><p><b>One.<br><p>Two</p><ul><li>a<li>b</ul><div>c</article><p>out") == "One.\n\nTwo\n\na\n\nb\n\nc"
    assert _text("<article>a &lt;b&gt; &#233;&#x6f22; &am &unknown; &amp") == "a <b> é漢 &am &unknown; &"
    assert _text("</p></article><article>x</nav>y</article>") == "xy"
    assert _text("<main><p>m</p></main><p>out</p>") == "m" and _text("<div class='post-content'><p>m</p></div><p>o</p>") == "m"
    assert _text("<article><table><tr><td>a<td>b<tr><td>c</table></article>") == "a\n\nb\n\nc"
    assert [page_blocks(h) for h in (None, "", "<p>", "<", "<article></article>")] == [[]] * 2 + [[], [("<", 1)], []]


def _brute(tokens, owner, run, least):
    pages = defaultdict(set)
    where = defaultdict(list)
    for i in range(len(tokens) - run + 1):
        if owner[i] == owner[i + run - 1]:
            key = tuple(tokens[i : i + run])
            pages[key].add(owner[i])
            where[key].append(i)
    return sorted(i for key, at in where.items() if len(pages[key]) >= least for i in at)


def test_suffix_array_finds_every_shared_run():
    draw = random.Random(1)
    for _ in range(60):
        counts = [draw.randrange(0, 40) for _ in range(draw.randrange(1, 8))]
        tokens = np.array([draw.randrange(3) for _ in range(sum(counts))], dtype=np.uint32)
        owner = np.repeat(np.arange(len(counts)), counts)
        for run, least in ((2, 2), (4, 3), (8, 2)):
            assert sorted(shared_runs(tokens, owner, run, least).tolist()) == _brute(tokens.tolist(), owner.tolist(), run, least)


def test_hosts_tell_loose_blocks(spark):
    shared = "this notice stands on every single page of our host and says nothing"
    rows = [(i, f"https://A.example:80/{i}", f"<body><p>{shared}</p><p>own words of page {i} with number {i * 7}</p><p>{shared}</p></body>") for i in range(1300)]
    rows += [(5000, "https://b.example/", f"<body><p>{shared}</p></body>"), (5001, None, None), (5002, None, ""), (None, "no url", f"<p>{shared}</p>")]
    rows += [(6000 + i, "https://c.example/", f"<article><p>{shared}</p></article>") for i in range(3)]
    rows += [rows[1303]] * 2
    got = main_text(_pages(spark, rows)).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    by = {r["page_id"]: r for r in got}
    assert all(by[i]["text"] == f"own words of page {i} with number {i * 7}" for i in range(1300))
    assert by[5000]["text"] == shared and by[5001]["text"] == by[5002]["text"] == "" and by[6000]["text"] == shared
    assert by[6000]["n_repeated"] == by[6000]["n_tokens"] == 13 and by[5000]["n_repeated"] == 0
    assert main_text(_pages(spark, [])).count() == 0


def test_a_long_page_and_the_join_for_many_runs(spark, monkeypatch):
    long = " ".join(f"w{i}" for i in range(60_000))
    shared = "eight words that two pages of it share"
    rows = [(1, "http://h/1", f"<p>{long}</p><p>{shared}</p>"), (2, "http://h/2", f"<p>{shared}</p><p>two</p>"), (3, "http://g/2", f"<p>{shared}</p>")]
    want = {1: long, 2: "two", 3: shared}
    assert {r["page_id"]: r["text"] for r in main_text(_pages(spark, rows)).collect()} == want
    monkeypatch.setattr("acreage.llm.html_text.BROADCAST_ROWS", -1)
    assert {r["page_id"]: r["text"] for r in main_text(_pages(spark, rows)).collect()} == want
