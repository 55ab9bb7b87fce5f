from __future__ import annotations

from llm_support import documents, sf_dir, workers  # noqa: F401

import random

import pytest

from pitlake.llm import html
from pitlake.llm.html import extract, main_text, report

ARTICLE = "Once, there was a long paragraph, with commas, and enough text to count as prose, more or less. " * 3


def test_boilerplate_goes_and_text_stays():
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body>
      <header>Site name</header><nav><ul><li><a href=/>Home</a></li></ul></nav><!-- note <p>no</p> -->
      <div class="cookie-notice">We use cookies, really, a lot, you know.</div><div class="ad">Buy, now, please</div>
      <article><h1>Title</h1><p>{ARTICLE}<p>Fish &amp; ch<b>ips</b>,&nbsp;nice<br>here</p>
      <form><p>Your, name, please</p></form><script>var a = "</p>";</script>
      <section id="comments"><p>First, nice, post, indeed, yes</p></section></article>
      <aside><p>Related, things, and, more, things</p></aside><footer>c</footer></body></html>"""
    assert main_text(page) == f"Title {ARTICLE.strip()} Fish & chips, nice here"


def test_best_container_without_article_element():
    page = f"""<body><div id="menu"><a href=1>a</a></div><div id="page"><div class="links"><p><a href=1>{ARTICLE}</a></p></div>
      <div class="story"><p>{ARTICLE}</p><p>Short end.</p></div></div>"""
    assert main_text(page) == f"{ARTICLE.strip()} Short end."


def test_broken_markup():
    assert main_text("<article><p><b>Bold<br><p>Next, one<p>Last</article><footer>x") == "Bold Next, one Last"
    assert main_text("a < b & c &lt; d") == "a < b & c < d"
    assert main_text("<article><p>open <a href='x>y'>link</a> &#65;&unknown;") == "open link A&unknown;"
    assert main_text("</div></p><article><ul><li>one<li>two</ul><p>end") == "one two end"


def test_nothing_there():
    for page in (None, "", "  ", "<p>", "<!-- x", "<div class='ad'>x</div>", "<script>x"):
        assert main_text(page) == ""


def test_deep_and_long_pages():
    assert main_text("<div>" * 5000 + "<p>deep, text, here</p>") == "deep, text, here"
    words = " ".join(str(k) for k in range(50_000))
    assert main_text(f"<article><p>{words}</p></article>") == words


def test_frames(spark):
    rows = [(1, "u", "<p>x, y</p>", "k"), (None, None, None, None), (1, "u", "<p>x, y</p>", "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in report(pages).collect()]
    assert sorted(got, key=str) == sorted([(1, "u", "x, y", 4), (None, None, "", 0), (1, "u", "x, y", 4)], key=str)
    assert report(pages.limit(0)).count() == 0
    assert extract(pages).columns == [*pages.columns, "main_text"]
    with pytest.raises(ValueError):
        extract(pages, out="text")


def test_references_are_decoded_within_their_text():
    assert main_text("<article><p>&am<b>p;</b> &lt;b&gt; &am<!-- x -->p;") == "&amp; <b> &amp;"


def test_link_lists_and_prose_are_not_dropped_by_looks_or_part_of_a_name():
    prose = "Then people lived here, and worked, and left again. " * 5
    page = f"""<article><p>{ARTICLE}</p><ul><li><a href=1>Smith, a paper on long matters</a><li><a href=2>Jones, another</a></ul>
      <div class="social-history">{prose}</div><div class="social-share">Share this</div><ul><li><a href=3>One</a><li><a
      href=4>Two</a><li><a href=5>Three</a></ul><div class="cookie-history">{prose}</div><p>End, at last.</p></article>"""
    assert main_text(page) == f"{ARTICLE.strip()} Smith, a paper on long matters Jones, another {prose.strip()} End, at last."


@pytest.mark.parametrize("page", [
    "<div>some text, with commas, and enough of it to count" * 50_000, "<div>" * 50_000 + "</p>" * 50_000 + "x",
    "<ul><li>" * 20_000 + "<p>deep", "<li><div>" * 20_000 + "y", "<header>" * 20_000 + "z", "<b>" * 50_000 + "</i>" * 50_000 + "w",
])
def test_nesting_of_any_depth_takes_linear_time(page):
    import time

    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 20


def test_scores_equal_their_definition():
    """Points are counted for every pair of a holder and an ancestor."""
    rng = random.Random(4)
    for _ in range(60):
        page = ""
        for _ in range(rng.randrange(1, 60)):
            page += rng.choice(["<div>", "</div>", "<p>", "</p>", "<section>", "<a href=1>", "</a>", "<b>", "</b>", "<li>"])
            page += rng.choice(["", "a few words, or so", "more, words, of text, " * rng.randrange(1, 20)])
        every = html.parse(page)
        html.measure(every)
        elements = list(html.walk(every[0]))
        html.measure(elements)
        html.score(elements)

        def texts(one, linked=False):
            for c in one.children:
                if isinstance(c, str):
                    yield linked or one.tag == "a", len(c.strip())
                else:
                    yield from texts(c, linked or one.tag == "a")

        def density(one):
            told = list(texts(one))
            return sum(n for by_link, n in told if by_link) / (sum(n for _, n in told) or 1)

        def points(one):
            own = "".join(
                c if isinstance(c, str) else "".join(x for x in c.children if isinstance(x, str))
                for c in one.children if isinstance(c, str) or c.tag in html.INLINE
            ).strip()
            if not own or one.tag in html.INLINE or not (one.tag in html.PARAGRAPHS or len(own) >= 25):
                return 0
            return (1 + own.count(",") + min(len(own) / 100, 3)) * (1 - density(one))

        want = {id(e): 0.0 for e in elements}
        for one in elements:
            above, share = one.parent if one.tag in html.PARAGRAPHS else one, 1
            while above is not None:
                want[id(above)] += points(one) * share
                above, share = above.parent, share / 2
        for one in elements:
            assert one.score == pytest.approx(want[id(one)] * (1 - density(one)))
