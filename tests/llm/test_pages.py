"""Archives, captures, main text and vector search against plain versions."""

from __future__ import annotations

import random
import time

import brute
import pytest

from mapledger.llm import html_extract, topk, warc

PAGES = "page_id long, url string, html string"


def test_captures(engine, rows, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_LINES", 20)
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    rng = random.Random(1)
    pages = [(i, f"https://h{rng.randrange(4)}.example.org/{rng.randrange(9)}?q={i % 3}", f"<p>{rng.randrange(30)}</p>\r\n\r\nWARC/1.1\r\n") for i in range(90)]
    pages += [(100, None, None), (101, "no host", ""), (None, "http://x.org/", "<p>1</p>"), (None, "http://x.org/", "only null"), pages[4]]
    pages += [(200 + i, "http://hot.example.org/", "hot " * 1000) for i in range(40)] + [(300, "http://odd.org/a\r\nb: c", "ü" * 10)]
    got = rows(warc.capture_report(engine.createDataFrame([(*p, 1) for p in pages], PAGES + ", key int")))
    assert got == brute.capture(pages)


def test_look_up(engine):
    pages = [(i, f"https://a{i % 7}.example.org/{i}", f"page {i}") for i in range(50)]
    path, captures = warc.write_archives(engine.createDataFrame(pages, PAGES))
    shards = warc.write_index(path, captures)
    asked = engine.createDataFrame([("org,example,a3)/3",), ("org,example,a3)/3",), ("org,none)/",), (None,)], "key string")
    found = warc.look_up(path, shards, asked).collect()
    assert [(r.page_id, r.type, bytes(r.payload)) for r in found] == [("3", "response", b"page 3")]


def test_small_payloads_are_not_revisited(engine):
    pages = engine.createDataFrame([(1, "http://a/", "x"), (2, "http://b/", "x"), (3, "http://c/", "xyz"), (4, "http://d/", "xyz")], PAGES)
    path, captures = warc.write_archives(pages, least_bytes=2)
    found = warc.look_up(path, warc.write_index(path, captures), captures).collect()
    assert {r.page_id: r.type for r in found} == {"1": "response", "2": "response", "3": "revisit", "4": "response"}


def test_no_pages(engine):
    none = engine.createDataFrame([], PAGES)
    assert warc.capture_report(none).count() == 0
    assert html_extract.text_report(none).count() == 0


TEXTS = [
    (None, ""), ("", ""), ("<p></p><script>var a='<p>x</p>'</script>", ""), ("plain &amp; simple", "plain & simple"),
    ("<nav>menu</nav><article><h1>T&eacute;st</h1><p>one\n two<p><b>three</b><br>four<div class='ad'>buy</div></article><footer>f</footer>", "Tést\n\none two\n\nthree four"),
    ("<main><header><h1>Title</h1></header><p>a<!-- <p>no</p> -->b</p><aside>side</aside><form><p>mail</p></form><section id=comments><p>me too</p></section></main>", "Title\n\nab"),
    ("<header>top</header><div id='content'><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></div><div class='cookie-notice'>ok?</div>", "x\n\ny\n\n1\n\n2"),
    ("<article><p>5 &lt; 6 & 7 > 3</p><pre>a\n\tb</pre><p hidden>no</p></article>", "5 < 6 & 7 > 3\n\na b"),
    ("<body class=has-sidebar><form><input><main class='with-ads'><p>in a form</p><article class=comment>no</article></main></form>", "in a form"),
    ("<article><div class=article-header><h1>T</h1></div><p>a</p><div class='post-footer share'>s</div></article><div class=comments><article>c</article></div>", "T\n\na"),
    ("<article><p title='a>b'>q</p><p>un<i>cl</i>osed", "q\n\nunclosed"),
]


@pytest.mark.parametrize(("html", "text"), TEXTS)
def test_main_text(html, text):
    assert "\n\n".join(t for t, _ in html_extract.parse(html or "")[0]) == text


def test_site_templates(engine):
    """Subtrees on many pages of a host go; an article's recurring paragraphs, and other hosts' pages, stay."""
    pages = [(i, f"https://one.org/{i}", f"<div><p>Welcome to one</p><p>Log in</p></div><div><p>story {i}</p></div>") for i in range(10)]
    pages += [(20 + i, f"https://two.org/{i}", f"<article><p>Same words</p><p>story {i}</p></article>") for i in range(10)]
    pages += [(40, "https://three.org/", "<div><p>Welcome to one</p><p>Log in</p></div><p>x</p>"), (41, None, "<p>y</p>")]
    frame = engine.createDataFrame([(*p, "old", 1) for p in pages], PAGES + ", text string, host int")
    got = {r.page_id: r.text for r in html_extract.main_text(frame).collect()}
    assert got[3] == "story 3" and got[25] == "Same words\n\nstory 5"
    assert got[40] == "Welcome to one\n\nLog in\n\nx" and got[41] == "y"


def test_templates_around_and_inside_articles(engine):
    """Counts decide inside and outside articles: containers on many pages go; paragraphs, other text outside an
    article, and what holds a whole article, stay."""
    page = "<div>Welcome</div><div><article><h1>T{i}</h1><div><p>Read our terms</p></div><p>Same words</p><p>story {i}</p></article></div><div>Added on day {i}</div>"
    pages = [(i, f"https://one.org/{i}", page.format(i=i)) for i in range(6)]
    pages += [(20 + i, f"https://two.org/{i}", f"<p>day {i}</p><main><div><p>all</p><p>of it</p></div></main>") for i in range(6)]
    pages += [(40, "https://three.org/", page.format(i=1))]
    got = {r.page_id: r.text for r in html_extract.main_text(engine.createDataFrame(pages, PAGES)).collect()}
    assert got[3] == "T3\n\nSame words\n\nstory 3\n\nAdded on day 3"
    assert got[25] == "day 5\n\nall\n\nof it"
    assert got[40] == "Welcome\n\nT1\n\nRead our terms\n\nSame words\n\nstory 1\n\nAdded on day 1"


def test_copies_and_large_hosts(engine):
    """Copies of a page count once, a whole page is no template, and a notice goes on hosts of any size."""
    story = "<body><div>Log in</div><div><p>The only story</p><p>of this host</p></div></body>"
    pages = [(i, f"https://copies.org/{i}", story) for i in range(5)]
    pages += [(10 + i, f"https://whole.org/{i}", f"<div><p>same</p></div>{'<p>more</p>' * (i > 2)}") for i in range(4)]
    pages += [(100 + i, f"https://large.org/{i}", f"{'<div>Notice</div>' * (i < 4)}<div>story {i}</div>") for i in range(400)]
    got = {r.page_id: r.text for r in html_extract.main_text(engine.createDataFrame(pages, PAGES)).collect()}
    assert {got[i] for i in range(5)} == {"Log in\n\nThe only story\n\nof this host"}
    assert got[10] == "same" and got[13] == "same\n\nmore"
    assert got[102] == "story 2" and got[499] == "story 399"


KEPT = [
    "<h2 id='related-work'>k</h2>", "<section id='social-history'><p>k</p></section>", "<p class='alert'>k</p>", "<section id='search'><p>k</p></section>",
    "<div class='search-results'>k</div>", "<div class='no-ads with-sidebar'>k</div>", "<ul id='share'><li class='promo'>k</ul>",
]
LEFT_OUT = ["<div class='ad box'>x</div>", "<section id='comments'><h2>Comments</h2></section>", "<div role='complementary'>x</div>", "<div hidden>x</div>"]


@pytest.mark.parametrize(("part", "text"), [(p, "a\n\nk\n\nb") for p in KEPT] + [(p, "a\n\nb") for p in LEFT_OUT])
def test_names_inside_an_article(part, text):
    assert "\n\n".join(t for t, _ in html_extract.parse(f"<article><p>a</p>{part}<p>b</p></article>")[0]) == text


@pytest.mark.parametrize(("html", "blocks"), [
    ("<a " * 350_000, 1), ("<a " * 350_000 + ">", 0), ("<div>x" * 50_000, 50_000), ("<div>" * 50_000 + "</b>" * 50_000 + "x", 1), ("<![CDATA[" * 100_000 + "x>", 0),
    ("<a \"'>x" * 100_000, 1), ("<!-- <p>" * 100_000, 0), ("<p>x" * 100_000, 100_000), ("<" * 500_000, 1), ("<b>" * 20_000 + "<div>x</div>" * 20_000, 20_000),
])
def test_odd_pages_take_time_by_their_length(html, blocks):
    start = time.time()
    assert len(html_extract.parse(html)[0]) == blocks
    assert time.time() - start < 20


def test_templates_against_plain_counts(engine):
    """Random pages of three hosts, whose recurring parts only counts can tell: every deletion against a plain counter."""
    draw = random.Random(11)
    parts = ["<div>Subscribe to us</div>", "<div><p>Log in</p><p>Sign up</p></div>", "<section><p>Terms</p></section>", "<div><div>Deep</div></div>", "<p>Same words</p>"]
    pages = []
    for i in range(240):
        own = [draw.choice(parts) for _ in range(draw.randint(0, 4))] + [f"<p>story {draw.randint(0, 40)}</p>" for _ in range(draw.randint(1, 3))]
        draw.shuffle(own)
        body = "".join(own)
        pages.append((i, f"https://h{i % 3}.org/{i}", f"<article>{body}</article>" if i % 2 else f"<body>{body}</body>"))
    got = {r.page_id: r.text for r in html_extract.main_text(engine.createDataFrame(pages, PAGES)).collect()}
    want, deleted = brute.main_texts(pages, html_extract.parse)
    assert got == want
    assert deleted > 200


@pytest.mark.parametrize("html", ["<p>a</p><div>b</div>", "<div>x</div><article><p>b</p></article>"])
def test_content_of_a_page(html):
    same = html_extract.parse(html.replace("x", "y"))[1]
    assert html_extract.parse(html)[1] == same != html_extract.parse(html.replace("b", "c"))[1]


def vectors(n: int, width: int) -> list[tuple]:
    rng = random.Random(8)
    rows = [(i, [round(rng.gauss(0, 0.3), 3) for _ in range(width)]) for i in range(n)]
    rows += [(n + i, rows[7][1]) for i in range(12)]
    return rows + [(1050, None), (None, [0.1] * width), (1051, [None] + [0.1] * (width - 1)), (1052, [float("inf")] + [0.0] * (width - 1)), (1100, [float("nan")] * width)]


@pytest.mark.parametrize("stripe", [16_384, 50])
def test_top_k(engine, rows, monkeypatch, stripe):
    monkeypatch.setattr(topk, "STRIPE", stripe)
    monkeypatch.setattr(topk, "BLOCK", 4)
    given = vectors(500, 6)
    frame = engine.createDataFrame([(*r, 1) for r in given], "vec_id long, embedding array<float>, stripe int")
    assert sorted(map(tuple, topk.topk_report(frame).collect())) == brute.top_k(given)


def test_top_k_of_few(engine):
    shape = "vec_id long, embedding array<float>"
    assert topk.topk_report(engine.createDataFrame([], shape)).count() == 0
    assert topk.topk_report(engine.createDataFrame([(50, [1.0])], shape)).count() == 0
    assert sorted(map(tuple, topk.topk_report(engine.createDataFrame([(50, [1.0]), (51, [0.0])], shape)).collect())) == [(50, 1, 51, 0)]
