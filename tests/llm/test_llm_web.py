"""Revisits and main text of pages."""

import html as entities
import random
import re
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from logmetrics.llm import html, warc
from logmetrics.llm.queries import op10_html_text

START = datetime(2024, 1, 1)


@pytest.fixture
def records(spark):
    def make(*rows):
        return spark.createDataFrame(
            [(i, u, None if t is None else START + timedelta(hours=t), s, h, d) for i, u, t, s, h, d in rows], warc.CAPTURE
        )

    return make


def resolved(records, **options):
    return {r.record_id: r for r in warc.resolve_revisits(records, **options).collect()}


def test_validators_and_headers(records):
    url = "http://Example.com:80/a/?b=2&a=1&utm_source=x#top"
    got = resolved(records(
        (1, url, 0, 200, {"ETag": '"e1"', "Content-Type": "text/html", "Date": "d1"}, "body1"),
        (2, "https://www.example.com/a?a=1&b=2", 5, 304, {"etag": 'W/"e1"', "Date": "d2", "Server": "s"}, None),
        (3, url, 6, 304, {"ETag": '"e2"'}, None),
        (4, url, 7, 304, {}, None),
        (5, url, 8, 304, None, None),
        (6, url, -1, 304, {"ETag": '"e1"'}, None),
        (7, "http://example.com/other", 9, 304, {"ETag": '"e1"'}, None),
        (8, None, 9, 304, {}, None), (9, url, None, 304, {}, None), (10, url, 9, 500, {}, None),
    ))
    assert {k: r.outcome for k, r in got.items()} == {
        2: "resolved", 3: "changed", 4: "unvalidated", 5: "unvalidated", 6: "orphan", 7: "orphan", 8: "orphan", 9: "orphan",
    }
    assert (got[2].response_id, got[2].digest) == (1, "body1")
    assert got[2].headers == {"etag": 'W/"e1"', "content-type": "text/html", "date": "d2"}
    assert got[3].response_id is None and got[3].headers is None
    assert got[2].url_key == "example.com/a?a=1&b=2"


def test_modification_time_where_no_tag(records):
    got = resolved(records(
        (1, "http://a.b/", 0, 200, {"Last-Modified": "t1"}, "x"), (2, "http://a.b", 1, 304, {"last-modified": "t1"}, None),
        (3, "http://a.b", 1, 304, {"last-modified": "t2"}, None),
    ))
    assert (got[2].outcome, got[3].outcome) == ("resolved", "changed")


def test_ties_take_the_greatest_id(records):
    got = resolved(records((1, "http://a.b/", 0, 200, {}, "x"), (2, "http://a.b/", 0, 200, {}, "y"), (0, "http://a.b/", 0, 304, {}, None)))
    assert got[0].response_id == 2


@pytest.mark.parametrize("span", [3600, 86_400, 10**9])
def test_one_hot_url_against_brute_force(records, span):
    pick = random.Random(2)
    rows = [(i, f"http://h.x/{pick.choice(('', '', 'p', 'q'))}", pick.randrange(200), pick.choice((200, 200, 304)), {}, f"d{i}") for i in range(400)]
    got = resolved(records(*rows), span_seconds=span)
    for i, u, t, s, _, _ in rows:
        if s == 304:
            before = [(x[2], x[0]) for x in rows if x[3] == 200 and x[1] == u and x[2] <= t]
            assert got[i].response_id == (max(before)[1] if before else None)


def test_no_records(records, spark):
    empty = spark.createDataFrame([], warc.CAPTURE)
    assert warc.resolve_revisits(empty).collect() == []
    extra = records((1, "http://a.b/", 0, 200, {}, "x"), (2, "http://a.b/", 1, 304, {}, None)).withColumns({"outcome": F.lit("z"), "span": F.lit(1)})
    assert warc.resolve_revisits(extra).first().outcome == "unvalidated"


def test_no_window_over_a_whole_url(spark):
    from logmetrics.llm.queries import captures

    plan = warc.resolve_revisits(captures(spark.read.parquet(f"{DATA}/pages.parquet")))._jdf.queryExecution().executedPlan().toString()
    inside = [line for line in plan.split("\n") if re.match(r"[\s+:-]*\(?\d*\)? ?Window", line)]
    assert any("span" in line.split("], [")[1] for line in inside if "last(body" in line)


@pytest.mark.parametrize("url, key", [
    ("HTTP://User@WWW.Example.COM:443/Path/", "example.com/Path"), ("https://a.b?sid=1&x=", "a.b?x="), (" http://a.b/#f ", "a.b"),
    ("not a url", "not a url"), ("", ""), (None, None), ("http://a.b/?b&a", "a.b?a&b"),
])
def test_canonical_url(spark, url, key):
    assert spark.createDataFrame([(url,)], "u string").select(warc.canonical_url(F.col("u"))).first()[0] == key


def text_of(page):
    return html.main_text(page, html.default_tree())


def test_pages_against_their_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    rows = op10_html_text(spark, DATA).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        pieces = re.split(r"</?(?:p|h1)>|<br>", article)
        want = [" ".join(entities.unescape(re.sub("<[^>]*>", "", p)).split()) for p in pieces]
        assert r.text == "\n".join(w for w in want if w)
        assert r.n_chars == len(r.text)


BODY = "<article><h1>A title</h1><p>First  words\n&amp; more.</p><p>Second <b>bold</b> text with a <a href='#'>link</a>.</p><p>End.</p></article>"
WANT = "A title\nFirst words & more.\nSecond bold text with a link.\nEnd."


@pytest.mark.parametrize("around", [
    "<nav><ul><li><a href='/'>Home</a><li><a href='/b'>About</a></ul></nav>", "<aside><p>Read this other story as well, it is long enough.</p></aside>",
    "<div class='cookie-banner'><p>We use cookies to improve the site for all of you.</p></div>", "<div class=ad>Buy now, it is cheap, only today!</div>",
    "<form action='/s'><label>Your mail address</label><input name=x><button>Send it</button></form>", "<footer><p>Copyright by all of us, since ever.</p></footer>",
    "<section id='comments'><h3>Comments</h3><p>What a good text, I have read it twice already.</p></section>", "<script>var a = '<p>not text</p>';</script>",
    "<style>p { margin: 0 }</style>", "<!-- <p>hidden</p> -->", "<header><h1>The site</h1><p>The best site of them all, every day.</p></header>",
    "<div role='navigation'><p>Somewhere else to go to</p></div>", "<noscript><p>Please turn scripts on for this page.</p></noscript>",
    "<div class='comment-list'><div class='comment'><p>Nice words, thank you for them, really.</p></div></div>",
])
def test_what_stands_around_goes(around):
    assert text_of(f"<html><head><title>T</title></head><body>{around}{BODY}</body></html>") == WANT
    assert text_of(f"<html><body>{BODY}{around}</body></html>") == WANT


SENTENCE = "The miller carried two sacks over the bridge before dawn and nobody in the village heard the wheels turn."
RIVER = "The river had risen in the night, and by noon the lower fields were one long sheet of grey water."
LINKS = "<div><a href='/a'>Home</a> <a href='/b'>News</a> <a href='/c'>Contact</a></div>"
BIG_MENU = "<div>" + " ".join(f"<a href='/{i}'>Section {i} pages</a>" for i in range(12)) + "</div>"
COOKIES = "<div><p>We use small files to remember your choices and to count visits. By going on you agree to our rules.</p></div>"
RIGHTS = "<div>&copy; 2024 River Press. All rights reserved. No part of this page may be copied without written leave.</div>"
STORY = ["The flood of that spring", SENTENCE, "Introduction", f"{RIVER} {SENTENCE}", "Then it ended.", "Two sacks lost", "One bridge gone", "A mill in ruins", RIVER]
STORY_HTML = "<h1>{}</h1><p>{}</p><h2>{}</h2><p>{}</p><p>{}</p><ul><li>{}</li><li>{}</li><li>{}</li></ul><p>{}</p>".format(*STORY)
POEM = ["Heron", "The moon is low", "and the reeds are still", "a heron stands", "upon the hill", "it does not move", "it does not call", "the night goes by", "and that is all"]


@pytest.mark.parametrize("page, want", [
    (LINKS + BIG_MENU + STORY_HTML + LINKS, STORY), (COOKIES + LINKS + STORY_HTML + LINKS + RIGHTS, STORY), (LINKS + STORY_HTML + LINKS + RIGHTS + COOKIES, STORY),
    (LINKS + "".join(f"<p>{x}</p>" for x in POEM) + LINKS, POEM), (LINKS + f"<p>{SENTENCE}</p>" + LINKS, [SENTENCE]), (f"<p>{SENTENCE}</p>", [SENTENCE]),
    (LINKS + f"<article><h1>Flood</h1><p>{SENTENCE}</p>{BIG_MENU}<p>{RIVER}</p></article>" + RIGHTS, ["Flood", SENTENCE, RIVER]), (STORY_HTML, STORY),
])
def test_densities_decide_where_no_name_helps(page, want):
    assert text_of(page).split("\n") == want


def test_a_heading_however_deep_is_one():
    assert html.blocks("<h2>" + "<span class=x>" * 9 + "Deep" + "</span>" * 9 + "</h2>")[0].heading


def test_labelled_pages_held_out():
    """Each labelled page judged by the tree of the others, in words."""
    kept = right = wanted = 0
    for i, page in enumerate(html.PAGES):
        found = html.blocks("".join(piece for piece, _ in page))
        words, label = np.array([b.words for b in found]), np.array([y for _, y in page if y >= 0])
        got = html.learn(html.PAGES[:i] + html.PAGES[i + 1 :]).keeps(html.features(found))
        kept, right, wanted = kept + words[got].sum(), right + words[got & (label == 1)].sum(), wanted + words[label == 1].sum()
    assert right / kept > 0.85 and right / wanted > 0.85


def test_page_without_helpful_names():
    long = "The ice came early that year and nobody in the whole village could remember anything like it at all. "
    page = f"<div><a href='/'>Home</a> <a href='/n'>News</a></div><div>{long}</div><div>{long * 2}</div><div><a href='/i'>Imprint</a></div>"
    assert text_of(page) == f"{long.strip()}\n{(long * 2).strip()}"


def test_broken_markup():
    assert text_of("<article><p><b>One<br><p>Two &lt;x&gt; &nbsp;y</article>") == "One\nTwo <x> y"
    assert text_of("<article><p>a < b and c > d</p></article>") == "a < b and c > d"
    for page in ("", None, "<", "<p", "</p></div>", "<script>x", "<!-- x", "<a href='x>y"):
        text_of(page)
    assert text_of("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert text_of("<article>" + "<a " * 50_000 + "</article>") is not None


def test_frame_words_do_not_hide_a_page():
    assert text_of(f"<body class='has-sidebar'><div class='layout with-sidebar'>{BODY}</div></body>") == WANT


def test_page_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>" + "long text of a page " * 20_000 + "</p>"), (4, "u", BODY), (4, "u", BODY)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    got = html.extract(pages).collect()
    assert len(got) == 5 and sorted(r.n_chars for r in got)[:2] == [0, 0]
    assert [r.text for r in got if r.page_id == 4] == [WANT, WANT]
    assert html.extract(pages.limit(0)).collect() == []


def test_the_tree_is_grown_from_its_table():
    tree = html.learn()
    assert {html.FEATURES[f] for f in tree.feature if f >= 0} >= {"around", "main", "words", "links", "stretch"}
    with pytest.raises(ValueError):
        html.learn([[("<p>a</p><p>b</p>", 1)]])


@pytest.mark.parametrize("start, end", [
    ("<article class='post type-post hentry category-privacy tag-social'>", "</article>"), ("<article class='privacy'>", "</article>"),
    ("<div class='content comments-open'>", "</div>"), ("<main id='reviews'>", "</main>"), ("<div class='post social'><article>", "</article></div>"),
])
def test_class_words_do_not_lose_an_article(start, end):
    page = f"<html><body><nav><a href='/'>Home</a></nav>{start}{BODY[9:-10]}{end}<div class='comments'><p>Me too, I was there.</p></div></body></html>"
    assert text_of(page) == WANT


def test_density_outvotes_a_class():
    long = "The ice came early that year and nobody in the whole village could remember anything like it at all."
    page = f"<div class='trending'><p><a href='/'>Home</a> <a href='/n'>News</a></p><p>{long}</p><p>{long} {long}</p></div><div class='footer'>Imprint</div>"
    assert text_of(page) == f"{long}\n{long} {long}"
    assert text_of(f"<div>{long} {long}</div><div>{long}</div><div class='comments'><p>{long}</p></div>") == f"{long} {long}\n{long}"


@pytest.mark.parametrize("name", ["main-nav", "post-comments", "entry-footer", "comment-content", "article-sidebar"])
def test_compound_classes_stay_around(name):
    assert text_of(f"{BODY}<div class='{name}'><p>Read this other story as well, it is long enough.</p></div>") == WANT


@pytest.mark.parametrize("name", ["video", "svg", "audio", "object", "select", "template", "iframe"])
def test_an_element_left_open_does_not_take_the_rest(name):
    for page in (f"<{name} src=x>{BODY}", f"<div><{name} src=x></div>{BODY}", BODY.replace("<p>Second", f"<{name}><p>Second"), BODY.replace("words", f"words<{name} src=y>", 1).replace("<p>End", f"<{name}>gone</{name}><p>End")):
        kept = text_of(f"<html><body>{page}<footer>Imprint</footer></body></html>")
        assert "Second bold text with a link." in kept and kept.endswith("End.") and "gone" not in kept
    assert text_of(BODY.replace("<p>End", f"<{name}><b>gone</b> <p>gone too</p></{name}><p>End")) == WANT


def test_raw_text_left_open_goes_on():
    for name in ("script", "style", "textarea", "title"):
        assert text_of(f"{BODY}<{name}><p>Not text, whatever stands here in the end of it.</p>") == WANT


def test_math_and_noscript_of_an_article_stay():
    assert text_of("<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p><noscript><p>A still picture.</p></noscript></article>") == "So x=2 holds.\nA still picture."
