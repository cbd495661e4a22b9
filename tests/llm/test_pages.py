import hashlib
import re
import time
from html import unescape

import pytest
from fixtures import rows_of

from topiclens.llm import main_text, warc
from topiclens.llm.main_text import stretches
from topiclens.llm.queries import QUERIES

LONG = "Some long article text that goes on for a while, indeed it does."


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""), ("", ""), ("plain", "plain"), ("<p>x</p>", "x"), ("<!-- a --><style>b</style>", ""),
        (f"<nav><a href=/>m</a></nav><div><h1>T</h1><p>{LONG}</p></div><footer>f</footer>", f"T\n{LONG}"),
        (f"<body><div class='site-header'>S</div><div id=sidebar><p>{LONG}</p></div><div class=content><p>{LONG}"
         f"<p>More &amp;lt; x&nbsp;y</div><div class=comments><p>{LONG}{LONG}</p></div>"
         "<div class='cookie-notice'>c</div>", f"{LONG}\nMore &lt; x y"),
        ("<header><h1>Site</h1></header><main><article><header><h2>Title</h2></header><p>Text</p><aside>no</aside>"
         "<form>no<input></form><section id=comments><article class=comment>c</article></section></article></main>",
         "Title\nText"),
        ("<article><p>a<script>var x='</p>'</script>b<br>c</p><ul><li>one<li>two</ul></article>", "a b c\none\ntwo"),
        ("<p a='>'>q</p><!-- <p>no</p> -->&Eacute;&#0000000065;&#x41;&am &amp", "q\nÉAA&am &"),
        ("<article><p>kept</p><div hidden>no</div><div style='display: none'>no</div></article>", "kept"),
        ("<nav>never closed <p>kept</p>", "never closed\nkept"),
        (f"<ul><li><a href=1>one</a></li><li><a href=2>two</a></li></ul><p>{LONG}</p>", LONG),
        ("<div class='no-sidebar'><p>kept</p></div>", "kept"),
        ("<article><P>I<b>n</b>line\t\n <i>x</i></P></article>", "Inline x"),
        ("<div class=comments><p>only this</p></div>", "only this"),
    ],
)
def test_main_text(html, text):
    assert main_text.main_text(html) == text


STORY = "".join(f"<p>{LONG} {i}</p>" for i in range(6))
STORY_TEXT = "\n".join(f"{LONG} {i}" for i in range(6))
TEASER = "<article><h3><a href=/t>Another story</a></h3><p>A short teaser.</p></article>"


@pytest.mark.parametrize(
    "html, text",
    [
        # Teasers are marked, the story is not.
        (f"{TEASER}<div class=story>{STORY}</div>{TEASER}{TEASER}", STORY_TEXT),
        (f"<div class=story>{STORY}</div><div><article><p>{LONG}</p></article></div>", f"{STORY_TEXT}\n{LONG}"),
        # The longest window is marked, most of the text is not: both are kept.
        (f"<article><p>{LONG * 4}</p></article><div>{STORY}</div>", f"{LONG * 4}\n{STORY_TEXT}"),
        # Nothing is marked.
        (f"<div><a href='/'>Home</a></div><ul><li>x</li></ul><nav>m</nav><nav>n</nav><nav>o</nav><div>{STORY}</div>"
         "<footer>f</footer><div class=cookie-notice>c</div><div class=share>s</div><div>(c) Us</div>", STORY_TEXT),
        # The story is marked.
        (f"<div>Hello</div><article><a href='/'>A</a>{STORY}</article><div><p>{LONG}</p></div>", f"A\n{STORY_TEXT}"),
    ],
)
def test_marks_are_believed_where_the_text_is(html, text):
    assert main_text.main_text(html) == text


ADS = "<div class=ad>a</div>" * 3
LINKED = f"<p>See <a href='/a'>{LONG}</a></p>"


@pytest.mark.parametrize(
    "html, text",
    [
        # A long paragraph, adverts inside the story, an ending: lengths 60, 5000, 0, 0, 0, 300, 250.
        (f"<div><h1>{'t' * 60}</h1><p>{'x' * 5000}</p>{ADS}<p>{'y' * 300}</p><p>{'z' * 250}</p></div>",
         f"{'t' * 60}\n{'x' * 5000}\n{'y' * 300}\n{'z' * 250}"),
        (f"<div><h1>T</h1><p>{'x' * 5000}</p>{ADS}<p>The end.</p></div><nav>m</nav><div>(c) Us</div>",
         f"T\n{'x' * 5000}\nThe end."),
        (f"<h1>T</h1><p>{'x' * 5000}</p>{ADS}<p>The end.</p>", f"T\n{'x' * 5000}\nThe end."),
        (f"<div><div><p>{'x' * 5000}</p></div>{ADS}<div><p>The end.</p></div></div>", f"{'x' * 5000}\nThe end."),
        (f"<div><p>{'x' * 5000}</p></div>{ADS}<div><p>{'y' * 300}</p></div>", f"{'x' * 5000}\n{'y' * 300}"),
        # A paragraph that is mostly a link stays, lists of links go.
        (f"<div>{STORY}{LINKED}</div>", f"{STORY_TEXT}\nSee {LONG}"),
        (f"<div>{STORY}<ul><li><a href='/1'>one</a><li><a href='/2'>two</a></ul></div>", STORY_TEXT),
        (f"<div>{STORY}{LINKED.replace(LONG, LONG * 2) * 2}</div>", "\n".join([STORY_TEXT, *[f"See {LONG * 2}"] * 2])),
        # Short text elsewhere goes.
        (f"<div>Motto</div>{ADS}<div>{STORY}</div>{ADS}<div>(c) Us</div>", STORY_TEXT),
    ],
)
def test_a_long_paragraph_does_not_raise_the_bar(html, text):
    assert main_text.main_text(html) == text


SHORT = "".join(f"<p>The story goes on with its part {i}.</p>" for i in range(5))
SHORT_TEXT = "\n".join(f"The story goes on with its part {i}." for i in range(5))


@pytest.mark.parametrize(
    "html",
    [
        f"<article><svg class=icon/>{SHORT}</article>", f"<article><svg>{SHORT}</article>",
        f"<article><iframe src='x' />{SHORT}</article><iframe></iframe>", f"<div><script src='x'/>{SHORT}</div><script></script>",
        f"<div><a name=top>{SHORT}</div>", f"<div><a name=top>{SHORT}</a></div>", f"<a name=top><a name=b>{SHORT}",
        f"<div><a href='/'>{SHORT.replace('<p>', '<p><b>x</b>', 0)}</div>",
        f"<form id=page>{SHORT}</form>", f"<form><nav><a href='/'>m</a></nav><div>{SHORT}</div><footer>f</footer></form>",
        f"<div>Motto</div>{ADS}<form><fieldset><div>{SHORT}</div></fieldset></form>",
        f"<div class=share-price>{SHORT}</div>{ADS}<div>(c) Us</div>", f"<div id=social-policy>{SHORT}</div>",
        f"<div class='discussion-paper related-work cookie-recipes'>{SHORT}</div><div class=site-footer>f</div>",
        f"<div>{SHORT}</div><form><p>Your name</p><input><p>{LONG}</p></form>",
        f"<div>{SHORT}</div><div class='cookie-notice'>{LONG}</div><div class='social-share-buttons'>{LONG}</div>"
        f"<div class=xyz-comments>{LONG}</div><div class='related-posts'>{LONG}</div><div class=c-ad-slot-2>{LONG}</div>",
    ],
)
def test_no_story_is_lost(html):
    assert main_text.main_text(html) == SHORT_TEXT


def test_deep_pages_take_linear_time():
    deep = 100_000
    start = time.perf_counter()
    assert main_text.main_text("<div>" * deep + SHORT + "</div>" * deep) == SHORT_TEXT
    assert main_text.main_text("<div>x " * deep + "</i></div>" * deep).count("x") == deep
    assert main_text.main_text("<svg><b>" * deep + SHORT) == SHORT_TEXT
    assert time.perf_counter() - start < 30


def test_surges_and_dives():
    assert stretches([0, 0, 0, 5, 0, 7, 0, 0, 0, 9, 0, 0], window=3) == [(3, 6, 12), (9, 10, 9)]
    assert stretches([], window=3) == [] and stretches([0, 0], window=3) == []


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, text string, n_chars string")


def test_extraction_of_odd_rows(spark):
    long = "<article>" + "<p>word </p>" * 30_000 + "</article>"
    rows = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (2, None, None), (None, "v", ""), (3, "w", long)]
    got = rows_of(main_text.extracted(pages(spark, rows)))
    assert got[:2] == [(1, "u", "a", 1)] * 2 and got[2] == (2, None, "", 0) and got[4] == (None, "v", "", 0)
    assert got[3][3] == 30_000 * 5 - 1
    assert main_text.extracted(pages(spark, [])).collect() == []


def test_query_against_marked_articles(spark, small):
    want = {}
    for r in spark.read.parquet(f"{small}/pages.parquet").collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [re.sub(r"<[^>]*>", "", b) for b in re.split(r"</?(?:h1|p)[^>]*>", article)]
        blocks = [" ".join(unescape(b).split()) for b in blocks]
        want[r.page_id] = (r.url, "\n".join(b for b in blocks if b))
    got = QUERIES["op1_line_blocks"](spark, small).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_pages_without_marks(spark, small):
    for r in spark.read.parquet(f"{small}/pages.parquet").collect():
        bare = re.sub(r"(</?)(?:article|main)\b", r"\1div", r.html)
        assert main_text.main_text(bare) == main_text.main_text(r.html)


def sha(text):
    return "sha256:" + hashlib.sha256(text.encode()).hexdigest()


def test_derivatives_refer_to_their_response(spark):
    html = "<html lang=fr><title>T &amp; U</title><body><a href='/x'>go</a><p>Text é</p>"
    rows = [(1, "http://a/", html), (2, None, None), (3, "http://b/", ""), (None, "http://c/", "x")]
    source = warc.responses(pages(spark, rows))
    made = warc.derivatives(source, "page_id")
    by = {(r.page_id, r.record_type): r for r in made.collect()}
    assert len(by) == 8 and len({r.record_id for r in by.values()}) == 8
    ids = {r.page_id: r for r in source.collect()}
    for (page, kind), r in by.items():
        own = ids[page]
        assert r.refers_to == own.record_id and r.target_uri == own.target_uri
        assert r.source_headers == own.headers and r.payload_digest == sha(own.payload)
        assert r.block_digest == sha(r.block) and r.content_length == len(r.block.encode())
    assert by[1, "conversion"].block == "go\nText é" and by[2, "conversion"].block == ""
    fields = by[1, "metadata"].block.split("\r\n")
    assert "http-status: 200" in fields and "title: T & U" in fields and "outlink: /x" in fields
    assert "languageOfDocument: fr" in fields and "http-header-Content-Type: text/html; charset=utf-8" in fields
    assert warc.derivatives(warc.responses(pages(spark, [])), "page_id").collect() == []
    again = {r.record_id for r in warc.derivatives(warc.responses(pages(spark, rows)), "page_id").collect()}
    assert again == {r.record_id for r in by.values()}


def test_records_round_trip(spark, small):
    made = QUERIES["op6_warc_derivatives"](spark, small)
    assert made.count() == 2 * spark.read.parquet(f"{small}/pages.parquet").count()
    for row in made.select("*", warc.serialized(made).alias("raw")).collect():
        fields, block = warc.parse(bytes(row.raw))
        assert block.decode() == row.block and bytes(row.raw).endswith(b"\r\n\r\n")
        assert fields["WARC-Refers-To"] == row.refers_to and fields["WARC-Type"] == row.record_type
        assert fields["WARC-Block-Digest"] == row.block_digest
