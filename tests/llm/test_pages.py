from __future__ import annotations

import hashlib
import html
import re
import time

import pytest
from hypothesis import given, settings, strategies as st

from edgelog.llm import html_text as H, shared, url_filter as U, warc as W

PAGES = "page_id long, url string, html string, host string"
BIG = "<p>" + "x" * 1200
ROWS = [
    (1, "HTTPS://A.Example.org/es/x?q", BIG, "h"), (2, "http://example.org/en/12", BIG, "h"), (3, None, None, None), (4, "no scheme", "", None),
    (5, "http://shop.cheap-pills.net", BIG, "h"), (6, "http://x.com/fr/a://b", "a\r\n\r\nWARC/1.1\r\nb\r\n", "h"), (6, "http://x.com/fr/a://b", "a\r\n\r\nWARC/1.1\r\nb\r\n", "h"),
    (None, "http://y.com/de/#f", BIG, "h"), (7, "x://com/de/\nz", "é😀" * 400, "h"), (8, "http://notexample.org/es/", "é😀" * 400, "h"), (9, "http://org/", "small", "h"),
    (10, "http://EXAMPLE.org:80/es/", "small", "h"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, PAGES)


def plain_verdict(url):
    _, mark, rest = (url or "").partition("://")
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut : min((rest.find(c, cut) for c in "?#" if rest.find(c, cut) >= 0), default=len(rest))]
    fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.text))
        return host, path, best.text, best.verdict
    listed = any(w in U.UNWANTED for w in host.replace("-", ".").split("."))
    return host, path, None, "block" if listed else "allow"


def test_urls_match_plain_code(spark, sf, pages):
    both = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").union(pages.select("page_id", "url"))
    got = sorted((tuple(r) for r in U.report(both).collect()), key=repr)
    assert got == sorted(((r.page_id, *plain_verdict(r.url)) for r in both.collect()), key=repr)


def test_judge_keeps_other_columns(pages):
    got = U.judge(pages)
    assert got.columns == ["page_id", "url", "html", "host", "path", "rule", "verdict"]
    assert got.count() == len(ROWS) and U.judge(pages.limit(0)).count() == 0


@pytest.mark.parametrize("every", [2, 97, 10_000])
def test_cascade_is_exact_over_its_universe(spark, every):
    keys = spark.range(4000).selectExpr("concat('k', id) AS key", "id").unionAll(spark.sql("SELECT CAST(NULL AS string), -1L"))
    from pyspark.sql import functions as F

    listed = F.substring(F.col("key"), 2, 9).try_cast("long") % every == 1
    cascade = U.build(keys.select("key").union(keys.select("key")), listed)
    wrong = keys.filter(F.coalesce(cascade.listed(F.coalesce("key", F.lit(""))), F.lit(False)) != F.coalesce(listed, F.lit(False)))
    assert wrong.count() == 0 and len(cascade.levels) >= 1
    assert U.build(keys.select("key"), F.lit(False)).levels == []


def plain_records(rows):
    out = []
    for page, _, html, *_ in rows:
        payload = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        again = len(payload) >= 1000 and page is not None and same and page != max(same)
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", max(same) if again else None))
    return sorted(out, key=repr)


def test_archives_match_plain_code(spark, sf, pages):
    assert sorted((tuple(r) for r in W.report(pages).collect()), key=repr) == plain_records(ROWS)
    table = spark.read.parquet(f"{sf}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in table.collect()]
    assert sorted((tuple(r) for r in W.report(table).collect()), key=repr) == plain_records(rows)
    assert W.report(pages.limit(0)).count() == 0


def test_transactions_nest_all_records(spark, pages):
    folder = shared.scratch(spark, "warc-test")
    W.write(pages, folder)
    found = W.transactions(W.read(spark, folder)).collect()
    assert len(found) == len(ROWS)
    assert all(r.request.id and r.metadata.id and r.response.id == r.id for r in found)
    whole = [bytes(r.response.payload).decode() for r in found if r.response.kind == "response" and r.response.page_id == "6"]
    assert whole == [ROWS[5][2]] * 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=60) | st.just(b"\r\n\r\n"), max_size=8), st.integers(1, 50))
def test_parser_reads_any_cuts(bodies, size):
    raw = b"".join(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(b), b) for b in bodies)
    parser = W.Parser()
    got = [body for at in range(0, len(raw), size) for _, body in parser.feed(raw[at : at + size])]
    parser.end()
    assert got == bodies


def test_broken_archives_are_errors():
    parser = W.Parser()
    list(parser.feed(b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc"))
    with pytest.raises(ValueError, match="inside a record"):
        parser.end()
    with pytest.raises(ValueError, match="no WARC record"):
        list(W.Parser().feed(b"hello\r\n\r\n"))


TEXT = "Lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore. "
BODY = f"<h1>A &amp; B</h1><p>{TEXT * 3}</p><p>Short.</p><div class='ad'>Buy</div><p>one<br>two <b>th</b>ree<p>{TEXT}</p>"
WANT = f"A & B\n\n{(TEXT * 3).strip()}\n\nShort.\n\none two three\n\n{TEXT.strip()}"
AROUND = "<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class='cookie-notice'>We use cookies</div>"
AFTER = "<form><input><p>Name</p></form><aside>See also</aside><div id='comments'><p>Nice one</p></div><footer>&copy; x</footer>"


@pytest.mark.parametrize("box", ["<article>{}</article>", "<main>{}</main>", "<div id='content'>{}</div>", "<div><div>{}</div></div>"])
@pytest.mark.parametrize("end", ["</body></html>", ""])
def test_main_text_without_what_surrounds_it(box, end):
    page = f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='</p><p>';</script></head><body class='has-sidebar'>{AROUND}{box.format(BODY)}{AFTER}{end}"
    assert H.main_text(page) == WANT


def test_awkward_pages():
    assert H.main_text(None) == H.main_text("") == H.main_text("<p> \n</p>") == ""
    assert H.main_text("plain &lt;b&gt; text") == "plain <b> text"
    assert H.main_text("<div class=ad>Buy<article><p>Kept text here</p></article>") == "Kept text here"
    assert H.main_text("<article>" + "<p>w w</p>" * 5000).count("w w") == 5000
    assert H.main_text("<p>" + "<b>" * 3000 + "deep") == "deep"
    assert H.main_text("<article><p>a</p><article class='comment'><p>no</p></article></article>") == "a"


LONG = f"<p>{TEXT * 4}</p>"
ITEM = "<li>An item of the list with some words of its own to read</li>"


@pytest.mark.parametrize(
    "page, wanted",
    [
        (f"<div id=content><h1>Title</h1>{LONG}<p>Main end.</p></div>" + "<article><h2>Card</h2><p>Teaser</p></article>" * 2, ["Title", TEXT.strip(), "Main end.", "Teaser"]),
        (f"<article>{LONG}</article><article><p>Brief note</p></article>", [TEXT.strip(), "Brief note"]),
        (f"<article>{LONG}<p>Short.</p></article><p>Outside. {TEXT * 4}</p>", [TEXT.strip(), "Short.", "Outside."]),
        (f"<div><section>{LONG * 6}</section><section><h2>Second</h2><p>{TEXT}</p></section></div>", ["Second"]),
        (f"<div><section>{LONG * 6}</section><section><h2>Second</h2><p>Short end.</p></section></div>", ["Second", "Short end."]),
        (f"<div><p>{TEXT}</p><ul>{ITEM * 30}</ul></div>", [TEXT.strip(), "An item"]),
        (f"<div>{LONG}<p><a href=/>A paragraph that is one link</a></p>{LONG}</div>", ["A paragraph that is one link"]),
    ],
)
def test_no_part_of_the_main_text_is_lost(page, wanted):
    got = H.main_text(f"<html><body>{AROUND}{page}{AFTER}</body></html>")
    assert all(part in got for part in wanted)
    assert not any(part in got for part in ("Home", "cookies", "See also", "Nice one", "Site"))


@pytest.mark.parametrize(
    "box",
    [
        "<div class='content with-sidebar'>{}</div>", "<div class='post no-comments'>{}</div>", "<article class='post has-sidebar'>{}</article>",
        "<div class=widget>{}</div>", "<article class=share><div id=related>{}</div></article>", "<div id=sidebar><div class=popup>{}</div></div>",
    ],
)
def test_names_never_take_the_whole_text(box):
    text = f"{LONG}<h2>Sub</h2><p>Short.</p><div class=ad>Buy this, all of it, now</div>{LONG}"
    got = H.main_text(f"<html><body class='has-sidebar'>{AROUND}{box.format(text)}{AFTER}</body></html>")
    assert got == f"{(TEXT * 4).strip()}\n\nSub\n\nShort.\n\n{(TEXT * 4).strip()}"


@pytest.mark.parametrize("name", ["id='notice-periods'", "class='share-prices'", "class='search-algorithms'", "class='no-comments'", "class='article-header'"])
def test_names_about_something_else_keep_their_section(name):
    got = H.main_text(f"<body><article>{LONG}<section {name}><h2>Part</h2><p>Said here.</p></section></article></body>")
    assert got.endswith("Part\n\nSaid here.")


@pytest.mark.parametrize(
    "name",
    ["class=ad", "class='ad-container'", "id=adBox", "class='comment-list'", "class='related-posts'", "class='social-links'", "class='cookie-banner'", "id=newsletter2", "role=complementary", "class='x sidebar-left'"],
)
def test_names_of_what_surrounds_a_text_leave_it_out(name):
    for page in (f"<article>{LONG}<div {name}><p>{TEXT}extra</p></div>{LONG}</article>", f"<div>{LONG}{LONG}</div><div {name}><p>{TEXT}extra</p></div>"):
        assert H.main_text(f"<body>{page}</body>") == f"{(TEXT * 4).strip()}\n\n{(TEXT * 4).strip()}"


def test_a_short_article_beside_a_long_advert():
    assert H.main_text(f"<body><div class=ad>{TEXT * 3}</div><article><h1>Title</h1><p>Brief.</p></article></body>") == "Title\n\nBrief."


@pytest.mark.parametrize(
    "page",
    [
        "<div>x" * 50_000, "<div class=ad>some text to read" * 50_000, "<b>" * 50_000 + "x</i>" * 50_000, "<div>" * 50_000 + "</section>" * 50_000 + "x",
        "<b>" * 20_000 + "<p>x" * 20_000, "<i>" + "<div>x</i>" * 30_000, "<article>x" * 20_000, "<section>" * 50_000 + LONG,
    ],
)
def test_deep_and_broken_pages_take_linear_time(page):
    began = time.perf_counter()
    assert H.main_text(page)
    assert time.perf_counter() - began < 10


def plain_text(page):
    """The given pages hold one article: its blocks, cut at tags by patterns alone."""
    body = re.search(r"<article>(.*?)</article>", re.sub(r"(?s)<(script|style)>.*?</\1>", "", page or ""), re.S)
    blocks = re.split(r"</?(?:p|h1|div|li|ul)\b[^>]*>", body[1]) if body else []
    told = (re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", b)) for b in blocks)
    return "\n\n".join(t for t in (" ".join(html.unescape(b).split()) for b in told) if t)


def test_given_pages_equal_plain_code(spark):
    for folder in ("sf0.001", "sf0.01"):
        table = spark.read.parquet(f"/root/testdata/{folder}/pages.parquet")
        want = {r.page_id: plain_text(r.html) for r in table.collect()}
        assert {r.page_id: r.text for r in H.report(table).collect()} == want


def test_lists_of_links_beside_the_text_go():
    assert "Other page" not in H.main_text(f"<body><div>{LONG}{LONG}</div><div><ul>{'<li><a href=/>Other page</a></li>' * 9}</ul></div></body>")


def test_text_of_whole_pages_keeps_columns(spark, sf, pages):
    got = H.with_text(pages)
    assert got.columns == ["page_id", "url", "host", "text"] and got.count() == len(ROWS)
    assert H.report(pages.limit(0)).count() == 0
    table = spark.read.parquet(f"{sf}/pages.parquet")
    for row in H.report(table).collect():
        assert row.n_chars == len(row.text) and "\n\n" in row.text and "track(" not in row.text
