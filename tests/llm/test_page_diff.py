import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tuplefeed.llm import page_diff
from tuplefeed.llm.queries import QUERIES

PAGES = "page_id long, url string, html string"


@settings(deadline=None)
@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=12))
def test_common_lines_are_a_longest_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    places = sorted(page_diff.common_lines(a, b))
    assert len(places) == table[-1][-1]
    rest = iter(b)
    assert all(any(a[i] == x for x in rest) for i in places)


PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?][^>]*>")


@settings(deadline=None, max_examples=500)
@given(st.text("<<>>/!a1\"' =", max_size=40))
def test_tags_equal_a_plain_pattern(page):
    assert list(page_diff.tags(page)) == [(m.start(), m.end(), m[1] or "", m[2] or "", m[3] or "") for m in PLAIN_TAG.finditer(page)]


@pytest.mark.parametrize(
    "part, after", [("<a ", ""), ("<a ", ">"), ('<a "', ">"), ("<a '<b \"", ">"), ("<!", ""), ("<div>", "</section>" * 100_000), ("<p><span>", "<hr>" * 100_000)]
)
def test_broken_markup_takes_linear_time(part, after):
    page = part * (1_000_000 // len(part)) + after
    begun = time.process_time()
    page_diff.lines_of(page)
    assert time.process_time() - begun < 8


def test_lines_by_markup():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>Menu</ul></nav>
    <div class="cookie-notice"><p>We use cookies</div><script>if (a < b) "<p>no</p>"</script>
    <article><header><h1>Title &amp;&nbsp;more</h1></header><p>One <b>bold</b>word<br>next <!-- x <p> --><p>Two
     lines</p><table><tr><td>a</td><td>b</td></tr></table><div class="related">Read on</div></article>
    <section id=comments><p>Great!</section><form><p>Mail<input></form>rest &lt;p&gt;<footer>&copy; us</footer>"""
    lines = page_diff.lines_of(page)
    assert [t for t, w in lines if w == 1] == ["Title & more", "One boldword next", "Two lines", "a b"]
    assert [t for t, w in lines if w == 0] == ["rest <p>"]
    assert {t for t, w in lines if w == -1} == {"T", "Site", "Menu", "We use cookies", "Read on", "Great!", "Mail", "© us"}


def test_query_on_pages(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op5_page_diff"](spark, sf_dir).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        plain = re.sub(r"<[^>]*>", "\n", article).replace("&lt;", "<").replace("&gt;", ">").replace("&quot;", '"').replace("&#x27;", "'").replace("&amp;", "&")
        assert r.text.split() == plain.split() and r.n_chars == len(r.text)


def test_shared_lines_go_and_copies_stay(spark):
    def page(i, body):
        return f"<body><div>Welcome to us</div><p>{body} one</p><p>{body} two</p><p>All rights</p><p>{body} three</p></body>"

    rows = [(i, f"http://h.x/a/{i}", page(i, f"text {i}")) for i in range(5)]
    rows += [(10, "http://h.x/b/1", page(1, "copy")), (11, "http://h.x/b/1/", page(1, "copy"))]
    rows += [(20, "http://alone.x/", page(0, "alone")), (21, None, None), (None, "http://alone.x:80/?q", "")]
    got = {r.page_id: r.text for r in page_diff.extract(spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS text", "'x' AS host")).collect()}
    for i in range(5):
        assert got[i] == f"text {i} one\ntext {i} two\ntext {i} three"
    assert "copy one\ncopy two" in got[10] and "copy three" in got[11]
    assert got[20].startswith("Welcome to us\nalone one")
    assert got[21] == "" and got[None] == "" and len(got) == 10


def test_template_inside_articles(spark):
    def page(body, advert, i):
        return f"<body><div>Advert {advert}</div><main><p>Please support us</p><p>{body}, the first part</p><p>{body}, the second part {i}</p></main>"

    rows = [(i, f"http://h.x/{i}", page(f"Story {i} of its own", i, i)) for i in range(4)]
    rows += [(10 + i, f"http://copies.x/{i}", page("The same story", i, "")) for i in range(4)]
    rows.append((20, "http://marked.x/", "<article><p>One<p class=advert>Buy<p>Two<ul><li class=promo><p>More</p>of it<li>Three</ul>Four</article>"))
    got = {r.page_id: r.text for r in page_diff.extract(spark.createDataFrame(rows, PAGES)).collect()}
    for i in (1, 2):
        assert got[i] == f"Story {i} of its own, the first part\nStory {i} of its own, the second part {i}"
    for i in range(4):
        assert got[10 + i] == "Please support us\nThe same story, the first part\nThe same story, the second part"
    assert got[20] == "One\nTwo\nThree\nFour"


def test_template_goes_from_all_copies_and_short_pages(spark):
    def page(body):
        return "<body>" + "".join(f"<p>Line {k} of the site</p>" for k in range(9)) + f"<p>{body}</p></body>"

    rows = [(i, f"http://h.x/a/{i}", page("copied")) for i in range(4)] + [(i, f"http://h.x/b/{i}", page(f"short {i}")) for i in range(4, 7)]
    got = {r.page_id: r.text for r in page_diff.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: "copied" for i in range(4)} | {i: f"short {i}" for i in range(4, 7)}


def test_empty_table(spark):
    assert page_diff.extract(spark.createDataFrame([], PAGES)).count() == 0
