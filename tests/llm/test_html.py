import random
import re
from html import unescape

from series_engine.llm import html
from tests.conftest import SF001

SCHEMA = "page_id long, url string, html string"


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_shared_is_a_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(500):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 12))] for _ in range(2))
        got = html.shared(a, b)
        assert len(got) == lcs(a, b) and got == sorted(set(got))
        it = iter(b)
        assert all(a[i] in it for i in got)


def test_articles_of_the_table(spark):
    """The article element of the pages, read in another way."""
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", body)
        want = [" ".join(unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", x)).split()) for x in blocks]
        assert got[r.page_id] == "\n".join(x for x in want if x)


def test_other_parts_go():
    page = """<html><head><title>T</title><style>x{}</style></head><body><header>Site</header><div class="cookie-notice">we use</div>
    <main><article class="post"><h1>Head&amp;line</h1><p>One <i>two</i>&nbsp; three<br>four<p>Next<div class="ad-box"><p>buy</p></div>
    <ul><li>a<li>b</ul><form>q <input></form><script>if (a<b) "</p>"</script><table><tr><td>x<td>y</tr></table></article>
    <section id="comments"><p>nice</p></section></main><aside>side</aside><footer>f</footer></body>"""
    assert [x for x, _ in html.lines_of(page)] == ["Head&line", "One two three four", "Next", "a", "b", "x y"]
    assert html.lines_of(None) == html.lines_of("") == [] and html.lines_of("a < b")[0][0] == "a < b"
    assert html.lines_of("<p>x<!-- open")[0][0] == "x"


def test_template_lines_go_where_no_article_is_marked(spark):
    def page(i):
        return (f"<div>Welcome to the site</div><div>Home News Sport</div><div>Story {i} begins here with own words</div>"
                f"<div>and goes on {i * 7} for a while</div><div>All rights reserved</div>")
    rows = [(i, f"http://h.example/{i % 4}/{i}", page(i)) for i in range(40)]
    rows += [(100, None, None), (101, "::odd", "<div>alone</div>"), (None, "http://h.example/1/1", ""), (102, "http://x.example/a", page(1)), (102, "http://x.example/a", page(1))]
    got = html.extract(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS _key", "1 AS text")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None and r.page_id < 100:
            assert r.text == f"Story {r.page_id} begins here with own words\nand goes on {r.page_id * 7} for a while"
    rest = {(r.page_id, r.url): r.text for r in got if r.page_id is None or r.page_id >= 100}
    assert rest[100, None] == "" and rest[101, "::odd"] == "alone" and rest[None, "http://h.example/1/1"] == ""
    assert rest[102, "http://x.example/a"].startswith("Welcome")  # no neighbour but its copy
    assert html.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_equal_pages_side_by_side_lose_the_same_lines(spark):
    def page(i):
        return f"<div>Welcome to the site</div><div>Story {i} begins here with own words</div><div>All rights reserved</div>"
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(9)]
    rows += [(100 + k, f"http://h.example/4{tail}", page(4)) for k, tail in enumerate(("?utm=a", "?utm=b", "#top", "/", "/?x"))]
    for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect():
        assert r.text == f"Story {r.page_id if r.page_id < 100 else 4} begins here with own words"
