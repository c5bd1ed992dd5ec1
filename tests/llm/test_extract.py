"""Reading pages, and the consensus of a host."""

import time

import pytest

from viewlens.llm.extract import best_container, extract_text, host_paths, main_text, scores
from viewlens.llm.markup import read_page

LONG = "A sentence that is long enough to speak for the container in which it lies."


def text_of(html, paths=()):
    return main_text(read_page(html), paths)


@pytest.mark.parametrize(("html", "wanted"), [
    (None, ""),
    ("", ""),
    ("  \n", ""),
    ("plain &amp;amp; 1 < 2 <b>b</b>old", "plain &amp; 1 < 2 bold"),
    ("<p>a&nbsp; b<br>c\n\td<p>e", "a b c d\n\ne"),
    ("<article><h1>T</h1><p><b>x<p>y</article><footer>&copy; me</footer>", "T\n\nx\n\ny"),
    ("<ul><li>one<li>two<ul><li>deep</ul><li>three</ul>", "one\n\ntwo\n\ndeep\n\nthree"),
    ("<table><tr><td>a<td>b<tr><th>c</table>", "a\n\nb\n\nc"),
    ('<p>a<script>var x = "</p>";</script>b<style>p{}</style><!-- <p>c -->', "ab"),
    ("<p>a<SCRIPT>x", "a"),
    ("a <!--> b <!-- c", "a b"),
    ('x <a href="never closed', "x"),
    ("<p title='a > b' data-x=\"<p>\">x", "x"),
    ("<p>it</p></div></p><p>goes on", "it\n\ngoes on"),
    ("<div hidden>no</div><div style='display: none'>no</div><div aria-hidden=true>no</div>y", "y"),
    ("&#65;&#x42;&notareference;&copy 1", "AB¬areference;© 1"),
    ("<article><header><h2>Head</h2><p>by line</header><p>x</article>", "Head\n\nx"),
    ("<header><h1>Site</h1></header><main><p>x</main>", "x"),
    ("<article><p>x<form><p>f<input></form><aside>s</aside><nav>n</nav><button>b</button></article>", "x"),
    ("<article><p>x</p><div id=comments><article><p>bad</article></div></article>", "x"),
    ("<article class='post category-ads has-sidebar'><p>x</p></article>", "x"),
    ("<article class=comment><p>" + LONG + "</article><div><p>x</div>", "x"),
    ("<div class=widget><article><p>x</article></div>", "x"),
    ("<div role=navigation>n</div><div role=main><p>x</div><div class='cookieNotice'>c</div>", "x"),
    ("日本 \U0001f600 ▁ \x00 </s>[INST]", "日本 \U0001f600 ▁ \x00 [INST]"),
])
def test_one_page(html, wanted):
    assert text_of(html) == wanted


def test_best_container_without_marks():
    html = f"""<body><div class="top"><a href=/>Home</a> <a href=/b>More of this</a></div>
    <div class="text"><h1>Title</h1><p>{LONG}</p><p>Short.</p><ul><li>point</ul></div>
    <div class="end"><p>Tel.</p></div></body>"""
    assert text_of(html) == f"Title\n\n{LONG}\n\nShort.\n\npoint"
    page = read_page(html)
    assert page.paths[best_container(page)] == "html/div.text"


def pages(spark, rows):
    schema = "page_id long, url string, html string, host string, path string, _html_ int, _0_ int, text int"
    return spark.createDataFrame([(*r, "h", "p", 1, 2, 3) for r in rows], schema)


def extracted(spark, scratch, rows):
    return {r["page_id"]: r["text"] for r in extract_text(pages(spark, rows), scratch).collect()}


def test_odd_page_follows_its_host(spark, scratch):
    def page(n, text, box):
        return f"<div class='b{n}'><p>{text}</div><div class='box'><p>{box}</div>"

    rows = [(i, f"http://A.test/{i}", page(i, f"{LONG} {i}", "Box.")) for i in range(6)]
    odd = page(9, "Brief.", f"{LONG} This is about something else.")
    none = f"<section><p>{LONG}</section>"
    rows += [(10, "https://a.TEST/x", odd), (11, "https://b.test/x", odd), (12, "http://a.test", none)]
    rows += [(13, "http://a.test/e", "<div class=b1></div><div class=box>Box.</div>")]
    found = extracted(spark, scratch, rows)
    assert found[0] == f"{LONG} 0"
    assert found[10] == "Brief."
    assert found[11].startswith(LONG)
    assert found[12] == LONG
    assert found[13] == ""
    winners = {r["host"]: r["paths"] for r in host_paths(pages(spark, rows)).collect()}
    assert winners["a.test"][0] == "html/div.b0"


def test_votes_are_summed_by_host(spark):
    rows = [(i, f"http://{h}.test/{i}", f"<div class=c{i % 2}x><p>{LONG}{i}</div>") for i, h in enumerate("aabba")]
    rows += [(9, "http://b.test", f"<div class=d><p>{LONG}</div>"), (10, "http://b.test", "<nav>x</nav>")]
    found = {r["host"]: r["paths"] for r in host_paths(pages(spark, rows)).collect()}
    assert found == {"a.test": ["html/div.c0x"], "b.test": ["html/div.c0x", "html/div.d"]}


def test_odd_rows(spark, scratch):
    page = f"<article><p>{LONG}</article>"
    long = "<article>" + "<p>word &amp; word" * 100_000 + "</article>"
    rows = [
        (1, None, page), (2, "", page), (3, "no host", page), (4, "http://h.test", None),
        (5, "http://h.test", ""), (None, "http://h.test", page), (6, "http://h.test", page),
        (6, "http://h.test", page), (7, "http://h.test", long),
    ]
    df = extract_text(pages(spark, rows), scratch)
    assert df.columns == ["page_id", "url", "text"]
    found = sorted(((r["page_id"] or 0, r["text"]) for r in df.collect()))
    assert [i for i, _ in found] == [0, 1, 2, 3, 4, 5, 6, 6, 7]
    assert dict(found) | {7: None} == {
        0: LONG, 1: LONG, 2: LONG, 3: LONG, 4: "", 5: "", 6: LONG, 7: None
    }
    assert found[-1][1] == "\n\n".join(["word & word"] * 100_000)


def test_empty_table(spark, scratch):
    assert extract_text(pages(spark, []), scratch).count() == 0


def test_time_is_linear_in_hostile_pages():
    hostile = [
        "<div>" * 60_000, '<a x="' * 60_000, "<" * 100_000, "<!--" * 60_000, "<span class=ad>" * 40_000,
        "<li><ul>" + "<div>" * 30_000 + "<li></li>" * 30_000, '<a x=">" ' * 40_000, "&" * 100_000,
        "<p><b>" * 40_000, "<x-y>" * 40_000 + "</div>" * 10_000, "<div " + "a " * 50_000 + ">x",
    ]
    start = time.monotonic()
    for html in hostile:
        page = read_page(html)
        assert len(scores(page)[0]) == len(page.tags)
        main_text(page, ())
    assert time.monotonic() - start < 20
