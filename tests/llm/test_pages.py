"""Main text of pages, and the templates of hosts."""

import html
import re

import pytest

from sheafspark.llm import html_templates, queries
from sheafspark.llm.html_templates import PageParser, extract_main_text, main_text

SCHEMA = "page_id long, url string, html string"


def text_of(page):
    return main_text(PageParser().parse(page)[0], set())


def slow_text(page):
    """The given pages mark their article and break blocks by three tags only."""
    inside = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inside))
    return "\n".join(b for b in blocks if b)


def test_query_on_the_given_pages(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op1_html_templates(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, slow_text(pages[r.page_id].html), len(r.text))


ARTICLE = (
    "<html><body class='has-sidebar'><header><h1>Site</h1></header><div class='cookie-notice'>We use cookies</div>"
    "<nav><a href=/>Home</a></nav><div class='page with-sidebar'><article><header><h1>Title &amp; more</h1></header>"
    "<p>One <a href=x>two</a>\n three<span class=ad>buy <span>it</span></span> end<br>four<p>five &lt;b&gt; &#233;&nbsp;x"
    "<ul><li>a<li>b</ul><aside>side</aside><div class='ad'>buy</div><form>mail <input></form><table><tr><td>1<td>2</table>"
    "<div id='comments'><article class='comment'><p>nice</p></article></div><footer>by me</footer></article></div>"
    "<script>if (a<b) '</p>'</script><style>p{}</style><footer>&copy;</footer></body></html>"
)


def test_marked_article():
    assert text_of(ARTICLE) == "Title & more\nOne two three end\nfour\nfive <b> é x\na\nb\n1\n2"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain text", "plain text"),
        ("<p>a<!-- <p>no --> b</p", "a b"),
        ("<p>a <b>b</b>c <p cl", "a bc"),
        ("<title>t</title><p>3 < 4 & 5 &amp", "3 < 4 & 5 &"),
        ("<main><p>in</p></main><p>out</p>", "in"),
        ("<div id=content><p>in</p><div class='related'>x</div></div><p>out</p>", "in"),
        ("<ul><li><a href=1>Home</a><li><a href=2>News</a></ul><p>Body <a href=3>link</a> text</p>", "Body link text"),
        ("<article><p>a</article></b></p><article>b", "a\nb"),
        ("<div class='comment-list'><article>nice</article></div>", "nice"),
        ("<a title='<p>'>x</a> y", "x y"),
    ],
)
def test_small_pages(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><h2 id='related-work'>Related</h2><section id='discussion'><p>a</p></section><h2 id='alert-rules'>b</h2></article>", "Related\na\nb"),
        ("<h2 id='search-algorithms'>Search</h2><section id='discussion'><p>a</p></section>", "Search\na"),
        ("<article><pre><code>x <span class='hljs-comment'># a</span> <span class='token comment'># b</span></code></pre></article>", "x # a # b"),
        ("<article><p>see <code>x <span class='comment'># a</span></code> <span class='ad'>buy</span></p></article>", "see x # a"),
        ("<div class='layout no-sidebar'><p>out</p><div id='content'><p>in</p></div></div>", "in"),
        ("<div class='layout sidebar'><p>out</p><div id='content'><p>in</p></div></div>", "in"),
        ("<div class='sidebar content'><main><p>in</p></main></div>", "in"),
        ("<div class='content'>x</div><main><h1>Title</h1><article><p>a</p></article><p>end</p></main>", "Title\na\nend"),
        ("<article><div class='comment-system'>a</div><div class='comments'>b</div><div class='related-posts'>c</div></article>", "a"),
    ],
)
def test_article_text_is_not_dropped_by_loose_words(page, text):
    assert text_of(page) == text


def test_link_blocks_are_left_out_where_they_repeat(stored):
    page = "<body><ul><li><a href=/>Home</a></ul><p>own {}</p><p><a href=x>source {}</a></p></body>"
    rows = extract_main_text(stored([(i, f"http://h.example/{i}", page.format(i, i)) for i in range(12)], SCHEMA)).collect()
    assert {r.page_id: r.text for r in rows} == {i: f"own {i}\nsource {i}" for i in range(12)}


def host_pages(n, host="one.example"):
    return [
        (
            i,
            f"https://{host}/{i}",
            f"<html><body><div class=top><p>Welcome to our pages</p></div><div class=x><h1>Head {i}</h1><p>text {i} of {host}</p>"
            + "".join(f"<p>more {i} {k}</p>" for k in range(i % 3))
            + "</div><div class=low><p>All of it by us</p></div></body></html>",
        )
        for i in range(n)
    ]


def test_text_of_the_host_template_is_left_out(stored):
    rows = {r.page_id: r.text for r in extract_main_text(stored(host_pages(20), SCHEMA)).collect()}
    for i in range(20):
        assert rows[i] == "\n".join([f"Head {i}", f"text {i} of one.example", *(f"more {i} {k}" for k in range(i % 3))])


def test_few_pages_have_no_template_text(stored):
    rows = extract_main_text(stored(host_pages(5), SCHEMA)).collect()
    assert all(r.text.startswith("Welcome to our pages\nHead") for r in rows)


def test_template_nodes(spark, stored):
    pages = stored([("h", i, page) for i, _, page in host_pages(20)], "host string, page long, html string")
    tokens = stored(html_templates.page_tokens(pages).collect(), "host string, page long, sequence array<long>, tokens array<long>, counts array<long>")
    template = html_templates.host_templates(tokens).collect()
    assert len(template) == 1 and template[0].pages == 20
    framing = [n for n in template[0].nodes if n.support == n.times == 20]
    # html, body, three div, h1, a p above and below, and their texts
    assert len(framing) == 1 and len(framing[0].members) == 10
    dropped = html_templates.template_texts(html_templates.host_templates(tokens)).collect()
    assert sorted(dropped[0].dropped) == sorted(framing[0].members)


def test_template_decides_on_marked_pages(stored):
    page = "<body><main><p>Read us daily</p><div>{}</div><p>own {}</p>{}</main></body>"
    rows = [(i, f"http://h.example/{i}", page.format("<p>a</p><p>Follow us</p>" if i % 3 else "", i, "" if i % 5 else "<p>rare</p>")) for i in range(20)]
    rows += [(20, "http://h.example/20", ""), (21, "http://h.example/21", None), (22, "http://h.example/22", "<p>no frame</p>")]
    got = {r.page_id: r.text for r in extract_main_text(stored(rows, SCHEMA)).collect()}
    # on most pages, not all of them; two pages have no tokens
    assert all(got[i] == (f"own {i}" if i % 5 else f"own {i}\nrare") for i in range(20))
    assert (got[20], got[21], got[22]) == ("", "", "no frame")


def test_headings_that_repeat_inside_articles_stay(stored):
    page = "<body><div>Home</div><article><h2>Ingredients</h2><p>{0} eggs</p><h2>Method</h2><p>stir {0} times</p></article></body>"
    rows = extract_main_text(stored([(i, f"http://h.example/{i}", page.format(i)) for i in range(12)], SCHEMA)).collect()
    assert {r.page_id: r.text for r in rows} == {i: f"Ingredients\n{i} eggs\nMethod\nstir {i} times" for i in range(12)}


def test_formulas_and_noscript_are_text(stored):
    page = "<article><p>Let <math><mi>x</mi></math> be<script>no</script></p><noscript><p>plain</p></noscript></article>"
    rows = extract_main_text(stored([(1, "http://h.example/1", page)], SCHEMA)).collect()
    assert [r.text for r in rows] == ["Let x be\nplain"]


def test_copies_of_a_marked_page_keep_their_text(stored):
    rows = extract_main_text(stored([(i, f"http://h.example/{i}", "<article><p>a</p></article>") for i in range(12)], SCHEMA)).collect()
    assert [r.text for r in rows] == ["a"] * 12


def test_unordered_classes_are_not_valid(stored):
    def page(i):
        parts = ["<p>same one</p>", "<p>same two</p>"]
        return f"<body><div>{''.join(parts if i % 2 else parts[::-1])}</div><p>own {i}</p></body>"

    rows = extract_main_text(stored([(i, f"http://h.example/{i}", page(i)) for i in range(12)], SCHEMA)).collect()
    assert all("same one" in r.text and "same two" in r.text for r in rows)


def test_odd_rows(stored):
    long_page = "<article>" + "<p>word &amp; word</p>" * 60_000
    rows = [
        (1, "http://h.example/1", None), (2, None, "<p>a</p>"), (3, "no url", ""), (None, None, None), (4, "http://h.example/4", long_page),
        (5, "http://h.example/5", "<p>b"), (5, "http://h.example/5", "<p>b"),
    ]
    got = extract_main_text(stored([(*r, "x", 1) for r in rows], SCHEMA + ", text string, host int")).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    want = ["", "a", "", "\n".join(["word & word"] * 60_000), "b", "b", ""]
    assert [(r.page_id, r.text, r.n_chars) for r in sorted(got, key=key)] == [
        (r[0], t, len(t)) for r, t in zip(sorted(rows, key=key), want, strict=True)
    ]
    assert extract_main_text(stored([], SCHEMA)).collect() == []
