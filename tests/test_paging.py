import pytest
from pyspark.sql import functions as F

from sheafspark.functions.links import next_from_link_header
from sheafspark.operators.paging import follow_pages
from sheafspark.streaming.paging import add_pages, begin_walk, followed_pages

SCHEMA = "request_url STRING, status INT, link_header STRING, body STRING"


def linked(target):
    return '{"link": [{"relation": "self", "url": "/s"}, {"relation": "next", "url": "%s"}]}' % target


def walk(spark, pages, starts=(("c", "/0"),)):
    table = spark.createDataFrame(pages, SCHEMA)
    rows = follow_pages(table, spark.createDataFrame(list(starts), "chain STRING, url STRING")).collect()
    return sorted((r.chain, r.page_no, r.url, r.error) for r in rows)


@pytest.mark.parametrize("n", [1, 2, 5, 17, 70])
def test_chains_of_many_lengths(spark, n):
    pages = [(f"/{i}", 200, None, linked(f"/{i + 1}") if i + 1 < n else "{}") for i in range(n)]
    assert walk(spark, pages) == [("c", i, f"/{i}", None) for i in range(n)]


def test_a_page_landed_twice_is_one_page(spark):
    pages = [("/0", 500, None, "x"), ("/0", 200, None, linked("/1")), ("/0", 200, None, linked("/1")), ("/1", 200, None, "{}")]
    assert walk(spark, pages) == [("c", 0, "/0", None), ("c", 1, "/1", None)]


def test_decoded_errors(spark):
    outcome = '{"resourceType": "OperationOutcome", "issue": [{"code": "timeout"}]}'
    table = spark.createDataFrame([("/0", 503, None, outcome), ("/1", 500, None, "gone"), ("/2", 200, None, "{}")], SCHEMA)
    starts = spark.createDataFrame([(i, f"/{i}") for i in range(3)], "chain INT, url STRING")
    rows = {r.chain: r.error_response for r in follow_pages(table, starts).collect()}
    assert rows[0].issue[0].code == "timeout" and rows[0].other_error is None
    assert rows[1].issue is None and rows[1].other_error == "gone" and rows[2] is None


@pytest.mark.parametrize("target, good", [("/a?b=%20", True), ("http://a/b", True), ("/a%2", False), ("/a%zz", False), ("/a\\u0007", False), ("a", False)])
def test_next_links_are_request_uris(spark, target, good):
    got = walk(spark, [("/0", 200, None, linked(target))])
    assert (got[0][3] is None) == good


def test_header_wins_over_body(spark):
    pages = [
        ("/0", 200, '<something>;rel="self",</1>;rel="next"', linked("/wrong")),
        ("/1", 200, '<something>;rel="self"', linked("/wrong")),
        ("/wrong", 200, None, "{}"),
    ]
    assert walk(spark, pages) == [("c", 0, "/0", None), ("c", 1, "/1", None)]


def test_bad_pages_end_the_walk(spark):
    pages = [
        ("/0", 200, None, linked("/1")), ("/1", 404, None, linked("/2")), ("/2", 200, None, "{}"),
        ("/a", 200, None, linked("/b")), ("/b", 200, None, "{"),
        ("/empty", 200, None, ""), ("/header", 200, "x", ""), ("/odd", 200, None, linked("no uri")),
    ]
    starts = [("c", "/0"), ("d", "/a"), ("e", "/empty"), ("f", "/header"), ("g", "/odd"), ("h", "/gone")]
    assert walk(spark, pages, starts) == [
        ("c", 0, "/0", None),
        ("c", 1, "/1", "request to /1 had a non-ok response status (404)"),
        ("d", 0, "/a", None),
        ("d", 1, "/b", "could not parse the response after request to /b"),
        ("e", 0, "/empty", "could not parse the response after request to /empty"),
        ("f", 0, "/header", None),
        ("g", 0, "/odd", "could not parse the next link after request to /odd"),
        ("h", 0, "/gone", "no page for /gone"),
    ]


@pytest.mark.parametrize("length", [1, 3, 9])
def test_cycles_end_before_a_repeated_page(spark, length):
    lead = [("/0", 200, None, linked("/1"))]
    ring = [(f"/{i}", 200, None, linked(f"/{i + 1 if i < length else 1}")) for i in range(1, length + 1)]
    assert walk(spark, lead + ring) == [("c", i, f"/{i}", None) for i in range(length + 1)]


def test_many_chains_share_pages(spark):
    pages = [(f"/{i}", 200, None, linked("/hub")) for i in range(50)] + [("/hub", 200, None, linked("/end")), ("/end", 200, None, "{}")]
    got = walk(spark, pages, [(f"c{i}", f"/{i}") for i in range(50)])
    assert len(got) == 150 and {u for _, n, u, _ in got if n == 2} == {"/end"}


@pytest.mark.parametrize(
    "header, target",
    [
        ('<something>;rel="self",<http://a/b?c=d>;rel="next"', "http://a/b?c=d"), ('< /x > ; rel="next" ', "/x"),
        ('</x>;rel="next";title=t', None), ('</x>;rel=next', None), ("", None), ('</a>;rel="next",</b>;rel="next"', "/a"),
    ],
)
def test_link_headers(spark, header, target):
    got = spark.createDataFrame([(header,)], "h STRING").select(next_from_link_header(F.col("h"))).first()[0]
    assert got == target


def test_chains_go_on_as_pages_arrive(spark, tmp_path):
    pages = [(f"/a{i}", 200, None, linked(f"/a{i + 1}") if i < 11 else "{}") for i in range(12)]
    pages += [("/b0", 200, None, linked("/b1")), ("/b1", 200, None, linked("/b2")), ("/b2", 200, None, linked("/b0"))]  # a cycle
    pages += [("/c0", 200, None, linked("/a7")), ("/d0", 503, None, "busy"), ("/e0", 200, None, linked("/gone"))]
    order = [5, 1, 12, 3, 0, 14, 9, 16, 2, 7, 13, 17, 15, 4, 6, 8, 11, 10]
    parts = [[pages[i] for i in order[n : n + 5]] for n in range(0, 20, 5)]
    parts += [[("/d0", 200, None, linked("/d1"))], [("/d1", 200, None, "{}")]]  # landed again without error
    starts = spark.createDataFrame([(c, f"/{c}0") for c in "abcdef"], "chain STRING, url STRING")
    target, landed = str(tmp_path / "walk"), []
    begin_walk(starts, target)

    def rows(found):
        return sorted((r.chain, r.page_no, r.url, r.error, r.body) for r in found.collect())

    for batch, part in enumerate(parts):
        landed += part
        for _ in range(2 if batch in (0, 2) else 1):  # a batch comes again
            add_pages(spark.createDataFrame(part, SCHEMA), batch, target)
        if batch in (1, 3, 5):
            table = spark.createDataFrame(landed, SCHEMA)
            assert rows(followed_pages(table, target)) == rows(follow_pages(table, starts))
