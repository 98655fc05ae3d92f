"""Walking next-page links over landed pages."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafspark.functions.json_text import using
from sheafspark.functions.links import is_request_uri, next_from_body, next_from_link_header
from sheafspark.operators.responses import decode_error
from sheafspark.storage import written_table

# Factor by which a round extends the walked distance.
FAN = 4


def _with_links(pages: DataFrame, url: str) -> DataFrame:
    """The pages with ``_link``, a struct of ``next_url`` and ``error``."""
    header = F.coalesce(F.col("link_header"), F.lit(""))
    by_header = F.struct(next_from_link_header(header).alias("url"), F.lit(True).alias("readable"))
    link = F.when(header != "", by_header).otherwise(next_from_body(F.col("body")))
    at = F.col(url)

    def judged(link):
        error = (
            F.when(
                F.col("status") != 200,
                F.concat(
                    F.lit("request to "), at, F.lit(" had a non-ok response status ("), F.col("status").cast("string"), F.lit(")")
                ),
            )
            .when(~link["readable"], F.concat(F.lit("could not parse the response after request to "), at))
            .when(
                ~is_request_uri(link["url"]), F.concat(F.lit("could not parse the next link after request to "), at)
            )
        )
        return F.struct(F.when(error.isNull(), link["url"]).alias("next_url"), error.alias("error"))

    # one column of two fields, so a body is decoded once for both
    return pages.withColumn("_link", using(link, judged))


def page_links(pages: DataFrame, url: str = "request_url") -> DataFrame:
    """``(url, next_url, error)`` per page.

    A non-empty link header decides alone; the body is decoded only without one.
    """
    return _with_links(pages, url).select(F.col(url).alias("url"), F.inline(F.array("_link")))


def follow_pages(pages: DataFrame, starts: DataFrame, url: str = "request_url") -> DataFrame:
    """``(chain, page_no, url, error, error_response, ...page columns)`` of the pages each chain reaches.

    ``starts`` has ``(chain, url)``. Page 0 is the start; the walk ends at a page
    without next link, at a bad page (its row has an ``error``), at a url nobody
    landed, or before a page the chain has already shown. A url landed several times
    is one page: a landing without error, if there is one. ``error_response`` is the
    decoded body of a page with a status other than 200.

    Pointer jumping: a round hops several times along stored links, and then replaces
    the links by ones that reach as far, so a chain of n pages takes log n rounds over
    (url, next url) pairs. Page bodies join once at the end.
    """
    links = written_table(chosen_landings(pages, url), "page-links")
    places = starts.select("chain", "url", F.lit(0).cast("bigint").alias("page_no")).distinct()
    reached = walk(places, links)
    return with_pages(reached, links, pages, url)


def walk(places: DataFrame, links: DataFrame) -> DataFrame:
    """The places ``(chain, url, page_no)`` and all that chains reach from there along stored links, each url once."""
    hops = links.where(F.col("next_url").isNotNull()).select("url", F.col("next_url").alias("target"))
    reached = written_table(places, "reached-pages")
    known, step = reached.count(), 1
    while True:
        further = [reached]
        for _ in range(FAN - 1):
            further.append(
                further[-1].join(hops, "url").select(
                    "chain", F.col("target").alias("url"), (F.col("page_no") + step).alias("page_no")
                )
            )
        # a page reached again keeps its first place, so the walk of a cycle stops growing
        joined = reduce(DataFrame.unionByName, further).groupBy("chain", "url")
        reached = written_table(joined.agg(F.min("page_no").alias("page_no")), "reached-pages")
        now = reached.count()
        if now == known:
            break
        known, step = now, step * FAN
        ahead = hops.select(F.col("url").alias("target"), F.col("target").alias("after"))
        jumps = hops
        for _ in range(FAN - 1):
            jumps = jumps.join(ahead, "target").select("url", F.col("after").alias("target"))
        hops = written_table(jumps, "page-hops")
    return reached


def chosen_landings(pages: DataFrame, url: str = "request_url") -> DataFrame:
    """``(url, next_url, error, digest, landings)``: of a page landed several times one, without error if there is one.

    Bodies are decoded here only; what is shuffled are urls and the digest that finds the page again.
    """
    said = _with_links(pages, url).select(F.col(url).alias("url"), "_link.*", _digest(pages).alias("digest"))
    best = said.groupBy("url").agg(F.min(F.struct("error", "next_url", "digest")).alias("best"), F.count("*").alias("landings"))
    return best.select("url", "best.next_url", "best.error", "best.digest", "landings")


def _digest(pages: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in pages.columns])


def with_pages(reached: DataFrame, links: DataFrame, pages: DataFrame, url: str = "request_url") -> DataFrame:
    """The rows of ``follow_pages`` for the places ``(chain, url, page_no)`` that chains have reached."""
    found = reached.join(links.withColumn("_landed", F.lit(True)), "url", "left")
    missing = found.where(F.col("_landed").isNull()).select("chain", "page_no", "url")
    missing = missing.withColumn("error", F.concat(F.lit("no page for "), F.col("url")))
    landed = found.where(F.col("_landed")).select("chain", "page_no", "url", "error", "digest", "landings")
    landed = written_table(landed, "landed-pages")
    details = [c for c in pages.columns if c not in (url, "chain", "page_no", "url", "error", "error_response")]
    content = pages.select(F.col(f"`{url}`").alias("url"), _digest(pages).alias("digest"), F.struct(*details).alias("_page"))
    shown = landed.where("landings = 1").join(content, ["url", "digest"]).select("url", "chain", "page_no", "error", "_page")
    again = landed.where("landings > 1")
    if not again.isEmpty():  # the same page may have landed twice as it is; one of those
        several = content.join(again, ["url", "digest"])
        shown = shown.unionByName(several.groupBy("url", "chain", "page_no", "error").agg(F.first("_page").alias("_page")))
    bad = F.col("status") != 200
    one = shown.select("chain", "page_no", "url", "error", "_page.*")
    one = one.withColumn("error_response", F.when(bad & F.col("error").isNotNull(), decode_error(F.col("body"))))
    return one.unionByName(missing, allowMissingColumns=True).select("chain", "page_no", "url", "error", "error_response", *details)
