"""Next-page links from headers and bodies."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheafspark.functions.json_text import using
from sheafspark.schemas import LINKS


def next_from_link_header(header: Column) -> Column:
    """Target of the first ``<url>;rel="next"`` element with exactly two parts."""
    parts = F.transform(F.split(header, ","), lambda link: F.split(link, ";"))
    following = F.filter(
        parts, lambda p: (F.size(p) == 2) & (F.regexp_replace(F.get(p, F.lit(1)), r"^\s+|\s+$", "") == 'rel="next"')
    )
    return F.btrim(F.get(F.get(following, F.lit(0)), F.lit(0)), F.lit("<> "))


def next_from_links(links: Column) -> Column:
    """Url of the first body link with the relation ``next``."""
    return F.get(F.filter(links, lambda link: link["relation"] == "next"), F.lit(0))["url"]


def next_from_body(body: Column) -> Column:
    """Struct ``(url, readable)`` of the next link in a body and whether the body is a JSON object."""
    parsed = F.from_json(body, f"link {LINKS}, _corrupt STRING", {"columnNameOfCorruptRecord": "_corrupt"})
    is_object = F.coalesce(body.rlike(r"^\s*\{"), F.lit(False))
    return using(
        parsed,
        lambda p: F.struct(
            next_from_links(p["link"]).alias("url"),
            (is_object & p["_corrupt"].isNull()).alias("readable"),
        ),
    )


def is_request_uri(url: Column) -> Column:
    """Absolute uri or absolute path, the two forms a next link may take, without control characters and broken escapes."""
    return url.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:|/)(?:[^\x00-\x1f\x7f%]|%[0-9A-Fa-f]{2})*+$")
