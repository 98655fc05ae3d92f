"""From bundle pages to one row per resource."""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafspark.functions.json_text import compact_json, using
from sheafspark.functions.outcomes import parse_outcome, read_outcome
from sheafspark.schemas import ENTRY_TEXT, ENTRY_TYPE
from sheafspark.sources.exact_json import read_exact


class Unbundled(NamedTuple):
    resources: DataFrame
    outcomes: DataFrame
    malformed: DataFrame


def _entries(body, schema):
    """Entries by the JSON functions; null where the body is no bundle."""
    parsed = F.from_json(body, f"entry {schema}, _corrupt STRING", {"columnNameOfCorruptRecord": "_corrupt"})
    empty = F.array().cast(schema)
    entries = using(parsed, lambda p: F.when(p["_corrupt"].isNull(), F.coalesce(p["entry"], empty)))
    return F.when(body == "", empty).when(body.rlike(r"^\s*\{"), entries)


def exact_entries(pages: DataFrame, body: str) -> DataFrame:
    """Pages with ``_entries`` in place of the body, resources as exact text; null where the body is no bundle."""
    read = read_exact(pages.withColumn("_blank", F.col(body) == ""), body, f"entry {ENTRY_TEXT}", "bodies")
    empty = F.array().cast(ENTRY_TEXT)
    entries = F.when(F.col("_blank"), empty).when(F.col("parsed").isNotNull(), F.coalesce(F.col("parsed.entry"), empty))
    return read.withColumn("_entries", entries).drop("_blank", "parsed")


def is_outcome(entry):
    return F.coalesce(entry["search"]["mode"] == "outcome", F.lit(False))


def carried_types(body):
    """One ``struct<type>`` per result entry of a page; null for a malformed page.

    Decodes the type of each resource only and builds no resource text.
    """
    carried = F.filter(_entries(body, ENTRY_TYPE), lambda e: e["resource"].isNotNull() & ~is_outcome(e))
    return F.transform(carried, lambda e: F.struct(e["resource"]["resourceType"].alias("type")))


def _kinds(rows, strict, named):
    """Splits the ``_entries`` column into rows and marks each as resource, outcome or malformed."""
    broken = F.col("_entries").isNull()
    # a malformed page becomes one row without entry, or an error; a page without entries no row at all
    instead = F.array(F.lit(None)).cast(ENTRY_TEXT)
    if strict:
        instead = F.raise_error(F.concat(F.lit("could not parse the bundle entries of "), F.coalesce(named, F.lit("a page"))))
    entries = F.coalesce(F.col("_entries"), instead)
    keep = [c for c in rows.columns if c != "_entries"]
    split = rows.select(*keep, broken.alias("_broken"), F.posexplode(entries).alias("entry_no", "_entry"))
    resource = F.col("_entry.resource")
    unread = F.lit("bad_outcome")
    if strict:
        unread = F.raise_error(F.concat(F.lit("could not parse an inline outcome of "), F.coalesce(named, F.lit("a page"))))
    kind = (
        F.when(F.col("_broken"), F.lit("malformed"))
        .when(
            is_outcome(F.col("_entry")) & resource.isNotNull(),
            F.when(read_outcome(resource)["readable"], F.lit("outcome")).otherwise(unread),
        )
        .otherwise(F.lit("resource"))
    )
    routed = split.select(
        *keep,
        F.when(~F.col("_broken"), F.col("entry_no")).alias("entry_no"),
        kind.alias("kind"),
        compact_json(F.col("_entry.resource")).alias("resource"),
    )
    return routed.where(F.col("resource").isNotNull() | (F.col("kind") == "malformed"))


def route_entries(pages: DataFrame, body: str = "body", exact: bool = True, strict: bool = False, named: str | None = None) -> DataFrame:
    """Page columns plus ``entry_no, kind, resource``, one row per entry that carries a resource.

    ``kind`` is ``resource``, ``outcome`` (inline outcomes), ``bad_outcome`` (inline
    outcomes that cannot be read) or ``malformed`` (one row for a page that cannot be
    decoded); the last two are errors with ``strict``. Writing
    this table partitioned by ``kind`` yields all outputs in one pass.

    ``exact`` keeps numbers and escapes as written: bodies are stored when this is called and the JSON
    file source cuts the resources. Without it the JSON functions cut them and write numbers in their
    own way, which suffices for routing and counting.
    """
    rows = exact_entries(pages, body) if exact else pages.withColumn("_entries", _entries(F.col(body), ENTRY_TEXT)).drop(body)
    return _kinds(rows, strict, F.col(named) if named else F.lit(None).cast("string"))


def route_file_entries(entries: DataFrame, strict: bool = False) -> DataFrame:
    """The same for ``read_ndjson_entries``, whose text is exact already."""
    decoded = entries.withColumn(
        "_entries",
        F.when(F.col("corrupt").isNull(), F.coalesce(F.col("entry"), F.array().cast(ENTRY_TEXT))),
    )
    return _kinds(decoded.drop("entry", "corrupt"), strict, F.col("file"))


_ERRORS = {"malformed": "could not parse the bundle entries", "bad_outcome": "could not parse an inline outcome"}


def split_kinds(routed: DataFrame) -> Unbundled:
    error = F.create_map(*[F.lit(text) for item in _ERRORS.items() for text in item])[F.col("kind")]
    outcomes = routed.where(F.col("kind") == "outcome")
    return Unbundled(
        routed.where(F.col("kind") == "resource").drop("kind"),
        outcomes.withColumn("issue", parse_outcome(F.col("resource"))["issue"]).drop("kind"),
        routed.where(F.col("kind").isin(list(_ERRORS))).withColumn("error", error)
        .drop("kind", "entry_no", "resource"),
    )


def unbundle(pages: DataFrame, body: str = "body", exact: bool = True, strict: bool = False, named: str | None = None) -> Unbundled:
    """Resources, inline outcomes with their issues, and the errors of pages.

    The three frames come from one table; to read the pages once, write ``route_entries`` and split that.
    """
    return split_kinds(route_entries(pages, body, exact, strict, named))
