"""Responses of a server: results, errors and batch entries."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafspark.functions.json_text import using
from sheafspark.functions.outcomes import fmt_outcome, read_outcome
from sheafspark.sources.exact_json import read_exact


class SplitResults(NamedTuple):
    ok: DataFrame
    non_ok: DataFrame
    failed: DataFrame


def result_class(status: Column, transport_error: Column) -> Column:
    """``failed`` for a transport error, else ``ok`` for status 200 or ``non_ok``."""
    return (
        F.when(transport_error.isNotNull(), F.lit("failed"))
        .when(status == 200, F.lit("ok"))
        .otherwise(F.lit("non_ok"))
    )


def split_results(log: DataFrame) -> SplitResults:
    """Three views of a request log; the error responses come with their decoded error."""
    classed = log.withColumn("_class", result_class(F.col("status"), F.col("transport_error")))
    ok, non_ok, failed = (classed.where(F.col("_class") == c).drop("_class") for c in ("ok", "non_ok", "failed"))
    return SplitResults(ok, non_ok.withColumn("error", decode_error(F.col("error_body"))), failed)


def decode_error(body: Column) -> Column:
    """Struct of ``issue`` if the body is an outcome, else of ``other_error`` with its text."""
    return using(
        read_outcome(body),
        lambda outcome: F.struct(
            outcome["issue"].alias("issue"), F.when(~outcome["readable"], body).alias("other_error")
        ),
    )


_ENVELOPE = (
    "type STRING, entry ARRAY<STRUCT<resource: STRING, response: STRUCT<status: STRING, location: STRING, outcome: STRING>>>"
)


def unwrap_async(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Adds ``resource, location, error`` of the batch response an asynchronous request ends with, in place of the body.

    The resource is the text as written; bodies are stored when this is called, see ``read_exact``.
    """
    read = read_exact(bodies, body, _ENVELOPE, "responses")
    kept = [c for c in read.columns if c != "parsed"]
    entry = F.get("parsed.entry", F.lit(0))
    first = read.select(
        *kept, "parsed", entry["resource"].alias("_resource"), entry["response"].alias("_response"),
        read_outcome(entry["response"]["outcome"]).alias("_outcome"),
    )
    error = _response_error(F.col("parsed"), F.col("_response"), F.col("_outcome"))
    judged = first.select(*kept, "_resource", "_response.location", error.alias("error"))
    good = F.col("error").isNull()
    return judged.select(
        *kept,
        F.when(good, F.col("_resource")).alias("resource"),
        F.when(good & F.col("_resource").isNull(), F.col("location")).alias("location"),
        "error",
    )


def _response_error(bundle, response, outcome):
    kind = F.coalesce(bundle["type"], F.lit(""))
    status = F.coalesce(response["status"], F.lit(""))
    entries = F.coalesce(F.size(bundle["entry"]), F.lit(0))
    return (
        F.when(bundle.isNull(), F.lit("error while reading the async response bundle"))
        .when(
            kind != "batch-response",
            F.concat(F.lit("expected batch-response bundle but the bundle type is: "), kind),
        )
        .when(
            entries != 1,
            F.concat(
                F.lit("expected one entry in async response bundle but was "), entries.cast("string"), F.lit(" entries")
            ),
        )
        .when(response.isNull(), F.lit("missing response in bundle entry"))
        .when(
            ~status.startswith("2"),
            F.when(response["outcome"].isNull(), F.concat(F.lit("error status: "), status))
            .when(
                ~outcome["readable"],
                F.lit("error while reading the outcome of an error response in the async response bundle"),
            )
            .otherwise(fmt_outcome(outcome["issue"])),
        )
    )


def zip_by_position(requests: DataFrame, responses: DataFrame, batch: str = "batch_id", position: str = "pos") -> DataFrame:
    """Pairs the n-th response entry of a batch with the n-th request.

    Both sides are one row per entry, so a large batch spreads over its
    positions. A side without counterpart keeps nulls and gets an ``error``.
    """
    asked = requests.withColumn("_asked", F.lit(True))
    answered = responses.withColumn("_answered", F.lit(True))
    at = F.col(position).cast("string")
    return asked.join(answered, [batch, position], "full_outer").withColumn(
        "error",
        F.when(F.col("_answered").isNull(), F.concat(F.lit("missing response entry with index "), at)).when(
            F.col("_asked").isNull(), F.concat(F.lit("missing request for entry with index "), at)
        ),
    ).drop("_asked", "_answered")


def batch_totals(paired: DataFrame, position: str = "pos") -> DataFrame:
    """Adds ``total`` of the searchset each response entry carries, or an ``error`` with the entry's index.

    Expects ``response_status`` and ``resource`` next to the columns of ``zip_by_position``.
    """
    at = F.col(position).cast("string")
    error = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("response_status").isNull(), F.concat(F.lit("missing response in entry with index "), at))
        .when(
            ~F.col("response_status").startswith("200"),
            F.concat(
                F.lit("unexpected response status code "), F.col("response_status"), F.lit(" in entry with index "), at
            ),
        )
        .when(F.col("resource").isNull(), F.concat(F.lit("missing resource in entry with index "), at))
        .when(F.col("_searchset._corrupt").isNotNull(), F.concat(F.lit("could not read the searchset in entry with index "), at))
    )
    searchset = F.from_json("resource", "total BIGINT, _corrupt STRING", {"columnNameOfCorruptRecord": "_corrupt"})
    read = paired.withColumn("_searchset", searchset).withColumn("error", error)
    return read.withColumn("total", F.when(F.col("error").isNull(), F.col("_searchset.total"))).drop("_searchset")


def length_mismatches(requests: DataFrame, responses: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Batches whose number of response entries differs from the number of requests."""
    both = requests.select(batch, F.lit(1).alias("asked"), F.lit(0).alias("answered")).unionByName(
        responses.select(batch, F.lit(0).alias("asked"), F.lit(1).alias("answered"))
    )
    sums = both.groupBy(batch).agg(F.sum("asked").alias("asked"), F.sum("answered").alias("answered"))
    return sums.where(F.col("asked") != F.col("answered")).select(
        batch,
        F.concat(
            F.lit("expect "), F.col("asked").cast("string"), F.lit(" bundle entries but got "),
            F.col("answered").cast("string"),
        ).alias("error"),
    )
