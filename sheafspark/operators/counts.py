"""Resources per type."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafspark.operators.capabilities import supports_interaction
from sheafspark.operators.unbundle import carried_types

TOTAL = "total"


def page_types(pages: DataFrame, body: str = "body") -> DataFrame:
    """``resource_type`` of every result entry, straight from the pages."""
    # the outer form keeps the optimizer from parsing each body a second time to find empty pages
    rows = pages.select(F.explode_outer(carried_types(F.col(body))).alias("entry"))
    return rows.where(F.col("entry").isNotNull()).select(F.col("entry.type").alias("resource_type"))


def resource_types(resources: DataFrame, resource: str = "resource") -> DataFrame:
    return resources.select(F.get_json_object(resource, "$.resourceType").alias("resource_type"))


def restrict_to_types(rows: DataFrame, capabilities: DataFrame, code: str = "search-type") -> DataFrame:
    """Rows whose ``resource_type`` offers the interaction."""
    return rows.join(supports_interaction(capabilities, code).select("resource_type"), "resource_type", "left_semi")


def count_resources(types: DataFrame, capabilities: DataFrame | None = None, by_name: bool = False) -> DataFrame:
    """``(place, resource_type, count)`` per type, the grand total last.

    Rows are counted before they meet the capability document, so the join sees
    one row per type. Types come in the order of the document, else by name.
    """
    counts = types.groupBy("resource_type").agg(F.count("*").alias("count"))
    return with_total(counts, capabilities, by_name)


def with_total(counts: DataFrame, capabilities: DataFrame | None = None, by_name: bool = False) -> DataFrame:
    """Orders counts per type, leaves out zeros and appends the total."""
    if capabilities is None:
        counts = counts.withColumn("position", F.lit(0))
    else:
        offered = supports_interaction(capabilities, "search-type")
        places = offered.groupBy("resource_type").agg(F.min("position").alias("position"))
        counts = counts.join(places, "resource_type")
    # the sets run over one row per type
    totals = counts.groupingSets(
        [[F.col("resource_type"), F.col("position")], []], F.col("resource_type"), F.col("position")
    ).agg(F.sum("count").alias("count"), F.grouping("resource_type").alias("is_total"))
    order = Window.orderBy("is_total", *([] if by_name else ["position"]), "resource_type")
    return (
        totals.where((F.col("count") != 0) | (F.col("is_total") == 1))
        .select(
            F.row_number().over(order).alias("place"),
            F.when(F.col("is_total") == 1, F.lit(TOTAL)).otherwise(F.col("resource_type")).alias("resource_type"),
            F.coalesce(F.col("count"), F.lit(0)).alias("count"),
        )
        .orderBy("place")
    )


def render_counts(counts: DataFrame) -> DataFrame:
    """``(line_no, line)``: aligned counts, a bar, and the total; one input row per type."""
    everything = Window.partitionBy()
    name_width = F.max(F.when(F.col("resource_type") != TOTAL, F.length("resource_type"))).over(everything)
    count_width = F.max(F.length(F.col("count").cast("string"))).over(everything)
    is_total = F.col("resource_type") == TOTAL
    rows = counts.select(
        "place",
        "resource_type",
        F.col("count").cast("string").alias("text"),
        F.greatest(F.coalesce(name_width, F.lit(0)), F.length("resource_type")).alias("pad"),
        F.coalesce(name_width, F.lit(0)).alias("width"),
        count_width.alias("digits"),
        is_total.alias("is_total"),
    )
    line = F.concat(
        F.rpad("resource_type", F.col("pad"), F.lit(" ")), F.lit(" : "), F.lpad("text", F.col("digits"), F.lit(" "))
    )
    bar = F.repeat(F.lit("-"), F.col("width") + F.col("digits") + 3)
    lines = F.when(F.col("is_total"), F.array(bar, line)).otherwise(F.array(line))
    numbered = rows.select("place", F.posexplode(lines).alias("part", "line"))
    order = Window.orderBy("place", "part")
    return numbered.select(F.row_number().over(order).alias("line_no"), "line")
