"""What servers declare in their capability documents."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def supports_interaction(capabilities: DataFrame, code: str) -> DataFrame:
    """Types a server-mode endpoint offers with an interaction, with their position in the document.

    Keeps all columns beside ``rest`` as the identity of the document.
    """
    keep = [c for c in capabilities.columns if c not in ("rest", "software")]
    endpoints = capabilities.select(*keep, F.posexplode("rest").alias("_rest_no", "_rest"))
    resources = endpoints.where(F.col("_rest.mode") == "server").select(
        *keep, "_rest_no", F.posexplode("_rest.resource").alias("_resource_no", "_resource")
    )
    offered = F.exists(F.col("_resource.interaction"), lambda i: i["code"] == code)
    return resources.where(offered).select(
        *keep,
        F.col("_resource.type").alias("resource_type"),
        F.struct(F.col("_rest_no").alias("rest"), F.col("_resource_no").alias("resource")).alias("position"),
    )


def supports_operation(rest: Column, name: str) -> Column:
    """True if a server-mode endpoint declares a system operation."""
    return F.coalesce(
        F.exists(
            rest,
            lambda r: (r["mode"] == "server")
            & F.coalesce(F.exists(r["operation"], lambda o: o["name"] == name), F.lit(False)),
        ),
        F.lit(False),
    )
