"""Semantic version comparison."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"(0|[1-9]\d*)"
_PRE = r"(?:0|[1-9]\d*|\d*[A-Za-z-][0-9A-Za-z-]*)"
_VERSION = rf"^{_NUMBER}(?:\.{_NUMBER}(?:\.{_NUMBER}(?:-({_PRE}(?:\.{_PRE})*))?(?:\+[0-9A-Za-z-]+(?:\.[0-9A-Za-z-]+)*)?)?)?$"


def _order_key(version):
    """Struct that orders like the version: numbers, release after pre-release, pre-release fields."""
    def number(i):
        found = F.regexp_extract(version, _VERSION, i)
        return F.when(found == "", F.lit("0")).otherwise(found).cast("decimal(38,0)")

    label = F.regexp_extract(version, _VERSION, 4)
    fields = F.transform(
        F.split(label, r"\."),
        lambda f: F.struct(
            (~f.rlike(r"^\d+$")).alias("is_text"),
            F.when(f.rlike(r"^\d+$"), f.cast("decimal(38,0)")).otherwise(F.lit(0).cast("decimal(38,0)")).alias("number"),
            F.when(f.rlike(r"^\d+$"), F.lit("")).otherwise(f).alias("text"),
        ),
    )
    return F.struct(
        number(1).alias("major"), number(2).alias("minor"), number(3).alias("patch"),
        (label == "").alias("is_release"), fields.alias("label"),
    )


def version_older(version: Column, minimum: str) -> Column:
    """True if the version is valid and older; a missing or invalid one allows no conclusion."""
    older = version.rlike(_VERSION) & (_order_key(version) < _order_key(F.lit(minimum)))
    return F.coalesce(older, F.lit(False))
