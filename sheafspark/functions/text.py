"""Text rendering of bytes, durations, ratios and indented blocks."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Byte units in ascending order.
BYTE_UNITS = ["B", "KiB", "MiB", "GiB", "TiB", "PiB"]


def two_decimals(value: Column) -> Column:
    """Two digits after the point of a single-precision number, exact ties to the even digit.

    Java's own ``%.2f`` rounds ties up, so the rounding goes through a decimal,
    whose twelve digits tell any single-precision number from a tie.
    """
    return F.bround(value.cast("float").cast("double").cast("decimal(38,12)"), 2).cast("string")


def fmt_bytes(value: Column) -> Column:
    """Scales down while the value exceeds 1024, so 1024 itself stays ``1024.00 B``."""
    size = value.cast("float").cast("double")
    scaled, unit = size, F.lit(" B")
    for power, name in enumerate(BYTE_UNITS[1:], start=1):
        larger = size > F.lit(1024.0**power)
        # a division by a power of two is exact, so one step equals repeated ones
        scaled = F.when(larger, size / F.lit(1024.0**power)).otherwise(scaled)
        unit = F.when(larger, F.lit(f" {name}")).otherwise(unit)
    return F.concat(two_decimals(scaled), unit)


def duration_text(ms: Column) -> Column:
    """Whole milliseconds as ``1h0m0s``, ``1m2.5s``, ``2.8s``, ``512ms`` or ``0s``."""
    size = F.abs(ms.cast("bigint"))
    whole = F.floor(size / 1000)
    # trailing zeros go, and the point with them if nothing remains
    fraction = F.rtrim(F.concat(F.lit("."), F.lpad((size % 1000).cast("string"), 3, "0")), F.lit("0."))
    clock = F.concat(
        F.when(whole >= 3600, F.concat(F.floor(whole / 3600).cast("string"), F.lit("h"))).otherwise(F.lit("")),
        F.when(whole >= 60, F.concat((F.floor(whole / 60) % 60).cast("string"), F.lit("m"))).otherwise(F.lit("")),
        (whole % 60).cast("string"),
        fraction,
        F.lit("s"),
    )
    text = (
        F.when(size == 0, F.lit("0s"))
        .when(size < 1000, F.concat(size.cast("string"), F.lit("ms")))
        .otherwise(clock)
    )
    return F.when(ms < 0, F.concat(F.lit("-"), text)).otherwise(text)


def fmt_duration(ms: Column) -> Column:
    """Millisecond precision under a minute, second precision from a minute on."""
    ms = ms.cast("bigint")
    to_second = F.floor((ms + 500) / 1000).cast("bigint") * 1000
    return duration_text(F.when(ms < 60000, ms).otherwise(to_second))


def indent_except_first(spaces: int, text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit("\n" + " " * spaces))


def indent(spaces: int, text: Column) -> Column:
    return F.concat(F.lit(" " * spaces), indent_except_first(spaces, text))


def ratio(count: Column, total: Column) -> Column:
    """Percentage in single precision; null for an empty total."""
    percent = (count * 100).cast("float") / F.nullif(total, F.lit(0)).cast("float")
    return percent.cast("float")


def fmt_ratio(percent: Column) -> Column:
    return F.concat(two_decimals(percent), F.lit(" %"))


def success_ratio(total: Column, *failures: Column) -> Column:
    """Share of the total without the failures, in percent, single precision."""
    good = reduce(lambda left, right: left - right, failures, total)
    share = (good.cast("float") / F.nullif(total, F.lit(0)).cast("float")).cast("float")
    return share * F.lit(100).cast("float")
