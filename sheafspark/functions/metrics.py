"""Display text of typed report values."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheafspark.functions.text import fmt_bytes


def fmt_quantity(value: Column, unit: Column, code: Column) -> Column:
    """``value`` is the decimal as text; the unit shown is the code, else the unit."""
    shown = F.coalesce(code, unit, F.lit(""))
    text = F.coalesce(value, F.lit(""))
    rate = value.try_cast("double")
    return (
        F.when(
            shown == "By/s",
            F.when(rate.isNotNull(), F.concat(fmt_bytes(rate), F.lit("/s"))).otherwise(F.concat(value, F.lit(" B/s"))),
        )
        .when(shown == "us", F.concat(text, F.lit(" µs")))
        .when(shown == "", text)
        .when(shown.startswith("/"), F.concat(text, shown))
        .otherwise(F.concat(text, F.lit(" "), shown))
    )


def fmt_param_value(quantity: Column, boolean: Column, decimal: Column, code: Column, string: Column) -> Column:
    """First value present of quantity, boolean, decimal, code and string."""
    return F.when(
        quantity.isNotNull(), fmt_quantity(quantity["value"], quantity["unit"], quantity["code"])
    ).otherwise(
        F.coalesce(
            F.when(boolean, F.lit("yes")).when(~boolean, F.lit("no")),
            decimal,
            code,
            string,
            F.lit("<unknown>"),
        )
    )
