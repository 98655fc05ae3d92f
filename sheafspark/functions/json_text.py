"""JSON text kept as written: whitespace removal."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A string literal, or a run of whitespace between tokens. All quantifiers are
# possessive: Java then matches long strings in a loop instead of recursing.
_STRING_OR_SPACE = r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|[ \t\r\n]++'


def using(value: Column, build) -> Column:
    """``build(value)`` with the value computed once, however often it is used.

    The optimizer repeats an expression for each field taken from its struct; a lambda variable stays one.
    """
    return F.get(F.transform(F.array(value), build), F.lit(0))


def compact_json(text: Column) -> Column:
    """Drops insignificant whitespace; numbers, escapes and key order stay untouched."""
    return F.regexp_replace(text, _STRING_OR_SPACE, "$1")
