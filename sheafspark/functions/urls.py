"""Url query strings."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _decode(text):
    return F.try_url_decode(text)


def parse_query(query: Column) -> Column:
    """Ordered ``array<struct<k, v>>`` of the pairs; repeated keys keep all values.

    A pair with a bad escape or a semicolon has a null key or value.
    """
    pieces = F.filter(F.split(query, "&"), lambda piece: piece != "")

    def pair(piece):
        cut = F.locate("=", piece)
        key = F.when(cut > 0, F.substring(piece, F.lit(1), cut - 1)).otherwise(piece)
        value = F.when(cut > 0, F.substring(piece, cut + 1, F.length(piece))).otherwise(F.lit(""))
        sound = ~piece.contains(";")
        return F.struct(F.when(sound, _decode(key)).alias("k"), F.when(sound, _decode(value)).alias("v"))

    return F.transform(pieces, pair)


def query_is_valid(pairs: Column) -> Column:
    return ~F.exists(pairs, lambda p: p["k"].isNull() | p["v"].isNull())


def _encode(text):
    # the form encoder escapes "~" and keeps "*"; query strings want it the other way round
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def encode_query(pairs: Column) -> Column:
    """Form-encoded text with the keys sorted; values of one key keep their order."""
    placed = F.transform(pairs, lambda p, i: F.struct(p["k"].alias("k"), i.alias("i"), p["v"].alias("v")))
    return F.array_join(
        F.transform(F.array_sort(placed), lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&"
    )
