"""Selecting resources by query and by history level."""

import re
from functools import reduce
from operator import and_
from urllib.parse import parse_qsl

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafspark.sources.resources import DOCUMENT


def _matches(df, field, value):
    """Equality with any of the comma-separated values.

    For a column the values are cast to its type, so the predicate reaches the
    scan; a value of another type matches nothing. A path ``$.…`` looks into the
    ``document`` of landed resources, where there is one, else into the ``resource``
    text; ``$.…:type`` compares values of that type, such as numbers.
    """
    values = value.split(",")
    if field.startswith("$"):
        path, _, kind = field.partition(":")
        kind = kind or "string"
        if DOCUMENT in df.columns:
            found = F.try_variant_get(F.col(DOCUMENT), path, kind)
        else:
            found = F.get_json_object("resource", path).try_cast(kind)
    else:
        found, kind = F.col(field), df.schema[field].dataType.simpleString()
    if kind == "string":
        return found.isin(values)
    return found.isin([F.lit(v).try_cast(kind) for v in values])


def search(
    df: DataFrame, query: str, fields: dict[str, str], resource_type: str | None = None, type_field: str = "resource_type"
) -> DataFrame:
    """Resources of a type (or all) that meet a query such as ``gender=female&city=A,B``.

    ``fields`` maps query keys to columns or to paths in resources, see ``land_resources``.
    A comma means or, a repeated key means and. ``_summary=count`` returns the
    number of matches as ``count``.
    """
    if ";" in query:
        raise ValueError("could not parse the search query: invalid semicolon separator in query")
    if re.search("%(?![0-9A-Fa-f]{2})", query):
        raise ValueError("could not parse the search query: invalid escape")
    conditions: list[Column] = []
    count_only = False
    if resource_type is not None:
        conditions.append(F.col(type_field) == resource_type)
    for key, value in parse_qsl(query, keep_blank_values=True, strict_parsing=False):
        if (key, value) == ("_summary", "count"):
            count_only = True
        elif key in fields:
            conditions.append(_matches(df, fields[key], value))
        else:
            raise ValueError(f"unknown search parameter `{key}`")
    found = df.where(reduce(and_, conditions)) if conditions else df
    return found.agg(F.count("*").alias("count")) if count_only else found


def history(
    df: DataFrame, resource_type: str | None = None, resource_id=None, type_field: str = "resource_type", id_field: str = "id"
) -> DataFrame:
    """Versions at system level, of a type, or of one instance; an id without type means system level."""
    if not resource_type:
        return df
    selected = df.where(F.col(type_field) == resource_type)
    return selected if resource_id is None else selected.where(F.col(id_field) == resource_id)
