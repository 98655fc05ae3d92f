"""JSON texts of a column read with string fields kept as they are written.

The JSON functions rewrite the numbers and escapes of a nested value that they hand out as a string. The JSON file source
does not: it cuts the value out of the line. So texts are landed, one line each, and read again by the file source.
"""

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, StructType, TimestampType

from sheafspark.storage import scratch_path

#: Ends a landed line; no valid JSON text holds this character.
_LINE_END = "\x1e"
#: Levels of nesting of a text that is read.
MAX_DEPTH = 100_000
# strict JSON: what other readers refuse is refused here, too
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "maxNestingDepth": str(MAX_DEPTH + 10)}


def _packed(value: Column, kind: DataType) -> Column:
    """A value as text that gives the same value again."""
    if isinstance(kind, TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, BinaryType):
        return F.base64(value)
    return F.to_variant_object(value).cast("string") if kind.typeName() in ("struct", "array", "map") else value.cast("string")


def _unpacked(text: Column, kind: DataType) -> Column:
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(text.cast("long"))
    if isinstance(kind, BinaryType):
        return F.unbase64(text)
    return F.from_json(text, kind) if kind.typeName() in ("struct", "array", "map") else text.cast(kind)


def read_exact(rows: DataFrame, text: str, fields: str, label: str = "json") -> DataFrame:
    """The columns of ``rows`` without ``text``, and ``parsed``, a struct of ``fields`` of the JSON object in ``text``.

    ``fields`` is a schema; values that it calls strings are the text as written. ``parsed`` is null unless the whole
    text is one JSON object that has the types of the schema where it has its fields. The texts are written to the
    shared folder when this is called, so ``rows`` is computed once, and nothing is shuffled. Columns of nested types
    pass through JSON themselves.
    """
    spark = rows.sparkSession
    # an unknown name: no text can close the list it stands in and go on as if it were the rest of the line
    mark = f"m{uuid.uuid4().hex}"
    kept = [f for f in rows.schema.fields if f.name != text]
    packed = [_packed(F.col(f"`{f.name}`"), f.dataType).alias(f"c{n}") for n, f in enumerate(kept)]
    head = F.to_json(F.struct(*packed)) if kept else F.lit("{}")
    body = F.col(f"`{text}`")
    body = F.when(body.rlike(r"^[ \t\r\n]*\{"), F.translate(body, _LINE_END, "\x01")).otherwise("null")
    # the line feed tells where the head of a line that does not parse ends
    line = F.concat(F.lit('{"kept":'), head, F.lit(f'\n,"{mark}":['), F.coalesce(body, F.lit("null")), F.lit(f',{{"{mark}":true}}]}}'))
    path = scratch_path(spark, label)
    rows.select(line.alias("value")).write.option("lineSep", _LINE_END).option("compression", "lz4").text(path)

    schema = StructType.fromDDL(fields)
    head_schema = StructType.fromDDL("kept STRUCT<" + ", ".join(f"c{n}: STRING" for n in range(max(1, len(kept)))) + ">")
    line_schema = StructType.fromDDL(f"{mark} ARRAY<STRUCT<{mark}: BOOLEAN>>, corrupt STRING")
    line_schema[mark].dataType.elementType.fields.extend(schema.fields)
    reader = spark.read.options(**_STRICT, lineSep=_LINE_END, columnNameOfCorruptRecord="corrupt")
    lines = reader.schema(StructType([*head_schema.fields, *line_schema.fields])).json(path)
    first, last = F.get(mark, F.lit(0)), F.get(mark, F.lit(1))[mark]
    whole = F.col("corrupt").isNull() & (F.size(mark) == 2) & last & first.isNotNull()
    broken_head = F.from_json(F.concat(F.substring_index("corrupt", "\n", 1), F.lit("}")), head_schema)["kept"]
    lines = lines.select(
        F.when(F.col("corrupt").isNull(), F.col("kept")).otherwise(broken_head).alias("kept"),
        F.when(whole, F.struct(*[first[f.name].alias(f.name) for f in schema.fields])).alias("parsed"),
    )
    columns = [_unpacked(F.col(f"kept.c{n}"), f.dataType).alias(f.name) for n, f in enumerate(kept)]
    return lines.select(*columns, "parsed")
