"""Cell values: declared types, JSON text, edges as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import quoted
from tidemark.sources.entities import EDGE_TYPE

#: Declared property type to column type. TINYINT is signed, so a byte widens.
DECLARED_TYPES = {
    "bool": "boolean",
    "byte": "smallint",
    "short": "smallint",
    "int": "int",
    "long": "bigint",
    "float": "float",
    "double": "double",
    "decimal": "decimal(38,10)",
    "DateTime": "timestamp_ntz",
    "DateTimeOffset": "timestamp",
    "TimeSpan": "string",
    "Guid": "string",
    "string": "string",
}


def column_type(declared: str) -> str:
    """Column type of a declared property type; nullability is stripped, unknown is text.

    ``decimal(p,s)`` keeps its precision and scale.
    """
    name = declared.strip()
    if name.startswith("Nullable<") and name.endswith(">"):
        name = name[len("Nullable<") : -1]
    name = name.rstrip("?")
    return name if name.startswith("decimal(") else DECLARED_TYPES.get(name, "string")


def json_time(ts: Column) -> Column:
    """A time as JSON writes it: the fraction without trailing zeros, none when zero."""
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(text, r"\.?0*$", "")


def cell_text(field: T.StructField) -> Column | None:
    """JSON text of a nested column; None where the column passes as it is."""
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.col(quoted(field.name)), {"ignoreNullFields": "false"})
    return None


def codes_from_json(text: Column) -> Column:
    return F.from_json(text, "array<string>")


def edges_from_json(text: Column) -> Column:
    return F.from_json(text, f"array<{EDGE_TYPE}>")


def edge_text(edge: Column) -> Column:
    """An edge as one line; a null part is empty and null properties count zero."""

    def end(side: str) -> Column:
        return F.concat(
            F.coalesce(edge[side]["Name"], F.lit("")), F.lit("§C:"), F.coalesce(edge[side]["Code"]["Key"], F.lit(""))
        )

    return F.concat(
        F.lit("EdgeType: "), F.coalesce(edge["EdgeType"]["Code"], F.lit("")),
        F.lit("; From: "), end("FromReference"),
        F.lit("; To: "), end("ToReference"),
        F.lit("; Properties: "), F.coalesce(F.size(edge["Properties"]), F.lit(0)).cast("string"),
    )


def _parsed(text: Column) -> Column:
    """The JSON array or object in a text, else null; other text is not parsed at all."""
    return F.when(text.rlike(r"^\s*[\[{]"), F.try_parse_json(text))


def json_kind(text: Column) -> Column:
    """``array`` or ``object`` when the text is such JSON, else ``text``; null for null."""
    return (
        F.when(text.isNull(), None)
        .when(_parsed(text).isNull(), "text")
        .otherwise(F.when(text.rlike(r"^\s*\["), "array").otherwise("object"))
    )


def nested_or_text(text: Column) -> Column:
    """A variant: nested for JSON arrays and objects, the text itself otherwise."""
    return F.coalesce(_parsed(text), text.cast(T.VariantType()))
