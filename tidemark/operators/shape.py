"""Shape rows for a target: columns, names, types, row markers."""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.cells import (
    codes_from_json,
    edge_text,
    edges_from_json,
    nested_or_text,
)
from tidemark.functions.columns import cols, quoted
from tidemark.functions.text import guid_text, iso_text
from tidemark.operators.envelope import CHANGE_TYPE
from tidemark.operators.temporal import PERIOD
from tidemark.sources.change_logs import LOG_COLUMNS, REMOVED

ROW_MARKER = "__rowMarker__"
CODE_COLUMNS = ("Codes",)
EDGE_COLUMNS = ("OutgoingEdges", "IncomingEdges")


def entity_columns(df: DataFrame) -> DataFrame:
    """The columns of a target: ``Id`` and the payload, without log and period columns."""
    hidden = {*LOG_COLUMNS, *PERIOD}
    return df.select(
        F.col("id").alias("Id"), *cols(c for c in df.columns if c not in hidden)
    )


def export_columns(df: DataFrame, delta_mode: bool) -> DataFrame:
    """The change type is exported in delta mode only."""
    return df if delta_mode else df.drop(CHANGE_TYPE)


def skip_removed(df: DataFrame, delta_mode: bool, initial: bool) -> DataFrame:
    """The first delta export leaves out removed entities; an unknown type stays."""
    if not (delta_mode and initial and CHANGE_TYPE in df.columns):
        return df
    return df.where(~F.col(CHANGE_TYPE).eqNullSafe(REMOVED))


def row_marker(df: DataFrame, first: bool) -> DataFrame:
    """The change type as a marker in the last column: 2 for removed, 4 for all else.

    The first file has no marker.
    """
    rest = cols(c for c in df.columns if c != CHANGE_TYPE)
    if first or CHANGE_TYPE not in df.columns:
        return df.select(*rest)
    marker = F.when(F.col(CHANGE_TYPE) == REMOVED, "2").otherwise("4")
    return df.select(*rest, marker.alias(ROW_MARKER))


def escape_name(name: str) -> str:
    return re.sub("[^a-zA-Z0-9_]", "_", name)


def escape_columns(df: DataFrame) -> DataFrame:
    """Names of letters, digits and ``_`` only; names that would become equal are an error."""
    taken: dict[str, str] = {}
    for name in df.columns:
        key = escape_name(name).lower()
        if key in taken:
            raise ValueError(f"Columns '{taken[key]}' and '{name}' get the same name")
        taken[key] = name
    return df.toDF(*(escape_name(c) for c in df.columns))


def guid_as_string(df: DataFrame, columns: Collection[str], form: str = "D") -> DataFrame:
    return df.withColumns({c: guid_text(F.col(quoted(c)), form) for c in columns})


def iso_offset(df: DataFrame, columns: Collection[str] | None = None) -> DataFrame:
    """Offset times as ISO text; all TIMESTAMP columns unless named."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: iso_text(F.col(quoted(c))) for c in columns}) if columns else df


def nullable_schema(df: DataFrame) -> DataFrame:
    """Every column nullable."""
    return df.select(
        *(F.when(F.col(quoted(c)).isNotNull(), F.col(quoted(c))).alias(c) for c in df.columns)
    )


def _is_array(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.ArrayType)


def codes_to_array(df: DataFrame) -> DataFrame:
    """Code columns as an array of text, from JSON text unless they are one already."""
    stored = [c for c in CODE_COLUMNS if c in df.columns and not _is_array(df, c)]
    return df.withColumns({c: codes_from_json(F.col(c)) for c in stored}) if stored else df


def edges_to_text(df: DataFrame) -> DataFrame:
    """Edge columns as an array of one line per edge, from an array of edges or JSON text."""
    lines = {
        c: F.transform(F.col(c) if _is_array(df, c) else edges_from_json(F.col(c)), edge_text)
        for c in EDGE_COLUMNS
        if c in df.columns
    }
    return df.withColumns(lines) if lines else df


def rehydrate_json(df: DataFrame, columns: Collection[str] | None = None) -> DataFrame:
    """Text that is a JSON array or object becomes nested; all text columns unless named."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: nested_or_text(F.col(quoted(c))) for c in columns}) if columns else df
