"""CSV, JSON and Parquet output, shaped as a profile asks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import cols, quoted
from tidemark.operators import shape
from tidemark.operators.envelope import serialize_cells
from tidemark.plans.profiles import ExportProfile


#: Commas, doubled quotes, empty for null; blanks are kept.
_CSV = {
    "header": True, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def prepare(df: DataFrame, profile: ExportProfile) -> DataFrame:
    """The columns as the format of the target takes them."""
    df = shape.iso_offset(df)
    if profile.guid_as_text and "Id" in df.columns:
        df = shape.guid_as_string(df, ["Id"])
    if profile.format == "json":
        return shape.rehydrate_json(df)
    if profile.format == "parquet" and profile.array_columns:
        lines = {*shape.CODE_COLUMNS, *shape.EDGE_COLUMNS}
        df = shape.edges_to_text(shape.codes_to_array(df))
        df = serialize_cells(df, keep=lines)
    else:
        df = serialize_cells(df)
    return shape.escape_columns(df) if profile.escape_names else df


def write(df: DataFrame, path: str, profile: ExportProfile, mode: str = "overwrite") -> None:
    """Write prepared rows; the format decides the writer."""
    if profile.writer is not None:
        profile.writer(df, path, profile)
        return
    writers = {"csv": write_csv, "json": write_json, "parquet": write_parquet}
    writers[profile.format](df, path, profile, mode)


def write_parquet(df: DataFrame, path: str, profile: ExportProfile, mode: str = "overwrite") -> None:
    _sized(df, profile).mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, profile: ExportProfile, mode: str = "overwrite") -> None:
    """Header, commas, doubled quotes, empty for null.

    Spark's writer would turn a line feed inside a value into the line end, so any
    line end but a line feed takes lines rendered here.
    """
    df = df.select(*(_csv_text(f).alias(f.name) for f in df.schema.fields))
    if profile.csv_line_end == "\n":
        _sized(df, profile).mode(mode).options(**_CSV).csv(path)
        return
    line = F.concat_ws(",", *(_csv_cell(c) for c in cols(df.columns)))
    header = ",".join(_quote(c) for c in df.columns)
    lines = _framed(df.select(line.alias("value")), head=header)
    lines.write.mode(mode).option("lineSep", profile.csv_line_end).text(path)


def write_by(df: DataFrame, path: str, profile: ExportProfile, by: str) -> None:
    """Prepared rows as one directory for each value of ``by``, Parquet or plain CSV.

    Rebalancing splits the rows of a large value over several files and tasks.
    """
    if profile.format == "parquet":
        _sized(df.hint("rebalance", by), profile).mode("overwrite").partitionBy(by).parquet(path)
        return
    text = df.select(*(_csv_text(f).alias(f.name) for f in df.schema.fields))
    _sized(text.hint("rebalance", by), profile).mode("overwrite").options(**_CSV).partitionBy(by).csv(path)


def written_by(spark: SparkSession, path: str, profile: ExportProfile, schema: T.StructType) -> DataFrame:
    """What :func:`write_by` wrote."""
    reader = spark.read.schema(schema)
    return reader.parquet(path) if profile.format == "parquet" else reader.options(multiLine=True, **_CSV).csv(path)


def write_json(df: DataFrame, path: str, profile: ExportProfile, mode: str = "overwrite") -> None:
    """One JSON array per part file, or JSON lines; nulls are kept."""
    row = F.to_json(F.struct(*cols(df.columns)), {"ignoreNullFields": "false"})
    lines = df.select(row.alias("value"))
    if not profile.json_lines:
        lines = _framed(lines, head="[", between=",", tail="]")
    lines.write.mode(mode).text(path)


def _sized(df: DataFrame, profile: ExportProfile):
    writer = df.write
    if profile.max_records_per_file:
        writer = writer.option("maxRecordsPerFile", profile.max_records_per_file)
    return writer


def _csv_text(field: T.StructField) -> Column:
    """Booleans as True and False; other values as Spark prints them."""
    column = F.col(quoted(field.name))
    if isinstance(field.dataType, T.BooleanType):
        return F.when(column, "True").when(~column, "False")
    return column


def _csv_cell(column: Column) -> Column:
    text = F.coalesce(column.cast("string"), F.lit(""))
    doubled = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[,"\r\n]|^ | $'), doubled).otherwise(text)


def _quote(name: str) -> str:
    special = any(c in name for c in ',"\r\n') or name != name.strip(" ")
    return '"' + name.replace('"', '""') + '"' if special else name


def _framed(lines: DataFrame, head: str, between: str = "", tail: str | None = None) -> DataFrame:
    """Put ``head`` and ``tail`` around the lines of each part file.

    An empty part has no lines at all, except the first, so an empty result still
    gives one well-formed file.
    """

    def batch(values: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"value": pa.array(values, pa.string())})

    def frame(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: str | None = None
        started = TaskContext.get().partitionId() == 0
        if started:
            yield batch([head])
        for part in parts:
            values = part.column(0).to_pylist()
            if not values:
                continue
            out = [] if started else [head]
            started = True
            if held is not None:
                out.append(held + between)
            out.extend(v + between for v in values[:-1])
            held = values[-1]
            yield batch(out)
        if held is not None:
            yield batch([held])
        if tail is not None and started:
            yield batch([tail])

    return lines.mapInArrow(frame, "value string")
