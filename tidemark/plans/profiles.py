"""What a target expects of an export."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

Hook = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class ExportProfile:
    """Options of a target and the points where a caller can change an export."""

    output_format: str = "json"
    guid_as_text: bool = False
    escape_names: bool = False
    array_columns: bool = False
    delta_mode: bool = False
    overwrite: bool = True
    stream_cache: bool = True
    use_current_time: bool = False
    stream_id_form: str = "N"
    name_pattern: str | None = None
    #: Directory of a mirrored table, or name of a loaded table, as a pattern.
    table_name: str | None = None
    mirror: bool = False
    load_table: bool = False
    allow_empty: bool = True
    csv_line_end: str = "\n"
    json_lines: bool = False
    max_records_per_file: int = 0
    #: Extension points: columns, file extension, writer, step after the export.
    fields: Hook | None = None
    extension: Callable[[str], str] | None = None
    writer: Callable[[DataFrame, str, ExportProfile], None] | None = None
    after: Callable[[SparkSession, str, DataFrame], None] | None = None

    def __post_init__(self) -> None:
        if self.output_format.strip().lower() not in ("csv", "json", "parquet"):
            raise ValueError(f"Format '{self.output_format}' is not supported")
        if self.mirror and self.format not in ("csv", "parquet"):
            raise ValueError("A mirrored target takes CSV or Parquet")
        if self.load_table and (self.format not in ("csv", "parquet") or not self.escape_names):
            raise ValueError("Loading a table needs CSV or Parquet and escaped names")

    @property
    def format(self) -> str:
        return self.output_format.strip().lower()

    def with_options(self, **options) -> ExportProfile:
        return replace(self, **options)

    @classmethod
    def azure(cls, **options) -> ExportProfile:
        return cls(**{"stream_id_form": "D", **options})

    @classmethod
    def onelake(cls, **options) -> ExportProfile:
        return cls(**{"guid_as_text": True, "escape_names": True, **options})

    @classmethod
    def mirrored(cls, **options) -> ExportProfile:
        fixed = {
            "guid_as_text": True, "escape_names": True, "array_columns": False, "delta_mode": True,
            "overwrite": False, "stream_cache": True, "mirror": True, "allow_empty": False,
            "name_pattern": None, "csv_line_end": "\r\n",
        }
        return cls(**{"output_format": "parquet", **options, **fixed})

    @classmethod
    def notebook(cls, **options) -> ExportProfile:
        """The notebook platforms, which share one set of defaults."""
        return cls(**{**options, "guid_as_text": True, "escape_names": True})

    databricks = synapse = ai_studio = notebook
