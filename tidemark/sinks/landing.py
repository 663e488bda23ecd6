"""Landing zone of a mirrored target."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.profiles import ExportProfile
from tidemark.sinks import writers
from tidemark.sources import files

#: Names of the target's own files.
METADATA = "_metadata.json"
PARTNER_EVENTS = "_partnerEvents.json"


def metadata(profile: ExportProfile) -> dict:
    """Key columns and, for CSV, the dialect of the files."""
    described: dict = {"keyColumns": ["Id"]}
    if profile.format == "csv":
        described |= {
            "fileExtension": "csv",
            "fileFormat": "csv",
            "fileFormatTypeProperties": {
                "firstRowAsHeader": True,
                "rowSeparator": profile.csv_line_end,
                "columnSeparator": ",",
                "quoteCharacter": '"',
                "escapeCharacter": '"',
                "nullValue": "",
                "encoding": "UTF-8",
            },
        }
    return described


def has_metadata(spark: SparkSession, root: str, table: str) -> bool:
    return files.exists(spark, f"{root}/{table}/{METADATA}")


def prepare_landing_zone(
    spark: SparkSession,
    root: str,
    table: str,
    profile: ExportProfile,
    initial: bool,
    partner: Mapping[str, object] | None = None,
) -> None:
    """Table directory with its metadata; the partner file is written once per zone."""
    if initial or not has_metadata(spark, root, table):
        files.write_text(spark, f"{root}/{table}/{METADATA}", json.dumps(metadata(profile), indent=2))
    if partner is not None and not files.exists(spark, f"{root}/{PARTNER_EVENTS}"):
        files.write_text(spark, f"{root}/{PARTNER_EVENTS}", json.dumps(dict(partner), indent=2, default=str))


#: Beside the numbered files: what each run put where.
RUNS = "_runs"


def _plans(spark: SparkSession, directory: str) -> list[str]:
    return [n for n in files.names(spark, f"{directory}/{RUNS}") if n.endswith(".json")]


def land_numbered(rows: DataFrame, directory: str, profile: ExportProfile, run: str) -> list[str]:
    """Add the part files of ``rows`` to ``directory`` as flat files with consecutive numbers; their names.

    Rows are written aside. Then a plan says which part gets which number, after the last number
    of the plans before it, and the parts are moved. A run that is repeated after its plan was
    written moves what is left, whatever its rows are then, and gives the same names; before that
    it starts anew, so no number is given twice or left out. An empty result adds no file. One
    run at a time may land in a directory.
    """
    spark = rows.sparkSession
    plan, staged = f"{directory}/{RUNS}/{run}.json", f"{directory}/_staged-{run}"
    parts = files.read_json(spark, plan)
    if parts is not None:
        left = set(files.output_names(spark, staged))
    else:
        files.delete(spark, staged)
        seen = Observation()
        # rebalanced, so that parts are of a good size
        writers.write(rows.hint("rebalance").observe(seen, F.count(F.lit(1)).alias("rows")), staged, profile)
        # an empty result is one part without rows
        found = [n for n in files.output_names(spark, staged) if n.startswith("part-")] if seen.get["rows"] else []
        earlier = [files.read_json(spark, f"{directory}/{RUNS}/{n}") for n in _plans(spark, directory)]
        last = max((int(name.split(".")[0]) for own in earlier for name in own), default=0)
        extension = profile.extension(profile.format) if profile.extension else profile.format
        parts = {f"{last + k:020d}.{extension.lower()}": part for k, part in enumerate(found, 1)}
        files.write_text(spark, f"{directory}/_plan-{run}.json", json.dumps(parts))
        files.rename(spark, f"{directory}/_plan-{run}.json", plan)
        left = set(found)
    files.rename_all(spark, ((f"{staged}/{part}", f"{directory}/{name}") for name, part in parts.items() if part in left))
    files.delete(spark, staged)
    return list(parts)

