"""Publishing a directory: write aside, describe, swap in."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.sources import files

#: Description of an output, inside its directory and hidden from readers.
DESCRIPTION = "_export.json"
TEMPORARY = ".tmp"


def publish(
    df: DataFrame,
    target: str,
    write: Callable[[DataFrame, str], None],
    description: Mapping[str, str],
    keep_empty: bool = True,
) -> int:
    """Write ``df`` next to ``target`` and put it in its place; return the number of rows.

    The rows are counted by the write itself. An existing output is always replaced, so a
    run that is repeated leaves the same rows and is recognised by its description. An empty
    output is thrown away unless ``keep_empty``.
    """
    spark = df.sparkSession
    staged = f"{target}.{uuid.uuid4().hex}{TEMPORARY}"
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")), staged)
    rows = seen.get["rows"]
    if rows == 0 and not keep_empty:
        files.delete(spark, staged)
        return 0
    files.write_text(spark, f"{staged}/{DESCRIPTION}", json.dumps(dict(description)))
    files.delete(spark, target)
    files.rename(spark, staged, target)
    return rows


def described(spark, target: str) -> dict | None:
    """The description of an output, None when there is no output."""
    return files.read_json(spark, f"{target}/{DESCRIPTION}") if files.exists(spark, target) else None
