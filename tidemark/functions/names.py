"""Output names from patterns such as ``{StreamId:N}_{DataTime:yyyyMMdd}.{OutputFormat}``.

A pattern is the same for all rows of a stream, so it is compiled once, on the
driver, into one column expression.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import ISO_ROUND_TRIP, guid_text

#: Fixed value: what a placeholder looks like.
_PLACEHOLDER = re.compile(r"\{(DataTime|StreamId|ContainerName|OutputFormat)(?::([a-zA-Z0-9\-._]+))?\}")

#: Standard one-letter time formats and their patterns.
_STANDARD = {
    "o": ISO_ROUND_TRIP,
    "O": ISO_ROUND_TRIP,
    "s": "yyyy-MM-dd'T'HH:mm:ss",
    "u": "yyyy-MM-dd HH:mm:ss'Z'",
    "d": "MM/dd/yyyy",
    "D": "EEEE, dd MMMM yyyy",
    "t": "HH:mm",
    "T": "HH:mm:ss",
    "g": "MM/dd/yyyy HH:mm",
    "G": "MM/dd/yyyy HH:mm:ss",
    "f": "EEEE, dd MMMM yyyy HH:mm",
    "F": "EEEE, dd MMMM yyyy HH:mm:ss",
    "m": "MMMM dd",
    "M": "MMMM dd",
    "r": "EEE, dd MMM yyyy HH:mm:ss 'GMT'",
    "R": "EEE, dd MMM yyyy HH:mm:ss 'GMT'",
    "y": "yyyy MMMM",
    "Y": "yyyy MMMM",
}

#: Custom time codes and their Spark codes. Times are UTC.
_CODES = {
    "yyyy": "yyyy", "yy": "yy", "MMMM": "MMMM", "MMM": "MMM", "MM": "MM", "M": "M",
    "dddd": "EEEE", "ddd": "EEE", "dd": "dd", "d": "d",
    "HH": "HH", "H": "H", "hh": "hh", "h": "h", "mm": "mm", "m": "m", "ss": "ss", "s": "s",
    "tt": "a", "zzz": "xxx", "K": "xxx",
}

_CASES = {"toupper": F.upper, "toupperinvariant": F.upper, "tolower": F.lower, "tolowerinvariant": F.lower}


def time_pattern(code: str) -> str:
    """The Spark pattern of a time format; a letter without a meaning stands for itself."""
    if len(code) == 1:
        if code not in _STANDARD:
            raise ValueError(f"Time format '{code}' is not supported")
        return _STANDARD[code]
    parts = []
    for run in re.finditer(r"([A-Za-z])\1*|.", code):
        text = run.group()
        if text in _CODES:
            parts.append(_CODES[text])
        elif set(text) == {"f"} and len(text) <= 7:
            parts.append("S" * len(text))
        elif text[0] in "yMdHhmsftzKgF":
            raise ValueError(f"Time format '{text}' is not supported")
        else:
            parts.append(f"'{text}'")
    return "".join(parts)


def expand_pattern(
    pattern: str, stream_id: Column, container_name: Column, data_time: Column, output_format: Column
) -> Column:
    """The name a pattern gives. A format after ContainerName has no effect."""

    def value(kind: str, form: str | None) -> Column:
        if kind == "DataTime":
            return F.date_format(data_time.cast("timestamp"), time_pattern(form or "o"))
        if kind == "StreamId":
            return guid_text(stream_id, form or "D")
        if kind == "ContainerName":
            return container_name
        if form is None:
            return output_format
        if form.lower() not in _CASES:
            raise ValueError(f"Format '{form}' is not supported")
        return _CASES[form.lower()](output_format)

    parts, end = [], 0
    for found in _PLACEHOLDER.finditer(pattern):
        if found.start() > end:
            parts.append(F.lit(pattern[end : found.start()]))
        parts.append(value(*found.groups()))
        end = found.end()
    if end < len(pattern) or not parts:
        parts.append(F.lit(pattern[end:]))
    return F.concat(*parts)


def default_name(stream_id: Column, data_time: Column, extension: Column, form: str = "N") -> Column:
    """``{StreamId}_{yyyyMMddHHmmss}.{extension}``."""
    stamp = F.date_format(data_time.cast("timestamp"), "yyyyMMddHHmmss")
    return F.concat(guid_text(stream_id, form), F.lit("_"), stamp, F.lit("."), extension)


def sub_directory(
    pattern: str | None,
    stream_id: Column,
    container_name: Column,
    data_time: Column,
    output_format: Column,
) -> Column:
    """Directory or table name: the pattern, or the bare stream id without one."""
    if pattern and pattern.strip():
        return expand_pattern(pattern, stream_id, container_name, data_time, output_format)
    return guid_text(stream_id, "N")
