"""Identifiers, ISO times and names as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: ISO 8601 round-trip text, seven fraction digits and an offset.
ISO_ROUND_TRIP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSxxx"


def instant(value: str) -> Column:
    """A UTC instant literal; a plain literal, so it can be pushed into a scan."""
    return F.expr(f"TIMESTAMP_NTZ '{value}'")


def iso_text(ts: Column, offset: str = "+00:00") -> Column:
    """A UTC instant as ISO text with seven fraction digits, at an offset."""
    if offset == "+00:00":
        return F.date_format(ts.cast("timestamp"), ISO_ROUND_TRIP)
    local = F.from_utc_timestamp(ts.cast("timestamp"), offset)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSS"), F.lit(offset))


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since 1970-01-01 UTC."""
    return F.unix_millis(ts.cast("timestamp"))


def guid_from(text: Column) -> Column:
    """A stable GUID made from the MD5 of a key."""
    digest = F.md5(text)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *(F.substring(digest, start, length) for start, length in cuts))


def guid_text(guid: Column, form: str = "D") -> Column:
    """A GUID in one of the forms D (hyphens), N (bare), B (braces), P (parentheses).

    Text that is no GUID stays as it is.
    """
    text = guid.cast("string")
    plain = F.lower(F.regexp_replace(text, "[-{}()]", ""))
    hyphened = F.regexp_replace(
        plain, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )
    forms = {
        "N": plain,
        "D": hyphened,
        "B": F.concat(F.lit("{"), hyphened, F.lit("}")),
        "P": F.concat(F.lit("("), hyphened, F.lit(")")),
    }
    if form.upper() not in forms:
        raise ValueError(f"GUID form '{form}' is not supported")
    return F.when(plain.rlike("^[0-9a-f]{32}$"), forms[form.upper()]).otherwise(text)
