"""From an entity change to a wide row with system columns."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cells import cell_text, column_type, json_time
from tidemark.functions.columns import cols, quoted
from tidemark.functions.text import epoch_millis, iso_text
from tidemark.operators.joins import join_lookup
from tidemark.sources.entities import EDGE_TYPE, code_text

CHANGE_TYPE = "__ChangeType__"
#: What an entity change brings besides its log columns; the envelope replaces it.
RAW_COLUMNS = (
    "persist_hash", "persist_version", "origin_entity_code", "entity_type",
    "properties", "codes", "outgoing_edges", "incoming_edges",
)


def codes(entities: DataFrame) -> Column:
    """Entity codes as an array of text, empty when there are none."""
    text = F.transform("codes", lambda c: code_text(c["type"], c["origin"], c["value"]))
    return F.coalesce(text, F.array().cast("array<string>"))


def apply_types(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Give columns their declared types; text that does not parse becomes null.

    Vocabulary keys are declared as text, whatever type their vocabulary has.
    """
    return df.withColumns(
        {name: F.col(quoted(name)).try_cast(column_type(kind)) for name, kind in declared.items()}
    )


#: Names of the columns whose text did not parse.
UNPARSED = "unparsed"


def parse_types(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """:func:`apply_types`, with the names of the columns whose text isn't null and does not parse.

    ``split_unparsed`` tells such rows from the others; they keep their text in ``as_given``.
    """
    typed = {name: F.col(quoted(name)).try_cast(column_type(kind)) for name, kind in declared.items()}
    failed = F.array_compact(
        F.array(*(F.when(F.col(quoted(n)).isNotNull() & t.isNull(), F.lit(n)) for n, t in typed.items()), F.lit(None).cast("string"))
    )
    given = F.struct(*(F.col(quoted(n)).cast("string").alias(n) for n in declared))
    rows = df.withColumns({UNPARSED: failed, "as_given": F.when(F.size(failed) > 0, F.to_json(given))})
    return rows.withColumns(typed)


def split_unparsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that parsed, and the others to be kept aside with what failed and their text as JSON."""
    fits = parsed.where(F.size(UNPARSED) == 0).drop(UNPARSED, "as_given")
    return fits, parsed.where(F.size(UNPARSED) > 0)


def with_event_time(
    df: DataFrame, now: Column, properties: str = "properties", offset: str = "+00:00"
) -> DataFrame:
    """``Timestamp`` (ISO text) and ``Epoch`` (ms), where the change brings none itself."""
    columns = {}
    for name, default in (("Timestamp", iso_text(now, offset)), ("Epoch", epoch_millis(now))):
        if name in df.columns:
            given = F.map_contains_key(properties, name)
            columns[name] = F.when(given, F.col(name)).otherwise(default.cast(df.schema[name].dataType))
        else:
            columns[name] = default
    return df.withColumns(columns)


def with_change_type(df: DataFrame, delta_mode: bool, event_mode: bool = False) -> DataFrame:
    """``__ChangeType__`` in delta mode unless present, ``ChangeType`` in event mode."""
    if delta_mode and CHANGE_TYPE not in df.columns:
        df = df.withColumn(CHANGE_TYPE, F.col("change_type"))
    return df.withColumn("ChangeType", F.col("change_type")) if event_mode else df


def attach_edges(df: DataFrame, outgoing: bool, incoming: bool) -> DataFrame:
    """``OutgoingEdges`` and ``IncomingEdges`` as asked for, empty when there are none."""
    none = F.array().cast(f"array<{EDGE_TYPE}>")
    if outgoing:
        df = df.withColumn("OutgoingEdges", F.coalesce("outgoing_edges", none))
    if incoming:
        df = df.withColumn("IncomingEdges", F.coalesce("incoming_edges", none))
    return df


def envelope(
    entities: DataFrame,
    declared: Mapping[str, str],
    provider_definition_id: str,
    container_name: str,
    now: Column,
    delta_mode: bool = False,
    event_mode: bool = False,
    outgoing_edges: bool = False,
    incoming_edges: bool = False,
    offset: str = "+00:00",
) -> DataFrame:
    """The wide row of a change: log columns, declared properties, system columns.

    The entity id stays in the log column ``id`` until the row is exported.
    """
    wide = entities.select(
        *cols(c for c in entities.columns if c != "codes"),
        *(F.col("properties")[name].alias(name) for name in declared),
        F.col("persist_hash").alias("PersistHash"),
        F.col("persist_version").alias("PersistVersion"),
        F.col("origin_entity_code").alias("OriginEntityCode"),
        F.col("entity_type").alias("EntityType"),
        codes(entities).alias("Codes"),
        F.lit(provider_definition_id).alias("ProviderDefinitionId"),
        F.lit(container_name).alias("ContainerName"),
    )
    wide = apply_types(wide, declared)
    wide = with_event_time(wide, now, offset=offset)
    wide = with_change_type(wide, delta_mode, event_mode)
    wide = attach_edges(wide, outgoing_edges, incoming_edges)
    return wide.drop(*(c for c in RAW_COLUMNS if c != "codes"))


def serialize_cells(
    df: DataFrame, text_times: Collection[str] = (), keep: Collection[str] = ()
) -> DataFrame:
    """Cells as a table keeps them: nested values as compact JSON, times in text columns as ISO.

    Columns named in ``keep`` stay nested.
    """
    columns = []
    for field in df.schema.fields:
        text = None if field.name in keep else cell_text(field)
        if field.name in text_times:
            text = json_time(F.col(quoted(field.name)))
        columns.append((F.col(quoted(field.name)) if text is None else text).alias(field.name))
    return df.select(columns)


def order_columns(df: DataFrame) -> DataFrame:
    """``Id`` first, the rest by name."""
    names = sorted(c for c in df.columns if c != "Id")
    return df.select(*(["Id"] if "Id" in df.columns else []), *cols(names))


def known_keys(log: DataFrame, properties: str = "properties") -> DataFrame:
    """The keys of the first change of each stream, which fix the schema of the stream."""
    first = F.min_by(F.map_keys(properties), F.struct(*position_columns(log)))
    return log.groupBy("stream_id").agg(first.alias("known_keys"))


def position_columns(log: DataFrame) -> list[str]:
    return [c for c in ("ts", "seq", "id") if c in log.columns]


def schema_guard(
    log: DataFrame, known: DataFrame | None = None, properties: str = "properties"
) -> tuple[DataFrame, DataFrame]:
    """Split a log into changes that fit the schema of their stream and changes that do not."""
    known = known_keys(log, properties) if known is None else known
    rows = join_lookup(log, known, ["stream_id"], few_keys=True)
    unknown = F.array_except(F.map_keys(properties), "known_keys")
    rows = rows.withColumn("unknown_keys", F.coalesce(unknown, F.array().cast("array<string>")))
    fits = F.size("unknown_keys") == 0
    columns = cols(log.columns)
    return (
        rows.where(fits).select(*columns),
        rows.where(~fits).select(*columns, "unknown_keys"),
    )
