"""Current state of entities: upsert, patch upsert and rejected changes.

Every result here is an aggregation with partial combine, so a hot entity leaves
each map task as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import cols, field
from tidemark.operators.ordered import (
    SLICE_ROWS,
    Latest,
    Preceding,
    drop_slices,
    running,
    with_slices,
)
from tidemark.sources.change_logs import KEY, ORDER, REMOVED, is_removed, payload_columns

#: Columns a soft delete writes; all others keep their last live value.
STAMPED = ("__ChangeType__", "Timestamp", "Epoch")


def position() -> Column:
    return F.struct(*ORDER)


def current_state(log: DataFrame, soft: bool = False) -> DataFrame:
    """The last change of each entity; removed entities are gone, or marked when ``soft``."""
    payload = payload_columns(log)
    if not soft:
        last = F.max_by(F.struct("change_type", *ORDER, *cols(payload)), position())
        return (
            log.groupBy(*KEY)
            .agg(last.alias("last"))
            .where(F.col("last.change_type") != REMOVED)
            .select(*KEY, "last.*")
        )
    stamped = [c for c in payload if c in STAMPED]
    kept = [c for c in payload if c not in STAMPED]
    live = ~is_removed()
    return (
        log.groupBy(*KEY)
        .agg(
            F.max_by(F.struct("change_type", *ORDER, *cols(stamped)), position()).alias("last"),
            F.max_by(F.struct(F.lit(1).alias("_"), *cols(kept)), F.when(live, position())).alias("body"),
        )
        .where(F.col("body").isNotNull())
        .select(
            *KEY,
            "last.change_type",
            *(f"last.{c}" for c in ORDER),
            *(field("last" if c in STAMPED else "body", c) for c in payload),
        )
    )


_ROW, _GONE = "\u0000row", "\u0000gone"


def _last_writes(log: DataFrame, properties: str) -> DataFrame:
    """The last write of each (entity, key), and the last time an entity was there or gone."""
    written = F.map_entries(F.coalesce(properties, F.expr("map()").cast("map<string,string>")))
    marker = F.struct(
        F.when(is_removed(), _GONE).otherwise(_ROW).alias("key"), F.lit(None).cast("string").alias("value")
    )
    cells = F.when(is_removed(), F.array(marker)).otherwise(F.array_append(written, marker))
    return log.select(*KEY, "change_type", *ORDER, F.inline(cells)).groupBy(*KEY, "key").agg(
        F.max_by(F.struct("value"), position()).alias("cell"),
        F.max(position()).alias("at"),
        F.max_by("change_type", position()).alias("change_type"),
    )


def patch_cells(log: DataFrame, soft: bool = False, properties: str = "properties") -> DataFrame:
    """:func:`patch_state` as one row per (entity, key), for entities with very many keys."""
    writes = _last_writes(log, properties)
    marks = F.col("key").isin(_ROW, _GONE)
    entity = writes.where(marks).groupBy(*KEY).agg(
        F.max(F.when(F.col("key") == _ROW, F.col("at"))).alias("row_at"),
        F.max(F.when(F.col("key") == _GONE, F.col("at"))).alias("gone_at"),
        F.max_by("change_type", "at").alias("change_type"),
    )
    here = F.col("row_at").isNotNull()
    if not soft:
        here = here & (F.col("gone_at").isNull() | (F.col("row_at") > F.col("gone_at")))
    kept = writes.where(~marks).drop("change_type").join(entity.where(here), list(KEY))
    if not soft:
        kept = kept.where(F.col("gone_at").isNull() | (F.col("at") > F.col("gone_at")))
    return kept.select(*KEY, "change_type", "key", F.col("cell.value").alias("value"))


def patch_state(log: DataFrame, soft: bool = False, properties: str = "properties") -> DataFrame:
    """Current state when a change sets only the keys it carries.

    An absent key keeps its earlier value and a present null overwrites it. A hard
    delete forgets all keys, a soft delete forgets none. The last write per (entity,
    key) is found first, so what is gathered per entity is one value per key.
    """
    writes = _last_writes(log, properties)
    marks = F.col("key").isin(_ROW, _GONE)
    entity = writes.groupBy(*KEY).agg(
        F.max(F.when(F.col("key") == _ROW, F.col("at"))).alias("row_at"),
        F.max(F.when(F.col("key") == _GONE, F.col("at"))).alias("gone_at"),
        F.max_by("change_type", F.when(marks, F.col("at"))).alias("change_type"),
        F.collect_list(
            F.when(~marks, F.struct("key", F.col("cell.value").alias("value"), "at"))
        ).alias("cells"),
    )
    alive = F.col("row_at").isNotNull()
    cells = F.col("cells")
    if not soft:
        newer = F.col("gone_at").isNull() | (F.col("row_at") > F.col("gone_at"))
        alive = alive & newer
        cells = F.filter(
            cells, lambda c: F.col("gone_at").isNull() | (c["at"] > F.col("gone_at"))
        )
    entries = F.transform(cells, lambda c: F.struct(c["key"], c["value"]))
    at = F.greatest("row_at", "gone_at")
    return entity.where(alive).select(
        *KEY,
        "change_type",
        *(at[c].alias(c) for c in ORDER),
        F.map_from_entries(entries).alias(properties),
    )


def rejected(log: DataFrame, soft: bool = False, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Deletes that hit no row: no live row for a hard delete, no row ever for a soft one."""
    rows = with_slices(log, KEY, ORDER, slice_rows)
    if soft:
        seen = Latest(F.when(~is_removed(), F.lit(True)))
        flagged = running(rows, KEY, ORDER, {"_seen": seen})
        orphan = F.col("_seen").isNull()
    else:
        before = Preceding(F.col("change_type"))
        flagged = running(rows, KEY, ORDER, {"_seen": before})
        orphan = F.col("_seen").isNull() | (F.col("_seen") == REMOVED)
    return drop_slices(flagged.where(is_removed() & orphan).drop("_seen"))
