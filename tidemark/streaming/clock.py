"""Event batches closed by count or by the clock.

Each target keeps its waiting changes, fewer than a batch, in the state of the stream, and a
timer on the clock of the cluster. A change sets the timer anew; when it runs out the waiting
changes are a batch, even if the source is quiet and no other target gets a change. State and
timers are in the checkpoint, so a restart goes on where it stopped and no batch is written twice.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.columns import quoted
from tidemark.operators.batches import BATCH_ROWS, IDLE_MILLIS, batch_name, event_document

COUNT, IDLE = "count", "idle"


def clocked_batches(
    source: DataFrame, target: Sequence[str], container: Column, n: int = BATCH_ROWS, idle_millis: int = IDLE_MILLIS
) -> DataFrame:
    """``target…, file_name, items, content, closed_by`` of a stream of changes, in the order they arrive.

    A batch has ``n`` changes, or fewer when its target had none for ``idle_millis``. Targets may
    be null. What is held of a target between two micro-batches is less than one batch.
    """
    fields = [T.StructField(c, source.schema[c].dataType) for c in target]
    rest = "container string, items bigint, flushed_at timestamp_ntz, content string, closed_by string"
    output = T.StructType([*fields, *T._parse_datatype_string(rest).fields])
    items = source.select(
        *(F.col(quoted(c)) for c in target),
        container.alias("_container"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("_ts"),
        event_document(source.columns).alias("_document"),
    )

    def close(key: tuple, waiting: list[list[str]], why: str) -> dict:
        documents = [w[2] for w in waiting]
        return {
            **dict(zip(target, key, strict=True)),
            "container": max(w[0] for w in waiting),
            "items": len(waiting),
            "flushed_at": max(w[1] for w in waiting),
            "content": "[" + ",".join(documents) + "]",
            "closed_by": why,
        }

    def fold(key: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting = json.loads(state.get[0]) if state.exists else []
        if state.hasTimedOut:
            state.remove()
            yield shown([close(key, waiting, IDLE)])
            return
        for part in parts:
            waiting += part[["_container", "_ts", "_document"]].values.tolist()
            full = len(waiting) // n * n
            yield shown([close(key, waiting[k : k + n], COUNT) for k in range(0, full, n)])
            waiting = waiting[full:]
        if waiting:
            state.update((json.dumps(waiting),))
            state.setTimeoutDuration(idle_millis)
        elif state.exists:
            state.remove()

    def shown(batches: list[dict]) -> pd.DataFrame:
        frame = pd.DataFrame(batches, columns=output.names)
        frame["flushed_at"] = pd.to_datetime(frame["flushed_at"])
        return frame

    grouped = items.groupBy(*(F.col(quoted(c)) for c in target))
    batches = grouped.applyInPandasWithState(fold, output, "waiting string", "append", GroupStateTimeout.ProcessingTimeTimeout)
    return batches.select(
        *(F.col(quoted(c)) for c in target),
        batch_name(F.col("container"), F.col("flushed_at")).alias("file_name"),
        "items", "content", "closed_by",
    )


def stream_clocked(
    source: DataFrame,
    path: str,
    checkpoint: str,
    target: Sequence[str],
    container: Column,
    n: int = BATCH_ROWS,
    idle_millis: int = IDLE_MILLIS,
    interval: str = "1 second",
) -> StreamingQuery:
    """Write :func:`clocked_batches` below ``path``, each batch once.

    The stream looks at its timers at every interval, so it runs until it is stopped; what waits
    then is kept for the next start.
    """
    writer = clocked_batches(source, target, container, n, idle_millis).writeStream.format("parquet").outputMode("append")
    return writer.option("path", path).option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()
