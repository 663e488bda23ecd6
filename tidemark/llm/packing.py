"""Vector bin packing of token sequences under three limits at once.

A piece weighs (tokens, 1 segment, loss-bearing tokens); a sequence has room for so many of each.
Full sequences are cut from long examples first. The rest is packed by the dot-product heuristic:
of the pieces that fit, the next one has the largest dot product of its weights with the room left,
both as shares of the limits. When none fits and a segment is left, the best piece is cut to fill
the sequence, so a sequence closes with padding only when segments or loss run out.

Every task packs its own rows as they come, with at most ``POOL`` open pieces, so nothing is
shuffled and memory doesn't grow with the input. What remains at the end of a task is cut into
sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import Encoder
from tidemark.llm.shared import slices, small_batches

POOL = 512
#: Bytes of text that a task encodes at once: half of what encoding alone takes, as the pool is held beside it.
BYTES = 2 << 20


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


@dataclass
class _Piece:
    row: int
    ids: np.ndarray
    start: int
    prompt: int

    def loss(self, length: int) -> int:
        """Tokens of the first ``length`` that a model is scored on: not the prompt, not an example's first."""
        return max(0, self.start + length - max(self.start, self.prompt, 1))


class Packer:
    """Packs pieces as they come; ``done`` collects (row, start, length, crc, sequence, offset)."""

    def __init__(self, limits: Limits, first: int):
        self.limits, self.sequence, self.pool, self.done = limits, first, [], []

    def add(self, piece: _Piece) -> None:
        limits = self.limits
        while len(piece.ids) >= limits.tokens and piece.loss(limits.tokens) <= limits.loss:
            piece = self._place(piece, limits.tokens, 0)
            self.sequence += 1
        if len(piece.ids):
            self.pool.append(piece)
            if len(self.pool) >= POOL:
                self.flush(POOL // 2)

    def _place(self, piece: _Piece, length: int, offset: int) -> _Piece:
        own = piece.ids[:length]
        crc = zlib.crc32(np.ascontiguousarray(own, dtype="<u4"))
        self.done.append((piece.row, piece.start, length, crc, self.sequence, offset))
        return _Piece(piece.row, piece.ids[length:], piece.start + length, piece.prompt)

    def flush(self, keep: int) -> None:
        """Fill sequences until at most ``keep`` pieces, or less than a sequence, are left."""
        limits = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], dtype=np.float64)
        pieces = self.pool
        weights = np.array([(len(p.ids), 1, p.loss(len(p.ids))) for p in pieces], dtype=np.float64).reshape(-1, 3)
        shares = weights / limits
        live = np.ones(len(pieces), dtype=bool)
        while live.sum() > keep and weights[live, 0].sum() >= limits[0]:
            room, offset = limits.copy(), 0
            while room[0] and room[1] and live.any():
                gain = shares @ (room / limits)
                fits = live & (weights <= room).all(axis=1)
                if fits.any():
                    best = int(np.argmax(np.where(fits, gain, -1)))
                    length = int(weights[best, 0])
                else:
                    best = int(np.argmax(np.where(live, gain, -1)))
                    length = self._fitting(pieces[best], room)
                    if not length:
                        break
                loss = pieces[best].loss(length)
                pieces[best] = self._place(pieces[best], length, offset)
                left = pieces[best]
                weights[best] = (len(left.ids), 1, left.loss(len(left.ids)))
                shares[best] = weights[best] / limits
                live[best] = len(left.ids) > 0
                offset += length
                room -= (length, 1, loss)
            self.sequence += 1
        self.pool = [p for p, on in zip(pieces, live, strict=True) if on]

    @staticmethod
    def _fitting(piece: _Piece, room: np.ndarray) -> int:
        """How much of ``piece`` fits into ``room``."""
        free = max(piece.prompt, 1) - piece.start  # leading tokens without loss
        return int(min(room[0], len(piece.ids), max(0, free) + room[2]))

    def finish(self) -> None:
        """Pack all that is left: whole sequences first, then powers of two without padding."""
        self.flush(0)
        left = sum(len(p.ids) for p in self.pool)
        pool = sorted(self.pool, key=lambda p: -len(p.ids))
        while left:
            size, offset, segments, loss = 1 << (left.bit_length() - 1), 0, 0, 0
            while pool and offset < size and segments < self.limits.segments:
                room = np.array([min(size, self.limits.tokens) - offset, 1, self.limits.loss - loss], dtype=np.float64)
                length = self._fitting(pool[0], room)
                if not length:
                    break
                loss += pool[0].loss(length)
                rest = self._place(pool[0], length, offset)
                offset, segments, left = offset + length, segments + 1, left - length
                pool[0] = rest
                if not len(rest.ids):
                    pool.pop(0)
            self.sequence += 1
        self.pool = []


def pack(docs: DataFrame, vocabulary: str, limits: Limits = Limits(), end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None) -> DataFrame:
    """One row per piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens``.

    ``vocabulary`` is the path of a tokenizer file that every executor has; ``end_id`` ends each
    example. ``prompt_col`` holds how many leading tokens bear no loss (null: none). Each token
    of each row lies in exactly one piece, and no sequence exceeds a limit. Null text counts as
    empty: a piece of ``end_id`` alone. Repeated rows are packed each. A null id stays null. An
    empty table gives no rows. The sequence's number holds its task's, so it is unique and the
    same when a task runs again.
    """
    if limits.loss < 1 or limits.segments < 1:
        raise ValueError("a sequence needs room for a segment and a token with loss")
    small_batches(docs.sparkSession, 2000)
    prompt = F.coalesce(F.col(prompt_col).cast("long"), F.lit(0)) if prompt_col else F.lit(0).cast("long")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), prompt.alias("prompt"))
    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, words = Packer(limits, TaskContext.get().partitionId() << 40), Encoder(vocabulary)
        known: dict[int, tuple] = {}  # rows with pieces in the pool
        number = 0

        def settled() -> pa.RecordBatch:
            nonlocal known
            own = packer.done
            packer.done = []
            cols = [[known[p[0]][0] for p in own], *([p[k] for p in own] for k in (1, 2, 3)), [known[p[0]][1] for p in own], *([p[k] for p in own] for k in (4, 5))]
            loss = [max(0, p[1] + p[2] - max(p[1], known[p[0]][2], 1)) for p in own]
            known = {p.row: known[p.row] for p in packer.pool}
            names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (*cols, loss)], names)

        for batch in batches:
            for part in slices(batch, "text", BYTES):
                ids, bounds = words.encode(part.column("text"))
                ids = ids.astype(np.uint32)
                for k, (ident, prompt_of) in enumerate(zip(part.column("id").to_pylist(), part.column("prompt").to_pylist(), strict=True)):
                    own = np.append(ids[bounds[k] : bounds[k + 1]], np.uint32(end_id))
                    known[number] = (ident, len(own), prompt_of)
                    packer.add(_Piece(number, own, 0, prompt_of))
                    number += 1
                yield settled()
        packer.finish()
        yield settled()

    return rows.mapInArrow(run, schema)
