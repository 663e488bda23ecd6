"""Word shingles of whole texts as sorted 64-bit hashes, vectorised over the bytes of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidemark.llm.shared import give_back

SHINGLE = 5
_CHUNK = 1 << 18  # bytes hashed at once, or one text; a byte takes some 60 while it is hashed

_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


_VALUES = _byte_values()
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_PLACES = mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base & (2**64 - 1), dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def _word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word; ``starts`` are the first bytes of the texts."""
    solid = ~_BLANK[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    begins[starts[starts < len(data)]] = solid[starts[starts < len(data)]]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    last = starts[(starts > 0) & (starts <= len(data))] - 1
    ends[last] = solid[last]
    at, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _powers_up_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[end] - sums[at]) * down[at]), at


def _chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    low = 0
    while low < len(offsets) - 1:
        high = int(np.searchsorted(offsets, offsets[low] + _CHUNK, "right")) - 1
        high = max(high, low + 1)
        yield low, high
        low = high


def sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text, its distinct shingles as sorted uint64; empty for null and for no words.

    A text of fewer than five words has its whole sequence as one shingle.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset :]
    if not len(texts):
        return
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    for low, high in _chunks(offsets):
        own = data[offsets[low] : offsets[high]]
        starts = offsets[low : high + 1] - offsets[low]
        if not len(own):
            yield from (np.zeros(0, dtype=np.uint64) for _ in range(low, high))
            continue
        words, at = _word_hashes(own, starts)
        firsts = np.searchsorted(at, starts)
        full = np.zeros(max(0, len(words) - SHINGLE + 1), dtype=np.uint64)
        for k in range(SHINGLE):
            full += words[k : k + len(full)] * _PLACES[k]
        full = mixed(full)
        for k in range(high - low):
            a, b = firsts[k], firsts[k + 1]
            if b - a >= SHINGLE:
                yield np.unique(full[a : b - SHINGLE + 1])
            elif b > a:
                short = (words[a:b] * _PLACES[: b - a]).sum(dtype=np.uint64) + np.uint64((b - a) * 0x51ED27)
                yield mixed(np.array([short], dtype=np.uint64))
            else:
                yield np.zeros(0, dtype=np.uint64)
    give_back()


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers below 2**63 in as few bytes each as the largest needs."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(raw: bytes) -> np.ndarray:
    width = raw[0]
    body = np.frombuffer(raw, dtype=np.uint8, offset=1).reshape(-1, width)
    out = np.zeros((len(body), 8), dtype=np.uint8)
    out[:, :width] = body
    return out.view(np.uint64).reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    """Like :func:`pack`, for ascending values: the first one and the differences."""
    return values[:1].astype(np.uint64).tobytes() + pack(np.diff(values))


def unpack_sorted(raw: bytes) -> np.ndarray:
    first = np.frombuffer(raw, dtype=np.uint64, count=1)
    return np.cumsum(np.concatenate([first, unpack(raw[8:])]), dtype=np.uint64)


def parity(own: np.ndarray, bits: int = 1024) -> np.ndarray:
    """As words of 64 slots: per slot, whether an odd number of shingles falls into it.

    Two sets differ in at least as many shingles as their parities differ in slots.
    """
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)
