"""Vectorised text helpers that run inside Arrow tasks.

Texts are handled as the UTF-8 bytes of an Arrow column. A word is a run of
bytes other than 0x20 and 0x09-0x0D, as in the pattern ``[^\\x20\\x09-\\x0D]+``
(these bytes never occur inside a longer UTF-8 sequence).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20  # bytes hashed at once; bounds the working arrays
P1 = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2**64
MASK = (1 << 64) - 1


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scramble 64-bit values (bijective for a given seed)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) & MASK)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def is_word_byte() -> np.ndarray:
    table = np.ones(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def ascii_lower() -> np.ndarray:
    table = np.arange(256)
    table[65:91] += 32
    return table


def byte_values(seed: int, lower: bool = False) -> np.ndarray:
    """A 64-bit value per byte; with ``lower``, A-Z share those of a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64), seed) | np.uint64(1)
    return values[ascii_lower()] if lower else values


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base & MASK, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


class Powers:
    """Growing tables of the powers of ``P1`` and of its inverse."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = powers(n, P1), powers(n, pow(P1, -1, 1 << 64))
        return self.up, self.down


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_slices(batches, text: str | int, limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each piece holds about ``limit`` bytes of the
    column ``text`` (a longer text is a piece of its own)."""
    for batch in batches:
        _, offsets = column_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the first word of each text
    (one entry more than texts, so that text i has words first[i]:first[i+1])."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = is_word_byte()[data]
    cut = np.zeros(len(data), bool)
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True  # words never cross texts
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, tables: list[np.ndarray], pows: Powers) -> list[np.ndarray]:
    """One 64-bit hash per word for each table of byte values, in blocks."""
    out = [np.zeros(len(starts), np.uint64) for _ in tables]
    at = 0
    while at < len(starts):
        end = max(int(np.searchsorted(ends, starts[at] + BLOCK, "right")), at + 1)
        low, high = int(starts[at]), int(ends[end - 1])
        up, down = pows.get(high - low)
        s, e = starts[at:end] - low, ends[at:end] - low
        with np.errstate(over="ignore"):
            for table, o in zip(tables, out):
                total = np.zeros(high - low + 1, np.uint64)
                np.cumsum(table[data[low:high]] * up[:high - low], out=total[1:])
                o[at:end] = mix((total[e] - total[s]) * down[s])
        at = end
    return out


def gram_hashes(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values, by its first position."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        size = len(words) - n + 1
        h = np.full(size, n + 1, np.uint64)
        for k in range(n):
            h = h * np.uint64(P1) + words[k:k + size]
        return mix(h, seed)
