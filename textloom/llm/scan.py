"""Vectorised scanning of the texts of an Arrow batch: words, pieces and hashes of any stretch of bytes.

Every function works on whole texts. A batch is cut into blocks of rows of a bounded size, so that memory does not
follow the batch; a single longer text makes a block of its own.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 18
#: Fixed value: white space that separates words.
SPACES = b" \t\n\x0b\f\r"

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def text_column(column: pa.Array) -> pa.Array:
    """The column as large strings without nulls: a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def row_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold at most ``limit`` bytes, or one row."""
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), len(column))
        yield start, stop
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes with a line feed after every text, and where each text starts (one more entry than texts)."""
    n = len(column)
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    lengths = np.diff(ends)
    starts = np.concatenate(([0], np.cumsum(lengths + 1)))
    out = np.full(int(starts[-1]), 10, np.uint8)
    if ends[-1] > ends[0]:
        data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]]
        out[np.arange(len(data)) + np.repeat(np.arange(n), lengths)] = data
    return out, starts


@functools.cache
def _space_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(SPACES)] = True
    return table


@functools.cache
def byte_values(fold_case: bool) -> np.ndarray:
    """A random 64-bit value per byte; with ``fold_case`` A-Z have those of a-z."""
    values = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64)
    if fold_case:
        values = values.copy()
        values[65:91] = values[97:123]
    return values


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not white space."""
    edge = np.diff(np.concatenate(([1], _space_table()[data].view(np.int8), [1])))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


_powers = np.ones(1, _U64)
_inverse_powers = np.ones(1, _U64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse_powers
    if len(_powers) < n:
        size = max(n, BLOCK_BYTES + 4096) + 1
        inverse = pow(_BASE, -1, 2**64)
        ones = np.ones(1, _U64)
        _powers = np.concatenate((ones, np.cumprod(np.full(size, _BASE, _U64), dtype=_U64)))
        _inverse_powers = np.concatenate((ones, np.cumprod(np.full(size, inverse, _U64), dtype=_U64)))
    return _powers, _inverse_powers


class Hashes:
    """Hashes of any stretches of a block's bytes in a few array steps, by differences of prefix sums."""

    def __init__(self, data: np.ndarray, fold_case: bool = False, values: np.ndarray | None = None):
        powers, self._inverse = _power_tables(len(data) + 1)
        terms = (byte_values(fold_case) if values is None else values)[data] * powers[: len(data)]
        self._prefix = np.concatenate((np.zeros(1, _U64), np.cumsum(terms, dtype=_U64)))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._prefix[ends] - self._prefix[starts]) * self._inverse[starts]
        return mix(raw + (ends - starts).astype(_U64))


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit value."""
    x = x + _U64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of ``width`` neighbouring hashes."""
    n = len(hashes) - width + 1
    total = np.zeros(max(n, 0), _U64)
    for k in range(width if n > 0 else 0):
        total = mix(total * _U64(0xD6E8FEB86659FD93) + hashes[k : k + n])
    return total


LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: Contractions that the tokenizers' pattern takes as tokens.
CONTRACTIONS_1 = "stmd"
CONTRACTIONS_2 = ("re", "ve", "ll")


@functools.cache
def _kinds() -> np.ndarray:
    """Kind of every code point as the tokenizers' pattern sees it."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        major = unicodedata.category(chr(cp))[0]
        if major == "L":
            kinds[cp] = LETTER
        elif major == "N":
            kinds[cp] = NUMBER
    whites = [m.start() for m in re.finditer(r"\s", "".join(map(chr, range(0x3001))))]
    kinds[[c for c in whites if not 0x1C <= c <= 0x1F]] = SPACE
    return kinds


def pieces(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The matches of the byte-level tokenizers' pattern, as one flat binary array, and how many each text has.

    The pattern is ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``: runs of one
    kind, where the last space before a run belongs to it. Its matches are found here by comparing neighbours.
    """
    n = len(column)
    raw = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    if raw[-1] == raw[0]:
        return pa.array([], pa.large_binary()), np.zeros(n, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[raw[0] : raw[-1]]
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    lead = np.flatnonzero((data & 0xC0) != 0x80)  # byte where each code point starts
    size = len(points)
    first = np.zeros(size + 1, bool)
    first[np.searchsorted(lead, raw - raw[0])] = True  # text starts, and the end
    kind = _kinds()[points]
    space = kind == SPACE
    change = np.ones(size, bool)
    change[1:] = (kind[1:] != kind[:-1]) | first[1:size]
    blank = np.zeros(size, bool)  # follows a plain space of the same text, which it takes along
    blank[1:] = (points[:-1] == 32) & ~first[1:size]
    start = change & (space | ~blank)
    # The last white character before something else starts a piece of its own or leads the next.
    before_word = np.zeros(size, bool)
    before_word[:-1] = space[:-1] & ~space[1:] & ~first[1:size]
    start |= before_word
    quotes = np.flatnonzero(change & (points == 39) & ~blank)
    if len(quotes):
        stops = np.searchsorted(lead, raw - raw[0])
        limit = stops[np.searchsorted(stops, quotes, side="right")]
        for q, end in zip(quotes.tolist(), limit.tolist()):
            tail = "".join(map(chr, points[q + 1 : min(q + 3, end)].tolist()))
            took = 1 if tail[:1] and tail[0] in CONTRACTIONS_1 else 2 if tail in CONTRACTIONS_2 else 0
            if took:
                start[q + 1] = False
                if q + 1 + took < end:
                    start[q + 1 + took] = True
    at = np.flatnonzero(start)
    counts = np.diff(np.searchsorted(at, np.searchsorted(lead, raw - raw[0])))
    offsets = np.concatenate((lead[at], [len(data)])).astype(np.int64)
    flat = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return flat, counts
