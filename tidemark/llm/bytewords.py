"""Words of Arrow string columns as spans and 64-bit hashes, vectorised over bytes.

Texts are handled in pieces of a quarter of a megabyte, cut between words, so a task
needs the same memory for one text of a gigabyte as for a million short ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Byte classes: what separates words.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Letters, digits and all bytes of non-ASCII characters make words.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
#: Letters and all bytes of non-ASCII characters make words.
NOT_LETTER = NOT_ALNUM.copy()
NOT_LETTER[0x30:0x3A] = True
#: First bytes of characters that are not white space (C2, E1, E2 and E3 may begin one that is).
SOLID = ~SPACES
SOLID[[0xC2, 0xE1, 0xE2, 0xE3]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    if len(_powers[0]) < n:
        n = max(n + n // 8, PIECE_BYTES + 4096)
        for i, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of uint64 values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each data[start:end]: equal bytes give equal hashes, wherever they stand."""
    up, down = powers(len(data) + 1)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=run[1:])
    return mix((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


class Piece(NamedTuple):
    """Whole words of consecutive texts.  rows: the text of each span of bounds."""

    data: np.ndarray  # bytes
    bounds: np.ndarray  # of the parts of texts in data, one more than rows
    rows: np.ndarray  # index of each part's text in the column


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is empty."""
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]: at[-1]], at - at[0]


def pieces(column: pa.Array, gap: np.ndarray, size: int = PIECE_BYTES, single: bool = False) -> Iterator[Piece]:
    """The texts in order, cut to about ``size`` bytes where a ``gap`` byte stands
    (``single``: and a character that is surely no white space comes next).

    A text that has no gap in ``size`` bytes is cut at the first one after."""
    data, at = strings(column)
    row, start = 0, 0
    while row < len(at) - 1:
        stop_row = int(np.searchsorted(at, start + size, "right")) - 1
        if stop_row > row:  # whole texts up to there (the first may be a rest)
            bounds = at[row: stop_row + 1].copy()
            bounds[0] = start
            yield Piece(data[start: bounds[-1]], bounds - start, np.arange(row, stop_row))
            row, start = stop_row, int(bounds[-1])
            continue
        end = int(at[row + 1])
        stop = start + size
        while stop < end:
            far = min(end, stop + 65536)
            window = gap[data[stop: far]]
            if single:
                window = window & SOLID[np.append(data[stop + 1: far + 1], 0x20)[: far - stop]]
            window = np.flatnonzero(window)
            if len(window):
                stop += int(window[0])
                break
            stop += 65536
        stop = min(stop, end)
        yield Piece(data[start: stop], np.array([0, stop - start]), np.array([row]))
        start = stop
        if stop == end:
            row += 1


def word_spans(piece: Piece, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and the part (index into piece.rows) of every word of a piece."""
    inside = np.zeros(len(piece.data) + 2, bool)
    inside[1:-1] = ~gap[piece.data]
    begins = inside[1:] & ~inside[:-1]
    stops = inside[:-1] & ~inside[1:]
    cuts = piece.bounds[1:-1]  # two texts that meet without a gap
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    begins[cuts] = stops[cuts] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    return starts, ends, np.searchsorted(piece.bounds, starts, "right") - 1


def text_words(column: pa.Array, gap: np.ndarray, lower: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Hashes of the words of whole texts: (first row, last row + 1, counts per row, hashes).

    A yield holds whole texts of about a piece together, or one longer text;
    its hashes take 8 bytes a word."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    data_rows = len(column)
    first = 0

    def flush(upto):
        rows = np.concatenate([r for r, _ in held]) if held else np.zeros(0, np.int64)
        hashes = np.concatenate([h for _, h in held]) if held else np.zeros(0, np.uint64)
        return first, upto, np.bincount(rows - first, minlength=upto - first), hashes

    at = strings(column)[1]
    seen = 0
    for p in pieces(column, gap):
        data = LOWER[p.data] if lower else p.data
        starts, ends, part = word_spans(p, gap)
        held.append((p.rows[part], span_hashes(data, starts, ends)))
        seen += len(p.data)
        last = int(p.rows[-1])
        if seen == at[last + 1]:  # the piece ends a text
            yield flush(last + 1)
            held, first = [], last + 1
    if first < data_rows:
        yield flush(data_rows)
