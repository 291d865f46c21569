"""Vectorised reading of texts as bytes: pieces of bounded size, words and their hashes.

Texts are UTF-8 in Arrow buffers. Everything works on pieces of about a megabyte, so temporary
arrays stay small whatever the texts' lengths.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Piece(NamedTuple):
    """``memory`` of rows ``first``... bounded by ``bounds``; ``tail`` more bytes of the last row
    follow, as that row goes on in the next piece; ``at`` is where its first row begins in it."""

    first: int
    memory: np.ndarray
    bounds: np.ndarray
    tail: int


def is_space(memory: np.ndarray) -> np.ndarray:
    """White space is 0x20 and 0x09 to 0x0D."""
    return (memory == 32) | ((memory >= 9) & (memory <= 13))


def buffers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, bounds of each value) of a string or binary array; NULL counts as empty."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    values = values.cast(pa.large_binary()) if len(values) else pa.array([], pa.large_binary())
    if values.null_count:
        values = values.fill_null(b"")
    _, at, data = values.buffers()
    bounds = np.frombuffer(at, np.int64)[values.offset : values.offset + len(values) + 1]
    memory = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return memory, bounds


def pieces(values: pa.Array, limit: int = PIECE, overlap: int = 3) -> Iterator[Piece]:
    """Whole rows together up to ``limit`` bytes; a longer row comes in several pieces.

    Long rows are cut before white space, unless a word is longer than ``limit``; such a word
    counts as several.
    """
    memory, bounds = buffers(values)
    row, n = 0, len(values)
    while row < n:
        last = int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1
        if last > row:
            low, high = bounds[row], bounds[last]
            yield Piece(row, memory[low:high], bounds[row : last + 1] - low, 0)
            row = last
            continue
        at, end = int(bounds[row]), int(bounds[row + 1])
        while at < end:
            cut = end
            if at + limit < end:
                gap = np.flatnonzero(is_space(memory[at + limit : min(end, at + 2 * limit)]))
                cut = at + limit + int(gap[0]) if len(gap) else min(end, at + 2 * limit)
            tail = min(overlap, end - cut)
            yield Piece(row, memory[at : cut + tail], np.array([0, cut - at]), tail)
            at = cut
        row += 1


_POWERS = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n, kept for the largest n so far."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row within the piece, start, end) of each word; words are ``[^\\x20\\x09-\\x0D]+``."""
    size = int(piece.bounds[-1])
    solid = ~is_space(piece.memory[:size])
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    inner = piece.bounds[:-1][piece.bounds[:-1] < size]
    opens[inner] = solid[inner]
    inner = piece.bounds[1:][piece.bounds[1:] > 0] - 1
    closes[inner] = solid[inner]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    rows = np.searchsorted(piece.bounds, starts, side="right") - 1
    return rows, starts, ends


def word_hashes(piece: Piece, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    size = int(piece.bounds[-1])
    up, down = _powers(size + 1)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum((piece.memory[:size].astype(np.uint64) + np.uint64(1)) * up[:size], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def span_hashes(
    memory: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each stretch of bytes, from different polynomials of them."""
    found = []
    up, down = _powers(len(memory) + 1)
    for shift in (np.uint64(1), np.uint64(0x5851F42D4C957F2D)):
        values = memory.astype(np.uint64) + shift
        sums = np.zeros(len(memory) + 1, np.uint64)
        np.cumsum((values * values if shift > 1 else values) * up[:-1], out=sums[1:])
        found.append(mix(((sums[ends] - sums[starts]) * down[starts]) ^ (ends - starts).view(np.uint64)))
    return found[0], found[1]
