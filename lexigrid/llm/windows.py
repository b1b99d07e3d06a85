"""Windows of a fixed width, dealt to content-defined anchors.

A window's anchor is its gram (a run of `gram` units) with the smallest hash, the first of equal ones, so equal windows have
equal anchors at equal offsets wherever they stand. Consecutive windows with one anchor form a stretch. The windows of a text
are thus split into stretches, about one for (width - gram) / 2 units, and two windows can be equal only if their stretches have
equal anchors. Hashing and sliding minima are numpy passes over pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute

#: Window starts handled at once.
PIECE = 1 << 18
_LOW = np.uint64((1 << 20) - 1)
_ODD = 0x9E3779B97F4A7C15
_M64 = (1 << 64) - 1


@dataclass
class Stretches:
    """Parallel arrays: document index, first window start, number of windows, anchor, and the anchor gram's hash."""

    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    gram: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(units: np.ndarray, gram: int) -> np.ndarray:
    """Polynomial hashes of all runs of `gram` units (a power of two), doubling the length of the run each time."""
    h, n, factor = units, 1, _ODD
    while n < gram:
        h = h[:-n] * np.uint64(factor) + h[n:]
        n, factor = 2 * n, factor * factor & _M64
    return mixed(h)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[: len(x) - (width - n)], x[width - n :]) if n < width else x


def stretches(units: Callable[[int, int], np.ndarray], lengths: np.ndarray, width: int, gram: int) -> Stretches:
    """Stretches of several texts laid end to end; units(a, b) gives 64-bit codes, positions count within each text."""
    ends = np.cumsum(lengths)
    firsts = ends - lengths
    out: list[tuple[np.ndarray, ...]] = []
    n_starts = int(lengths.sum()) - width + 1
    for at in range(0, max(0, n_starts), PIECE):
        stop = min(at + PIECE, n_starts)
        grams = gram_hashes(units(at, stop + width - 1), gram)
        least = _sliding_min((grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64), width - gram + 1)
        anchor = (least & _LOW).astype(np.int64)
        start = np.arange(at, stop)
        doc = np.searchsorted(ends, start, side="right")
        valid = start + width <= ends[doc]
        turn = np.ones(len(start), bool)
        turn[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(turn & valid)
        # a text's last windows run on into the next text; they are not valid, so a stretch ends before them
        broken = np.flatnonzero(turn | ~valid)
        last = np.append(broken, len(start))[np.searchsorted(broken, first, side="right")]
        d = doc[first]
        out.append((d, start[first] - firsts[d], last - first, anchor[first] + at - firsts[d], grams[anchor[first]]))
    if not out:
        out = [(np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)]
    return Stretches(*(np.concatenate(x) for x in zip(*out)))


def covered(starts: np.ndarray, counts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Bounds [from, to, from, to, ...] of what windows cover: `counts` consecutive windows from each start, in a text of n."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + counts - 1 + width, -1)
    inside = (np.cumsum(edge)[:n] > 0).astype(np.int8)
    return np.flatnonzero(np.diff(np.concatenate(([0], inside, [0]))))


def packed(start: np.ndarray, count: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """A stretch in one integer: its start, its windows (up to 512), and how far behind the start its anchor is (under 512)."""
    return start << 18 | (count - 1) << 9 | (anchor - start)


def unpacked(pack: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, count and anchor."""
    start = pack >> 18
    return start, (pack >> 9 & 511) + 1, start + (pack & 511)


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of batches whose binary column holds about `limit` bytes, or one row with more."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum([0 if x is None else x for x in pa.compute.binary_length(batch.column(column)).to_pylist()])
        cuts = np.unique(np.searchsorted(sizes, np.arange(limit, int(sizes[-1]) + limit, limit), side="left") + 1)
        at = 0
        for cut in np.minimum([*cuts.tolist(), batch.num_rows], batch.num_rows).tolist():
            if cut > at:
                yield batch.slice(at, cut - at)
                at = cut
