"""Frequent features of texts in two passes: a sketch of all features' frequencies, then exact counts of those that can be chosen.

Features are never listed: the first pass adds up hashes, which those of longer runs are made of, in one array a task; the second one
writes out only features whose sketched frequency reaches a threshold. Features are of one of three kinds: runs of neighbours in a list,
joined by a blank (``word``), runs of characters inside the padded elements of a list (``char_wb``), and runs of a text's characters
(``char``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lexigrid.operators.term_counts import BUCKETS_PER_TERM, SKETCH_ROWS, _numbered, _pieces

#: Elements of lists, or characters, that are looked at once; buckets in a row of a task's sketch; cells of a table of documents and features.
PIECE, CHUNK, TABLE = 1 << 20, 1 << 12, 1 << 23
_BASE = np.uint64(0x9E3779B97F4A7C15)
_COUNTS = "term string, df long, cf long, size int"


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _hashed(terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each string, and the base to the power of its length: the hash of joined strings follows from theirs."""
    flat = terms.cast(pa.large_binary())
    if not len(flat):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    ends = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    lengths = np.diff(ends)
    powers = _powers(int(lengths.max()))
    left = np.repeat(ends[1:], lengths) - 1 - np.arange(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[left], dtype=np.uint64)))
    return sums[ends[1:]] - sums[ends[:-1]], powers[lengths]


def _mixed(x: np.ndarray) -> np.ndarray:
    for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(m)
    return x ^ (x >> np.uint64(31))


def _counted(row: np.ndarray, code: np.ndarray, tf: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and occurrences of each feature; ``row`` is in order and may repeat a feature."""
    df, step = np.zeros(width, np.int64), max(1, TABLE // max(1, width))
    ends = np.searchsorted(row, np.arange(0, int(row[-1]) + 1 + step, step)) if len(row) else [0]
    for k, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        seen = np.zeros((step, width), bool)
        seen[row[a:b] - k * step, code[a:b]] = True
        df += np.count_nonzero(seen, axis=0)
    return df, np.bincount(code, tf, width).astype(np.int64)


def _batch(terms: pa.Array, df: np.ndarray, cf: np.ndarray, size: int = 0) -> pa.RecordBatch:
    """``size`` is that of the runs, or 0 where a batch has several."""
    return pa.RecordBatch.from_arrays([terms.cast(pa.string()), pa.array(df), pa.array(cf), pa.array(np.full(len(terms), size, np.int32))], ["term", "df", "cf", "size"])


class _Words:
    """Runs of neighbours in the lists of a piece."""

    def __init__(self, lists: pa.Array, sizes: tuple[int, int]) -> None:
        self.sizes = sizes
        self.row, self.code, self.words = _numbered(lists)

    def _runs(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Size, first positions and hashes of runs."""
        (own, power), row, code = _hashed(self.words), self.row, self.code
        run = hashes = own[code]
        for n in range(1, self.sizes[1] + 1):
            m = max(0, len(code) - n + 1)
            if n > 1:
                last = power[code[n - 1 :]] if m else power[:0]
                run = run[:m] * (last * _BASE) + np.uint64(33) * last + hashes[len(hashes) - m :]
            if n >= self.sizes[0]:
                at = np.flatnonzero(row[:m] == row[len(row) - m :])
                yield n, at, _mixed(run[at])

    def hashes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
        if self.sizes == (1, 1):
            yield 1, _mixed(_hashed(self.words)[0]), np.bincount(self.code, minlength=len(self.words))
        else:
            yield from ((n, h, None) for n, _, h in self._runs())

    def counts(self, hot, by_size: bool) -> Iterator[pa.RecordBatch]:
        if self.sizes == (1, 1):
            chosen = np.flatnonzero(hot(1, _mixed(_hashed(self.words)[0])))
            place = np.full(len(self.words), -1)
            place[chosen] = np.arange(len(chosen))
            code, row = place[self.code], self.row
            yield _batch(self.words.take(pa.array(chosen)), *_counted(row[code >= 0], code[code >= 0], np.ones(np.count_nonzero(code >= 0)), len(chosen)), 1)
            return
        rows, terms = [], []
        for n, at, h in self._runs():
            at = at[hot(n, h)]
            parts = [self.words.take(pa.array(self.code[at + k])).cast(pa.large_string()) for k in range(n)]
            terms.append(parts[0] if n == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())))
            rows.append(self.row[at])
            if by_size or n == self.sizes[1]:  # equal strings are one feature whatever their size, unless sizes are told apart
                row, coded = np.concatenate(rows), pa.concat_arrays(terms).dictionary_encode()
                order = np.argsort(row, kind="stable")
                code = coded.indices.to_numpy().astype(np.int64)[order]
                yield _batch(coded.dictionary, *_counted(row[order], code, np.ones(len(code)), len(coded.dictionary)), n if by_size else 0)
                rows, terms = [], []


class _Characters:
    """Runs of the characters of strings; ``whole``: strings that are a feature themselves, as they are too short."""

    def __init__(self, strings: list[str], sizes: tuple[int, int]) -> None:
        self.sizes = sizes
        self.signs = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32).astype(np.uint64)
        self.of = np.repeat(np.arange(len(strings)), np.fromiter(map(len, strings), np.int64, len(strings)))

    def runs(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        run = self.signs + np.uint64(1)
        for n in range(1, self.sizes[1] + 1):
            m = max(0, len(self.signs) - n + 1)
            run = run if n == 1 else run[:m] * _BASE + self.signs[len(self.signs) - m :] + np.uint64(1)
            if n >= self.sizes[0]:
                at = np.flatnonzero(self.of[:m] == self.of[len(self.of) - m :])
                yield n, at, _mixed(run[at])

    def numbered(self, hot) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """String and number of each feature that is hot, and the features."""
        of, codes, terms = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        for n, at, h in self.runs():
            at = at[keep := hot(n, h)]
            first, code = np.unique(h[keep], return_index=True, return_inverse=True)[1:]
            windows = [self.signs[at + k] for k in range(n)]
            if any((w != w[first][code]).any() for w in windows):  # two runs of one hash: tell them by their signs
                first, code = np.unique(np.stack(windows, 1), axis=0, return_index=True, return_inverse=True)[1:]
                code = code.ravel()
            of.append(self.of[at])
            codes.append(code + len(terms))
            terms += [bytes(x).decode("utf-32-le") for x in np.stack([w[first] for w in windows], 1).astype(np.uint32)]
        return np.concatenate(of), np.concatenate(codes), terms


class _Texts:
    """Runs of the characters of a piece's texts."""

    def __init__(self, texts: pa.Array, sizes: tuple[int, int]) -> None:
        self.signs = _Characters([x or "" for x in texts.to_pylist()], sizes)

    def hashes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
        yield from ((n, h, None) for n, _, h in self.signs.runs())

    def counts(self, hot, by_size: bool) -> Iterator[pa.RecordBatch]:
        row, code, terms = self.signs.numbered(hot)
        order = np.argsort(row, kind="stable")
        yield _batch(pa.array(terms, pa.string()), *_counted(row[order], code[order], np.ones(len(row)), len(terms)))


class _Inside:
    """Runs of characters inside the padded elements of a piece's lists; one that is shorter than all runs is a feature itself."""

    def __init__(self, lists: pa.Array, sizes: tuple[int, int]) -> None:
        self.row, self.code, words = _numbered(lists)
        padded = [f" {w} " for w in words.to_pylist()]
        self.signs, self.n = _Characters(padded, sizes), len(padded)
        self.short = [i for i, w in enumerate(padded) if len(w) < sizes[0]] if sizes[0] > 3 else []
        self.padded = padded

    def _short(self) -> np.ndarray:
        one = (_Characters([self.padded[i]], (len(self.padded[i]),) * 2) for i in self.short)
        return np.array([h[0] for c in one for _, _, h in c.runs()], np.uint64)

    def hashes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
        times = np.bincount(self.code, minlength=self.n)
        for n, at, h in self.signs.runs():
            yield n, h, times[self.signs.of[at]]
        if self.short:
            yield self.signs.sizes[0], self._short(), times[self.short]

    def counts(self, hot, by_size: bool) -> Iterator[pa.RecordBatch]:
        word, code, terms = self.signs.numbered(hot)
        short = np.array(self.short, np.int64)[hot(self.signs.sizes[0], self._short())] if self.short else np.zeros(0, np.int64)
        word, code = np.concatenate((word, short)), np.concatenate((code, len(terms) + np.arange(len(short))))
        terms = terms + [self.padded[i] for i in short]
        width = max(1, len(terms))
        held, times = np.unique(word * width + code, return_counts=True)  # features of each word, in order of words
        word, code = held // width, held % width
        pair = np.unique(self.row * max(1, self.n) + self.code, return_counts=True)
        row, own, tf = pair[0] // max(1, self.n), pair[0] % max(1, self.n), pair[1]
        starts, ends = np.searchsorted(word, own), np.searchsorted(word, own, side="right")
        df, cf, step = np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64), max(1, TABLE // 32)
        much = np.cumsum(ends - starts)
        at = 0
        while at < len(row):  # whole documents, whose words hold about so many features
            to = max(at + 1, int(np.searchsorted(much, (much[at - 1] if at else 0) + step, side="right")))
            to = int(np.searchsorted(row, row[to - 1], side="right"))
            n = (ends - starts)[at:to]
            where = np.repeat(starts[at:to] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            d, c = _counted(np.repeat(row[at:to] - row[at], n), code[where], np.repeat(tf[at:to], n) * times[where], len(terms))
            df, cf, at = df + d, cf + c, to
        yield _batch(pa.array(terms, pa.string()), df, cf)


_KINDS = {"word": _Words, "char": _Texts, "char_wb": _Inside}


def _parts(batches: Iterator[pa.RecordBatch], kind: str, sizes: tuple[int, int]) -> Iterator[tuple[int, _Words | _Texts | _Inside]]:
    """Documents and features of pieces."""
    for batch in _pieces(batches, "terms", PIECE):
        yield batch.num_rows, _KINDS[kind](batch.column("terms"), sizes)


class TextSketch:
    """Upper bounds of the frequencies of the features of ``texts`` (terms): lists, or texts for ``char``."""

    def __init__(self, texts: DataFrame, wanted: int, sizes: tuple[int, int] = (1, 1), kind: str = "word") -> None:
        self.width = min(1 << 21, 1 << max(12, (BUCKETS_PER_TERM * wanted - 1).bit_length()))
        self.texts, self.sizes, self.kind, width = texts, tuple(sizes), kind, self.width
        sizes = self.sizes

        lo, n_sizes = sizes[0], sizes[1] - sizes[0] + 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, docs = np.zeros((n_sizes * SKETCH_ROWS, width), np.int64), 0
            for rows, part in _parts(batches, kind, sizes):
                docs += rows
                for n, h, times in part.hashes():
                    for r in range(SKETCH_ROWS):
                        sums[(n - lo) * SKETCH_ROWS + r] += np.bincount(_bucket(h, r, width), times, width).astype(np.int64)
            out = [(r, c, sums[r, c : c + CHUNK].tobytes()) for r in range(len(sums)) for c in range(0, width, CHUNK)]
            out = [x for x in out if any(x[2])] + [(-1, 0, np.array([docs]).tobytes())]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary()))], ["r", "c", "n"])

        def add(table: pa.Table) -> pa.Table:
            total = np.sum([np.frombuffer(x, np.int64) for x in table.column("n").to_pylist()], axis=0)
            return pa.table([table.column("r").slice(0, 1), table.column("c").slice(0, 1), pa.array([total.tobytes()])], names=["r", "c", "n"])

        sums = texts.mapInArrow(run, "r int, c int, n binary").groupBy("r", "c").applyInArrow(add, "r int, c int, n binary")
        self.sums, self.n_docs = np.zeros((n_sizes * SKETCH_ROWS, width), np.int64), 0
        for r, c, n in sums.collect():  # as many numbers as the sketch has
            values = np.frombuffer(n, np.int64)
            if r < 0:
                self.n_docs = int(values[0])
            else:
                self.sums[r, c : c + len(values)] = values
        self.sums = self.sums.reshape(n_sizes, SKETCH_ROWS, width)

    def _of(self, sizes: tuple[int, int]) -> np.ndarray:
        """The sketch of the runs of these sizes."""
        return self.sums[sizes[0] - self.sizes[0] : sizes[1] - self.sizes[0] + 1].sum(axis=0)

    def above(self, rank: int, sizes: tuple[int, int] | None = None) -> int:
        """The ``rank``-th largest bucket of a row, 0 if fewer are filled."""
        row = self._of(sizes or self.sizes)[0]
        return int(np.partition(row, len(row) - rank)[len(row) - rank]) if 0 < rank <= len(row) else 0

    def candidates(self, least: int) -> DataFrame:
        """Partial counts of all features that can have a frequency of ``least``, and few others."""
        return self._counts([(self.sizes, least)], False).drop("size")

    def by_size(self, asked: list[tuple[tuple[int, int], int]]) -> DataFrame:
        """Partial counts with the size of runs, of all that can have a least frequency among the runs of some sizes (sizes, least)."""
        return self._counts(asked, True)

    def _counts(self, asked: list[tuple[tuple[int, int], int]], by_size: bool) -> DataFrame:
        tables = [(sizes, self._of(sizes) >= least) for sizes, least in asked]
        shared, kind, sizes, width = self.texts.sparkSession.sparkContext.broadcast(tables), self.kind, self.sizes, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = shared.value

            def hot(n: int, h: np.ndarray) -> np.ndarray:
                out, places = np.zeros(len(h), bool), [_bucket(h, r, width) for r in range(SKETCH_ROWS)]
                for table in (t for (lo, hi), t in tables if lo <= n <= hi):
                    one = table[0][places[0]]
                    for r in range(1, SKETCH_ROWS):
                        one &= table[r][places[r]]
                    out |= one
                return out

            for _, part in _parts(batches, kind, sizes):
                yield from part.counts(hot, by_size)

        return self.texts.mapInArrow(run, _COUNTS)

    def close(self) -> None:
        pass


def _bucket(h: np.ndarray, r: int, width: int) -> np.ndarray:
    """Bits of the hash that the rows do not share."""
    return (h >> np.uint64(21 * r)).astype(np.int64) & (width - 1)
