"""Periodic runs of words: stretches that repeat a shorter stretch at least three times, found by a dictionary of basic factors.

A run is a stretch of consecutive words of one text with smallest period q (words q apart are identical) that has at least
`min_words` words and `times` periods and that no neighbouring word extends. For each power of two m the factors of m words are
named, equal ones by the same number; the names of length 2m are pairs of names of length m. Where the next occurrence of a factor
starts within its length, so that both lie within twice that length, its distance is a proposed period. Successors at one
distance from consecutive places are one progression and one proposal. Proposals are extended as far as words q apart are equal
and deduplicated, as lengths above the period propose it again.

This finds each run: let m be the least power of two that is q or more, so q + m < 3q, and the factor at the run's first word
occurs again q words on; an earlier occurrence would make the period a repetition of a shorter one. For the same reason a proposal
that has three periods has no smaller period. Factors that occur once in their text are in no run and are dropped from the next
length, so ordinary prose ends after a few lengths. All texts of a batch are named in the same numpy passes; a text is never cut.

Defined cases: null, empty and blank texts have no words, no runs and an empty collapsed text; words are compared by bytes, as they
stand; every row is judged by itself, so repeated rows and null doc_ids keep their rows; an empty table gives no rows; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import raw
from lexigrid.llm.windows import by_bytes

#: Cells compared at once when proposals are extended.
CELLS = 1 << 21

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, strongest int, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _equal_steps(codes: np.ndarray, at: np.ndarray, period: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """How many words from `at` on, in steps of 1 or -1 and at most `most`, equal the word a period later."""
    total, active, width = np.zeros(len(at), np.int64), np.flatnonzero(most > 0), 8
    while len(active):
        width = max(1, min(width, CELLS // len(active)))
        ahead = total[active, None] + np.arange(width)
        inside = ahead < most[active, None]
        place = np.where(inside, at[active, None] + step * ahead, 0)
        equal = inside & (codes[place] == codes[np.where(inside, place + period[active, None], 0)])
        count = np.where(equal.all(axis=1), width, equal.argmin(axis=1))
        total[active] += count
        active = active[(count == width) & (total[active] < most[active])]
        width = min(2 * width, 4096)
    return total


def _proposals(codes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, known end of equality and period of each progression of successors, over all lengths."""
    place, name, m = np.arange(len(codes)), doc * (int(codes.max()) + 1) + codes, 1
    found = []
    while len(place) > 1:
        order = np.argsort(name, kind="stable")
        same = np.diff(name[order]) == 0
        here, after = place[order[:-1][same]], place[order[1:][same]]
        near = after - here <= m
        here, period = here[near], (after - here)[near]
        if len(here):
            by = np.lexsort((here, period))
            here, period = here[by], period[by]
            first = np.flatnonzero(np.concatenate(([True], (np.diff(here) != 1) | (np.diff(period) != 0))))
            last = np.append(first[1:], len(here)) - 1
            found.append((here[first], here[last] + m, period[first]))
        again = np.append(same, False) | np.insert(same, 0, False)
        names = np.full(len(codes) + m, -1, np.int64)
        names[place[order[again]]] = np.cumsum(np.concatenate(([0], ~same)))[again]
        place = place[names[place] >= 0]
        place = place[names[place + m] >= 0]
        place = place[doc[place] == doc[place + m]]
        name = names[place] * (len(codes) + 1) + names[place + m]
        m *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def find_runs(codes: np.ndarray, lengths: np.ndarray, min_words: int = 24, times: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of every run in texts laid end to end, by text, start and period.

    codes: a number for each word, equal for equal words; lengths: words of each text; starts count from the text's first word.
    """
    if times < 3:
        raise ValueError("runs of fewer than three periods are not looked for")
    ends = np.cumsum(lengths)
    begins = ends - lengths
    doc = np.repeat(np.arange(len(lengths)), lengths)
    start, stop, period = _proposals(codes, doc) if len(codes) else (np.zeros(0, np.int64),) * 3
    of = doc[start]
    stop = stop + _equal_steps(codes, stop, period, ends[of] - period - stop, 1)
    start = start - _equal_steps(codes, start - 1, period, start - begins[of], -1)
    length = stop + period - start
    go = (length >= min_words) & (length >= times * period)
    rows = np.unique(np.stack([of[go], start[go] - begins[of[go]], period[go], length[go]], axis=1), axis=0)
    return rows[:, 0], rows[:, 1], rows[:, 3], rows[:, 2]


def kept_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words stay when every run is cut down to its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge)[:n] == 0


def _judged(min_words: int, times: int):
    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [text.split() for text in raw(batch.column(1))]  # on bytes: the six ASCII blanks
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        words = pa.array([w for words in texts for w in words], pa.binary()).dictionary_encode()
        of, start, length, period = find_runs(words.indices.to_numpy().astype(np.int64), lengths, min_words, times)
        cuts = np.searchsorted(of, np.arange(len(texts) + 1))
        strongest, collapsed = [], []
        for i, text in enumerate(texts):
            a, b = cuts[i], cuts[i + 1]
            if a == b:
                strongest.append(None)
                collapsed.append(b" ".join(text))
                continue
            powers = [Fraction(x, y) for x, y in zip(length[a:b].tolist(), period[a:b].tolist())]
            strongest.append(powers.index(max(powers)))  # the first: smallest start, then smallest period
            stays = kept_words(len(text), start[a:b], length[a:b], period[a:b])
            collapsed.append(b" ".join([text[j] for j in np.flatnonzero(stays).tolist()]))
        runs = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], fields=list(_RUN))
        runs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), runs)
        columns = [batch.column(0), pa.array(lengths), runs, pa.array(strongest, pa.int32()), pa.array(collapsed, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "strongest", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(make, by_bytes(batches, 1))

    return run


def periodic_runs(docs: DataFrame, min_words: int = 24, times: int = 3) -> DataFrame:
    """One row for each row of `docs`: its words, its runs by start and period, and its text with every run cut to one period.

    runs: start (number of the first word, from 0), length and period in words. strongest: index of the run with the greatest
    length / period, the first of equal ones; null without runs. collapsed: the kept words, joined by one space.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(_judged(min_words, times), SCHEMA)
