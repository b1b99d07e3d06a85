"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over training token windows.

Words are runs of digits, letters (A to Z lower-cased) and characters outside ASCII. The windows of an item are its runs of
`width` words; an item with fewer words is one window, an item without words none. A document word inside any occurrence of a
window is hit. The set holds the windows themselves, so a lookup compares hashes first and then all words. It is broadcast in
blocks of at most `BLOCK_WORDS` benchmark words, a bound on its size; the blocks of a larger benchmark scan each document one
after the other and add up their hits. Nothing is shuffled.

Defined cases: null or empty texts have no words, no hits, no items; a null item_id counts as the item with an empty name;
repeated items count once; rows of equal doc_id each keep a row; without items every document is clean. Texts may be of any
length. Further columns stay out of the way: only doc_id, text, item_id are read, and `decontaminated` returns all columns.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import by_rows, raw

#: Benchmark words in one broadcast block: windows of some 20 MB.
BLOCK_WORDS = 200_000

_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def tokens(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


class Windows:
    """The windows of some items, by length, and the items each is from."""

    def __init__(self, items: list[tuple[str, bytes]], width: int) -> None:
        self.width = width
        self.items: dict[bytes, set[str]] = defaultdict(set)
        for item, text in items:
            w = tokens(text)
            for i in range(max(1, len(w) - width + 1) if w else 0):
                self.items[b" ".join(w[i : i + width])].add(item)
        #: Short windows by their first word: their lengths.
        self.short: dict[bytes, set[int]] = defaultdict(set)
        for gram in self.items:
            w = gram.split(b" ")
            if len(w) < width:
                self.short[w[0]].add(len(w))

    def scan(self, text: bytes) -> tuple[int, np.ndarray, set[str]]:
        """Number of words, which of them are hit, and the items with occurring windows."""
        w = tokens(text)
        hit, found = np.zeros(len(w), bool), set()
        joined = b" ".join(w)
        ends = list(accumulate(map((1).__add__, map(len, w))))  # where the next word starts
        starts = [0, *ends]
        grams, k = self.items, self.width
        for i, (a, b) in enumerate(zip(starts, ends[k - 1 :])):
            if (gram := joined[a : b - 1]) in grams:
                hit[i : i + k] = True
                found |= grams[gram]
        if self.short:
            for i, word in enumerate(w):
                for n in self.short.get(word, ()):
                    if i + n <= len(w) and (gram := joined[starts[i] : ends[i + n - 1] - 1]) in grams:
                        hit[i : i + n] = True
                        found |= grams[gram]
        return len(w), hit, found


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of a bounded number of words, read one partition at a time."""
    block, size = [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    for row in rows.toLocalIterator():
        n = len(row.text) // 2 + 1
        if block and size + n > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((row.item, bytes(row.text)))
        size += n
    yield block


def _blocks_of(benchmark: DataFrame, width: int) -> list:
    sc = benchmark.sparkSession.sparkContext
    return [sc.broadcast(Windows(block, width)) for block in _blocks(benchmark)]


def _scan(text: bytes, blocks: list) -> tuple[int, np.ndarray, set[str]]:
    n, hit, found = blocks[0].value.scan(text)
    for block in blocks[1:]:
        _, more, items = block.value.scan(text)
        hit, found = hit | more, found | items
    return n, hit, found


def contaminated(n_hit: int, n_words: int, share: int = 20) -> bool:
    """At least one word in `share` is hit."""
    return n_hit > 0 and share * n_hit >= n_words


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 13) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, the sorted ids of its items, and contaminated."""
    blocks = _blocks_of(benchmark, width)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [_scan(t, blocks) for t in raw(batch.column(1))]
        n, k = [x[0] for x in found], [int(x[1].sum()) for x in found]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n, pa.int64()),
                pa.array(k, pa.int64()),
                pa.array([sorted(x[2]) for x in found], pa.list_(pa.string())),
                pa.array(list(map(contaminated, k, n))),
            ],
            ["doc_id", "n_words", "n_hit", "items", "contaminated"],
        )

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(by_rows(make), "doc_id long, n_words long, n_hit long, items array<string>, contaminated boolean")


def _cut(text: str, hit: np.ndarray) -> str:
    """The text without hit words and the separators inside their runs, which one blank replaces."""
    data = text.encode()
    clean = data.translate(_KEEP)
    starts, ends, at = [], [], 0
    for word in clean.split():
        at = clean.index(word, at)
        starts.append(at)
        at += len(word)
        ends.append(at)
    bounds = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0])))).tolist()
    out, last = [], 0
    for a, b in zip(bounds[::2], bounds[1::2]):
        out.append(data[last : starts[a]])
        last = ends[b - 1]
    return b"".join([*out, data[last:]]).decode()


def decontaminated(docs: DataFrame, benchmark: DataFrame, width: int = 13, spans: bool = False) -> DataFrame:
    """The documents with all their columns: without contaminated ones, or (`spans`) with their hit words cut out instead."""
    blocks = _blocks_of(benchmark, width)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index("text")
        texts = batch.column(at)
        found = [_scan(t, blocks) for t in raw(texts.cast(pa.binary()))]
        if not spans:
            return batch.filter(pa.array([not contaminated(int(hit.sum()), n) for n, hit, _ in found], pa.bool_()))
        cut = [_cut(t, hit) if hit.any() else t for t, (_, hit, _) in zip(texts.to_pylist(), found)]
        return pa.RecordBatch.from_arrays([pa.array(cut, texts.type) if i == at else c for i, c in enumerate(batch.columns)], batch.schema.names)

    return docs.mapInArrow(by_rows(make), docs.schema)
