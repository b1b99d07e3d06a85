"""Terms counted inside the row, and sums of them that no shuffle of single occurrences has to carry.

A document's features are numbered, and repeated ones added up, in Arrow batches, so a term leaves its document once and
leaves a batch once. Everything above is a sum over these rows: document frequencies, corpus frequencies, counts by class and
by fold.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.session import cut, keep

#: Features of a batch that are numbered at once, about.
PIECE = 1 << 21
#: Buckets of a sketch for each wanted term, its rows, and the largest number of buckets a row.
BUCKETS_PER_TERM, SKETCH_ROWS, MOST_BUCKETS = 64, 3, 1 << 22


def _pieces(batches: Iterator[pa.RecordBatch], column: str, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of batches whose lists (or texts) hold about ``PIECE`` elements (or bytes), or one row with more."""
    for batch in batches:
        own = batch.column(column)
        lengths = pc.list_value_length(own) if pa.types.is_list(own.type) or pa.types.is_large_list(own.type) else pc.binary_length(own)
        sizes = np.cumsum(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, before + (most or PIECE), side="right")))
            yield batch.slice(at, to - at)
            at = to


def _numbered(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and number of each element of a list column, and the distinct elements."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    flat = flat.cast(pa.large_string()) if flat.type == pa.string() and flat.nbytes > 1 << 30 else flat
    coded = flat.dictionary_encode()
    return np.repeat(np.arange(len(lists)), lengths), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _joined(lists: pa.Array, lo: int, hi: int) -> pa.Array:
    """Runs of lo to hi neighbouring elements of each list, joined by a blank."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat, row = lists.flatten(), np.repeat(np.arange(len(lists)), lengths)
    parts, rows, run = [], [], flat
    for n in range(1, hi + 1):
        if n > 1:
            run = pc.binary_join_element_wise(run.slice(0, max(0, len(flat) - n + 1)), flat.slice(min(n - 1, len(flat))), " ")
        if n >= lo:
            same = row[n - 1 :] == row[: len(row) - n + 1] if len(row) >= n else np.zeros(0, bool)
            parts.append(run.filter(pa.array(same)) if n > 1 else run)
            rows.append(row[: len(same)][same])
    of = np.concatenate(rows)
    order = np.argsort(of, kind="stable")
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(of[order], np.arange(len(lists) + 1)), pa.int32()), pa.concat_arrays(parts).take(pa.array(order)))


def _in_rows(batch: pa.RecordBatch, sizes: tuple[int, int] = (1, 1)) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Row, number and occurrences of each distinct term of a row, and the distinct terms; ``tfs`` counts, where there is one."""
    lists = batch.column("terms")
    row, code, terms = _numbered(lists if sizes == (1, 1) else _joined(lists, *sizes))
    if "tfs" in batch.schema.names:
        return row, code, batch.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(np.int64), terms
    pair, tf = np.unique(row * max(1, len(terms)) + code, return_counts=True)
    return pair // max(1, len(terms)), pair % max(1, len(terms)), tf, terms


def _fields(df: DataFrame, keys: tuple[str, ...]) -> list[T.StructField]:
    return [T.StructField(k, df.schema[k].dataType) for k in keys]


def counted_documents(corpus: DataFrame, grams: Column, *keys: str, sizes: tuple[int, int] = (1, 1)) -> DataFrame:
    """``(keys..., terms, tfs)``: each row's distinct terms and how often it holds them; one pass over the texts.

    ``sizes``: terms are runs of so many neighbours in ``grams``, joined by a blank.
    """
    schema = T.StructType([*_fields(corpus, keys), T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("tfs", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, "terms"):
            row, code, tf, terms = _in_rows(batch, sizes)
            offsets = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (terms.take(pa.array(code)).cast(pa.string()), pa.array(tf.astype(np.int32)))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), *lists], [*keys, "terms", "tfs"])

    return corpus.select(*keys, grams.alias("terms")).mapInArrow(run, schema)


def partial_counts(rows: DataFrame, *keys: str, sizes: tuple[int, int] = (1, 1)) -> DataFrame:
    """``(keys..., term, df, cf)`` summed over Arrow batches: to be summed again by key and term.

    ``rows`` has ``terms`` (features with repeats), or ``terms`` and ``tfs`` as from `counted_documents`. A row without a term
    (null) has the number of documents as ``df``. ``sizes``: as for `counted_documents`.
    """
    schema = T.StructType([*_fields(rows, keys), T.StructField("term", T.StringType()), T.StructField("df", T.LongType()), T.StructField("cf", T.LongType())])
    columns = [*keys, "terms", *(["tfs"] if "tfs" in rows.columns else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, "terms"):
            group, first = np.zeros(batch.num_rows, np.int64), np.zeros(1, np.int64)
            if keys:
                of = pa.StructArray.from_arrays([batch.column(k) for k in keys], list(keys))
                named: dict = {}
                group = np.fromiter((named.setdefault(tuple(x.values()), len(named)) for x in of.to_pylist()), np.int64, batch.num_rows)
                first = np.unique(group, return_index=True)[1]
            row, code, tf, terms = _in_rows(batch, sizes)
            width = max(1, len(terms))
            at, where = np.unique(group[row] * width + code, return_inverse=True)
            df, cf = np.bincount(where, minlength=len(at)), np.bincount(where, tf, len(at))
            docs = np.bincount(group, minlength=len(first))
            owner = pa.array(first[np.concatenate((at // width, np.arange(len(first))))])
            term = pa.concat_arrays([terms.take(pa.array(at % width)).cast(pa.string()), pa.nulls(len(first), pa.string())])
            counts = [pa.array(np.concatenate(x).astype(np.int64)) for x in ((df, docs), (cf, np.zeros(len(first))))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(owner) for k in keys), term, *counts], [*keys, "term", "df", "cf"])

    return rows.select(*columns).mapInArrow(run, schema)


def summed(counts: DataFrame, *keys: str) -> DataFrame:
    """``(keys..., term, df, cf)``, one row for each."""
    return counts.filter("term is not null").groupBy(*keys, "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def count_documents(counts: DataFrame) -> int:
    return counts.filter("term is null").agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]


class Sketch:
    """Upper bounds of corpus frequencies: a count-min sketch of partial counts.

    Each row of the sketch adds up the frequencies of terms by a bucket of their hash; sketches of partitions are added by a
    shuffle of at most ``SKETCH_ROWS * width`` rows a partition, whatever the number of terms.
    """

    def __init__(self, counts: DataFrame, wanted: int) -> None:
        self.width = 1 << max(12, (BUCKETS_PER_TERM * wanted - 1).bit_length())
        self.counts = counts.filter("term is not null").withColumn("_h", F.xxhash64("term"))
        rows = [self.counts.groupBy(self._bucket(r).alias("b")).agg(F.sum("cf").alias("most")).select(F.lit(r).alias("r"), "b", "most") for r in range(SKETCH_ROWS)]
        self.sums = keep(reduce(DataFrame.unionByName, rows))

    def _bucket(self, r: int) -> Column:
        """Bits of the hash that the rows do not share."""
        return F.shiftrightunsigned("_h", 21 * r).bitwiseAND(F.lit(min(self.width, 1 << 21) - 1))

    def above(self, rank: int) -> int:
        """The ``rank``-th largest bucket of a row."""
        largest = self.sums.filter("r = 0").orderBy(F.desc("most")).limit(rank)
        return largest.agg(F.coalesce(F.min("most"), F.lit(0))).first()[0]

    def candidates(self, least: int) -> DataFrame:
        """The counts of all terms that can have a frequency of ``least``, and few others."""
        hot = self.sums.filter(F.col("most") >= least)
        out = self.counts
        for r in range(SKETCH_ROWS):
            row = hot.filter(F.col("r") == r).select(F.col("b").alias("_b"))  # at most `width` rows
            out = out.withColumn("_b", self._bucket(r)).join(F.broadcast(row), "_b", "left_semi").drop("_b")
        return out.drop("_h")

    def close(self) -> None:
        self.sums.unpersist()


def heavy_terms(counts: DataFrame | None, k: int, pick, least: int = 1, groups: int = 1, sketch=None) -> DataFrame:
    """Exact statistics of the terms that ``pick`` chooses from partial counts, in reliable storage.

    ``pick`` maps partial counts to rows of chosen terms with their ``cf``: at most ``k`` in each of ``groups``, by falling ``cf``,
    and none with ``cf < least``; a term's ``cf`` is at most its sum over all counts. Only terms whose sketched frequency reaches a
    threshold are shuffled. The threshold starts at a bucket's frequency that about ``2 k`` terms reach; if the least frequent
    chosen term does not reach it, terms outside could be chosen too, and the threshold becomes that term's frequency, or ``least``.
    ``sketch``: one that stands for the counts, as of texts.
    """
    if sketch is None and BUCKETS_PER_TERM * k > MOST_BUCKETS:
        return cut(pick(counts))
    sketch = sketch or Sketch(counts, k)
    threshold = max(least, sketch.above(2 * k))
    while True:
        chosen = cut(pick(sketch.candidates(threshold)))
        n, reached = chosen.agg(F.count(F.lit(1)), F.min("cf")).first()
        full = n >= k * groups
        if threshold <= least or (full and reached >= threshold):
            sketch.close()
            return chosen
        threshold = max(least, reached) if full else least
