"""Vocabulary fit: term statistics, frequency cuts, top terms, index."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.operators.term_counts import BUCKETS_PER_TERM, MOST_BUCKETS, heavy_terms, partial_counts, summed
from lexigrid.operators.text_sketch import TextSketch
from lexigrid.session import cut

# Rows a single task may merge when the top terms of all partitions meet.
TOP_MERGE_ROWS = 20_000_000


#: Sizes of the runs that are terms, least document frequency, number of terms.
Top = tuple[tuple[int, int], int, int]


def term_stats(corpus: DataFrame, grams: Column, sizes: tuple[int, int] = (1, 1), kind: str = "word", tops: list[Top] | None = None) -> DataFrame:
    """``(term, df, cf)``: documents with the term and occurrences of the term.

    Terms are counted inside the row and added up inside an Arrow batch, so a frequent term is
    shuffled once for each batch and a rare one once for each document. ``sizes``, ``kind``: as for `fit_vocabulary`.

    ``tops``: ``(top, term, df, cf)``, the most frequent terms of each of these only, by its place in the list; other terms are not
    shuffled. All of them share one sketch and, as a rule, one pass for the exact counts.
    """
    if tops is None:
        return summed(partial_counts(corpus.select(grams.alias("terms")), sizes=sizes))
    sketch = TextSketch(corpus.select(grams.alias("terms")), max(k for _, _, k in tops), sizes, kind)
    bounds = [max(low, sketch.above(2 * k, rng)) for rng, low, k in tops]
    out, left = None, list(range(len(tops)))
    while left:
        if kind == "word":
            rows = cut(sketch.by_size([(tops[i][0], bounds[i]) for i in left]).groupBy("size", "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")))
        else:  # runs of characters have one list of sizes
            rows = cut(summed(sketch.candidates(min(bounds[i] for i in left))))
        again = []
        for i in left:
            rng, low, k = tops[i]
            stats = rows.filter(F.col("size").between(*rng)).drop("size") if kind == "word" else rows
            one = cut(top_terms(frequency_cut(stats, sketch.n_docs, low), k).select(F.lit(i).alias("top"), "term", "df", "cf"))
            n, reached = one.agg(F.count(F.lit(1)), F.min("cf")).first()
            if bounds[i] <= low or (n >= k and reached >= bounds[i]):
                out = one if out is None else out.unionByName(one)
            else:  # a term that was left out can be more frequent than the last one
                bounds[i] = max(low, reached) if n >= k else low
                again.append(i)
        left = again
    return out


def frequency_cut(stats: DataFrame, n_docs: int, min_df: int | float = 1, max_df: int | float = 1.0) -> DataFrame:
    """Keep terms by document frequency; a float bound is a share of the documents.

    A share and a number may cross as the corpus grows: then no term is within both.
    """
    low = min_df * n_docs if isinstance(min_df, float) else min_df
    high = max_df * n_docs if isinstance(max_df, float) else max_df
    return stats.filter((F.col("df") >= F.lit(low)) & (F.col("df") <= F.lit(high)))


def top_terms(stats: DataFrame, k: int, merge_rows: int = TOP_MERGE_ROWS) -> DataFrame:
    """The ``k`` most frequent terms of the corpus, ties by term.

    A plain ``orderBy.limit`` merges up to ``k`` rows of every partition in one task.  When
    that would be too many, a histogram over logarithmic frequency bins first finds the
    bins that can hold the top ``k``, and only their terms are ordered.
    """
    order = (F.col("cf").desc(), F.col("term"))
    partitions = int(stats.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if partitions * k > merge_rows:
        binned = stats.withColumn("bin", F.floor(F.log2(F.col("cf").cast("double")) * 16))
        bins = binned.groupBy("bin").agg(F.count("*").alias("n"))  # at most ~1000 bins
        seen = bins.withColumn(
            "above", F.sum("n").over(Window.orderBy(F.col("bin").desc())) - F.col("n")
        )
        floor_bin = seen.filter(F.col("above") < k).agg(F.min("bin")).first()[0]
        if floor_bin is not None:
            stats = binned.filter(F.col("bin") >= floor_bin).drop("bin")
    return stats.orderBy(*order).limit(k)


def alphabetical_index(terms: DataFrame, bounded: bool) -> DataFrame:
    """Add ``idx`` (0-based, by term).

    A bounded vocabulary is numbered in one window.  An unbounded one is range-partitioned
    by term, stored, and numbered by position in the partition plus the sizes of the
    partitions before it.
    """
    if bounded:
        return terms.withColumn("idx", F.row_number().over(Window.orderBy("term")) - 1)
    placed = cut(
        terms.repartitionByRange("term")
        .sortWithinPartitions("term")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))  # one row per partition
    starts = sizes.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start"),
    )
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn("idx", F.col("_start") + F.col("_pos"))
        .drop("_part", "_pos", "_start")
    )


def least_documents(n_docs: int, min_df: int | float) -> int:
    """Documents that a term needs; its occurrences are as many at least."""
    return max(1, math.ceil(min_df * n_docs) if isinstance(min_df, float) else min_df)


def top_of(counts: DataFrame | None, n_docs: int, min_df: int | float, max_df: int | float, max_features: int, sketch: TextSketch | None = None) -> DataFrame:
    """The most frequent terms within the frequency bounds, from partial counts or a sketch of texts; the tail of rare terms is not shuffled."""
    low = least_documents(n_docs, min_df)
    return heavy_terms(
        counts, max_features, lambda rows: top_terms(frequency_cut(summed(rows), n_docs, min_df, max_df), max_features), low, sketch=sketch
    )


def _top(
    texts: DataFrame, n_docs: int | None, min_df: int | float, max_df: int | float, max_features: int, sizes: tuple[int, int], kind: str,
) -> tuple[DataFrame, int]:
    """The most frequent terms of texts (terms) within the frequency bounds, and the number of documents."""
    sketch = TextSketch(texts, max_features, sizes, kind) if kind != "word" or BUCKETS_PER_TERM * max_features <= MOST_BUCKETS else None
    n_docs = n_docs if n_docs is not None else sketch.n_docs if sketch else texts.count()
    counts = None if sketch else partial_counts(texts, sizes=sizes)
    return top_of(counts, n_docs, min_df, max_df, max_features, sketch), n_docs


def fit_vocabulary(
    corpus: DataFrame,
    grams: Column,
    min_df: int | float = 1,
    max_df: int | float = 1.0,
    max_features: int | None = None,
    n_docs: int | None = None,
    sizes: tuple[int, int] = (1, 1),
    kind: str = "word",
) -> DataFrame:
    """``(term, idx, df, cf, idf)`` with ``idf = ln((1 + n) / (1 + df)) + 1``.

    ``sizes``: terms are runs of so many neighbours in ``grams``, joined by a blank. With ``max_features``, ``kind`` may say that
    they are runs of characters of the text ``grams`` (``char``) or inside the padded elements of ``grams`` (``char_wb``).
    """
    if max_features is None and kind != "word":
        raise ValueError("an unbounded vocabulary takes its terms as a list")
    if max_features is None:
        if n_docs is None:
            n_docs = corpus.count()
        stats = frequency_cut(term_stats(corpus, grams, sizes), n_docs, min_df, max_df)
    else:
        stats, n_docs = _top(corpus.select(grams.alias("terms")), n_docs, min_df, max_df, max_features, sizes, kind)
    indexed = alphabetical_index(stats, bounded=max_features is not None)
    return indexed.select(
        "term",
        F.col("idx").cast("int").alias("idx"),
        "df",
        "cf",
        (F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0).alias("idf"),
    )


def stored_vocabulary(*args, **kwargs) -> DataFrame:
    """A fitted vocabulary in reliable storage, for joins that read it more than once; an unbounded one lies there already."""
    fitted = fit_vocabulary(*args, **kwargs)
    return fitted if kwargs.get("max_features") is None and len(args) < 5 else cut(fitted)


def space_profile(stats: DataFrame, n_docs: int, name: str, min_df: int, max_features: int) -> DataFrame:
    """Size of a candidate feature space from term statistics alone.

    The number of stored cells is the sum of the document frequencies of the kept terms, so
    no feature matrix is built.
    """
    kept = top_terms(frequency_cut(stats, n_docs, min_df), max_features)
    gib = float(1 << 30)
    return kept.agg(F.count("*").alias("n_terms"), F.coalesce(F.sum("df"), F.lit(0)).alias("nnz")).select(
        F.lit(name).alias("candidate"),
        F.lit(n_docs).cast("long").alias("n_docs"),
        "n_terms",
        "nnz",
        F.coalesce(F.try_divide(F.col("nnz"), F.col("n_terms") * F.lit(n_docs)), F.lit(0.0)).alias("density"),
        (F.col("n_terms") * F.lit(n_docs) * 8.0 / gib).alias("dense_gb"),
        (F.col("nnz") * 12.0 / gib).alias("sparse_gb"),
    )
