"""Vocabularies and naive Bayes models of all folds from one pass over the texts.

What is fitted on a fold's training part is made of sums over documents, and the training part is the corpus without the fold: its
sums are those of the corpus minus those of the fold. One table of counts by (fold, label, term) thus holds k vocabularies and k
models, and no text is read again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.operators.classifiers import Fitted
from lexigrid.operators.naive_bayes import DRIVER_CELLS, ClassTermCounts, score_vectors
from lexigrid.operators.term_counts import _numbered, _pieces, heavy_terms, partial_counts, summed
from lexigrid.operators.vocab import frequency_cut, least_documents, top_terms
from lexigrid.session import keep


@dataclass
class FoldVocabulary:
    """Terms of a fold's training part by index, with their inverse document frequencies."""

    terms: list[str]
    idf: np.ndarray


@dataclass
class FoldStatistics:
    """Partial counts of a corpus by (fold, label, term), and the documents of each fold and label."""

    counts: DataFrame
    documents: dict[tuple[int, str | None], int]
    held: list[DataFrame] = field(default_factory=list)

    @classmethod
    def of(cls, counted: DataFrame) -> FoldStatistics:
        """``counted``: label, fold, terms, tfs of every document."""
        counts = keep(partial_counts(counted, "fold", "label"))
        docs = counts.filter("term is null").groupBy("fold", "label").agg(F.sum("df").alias("n")).collect()  # a row a fold and label
        return cls(counts, {(r["fold"], r["label"]): r["n"] for r in docs})

    def close(self) -> None:
        self.counts.unpersist()

    @property
    def folds(self) -> list[int]:
        return sorted({f for f, _ in self.documents})

    def train_size(self, fold: int) -> int:
        return sum(n for (f, _), n in self.documents.items() if f != fold)

    def train_labels(self, fold: int) -> list[str]:
        return sorted({label for (f, label), n in self.documents.items() if f != fold and label is not None and n})

    def _without(self, rows: DataFrame, fold: int) -> DataFrame:
        """``(term, df, cf)`` of all folds but one, from rows of ``_by_term``."""
        own = F.get("by_fold", F.lit(self.folds.index(fold)))
        return rows.select("term", (F.col("df") - own["df"]).alias("df"), (F.col("cf") - own["cf"]).alias("cf")).filter("df > 0")

    def _by_term(self, counts: DataFrame) -> DataFrame:
        """A row for each term: its sums, and those of each fold in order."""
        sums = [
            F.struct(F.sum(F.when(F.col("fold") == f, F.col("df")).otherwise(0)).alias("df"), F.sum(F.when(F.col("fold") == f, F.col("cf")).otherwise(0)).alias("cf"))
            for f in self.folds
        ]
        return counts.filter("term is not null").groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"), F.array(*sums).alias("by_fold"))

    def vocabularies(self, min_df: int | float = 1, max_df: int | float = 1.0, max_features: int | None = None) -> DataFrame:
        """``(fold, term, idx, df, cf, idf)`` of each fold's training part: what a fit on that part alone gives."""
        bounds = {f: self.train_size(f) for f in self.folds}

        def pick(counts: DataFrame) -> DataFrame:
            rows = keep(self._by_term(counts))
            self.held.append(rows)
            out = None
            for fold, n in bounds.items():
                stats = frequency_cut(self._without(rows, fold), n, min_df, max_df)
                one = (stats if max_features is None else top_terms(stats, max_features)).select(F.lit(fold).alias("fold"), "term", "df", "cf")
                out = one if out is None else out.unionByName(one)
            return out

        least = min(least_documents(n, min_df) for n in bounds.values())
        chosen = pick(self.counts) if max_features is None else heavy_terms(self.counts, max_features, pick, least, len(bounds))
        sizes = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])
        idx = (F.row_number().over(Window.partitionBy("fold").orderBy("term")) - 1).cast("int")
        return chosen.select("fold", "term", idx.alias("idx"), "df", "cf", (F.log((1.0 + sizes[F.col("fold")]) / (1.0 + F.col("df"))) + 1.0).alias("idf"))

    def collected(self, max_terms: int, **bounds) -> dict[int, FoldVocabulary]:
        """The vocabularies as objects on the driver, of at most ``max_terms`` terms each."""
        chosen = self.vocabularies(**bounds)
        if chosen.groupBy("fold").count().filter(F.col("count") > max_terms).head(1):
            raise ValueError("the vocabulary is too large for a model object: set maxFeatures")
        rows = chosen.select("fold", "term", "idx", "idf").collect()
        for frame in self.held:
            frame.unpersist()
        out = {}
        for fold in self.folds:
            own = sorted((r for r in rows if r["fold"] == fold), key=lambda r: r["idx"])
            if not own:
                raise ValueError(f"empty vocabulary in fold {fold}: no term survives the frequency bounds")
            out[fold] = FoldVocabulary([r["term"] for r in own], np.array([r["idf"] for r in own]))
        return out

    def class_counts(self, vocabularies: dict[int, FoldVocabulary]) -> dict[int, ClassTermCounts]:
        """Class x term counts of each fold's training part, over its vocabulary."""
        terms = sorted({t for v in vocabularies.values() for t in v.terms})
        labels = sorted({label for _, label in self.documents if label is not None})
        if len(terms) * len(labels) * len(self.folds) > DRIVER_CELLS:
            raise ValueError("class x term tables of the folds are too large for the driver: use fewer terms")
        wanted = self.counts.sparkSession.createDataFrame([(t,) for t in terms], "term string")
        rows = summed(self.counts.join(F.broadcast(wanted), "term"), "fold", "label").filter("label is not null").collect()
        at = {t: i for i, t in enumerate(terms)}
        cube = np.zeros((len(self.folds), len(labels), len(terms)))
        for r in rows:
            cube[self.folds.index(r["fold"]), labels.index(r["label"]), at[r["term"]]] = r["cf"]
        rest, out = cube.sum(axis=0), {}
        for i, fold in enumerate(self.folds):
            own = self.train_labels(fold)
            columns = [at[t] for t in vocabularies[fold].terms]
            out[fold] = ClassTermCounts(own, (rest - cube[i])[[labels.index(x) for x in own]][:, columns])
        return out


def counted_vectors(counted: DataFrame, vocabulary: FoldVocabulary, weighting: str, *keys: str) -> DataFrame:
    """``(keys..., features)``: counts or L2-normalised TF-IDF of counted documents as sparse vectors; a row's terms are looked up in the row."""
    sent = counted.sparkSession.sparkContext.broadcast(({t: i for i, t in enumerate(vocabulary.terms)}, vocabulary.idf))
    schema = T.StructType([*(T.StructField(k, counted.schema[k].dataType) for k in keys), T.StructField("features", VectorUDT())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, idf = sent.value
        for batch in _pieces(batches, "terms"):
            row, code, terms = _numbered(batch.column("terms"))
            tf = batch.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            idx = np.fromiter((index.get(t, -1) for t in terms.to_pylist()), np.int64, len(terms))[code]
            known = idx >= 0
            row, idx, value = row[known], idx[known], tf[known]
            order = np.lexsort((idx, row))
            row, idx, value = row[order], idx[order], value[order]
            if weighting == "tfidf":
                value = value * idf[idx]
                norm = np.sqrt(np.bincount(row, value * value, batch.num_rows))
                value = value / norm[row]
            offsets = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
            cells = [pa.ListArray.from_arrays(offsets, x) for x in (pa.array(idx.astype(np.int32)), pa.array(value))]
            fixed = [pa.array(np.full(batch.num_rows, x), kind) for x, kind in ((0, pa.int8()), (len(index), pa.int32()))]
            vectors = pa.StructArray.from_arrays([*fixed, *cells], ["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), vectors], [*keys, "features"])

    return counted.select(*keys, "terms", "tfs").mapInArrow(run, schema)


def complement_nb_from(counts: ClassTermCounts, alpha: float = 1.0) -> Fitted:
    """Complement naive Bayes from class x term counts; equal to a fit on the count vectors."""
    weights = counts.weights(alpha)
    return Fitted(counts.labels, lambda rows: score_vectors(rows, weights, "_p"))
