"""Term counts and TF-IDF, as sparse vectors and in long form."""

from __future__ import annotations

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.functions.text import FLAG_PATTERNS, analyze, analyze_parts, analyze_units, regex_flags
from lexigrid.functions.vectors import vector_cells
from lexigrid.operators.vocab import fit_vocabulary
from lexigrid.session import fits_broadcast

# A vocabulary that rides in a model object on the driver may hold at most this many terms.
DRIVER_TERMS = 1_000_000


# --- sparse vectors: row-local, no shuffle --------------------------------


def bound(value: float, below: float) -> float | int:
    """A share of the documents stays a float, a number of documents becomes an int."""
    return value if value < below else int(value)


class _AnalyzerParams(HasInputCol, HasOutputCol):
    analyzer = Param(Params._dummy(), "analyzer", "word, char, char_wb or space", TypeConverters.toString)
    ngramRange = Param(Params._dummy(), "ngramRange", "smallest and largest n", TypeConverters.toListInt)
    stripAccents = Param(Params._dummy(), "stripAccents", "drop diacritics first", TypeConverters.toBoolean)
    stopWords = Param(Params._dummy(), "stopWords", "words to drop", TypeConverters.toListString)

    def _asked(self) -> tuple:
        return (
            F.col(self.getOrDefault("inputCol")),
            self.getOrDefault("analyzer"),
            tuple(self.getOrDefault("ngramRange")),
            self.getOrDefault("stripAccents"),
            self.getOrDefault("stopWords"),
        )

    def _grams(self) -> Column:
        return analyze(*self._asked())

    def _parts(self, bounded: bool) -> tuple[Column, tuple[int, int], str]:
        return analyze_units(*self._asked()) if bounded else (*analyze_parts(*self._asked()), "word")


class Analyzer(Transformer, _AnalyzerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Text column to array-of-features column."""

    @keyword_only
    def __init__(self, *, inputCol="text", outputCol="grams", analyzer="word", ngramRange=(1, 1),
                 stripAccents=False, stopWords=()):
        super().__init__()
        self._setDefault(inputCol="text", outputCol="grams", analyzer="word", ngramRange=[1, 1],
                         stripAccents=False, stopWords=[])
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOrDefault("outputCol"), self._grams())


class NgramVectorizer(Estimator, _AnalyzerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits a bounded vocabulary; the model turns text into counts or L2-normalised TF-IDF.

    The fitted model looks terms up in a broadcast dictionary inside each row, so
    transforming needs no shuffle, and a text without known terms becomes a zero vector.
    """

    minDF = Param(Params._dummy(), "minDF", "least document frequency: a share below 1, else a number of documents", TypeConverters.toFloat)
    maxDF = Param(Params._dummy(), "maxDF", "largest document frequency: a share up to 1, else a number of documents", TypeConverters.toFloat)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "size of the vocabulary, 0 = all", TypeConverters.toInt)
    weighting = Param(Params._dummy(), "weighting", "count or tfidf", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol="text", outputCol="features", analyzer="word", ngramRange=(1, 1),
                 stripAccents=False, stopWords=(), minDF=1.0, maxDF=1.0, maxFeatures=0, weighting="tfidf"):
        super().__init__()
        self._setDefault(inputCol="text", outputCol="features", analyzer="word", ngramRange=[1, 1],
                         stripAccents=False, stopWords=[], minDF=1.0, maxDF=1.0, maxFeatures=0,
                         weighting="tfidf")
        self._set(**self._input_kwargs)

    def vocabulary(self, dataset: DataFrame) -> DataFrame:
        parts, sizes, kind = self._parts(self.getOrDefault("maxFeatures") > 0)
        return fit_vocabulary(
            dataset,
            parts,
            bound(self.getOrDefault("minDF"), below=1.0),
            bound(self.getOrDefault("maxDF"), below=1.0 + 1e-12),
            self.getOrDefault("maxFeatures") or None,
            sizes=sizes,
            kind=kind,
        )

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        vocab = self.vocabulary(dataset)
        rows = vocab.select("term", "idx", "idf").limit(DRIVER_TERMS + 1).collect()
        if len(rows) > DRIVER_TERMS:
            raise ValueError(
                "the vocabulary is too large for a model object: set maxFeatures, or use "
                "fit_vocabulary with tfidf_long, which join terms without a broadcast"
            )
        return self.model_from(rows)

    def model_from(self, rows) -> PipelineModel:
        """Model from collected ``(term, idx, idf)`` rows."""
        rows = sorted(rows, key=lambda r: r["idx"])
        out = self.getOrDefault("outputCol")
        analyzer = Analyzer(
            inputCol=self.getOrDefault("inputCol"), outputCol=f"{out}_grams",
            analyzer=self.getOrDefault("analyzer"), ngramRange=self.getOrDefault("ngramRange"),
            stripAccents=self.getOrDefault("stripAccents"), stopWords=self.getOrDefault("stopWords"),
        )
        if not rows:
            raise ValueError("empty vocabulary: no term survives the frequency bounds")
        counts_out = out if self.getOrDefault("weighting") == "count" else f"{out}_counts"
        stages = [
            analyzer,
            CountVectorizerModel.from_vocabulary([r["term"] for r in rows], f"{out}_grams", counts_out),
        ]
        if self.getOrDefault("weighting") == "tfidf":
            idf = Vectors.dense([r["idf"] for r in rows])
            stages += [
                ElementwiseProduct(scalingVec=idf, inputCol=counts_out, outputCol=f"{out}_raw"),
                Normalizer(p=2.0, inputCol=f"{out}_raw", outputCol=out),
            ]
        return PipelineModel(stages)


def featurize(model: PipelineModel, df: DataFrame, *keep: str, out: str = "features") -> DataFrame:
    """Apply a vectorizer model and keep only the named columns and the vector."""
    return model.transform(df).select(*keep, out)


def vector_entries(df: DataFrame, *keys: str, vector: str = "features") -> DataFrame:
    """Non-zero cells of vectors as ``(keys..., idx, value)`` rows."""
    return df.select(*keys, F.inline(vector_cells(F.col(vector)))).filter("value <> 0")


def flag_columns(text: Column, patterns: dict[str, str] = FLAG_PATTERNS) -> list[Column]:
    """Indicator patterns as 0/1 doubles."""
    return [
        c.cast("double").alias(name) for c, name in zip(regex_flags(text, patterns), patterns, strict=True)
    ]


def stack_features(df: DataFrame, inputs: list[str], out: str = "features") -> DataFrame:
    """Horizontal stack of vector and numeric columns; sparse inputs stay sparse."""
    return VectorAssembler(inputCols=inputs, outputCol=out).transform(df)


# --- long form: any vocabulary size ---------------------------------------


def lookup_terms(terms: DataFrame, vocab: DataFrame, hot: int = 10_000) -> DataFrame:
    """Join ``(..., term)`` rows to the vocabulary; unknown terms are dropped.

    A vocabulary within the broadcast bound is broadcast.  A larger one is split: the
    ``hot`` most frequent terms, which carry most rows, are broadcast, and only the rest
    is shuffled on the term, where no key is frequent any more.
    """
    if fits_broadcast(vocab):
        return terms.join(F.broadcast(vocab), "term")
    frequent = vocab.orderBy(F.col("df").desc(), "term").limit(hot)
    payload = [c for c in vocab.columns if c != "term"]
    marked = terms.join(F.broadcast(frequent.withColumn("_hot", F.lit(True))), "term", "left")
    common = marked.filter("_hot").drop("_hot")
    rare = marked.filter("_hot IS NULL").drop("_hot", *payload)
    cold = vocab.join(F.broadcast(frequent.select("term")), "term", "left_anti")
    return common.unionByName(rare.join(cold.hint("shuffle_hash"), "term"))


def count_long(corpus: DataFrame, grams: Column, vocab: DataFrame, *keys: str) -> DataFrame:
    """``(keys..., term, idx, tf, ...)``; the sum per document runs map-side first."""
    counted = (
        corpus.select(*keys, F.explode(grams).alias("term"))
        .groupBy(*keys, "term")
        .agg(F.count("*").alias("tf"))
    )
    return lookup_terms(counted, vocab)


def tfidf_long(corpus: DataFrame, grams: Column, vocab: DataFrame) -> DataFrame:
    """``(doc_id, idx, term, value)`` of the L2-normalised TF-IDF cells.

    A document without known terms keeps one row, without index and term and with value 0.
    """
    cells = count_long(corpus, grams, vocab, "doc_id").withColumn("w", F.col("tf") * F.col("idf"))
    of_doc = Window.partitionBy("doc_id")
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(of_doc))
    weighted = cells.select("doc_id", "idx", "term", (F.col("w") / norm).alias("value"))
    return corpus.select("doc_id").join(weighted, "doc_id", "left").fillna({"value": 0.0})


def stack_long(blocks: list[tuple[DataFrame, int]], *keys: str) -> DataFrame:
    """Stack long blocks ``(keys..., idx, value)`` side by side: widths shift the index."""
    out, offset = None, 0
    for block, width in blocks:
        shifted = block.select(*keys, (F.col("idx") + offset).alias("idx"), "value")
        out = shifted if out is None else out.unionByName(shifted)
        offset += width
    return out


def feature_variance(df: DataFrame, column: str, width: int) -> DataFrame:
    """Variance over all cells of a feature matrix, and ``gamma = 1 / (width * variance)``.

    Sums of values and squares per row; cells that a sparse vector does not store are zero.
    """
    kind = df.schema[column].dataType.typeName()
    values = F.col(column) if kind == "array" else F.unwrap_udt(column)["values"]
    per_row = df.select(
        F.aggregate(values, F.lit(0.0), lambda a, x: a + x).alias("s"),
        F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double") * x).alias("q"),
    )
    cells = F.count("*") * F.lit(width)
    mean = F.sum("s") / cells
    return per_row.agg(
        F.count("*").alias("n_rows"),
        (F.sum("q") / cells - mean * mean).alias("variance"),
    ).withColumn("gamma", F.try_divide(F.lit(1.0), F.col("variance") * F.lit(float(width))))


def as_matrix(rows, column: str) -> np.ndarray:
    """Collected, bounded rows of vectors as a dense matrix."""
    return np.array([np.asarray(r[column], dtype=float) for r in rows])
