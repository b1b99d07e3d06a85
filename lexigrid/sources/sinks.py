"""Writers: result tables, matrices, predictions, JSON documents, vectors."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# params are read as JSON text: their keys differ from model to model
SELECTION_DDL = (
    "selected_models array<struct<name:string,"
    "vectorizer:struct<class:string,params:string>,classifier:struct<type:string,params:string>,"
    "metrics:struct<accuracy:double,macro_f1:double,holdout_macro_f1:double,cv_macro_f1_mean:double>,"
    "weight:double>>"
)


def flat_for_csv(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, scalar columns unchanged."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(
        *[
            F.to_json(f.name, {"ignoreNullFields": "false"}).alias(f.name)
            if isinstance(f.dataType, nested)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def write_results(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Result table: ``path/parquet`` to read back, ``path/csv`` as the export."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/parquet")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/parquet")
    flat_for_csv(stored).write.mode("overwrite").csv(
        f"{path}/csv", header=True, escape='"', lineSep="\n"
    )


def correlation_matrix(pairs: DataFrame, models: list[str] | None = None) -> DataFrame:
    """Square table from long ``(a, b, corr)`` rows; the columns are the models."""
    return pairs.groupBy("a").pivot("b", models).agg(F.first("corr"))


def write_predictions(votes: DataFrame, corpus: DataFrame, path: str) -> None:
    """``(doc_id, text, true_label, pred_ensemble)`` of the scored documents."""
    out = votes.join(corpus.select("doc_id", "text"), "doc_id").select(
        "doc_id",
        "text",
        F.col("y_true").alias("true_label"),
        F.col("y_pred").alias("pred_ensemble"),
    )
    out.write.mode("overwrite").option("escape", '"').csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row; missing values are kept as null, variants become objects."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).write.mode("overwrite").text(path)


def selection_document(selection: DataFrame) -> DataFrame:
    """One row ``{"selected_models": [...]}`` in rank order.

    ``selection`` has rank, name, vectorizer, classifier (structs with params as JSON text),
    metrics and weight; it holds at most ``max_models`` rows. Params become objects.
    """
    models = F.sort_array(
        F.collect_list(F.struct("rank", "name", "vectorizer", "classifier", "metrics", "weight"))
    )
    return selection.agg(
        F.transform(
            models,
            lambda m: F.struct(
                m["name"].alias("name"),
                F.struct(m["vectorizer"]["class"].alias("class"), F.parse_json(m["vectorizer"]["params"]).alias("params")).alias("vectorizer"),
                F.struct(m["classifier"]["type"].alias("type"), F.parse_json(m["classifier"]["params"]).alias("params")).alias("classifier"),
                m["metrics"].alias("metrics"),
                m["weight"].alias("weight"),
            ),
        ).alias("selected_models")
    )


def read_selection(spark: SparkSession, path: str) -> DataFrame:
    """One row per selected model; a missing weight is 1.  Params stay JSON text."""
    doc = spark.read.schema(SELECTION_DDL).json(path, multiLine=True)
    return doc.select(F.posexplode("selected_models").alias("pos", "m")).select(
        (F.col("pos") + 1).alias("rank"),
        F.coalesce("m.name", F.lit("model")).alias("name"),
        F.col("m.vectorizer.class").alias("vec_class"),
        F.coalesce("m.vectorizer.params", F.lit("{}")).alias("vec_params"),
        F.col("m.classifier.type").alias("clf_type"),
        F.coalesce("m.classifier.params", F.lit("{}")).alias("clf_params"),
        F.coalesce("m.weight", F.lit(1.0)).alias("weight"),
    )


def export_vectors(features: DataFrame, path: str, column: str = "features") -> None:
    """Dense document vectors with id and label, as Parquet arrays."""
    features.select("doc_id", vector_to_array(column).alias("vector"), "label").write.mode(
        "overwrite"
    ).parquet(path)
