"""Corpus profile: class balance, frequent tokens, label space, class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.session import broadcast_if_small


def class_counts(corpus: DataFrame, label: str = "label") -> DataFrame:
    return corpus.groupBy(label).agg(F.count("*").alias("n"))


def class_balance(corpus: DataFrame, label: str = "label") -> DataFrame:
    """``(label, count, percent)``; the window runs over one row per class."""
    counts = corpus.groupBy(label).agg(F.count("*").alias("count"))
    whole = F.sum("count").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("percent", F.round(100.0 * F.col("count") / whole, 2)).orderBy(
        F.col("count").desc(), label
    )


def top_tokens(corpus: DataFrame, tokens: Column, k: int = 30, label: str = "label") -> DataFrame:
    """Most frequent tokens per class, ties by token.

    The rank filter reaches the partial group limit before the shuffle, so a class with most
    of the vocabulary sends at most ``k`` rows per partition.
    """
    counted = (
        corpus.select(label, F.explode(tokens).alias("token"))
        .groupBy(label, "token")
        .agg(F.count("*").alias("n"))
    )
    by_count = Window.partitionBy(label).orderBy(F.col("n").desc(), "token")
    return counted.withColumn("rank", F.row_number().over(by_count)).filter(F.col("rank") <= k)


def label_space(*frames: DataFrame, label: str = "label") -> DataFrame:
    """``(label, idx)``: distinct labels of all frames, indexed in sorted order."""
    union = None
    for f in frames:
        part = f.select(F.col(label).alias("label")).distinct()
        union = part if union is None else union.unionByName(part)
    labels = union.filter("label IS NOT NULL").distinct()
    return labels.withColumn("idx", F.row_number().over(Window.orderBy("label")) - 1)


def same_label_space(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def class_weights(corpus: DataFrame, label: str = "label") -> DataFrame:
    """``(label, n, inverse, balanced)``.

    ``inverse`` is 1/count scaled to mean 1 over the classes; ``balanced`` is n/(k*count).
    """
    counts = class_counts(corpus, label)
    everything = Window.partitionBy(F.lit(1))
    return counts.select(
        label,
        "n",
        ((F.lit(1.0) / F.col("n")) / F.avg(F.lit(1.0) / F.col("n")).over(everything)).alias("inverse"),
        (F.sum("n").over(everything) / (F.count("*").over(everything) * F.col("n"))).alias("balanced"),
    )


def with_class_weight(df: DataFrame, label: str = "label", kind: str = "balanced", out: str = "weight") -> DataFrame:
    """Attach the class weight to each row; the weight table has one row per class."""
    weights = class_weights(df, label).select(label, F.col(kind).alias(out))
    return df.join(broadcast_if_small(weights), label)


def split_sizes(split: DataFrame, label: str = "label") -> DataFrame:
    return split.agg(
        F.count_if(F.col("part") == "train").alias("n_train"),
        F.count_if(F.col("part") == "test").alias("n_test"),
        F.count("*").alias("support_total"),
        F.countDistinct(label).alias("n_classes"),
    )
