"""Exact, reproducible holdouts and folds, without sorting a class in one task.

Rows are ordered by the MD5 of seed and id.  The leading hex digits give buckets of nearly
equal size; counts per (class, bucket) are small and tell where every quota ends, so only
rows inside a bucket ever have to be ranked.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.session import broadcast_if_small, keep

# Rows of a bucket that one task ranks, about; the number of buckets follows from it.
BUCKET_ROWS = 50_000
LABELS_ON_DRIVER = 100_000


def order_key(row_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit(""))))


def hex_digits(n_rows: int) -> int:
    """Leading digits of the key that make a bucket: enough for buckets of BUCKET_ROWS, 7 at most."""
    return min(7, max(1, math.ceil(math.log(max(n_rows / BUCKET_ROWS, 1), 16))))


def _bucket(key: Column, digits: int) -> Column:
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("int")


def class_quotas(counts: dict, test_size: float) -> dict:
    """Test rows per class: proportional, by largest remainder, summing to ceil(n * f)."""
    n = sum(counts.values())
    total = math.ceil(n * test_size)
    quota = {c: m * total // n for c, m in counts.items()}
    rest = {c: m * total % n for c, m in counts.items()}
    missing = total - sum(quota.values())
    for c in sorted(counts, key=lambda c: (-rest[c], c))[:missing]:
        quota[c] += 1
    return quota


def holdout(
    df: DataFrame, test_size: float, seed: int = 42, stratify: str | None = "label", row_id: str = "doc_id"
) -> DataFrame:
    """Add ``part`` = ``train`` or ``test`` with exact sizes.

    One pass counts rows per (class, bucket), a second ranks the single bucket per class in
    which the quota ends; after that the split is a comparison with the class's last test
    key, so the corpus itself is never shuffled.
    """
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must lie between 0 and 1")
    spark = df.sparkSession
    group = F.coalesce(F.col(stratify).cast("string"), F.lit("\0")) if stratify else F.lit("")
    keyed = df.select(group.alias("_g"), order_key(F.col(row_id), seed).alias("_k"), F.col(row_id).alias("_id"))
    keyed = keyed.withColumn("_b", _bucket(F.col("_k"), hex_digits(df.count())))
    hist = keep(keyed.groupBy("_g", "_b").agg(F.count("*").alias("_n")))

    totals = hist.groupBy("_g").agg(F.sum("_n").alias("n")).limit(LABELS_ON_DRIVER + 1).collect()
    if len(totals) > LABELS_ON_DRIVER:
        raise ValueError("too many classes for a stratified split")
    quotas = class_quotas({r["_g"]: r["n"] for r in totals}, test_size)
    quota_df = spark.createDataFrame(list(quotas.items()), "_g string, _q long")

    before = F.sum("_n").over(Window.partitionBy("_g").orderBy("_b")) - F.col("_n")
    edge = (
        hist.withColumn("_before", before)
        .join(F.broadcast(quota_df), "_g")
        .filter((F.col("_before") < F.col("_q")) & (F.col("_before") + F.col("_n") >= F.col("_q")))
        .select("_g", "_b", (F.col("_q") - F.col("_before")).alias("_need"))
    )
    ranked = keyed.join(F.broadcast(edge), ["_g", "_b"]).withColumn(
        "_r", F.row_number().over(Window.partitionBy("_g").orderBy("_k", "_id"))
    )
    last = ranked.filter("_r = _need").select("_g", F.col("_k").alias("_lk"), F.col("_id").alias("_li"))
    cuts = spark.createDataFrame(last.collect(), last.schema)  # one row per class
    hist.unpersist()

    tagged = df.withColumn("_g", group).withColumn("_k", order_key(F.col(row_id), seed))
    in_test = (F.col("_k") < F.col("_lk")) | ((F.col("_k") == F.col("_lk")) & (F.col(row_id) <= F.col("_li")))
    return (
        tagged.join(F.broadcast(cuts), "_g", "left")
        .withColumn("part", F.when(in_test, F.lit("test")).otherwise(F.lit("train")))
        .drop("_g", "_k", "_lk", "_li")
    )


def _id_bucket(df: DataFrame, row_id: str, buckets: int) -> DataFrame:
    """Bucket ids by approximate quantiles; only the order of the buckets matters."""
    low = -float("inf")  # rows without an id come first
    as_double = df.withColumn("_d", F.coalesce(F.col(row_id).cast("double"), F.lit(low)))
    probs = [i / buckets for i in range(1, buckets)]
    inner = sorted(set(as_double.approxQuantile("_d", probs, 0.25 / buckets)) - {low})
    splits = [low, *inner, float("inf")]
    placed = Bucketizer(splits=splits, inputCol="_d", outputCol="_b").transform(as_double)
    return placed.withColumn("_b", F.col("_b").cast("int")).drop("_d")


def kfold(df: DataFrame, k: int, seed: int | None = 42, label: str = "label", row_id: str = "doc_id") -> DataFrame:
    """Add ``fold`` in 0..k-1; class and total sizes differ by at most one row per fold.

    ``seed=None`` keeps the order of the ids.  Only ids and labels are ranked, inside (class,
    bucket), and the sizes of the buckets before are added, so no task holds a whole class and
    no text takes part in the ranking; the folds are then joined to the rows. Rows of equal id
    and label share a fold, and so do rows of a label that have no id.
    """
    if k < 2:
        raise ValueError("k-fold cross-validation needs at least 2 folds")
    keyed = df.select(F.col(row_id).alias("_id"), F.coalesce(F.col(label).cast("string"), F.lit("\0")).alias("_g")).distinct()
    n_rows = df.count()
    if seed is None:
        placed = _id_bucket(keyed, "_id", max(4, n_rows // BUCKET_ROWS)).withColumn("_k", F.col("_id"))
    else:
        placed = keyed.withColumn("_k", order_key(F.col("_id"), seed))
        placed = placed.withColumn("_b", _bucket(F.col("_k"), hex_digits(n_rows)))

    hist = placed.groupBy("_g", "_b").agg(F.count("*").alias("_n"))
    in_class = F.sum("_n").over(Window.partitionBy("_g").orderBy("_b")) - F.col("_n")
    classes = hist.groupBy("_g").agg(F.sum("_n").alias("_m"))
    class_start = classes.select("_g", (F.sum("_m").over(Window.orderBy("_g")) - F.col("_m")).alias("_cs"))
    starts = (
        hist.select("_g", "_b", in_class.alias("_bs"))
        .join(broadcast_if_small(class_start), "_g")
        .select("_g", "_b", (F.col("_bs") + F.col("_cs")).alias("_start"))
    )
    rank = F.row_number().over(Window.partitionBy("_g", "_b").orderBy("_k", "_id")) - 1
    folds = placed.withColumn("_r", rank).join(broadcast_if_small(starts), ["_g", "_b"]).select(
        "_id", "_g", ((F.col("_start") + F.col("_r")) % k).cast("int").alias("fold")
    )
    own = F.coalesce(F.col(label).cast("string"), F.lit("\0"))
    return df.join(folds, F.col(row_id).eqNullSafe(F.col("_id")) & (own == F.col("_g"))).select(*[df[c] for c in df.columns], "fold")


def first_rows(df: DataFrame, n: int, row_id: str = "doc_id") -> DataFrame:
    """The first ``n`` rows by id (a preview, or the quick study's subsample)."""
    return df.orderBy(row_id).limit(n)


def split_fingerprint(split: DataFrame, row_id: str = "doc_id") -> DataFrame:
    """``(n_train, n_test, split_id)``: a hash of who is in which part, whatever the order."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.col(row_id).cast("string"), F.col("part"))), 1, 8), 16, 10)
    return (
        split.agg(
            F.count_if(F.col("part") == "train").alias("n_train"),
            F.count_if(F.col("part") == "test").alias("n_test"),
            F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)")).alias("h"),
        )
        .select(
            "n_train",
            "n_test",
            F.substring(
                F.md5(F.concat_ws("|", F.col("h").cast("string"), F.col("n_train").cast("string"),
                                  F.col("n_test").cast("string"))), 1, 16,
            ).alias("split_id"),
        )
    )
