"""From documents to token files: the stages of a training-data pipeline, each over all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lexigrid.llm import decontaminate, mixing, quality_model, simhash, token_files
from lexigrid.llm.common import stored, table

#: Cannot be put in SQL: the classifier is fitted, fingerprints are XXH64, ids come from a tokenizer file.
ORACLE_SQL: str | None = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is fitted on the labelled ones."""
    trees = quality_model.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality_model.accepted(docs, trees)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of fingerprints within 4 bits: 4-word shingles, linked by the trie join."""
    return simhash.deduplicated(docs, shingle=4, errors=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the benchmark's contaminated ones."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document taken twice has two rows."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder, described per document."""
    return token_files.token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
    ("token-ID output", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
