"""Registered queries of the operators, with the columns that their contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm import decontaminate, html_extract, line_rules, mixing, periodic_runs, quality_model, rlz_dedup, simhash, sql
from lexigrid.llm import suffix_dedup, token_alignment, token_files, url_filter, vector_join
from lexigrid.llm.common import table, words

#: Token id that ends a document, and the tokenizer file.
END_ID, TOKENIZER = 2, "byte_bpe_50k.json"
#: The other tokenizer of the alignment.
PIECES = "piece_bpe_32k.model"


#: Verdict and rule (host/path) of the URL filter.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    model = url_filter.fit_urls(url_filter.labelled_urls(pages.select("url")))
    return url_filter.judged_urls(pages, URL_RULES, model).drop("url")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz_dedup.deduplicated(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))  # a row without an id is not held out
    trees = quality_model.fit_quality(docs, labels.filter(~held))
    scored = quality_model.quality_scores(docs, trees)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judged(table(spark, sf_dir, "documents")).drop("host")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(table(spark, sf_dir, "pages"))


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.expr("cast(size(spans) div 2 as long)").alias("n_spans"), "kept_sha256")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.takes(table(spark, sf_dir, "documents")).drop("source")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, files = table(spark, sf_dir, "documents"), [public_tokenizers.path(name) for name in (TOKENIZER, PIECES)]
    found = token_alignment.alignments(docs, *files, token_alignment.pair_counts(docs, *files))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


def op12_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.vector_groups(table(spark, sf_dir, "embeddings"), cosine=0.93)


def _with_planted_periods(docs: DataFrame) -> DataFrame:
    """The contract's texts: in one of ten documents, by a hash of doc_id, the words from `a` on repeat the first `p` of them."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split, n = words(F.col("text")), F.size(words(F.col("text")))
    planted = docs.select("doc_id", "text", hashed.alias("h"), F.when(hashed % 10 == 0, split).alias("w"), F.when(hashed % 10 == 0, n).alias("n"))
    at = F.when(F.col("n") > 0, (F.floor(F.col("h") / 10) % F.col("n")).cast("int"))
    planted = planted.withColumn("a", at).withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.floor(F.col("h") / 10) % 8))).cast("int"))
    repeated = F.expr("slice(concat(slice(w, 1, a), flatten(array_repeat(slice(w, a + 1, p), cast((n - a) div p as int) + 1))), 1, n)")
    return planted.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_with_planted_periods(table(spark, sf_dir, "documents")), min_words=24, times=3)
    best = F.get("runs", F.col("strongest"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * runs[strongest].length div runs[strongest].period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filter, op2_simhash, op3_substrings, op4_quality, op5_line_rules, op6_html_text, op7_suffix_array, op8_decontaminate, op9_mixing, op10_token_files, op11_alignment, op12_vector_join, op13_periodic_runs, pipeline)
}


def statements() -> dict[str, str]:
    return dict(sql.STATEMENTS)
