"""Headline queries, timed end to end; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from lexigrid.plans.queries import REGISTRY
from lexigrid.session import local_session

HEADLINE = (
    "class_balance", "word_ngrams", "char_ngrams", "top_tokens_per_class", "regex_flags", "vocab_fit", "tfidf",
    "tfidf_unbounded", "tfidf_word_char_flags", "feature_space_profile", "stratified_holdout", "stratified_kfold",
    "cnb_predict", "classification_report", "pairwise_diversity", "soft_vote", "param_sweep", "lr_ovr", "rf",
    "gbt_ovr", "w2v_docvec", "holdout_study", "cv_study", "ensemble_end_to_end",
)


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=int(cores))
    spark.sparkContext.setLogLevel("OFF")
    names = sys.argv[1:] or HEADLINE
    REGISTRY["word_ngrams"](spark, base).limit(1).collect()  # start the executor threads
    times = {}
    for name in names:
        started = time.perf_counter()
        REGISTRY[name](spark, base).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
        spark.catalog.clearCache()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(base.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
