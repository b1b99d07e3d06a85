"""Repeated rows, hot labels and pages that are made to be slow."""

import time

import pytest
from pyspark.sql import functions as F

from lexigrid.llm import html_extract, quality_model, rlz_dedup, suffix_dedup


@pytest.fixture(scope="module")
def copies(spark):
    text = " ".join(f"w{i % 350}" for i in range(400))
    rows = [(7, text)] * 2000 + [(3, text + " more"), (9, text)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_repeated_rows_list_each_run_once(copies):
    for module in (rlz_dedup, suffix_dedup):
        sizes = [r.n for r in module.listed_runs(copies).select(F.size("runs").alias("n")).collect()]
        assert len(sizes) in (2, 3) and max(sizes) <= 2200, module  # no more runs than places, however many rows
    assert {r.n_removed for r in rlz_dedup.deduplicated(copies).filter("doc_id in (7, 9)").collect()} == {400}
    found = suffix_dedup.deduplicated(copies).filter("doc_id = 7").collect()
    assert len(found) == 2000 and all(r.n_removed == r.n_bytes for r in found)


def test_labelled_rows_are_bounded(spark):
    docs = spark.createDataFrame([(1, f"text {i % 300}") for i in range(500)] + [(2, "other")] * 500 + [(i, f"doc {i}") for i in range(10, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] * 500 + [(2, 0)] * 499 + [(2, 1)] + [(i, i % 2) for i in range(10, 40)] + [(None, 1), (5, None)], "doc_id long, quality int")
    for limit in (10, 25, 1000):
        rows = quality_model.training_rows(docs, labels, limit).select("id", "text_hash", "good").distinct().collect()
        assert 0 < len(rows) <= limit
    # all of them, without the copies: 300 texts of one id, one of another, and 30 more
    assert len(rows) == 331 and {r.good for r in rows if r.id == 2} == {0.0}
    trees = quality_model.fit_quality(docs, labels, 25)
    assert quality_model.quality_scores(docs, trees).count() == docs.count()


@pytest.mark.parametrize(
    "page",
    [
        "<x 'a " * 100_000 + "\"" + " <p>end</p>",
        "<x " * 200_000 + "\"",
        "<div>" * 3000 + "</p>" * 200_000,
        "<i>" * 3000 + "</b>" * 200_000,
        "<div>" * 3000 + "<li>x" * 50_000,
        "<" * 1_000_000,
        "<!--" * 200_000,
        "<a href=\"" * 100_000,
    ],
)
def test_odd_pages_take_no_longer_than_their_length(page):
    began = time.process_time()
    html_extract.main_text(page)
    assert time.process_time() - began < 8


def test_a_lone_quote_does_not_hide_text():
    prose = "Some words of an article that go on for a while, so that they are dense. " * 5
    assert html_extract.main_text(f"<body><p title=\"it>{prose}</p><p class='x'>{prose}</p></body>").count("Some words") >= 5
