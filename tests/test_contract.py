"""Registered queries against their SQL twins in an independent engine."""

import os

import pytest

import __spark_entry__ as contract
from lexigrid.plans import oracle

# the smaller set runs by default; LEXIGRID_ALL_QUERIES=1 compares every query
DEFAULT = (
    "corpus_select", "class_balance", "word_ngrams", "char_ngrams", "char_wb_ngrams", "regex_flags", "tfidf",
    "tfidf_word_char_flags", "stratified_holdout", "stratified_kfold", "split_fingerprint", "cnb_fit", "cnb_predict",
    "classification_report", "pairwise_diversity", "soft_vote", "param_sweep", "doc_mean_vector",
    "select_improve", "cv_study", "vocab_shares", "delimited_round_trip", "vector_export_round_trip", "first_rows", "tfidf_unbounded",
)
NAMES = list(oracle.statements()) if os.environ.get("LEXIGRID_ALL_QUERIES") else DEFAULT


@pytest.fixture(scope="module")
def duck(small):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, small, duck, name):
    got = contract.queries()[name](spark, small).toPandas()
    want = duck.execute(contract.oracle_sql()[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    a = got[cols].sort_values(cols).reset_index(drop=True)
    b = want[cols].sort_values(cols).reset_index(drop=True)
    assert len(a) == len(b)
    for c in cols:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        assert same.all(), c


def test_every_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
