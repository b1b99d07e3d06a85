"""The operators' queries against their SQL twins, and the pipeline against its stages' contracts."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexigrid.llm import queries, simhash
from lexigrid.llm.common import table


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_equals_sql(spark, small, duck, name):
    got = queries.REGISTRY[name](spark, small).toPandas()
    want = duck.execute(queries.statements()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    a, b = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert len(a) == len(b) == table(spark, small, "embeddings" if name == "op12_vector_join" else "documents").count()
    for c in columns:
        a[c], b[c] = (x[c].astype(object).where(x[c].notna(), None) for x in (a, b))
        same = [x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-12)) for x, y in zip(a[c], b[c])]
        assert all(same), (c, a[~a.index.isin([i for i, s in enumerate(same) if s])].head())


@pytest.mark.parametrize(
    ("name", "columns", "source"),
    [
        ("op1_url_filter", {"page_id", "host", "path", "rule", "verdict"}, "pages"),
        ("op2_simhash", {"doc_id", "fingerprint", "component_id"}, "documents"),
        ("op4_quality", {"doc_id", "held_out", "score", "predicted"}, "documents"),
        ("op6_html_text", {"page_id", "url", "text", "n_chars"}, "pages"),
        ("op10_token_files", {"doc_id", "start", "n_tokens", "ids_crc32"}, "documents"),
        ("op11_alignment", {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}, "documents"),
    ],
)
def test_query_has_a_row_for_each_of_its_table(spark, small, name, columns, source):
    frame = queries.REGISTRY[name](spark, small)
    assert set(frame.columns) == columns
    assert frame.count() == table(spark, small, source).count()


def test_quality_of_held_out_labels(spark, small):
    labels = table(spark, "/root/testdata/sf0.01", "labels").select("doc_id", "quality")
    rows = queries.op4_quality(spark, "/root/testdata/sf0.01").filter("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95


def test_stages_take_effect(spark, small):
    docs = table(spark, small, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, small).persist()
        assert after.columns == docs.columns and after.count() > 0, name
        if name == "mixing sources to target weights":
            assert after.select("doc_id").distinct().join(docs, "doc_id", "left_anti").isEmpty()
        else:
            assert after.select("doc_id").exceptAll(docs.select("doc_id")).isEmpty() and after.count() < docs.count(), name
        if name == "SimHash near-dedup":
            assert simhash.simhash_groups(after).filter("doc_id != component_id").isEmpty()
        docs = after
    out = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert out.count() == docs.count() and out.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0] == out.agg(F.sum("n_tokens")).first()[0]
