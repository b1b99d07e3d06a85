"""op5_line_rules against its SQL twin on a table where lines above both limits decide documents."""

import random
import re

import duckdb
from pyspark.sql import Row
from pyspark.sql import functions as F

from lexigrid.llm import line_rules, queries


def test_line_rule_equals_sql_where_it_decides(spark, tmp_path):
    rng = random.Random(4)
    prose = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    share = "Share  this page 12 with all of your friends"
    rows = [(i, f"{share}\n{prose(30)}", "a") for i in range(101)] + [(200 + i, f"{share}\n{prose(5)}", "a") for i in range(20)]
    rows += [(300 + i, f"{share}\n{share}\n{prose(40)}", "a") for i in range(20)]
    rows += [(400 + i, f"{share}\n{prose(5)}", "b") for i in range(100)]  # the same share of a smaller host
    rows += [(600 + i, f"{share}\n{prose(5)}", "d") for i in range(3)]  # 3 documents are not above the floor
    rows += [(1000 + i, f"{share}\n{prose(5)}" if i < 110 else prose(12), "c") for i in range(2300)]  # under 5% of the host
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(queries.statements()["op5_line_rules"]).df()
    got = queries.op5_line_rules(spark, str(tmp_path)).toPandas()[list(want.columns)]
    a, b = (sorted(map(tuple, x.values.tolist())) for x in (got, want))
    assert a == b
    assert {r.doc_id for r in got.itertuples() if not r.base_failed and not r.kept} == {*range(200, 220), *range(400, 500)}


def test_texts_without_frequent_lines(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    rows = [(i, f"{prose(12)}\nShare  it 12\n\n{prose(3)}\nSHARE it 7", "a", "x") for i in range(30)] + [(40, "share it 1", "a", "x"), (41, None, "a", "x"), (42, "Share it 5", "b", "x"), (1, "own", "a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, line string").withColumns({c: F.lit(1) for c in ("host", "text_hash", "_gone")}).repartition(3)
    got = line_rules.without_frequent_lines(docs)
    assert got.columns == docs.columns
    plain = lambda x: re.sub(r"\s+", " ", re.sub("[0-9]+", "0", x.lower())).strip()
    want = [(i, None if t is None else t if s == "b" else "\n".join(x for x in t.split("\n") if plain(x) != "share it 0"), s) for i, t, s, _ in rows]
    assert sorted(map(str, got.select("doc_id", "text", "source").collect())) == sorted(str(Row(doc_id=i, text=t, source=s)) for i, t, s in want)
    words = {(r.doc_id, r.n_words): r.n_boilerplate for r in line_rules.judged(docs).collect()}
    for (i, before, _, _), (_, after, _) in zip(rows, want):
        n = len((before or "").split())
        assert words[i, n] == n - len((after or "").split())
