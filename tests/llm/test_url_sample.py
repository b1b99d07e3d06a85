"""The URL filter's labelled sample holds distinct URLs: neither nulls nor one hot URL enlarge it."""

import pytest
from pyspark.sql import functions as F

from lexigrid.llm import url_filter


@pytest.mark.parametrize("hot", [None, "https://hot.example.com/en/22"])
def test_sample_is_bounded_where_one_value_holds_a_third(spark, hot):
    urls = spark.range(20_000).select(F.concat(F.lit("https://site.example.com/en/"), "id").alias("url"))
    many = urls.unionByName(spark.range(10_000).select(F.lit(hot).cast("string").alias("url")))
    # the hot URL's hash is one that falls in
    assert hot is None or spark.range(1).select(F.pmod(F.xxhash64(F.lit(hot)), F.lit(1 << 20))).first()[0] < (1 << 20) * 2000 // 30_000
    made = url_filter.labelled_urls(urls.limit(0)).count()
    rows = [r.url for r in url_filter.labelled_urls(many).collect()]
    assert None not in rows and len(rows) == len(set(rows)) and 1500 < len(rows) - made < 2500
