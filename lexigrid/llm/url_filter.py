"""URL filters: host and path rules, and a logistic regression on hashed character n-grams for the rest.

The host is what follows the first `://` up to `/`, `?`, `#` or the end, with A to Z in lower case; the path follows it up to
`?`, `#` or the end. A rule is `host/path`; it fits its host and all subdomains if the URL's path starts with the rule's path,
and the longest fitting rule decides (of equally long ones, the last in code-point order). Other URLs are judged by the model.

The model is trained from a small labelled URL table (url, blocked), bounded by its caller; scoring is a sparse dot product in
the JVM. `labelled_urls` makes such a table: stems of unwanted and of ordinary sites in common URL shapes, and a bounded sample
of the given URLs, blocked if a word of the host's name is one of the unwanted stems.

Defined cases: a null URL, or one without `://`, has an empty host and path, which no rule fits unless its own host is empty;
the model judges it by the n-grams of the empty strings. URLs may be of any length. Repeated rows each keep a row; an empty
table gives no rows; a training table with one class only gives that class as the model's verdict. Other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sizes of n-grams and the hashed feature space.
SIZES, FEATURES = (3, 4, 5), 1 << 15
#: URLs of the given table that the labelled table takes at most, about.
SAMPLE = 2000

UNWANTED = "adult xxx porn sex casino poker slots betting bets gambling pills pharmacy viagra cialis replica spam farm ads track tracker tracking banner click popup warez cracks torrent phishing scam malware loans payday cheap win prize lottery".split()
ORDINARY = "news library museum university school garden kitchen weather travel history science music books sports health bank city water forest river shop recipes forum wiki docs code maps letters theatre archive journal".split()


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    raw_host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    host = F.translate(raw_host, string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(F.substr(rest, F.length(raw_host) + 1), r"^[^?#]*", 0)
    return host, path


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """(length, rule, verdict) of the longest rule that fits, else null."""
    fits = []
    for verdict, rule in rules:
        rule_host, slash, rest = rule.partition("/")
        on_host = (host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))
        fits.append(F.when(on_host & F.startswith(path, F.lit(slash + rest)), F.struct(F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<length:int,rule:string,verdict:string>")


def _grams(field: str) -> str:
    """Character n-grams of a column between marks for its ends, named after the field."""
    s = f"concat('^', {field}, '$')"
    return f"""flatten(transform(array({', '.join(map(str, SIZES))}), n -> CASE WHEN length({s}) < n THEN array()
        ELSE transform(sequence(1, length({s}) - n + 1), i -> concat('{field}:', substring({s}, i, n))) END))"""


def with_grams(urls: DataFrame) -> DataFrame:
    """Needs the columns host and path."""
    return urls.withColumn("grams", F.expr(f"array_distinct(concat({_grams('host')}, {_grams('path')}))"))


def labelled_urls(urls: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(url, blocked): shapes of stems, and a sample of at most about `sample` distinct given URLs by hash; null is none."""
    shapes = ["http://{a}.example.com/", "https://www.{a}-{b}.example.org/en/1", "http://m.{a}.example.net/{b}.html", "https://{a}{b}.example.com/{b}/2"]
    made = [(shape.format(a=a, b=stems[(i + 1 + k) % len(stems)]), int(stems is UNWANTED)) for stems in (UNWANTED, ORDINARY) for i, a in enumerate(stems) for k, shape in enumerate(shapes)]
    urls = urls.select("url").filter("url is not null")
    n = urls.agg(F.approx_count_distinct("url")).first()[0]  # a value's rows are taken together, so values are counted
    some = urls.filter(F.pmod(F.xxhash64("url"), F.lit(1 << 20)) < max(1, int((1 << 20) * min(1.0, sample / max(n, 1))))).distinct()
    host, _ = parts(F.col("url"))
    bad = F.exists(F.split(host, "[.-]"), lambda w: w.isin(UNWANTED))
    return some.select("url", bad.cast("int").alias("blocked")).unionByName(urls.sparkSession.createDataFrame(made, "url string, blocked int"))


def fit_urls(labelled: DataFrame) -> PipelineModel:
    """The model of a small labelled table (url, blocked)."""
    host, path = parts(F.col("url"))
    rows = with_grams(labelled.select(host.alias("host"), path.alias("path"), F.col("blocked").cast("double").alias("label")).filter("label is not null"))
    rows = rows.coalesce(2).persist()
    try:
        hashing = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
        return Pipeline(stages=[hashing, LogisticRegression(maxIter=40, regParam=0.002)]).fit(rows)
    finally:
        rows.unpersist()


def judged_urls(pages: DataFrame, rules: list[tuple[str, str]], model: PipelineModel) -> DataFrame:
    """page_id, url, host, path, rule (null if none fits) and verdict of every row."""
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    scored = model.transform(with_grams(rows))
    found = scored.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("prediction") > 0.5, "block").otherwise("allow")
    return found.select("page_id", "url", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", own).alias("verdict"))
