"""URL filter: rules first, then logistic regression on hashed n-grams.

A rule (host, path) fits its host and all subdomains where the URL's path
starts with the rule's; of several, the longest text wins.  URLs that no rule
fits are judged by a logistic regression over character n-grams of host and
path, hashed into ``FEATURES`` places by Spark ML's ``HashingTF`` and fitted by
its ``LogisticRegression`` on a small labelled URL table.  Everything is built
of DataFrame functions and JVM stages.

``labelled_by_rules`` makes such a table from the URLs a rule decides: distinct
(host, path) pairs, at most about ``rows`` of each verdict, chosen by hash.  The
model is one vector of ``FEATURES`` weights whatever the number of URLs.

Edge cases: a null URL or one without ``://`` has empty host and path, fits no
rule with a host and gets the model's verdict for no n-grams; without labelled
rows of both verdicts the verdict is that of the only one there is, or
``allow``; repeated rows get equal results; very long URLs count whole; of equally
long rules the first in order of text wins; extra columns, whatever their names, are
kept by ``judge`` (those named like an output are replaced).
"""
from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, by_place, replacing

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
FEATURES = 1 << 14
SIZES = (3, 4)
TRAIN_ROWS = 5000
OUT = ["host", "path", "rule", "verdict"]
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, _URL, 1), UPPER, UPPER.lower()), F.regexp_extract(url, _URL, 2)


def ruling(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null.  Rules are
    a short stated list; of equally long ones the first in order of text wins."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    return F.coalesce(*[
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
               F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for v, h, p in ordered]) if ordered else F.lit(None).cast("struct<rule:string,verdict:string>")


def grams(text: Column, tag: str, sizes=SIZES) -> Column:
    """Marked n-grams of a short text with its ends shown."""
    s = F.concat(F.lit("^"), text, F.lit("$"))
    return F.concat(*[F.when(F.length(s) >= k, F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(s) - k + 1, F.lit(1))),
        lambda i, k=k: F.concat(F.lit(tag), F.substring(s, i, F.lit(k))))).otherwise(F.array().cast("array<string>")) for k in sizes])


def features(df: DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    words = df.withColumn("_grams", F.concat(grams(F.col(host), "h "), grams(F.col(path), "p ")))
    return HashingTF(inputCol="_grams", outputCol="_features", numFeatures=FEATURES, binary=True).transform(words).drop("_grams")


def labelled_by_rules(urls: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(host, path, block 0/1): a bounded labelled table from ruled URLs
    (columns host, path, verdict)."""
    known = urls.filter("verdict IS NOT NULL").select("host", "path", "verdict")
    h = F.xxhash64("host", "path")
    sizes = {r.verdict: r.n for r in known.groupBy("verdict").agg(F.approx_count_distinct(h, 0.02).alias("n")).collect()}
    share = F.lit(0.0)
    for v, n in sizes.items():  # block and allow
        share = F.when(F.col("verdict") == v, F.lit(min(1.0, rows / max(n, 1)))).otherwise(share)
    return (known.filter(F.pmod(h, F.lit(1 << 30)) < share * (1 << 30)).dropDuplicates()
            .select("host", "path", (F.col("verdict") == "block").cast("double").alias("block")))


def train(labelled: DataFrame):
    """Model from (host, path, block), or the only verdict there is."""
    rows = features(labelled).persist()
    try:
        seen = {r.block for r in rows.select("block").distinct().collect()}
        if len(seen) < 2:
            return "block" if seen == {1.0} else "allow"
        return LogisticRegression(featuresCol="_features", labelCol="block", predictionCol="_block", probabilityCol="_p",
                                  rawPredictionCol="_raw", regParam=1e-3, maxIter=40).fit(rows)
    finally:
        rows.unpersist()


def judge(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None, url_col: str = "url") -> DataFrame:
    """``pages`` plus host, path, rule, verdict.  ``labelled``: (host, path,
    block); by default made from the pages that rules decide."""
    rest = replacing(pages, OUT).columns
    own, at = by_place(pages)
    base = own.withColumns(dict(zip(("host", "path"), host_and_path(F.col(at[url_col])))))
    ruled = base.withColumn("_r", ruling(F.col("host"), F.col("path"), rules)).withColumns(
        {"rule": F.col("_r.rule"), "verdict": F.col("_r.verdict")})
    model = train(labelled_by_rules(ruled) if labelled is None else labelled)
    if isinstance(model, str):
        other = F.lit(model)
    else:
        ruled = model.transform(features(ruled))
        other = F.when(F.col("_block") == 1.0, "block").otherwise("allow")
    return ruled.withColumn("verdict", F.coalesce("verdict", other)).select(*[F.col(at[c]).alias(c) for c in rest], *OUT)
