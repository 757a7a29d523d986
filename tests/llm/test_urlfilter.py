from __future__ import annotations

import re

import pytest

from pregame.llm import urlfilter as U


def by_hand(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


ODD = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.NET/en/x?y#z"), (5, "http://example.net"), (6, "ftp://x://y/z"),
       (7, "http://org/fr/"), (8, "HTTP://notorg/fr/"), (9, "http://a.ORG/fr/é"), (9, "http://a.ORG/fr/é"), (None, "http://x.net/en/"),
       (10, "http://Éa.net/"), (11, "http://h?q=/a"), (12, "://"), (13, "http://x\ny.net/a\nb")]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in ODD], "page_id long, url string, host string, VERDICT string")
    out = U.judge(pages)
    rows = {(r.page_id, r.url): r for r in out.collect()}
    assert out.count() == len(ODD)
    for i, u in ODD:
        r, (host, path, rule, verdict) = rows[i, u], by_hand(u)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("block", "allow")


def test_pages_and_model(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    rows = U.judge(pages).collect()
    assert len(rows) == pages.count()
    for r in rows:
        host, path, rule, verdict = by_hand(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict)


def test_held_out_urls(spark):
    """The model alone, on ruled URLs it has not seen."""
    from pyspark.sql import functions as F
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    host, path = U.host_and_path(F.col("url"))
    d = pages.select(host.alias("host"), path.alias("path")).withColumn("r", U.ruling(F.col("host"), F.col("path"))).select(
        "host", "path", F.col("r.verdict").alias("verdict")).filter("verdict IS NOT NULL")
    test = F.crc32(F.concat("host", "path")) % 4 == 0
    model = U.train(U.labelled_by_rules(d.filter(~test)))
    got = model.transform(U.features(d.filter(test))).select("verdict", "_block").collect()
    assert len(got) > 100
    assert sum((r.verdict == "block") == (r._block == 1.0) for r in got) > 0.97 * len(got)


def test_nothing_to_learn(spark):
    one = spark.createDataFrame([(1, "http://x.io/")], "page_id long, url string")
    assert U.judge(one).first().verdict == "allow"
    blocked = spark.createDataFrame([("h", "/", 1.0)], "host string, path string, block double")
    assert U.judge(one, labelled=blocked).first().verdict == "block"
    assert U.judge(one.limit(0)).count() == 0
