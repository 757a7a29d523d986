from __future__ import annotations

import pytest

from pregame.llm import warc as W

SCHEMA = ("record_id long, uri string, captured long, kind string, status int, headers map<string,string>, "
          "payload_bytes long, payload_digest string, _url string, outcome string")


def record(i, uri, t, kind="response", status=200, headers=None, digest=None):
    return (i, uri, t, kind, status, headers, 5 if digest else 0, digest, "x", "y")


ROWS = [
    record(1, "http://A.com", 10, headers={"etag": '"a"', "content-type": "t", "x": "old"}, digest="d1"),
    record(2, "http://a.com:80/#top", 20, "revisit", 304, {"etag": 'W/"a"', "content-type": "no", "x": "new", "y": "1"}),
    record(3, "http://a.com/", 30, "revisit", 304, {"etag": '"b"'}),
    record(4, "http://a.com/", 40, "response", 404, {}, "d4"),
    record(5, "http://a.com/", 50, headers={"last-modified": "m"}, digest="d5"),
    record(6, "http://a.com/", 60, "revisit", 304, {"last-modified": "m"}),
    record(7, "http://a.com/", 61, "revisit", 304, {"etag": '"a"'}),
    record(8, "http://a.com/", 62, "revisit", 304, None),
    record(9, "http://a.com/b", 5, "revisit", 304, {"etag": '"a"'}),
    record(10, None, 5, "revisit", 304, {"etag": '"a"'}),
    record(11, None, 4, headers={"etag": '"a"'}, digest="d11"),
    record(12, "http://a.com/b", None, headers={"etag": '"a"'}, digest="d12"),
    record(13, "http://a.com/b", None, headers={"etag": '"a"'}, digest="d13"),
]


def test_outcomes(spark):
    out = {r.record_id: r for r in W.resolve(spark.createDataFrame(ROWS, SCHEMA)).collect()}
    assert {i: (r.outcome, r.refers_to) for i, r in out.items()} == {
        1: ("full", None), 2: ("resolved", 1), 3: ("mismatch", None), 4: ("other", None), 5: ("full", None), 6: ("resolved", 5),
        7: ("unvalidated", None), 8: ("unvalidated", None), 9: ("resolved", 13), 10: ("no_prior", None), 11: ("full", None),
        12: ("full", None), 13: ("full", None)}
    assert out[2].headers == {"etag": 'W/"a"', "content-type": "t", "x": "new", "y": "1"}
    assert (out[2].payload_digest, out[2].payload_bytes, out[2].url) == ("d1", 5, "http://a.com/")


@pytest.mark.parametrize("partitions", [1, 16])
def test_one_url_over_many_partitions(spark, partitions):
    """Most records share a URL; the last full response is carried over."""
    rows = []
    for i in range(2000):
        uri = "http://hot.example/" if i % 3 else f"http://u{i % 7}.example/"
        full = i % 97 == 0
        rows.append(record(i, uri, i, "response" if full else "revisit", 200 if full else 304, {"etag": '"e"'}, "d" if full else None))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.record_id: r.refers_to for r in W.resolve(spark.createDataFrame(rows, SCHEMA)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    last, want = {}, {}
    for r in rows:
        want[r[0]] = None if r[3] == "response" else last.get(r[1])
        if r[3] == "response":
            last[r[1]] = r[0]
    assert got == want


def test_payloads_and_empty(spark):
    records = spark.createDataFrame(ROWS, SCHEMA)
    payloads = spark.createDataFrame([(1, "body1"), (5, "body5")], "record_id long, payload string")
    got = {r.record_id: r.payload for r in W.attach_payloads(W.resolve(records), payloads).collect()}
    assert got[2] == "body1" and got[6] == "body5" and got[3] is None and got[1] == "body1"
    assert W.resolve(records.limit(0)).count() == 0
