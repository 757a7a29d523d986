"""Not-modified revisits of a web archive, resolved by an as-of join.

A revisit record (a 304 answer) has no payload of its own.  It takes that of
the latest earlier full response (status 200) of the same canonical URL, if its
validators agree with that response's: the entity tag, compared weakly, if it
carries one, otherwise the last-modified date.  The headers then are the stored
response's, updated by those of the 304 that may update them; hop-by-hop
fields and fields that describe the stored body stay as they were.

The join has no candidate pairs: records are put in order of (URL, time, id) by
a range sort, which spreads a URL with a third of all rows over many
partitions; each partition finds the last full response before every record
among its own rows, and rows whose URL began in an earlier partition take the
one carried over, from a table of two rows a partition.  Payloads never move;
``attach_payloads`` joins them on demand.

Outcome of a record: ``full`` (a response), ``resolved``, ``mismatch`` (a
validator differs), ``unvalidated`` (the revisit or the response has none to
compare), ``no_prior`` (no earlier full response, or no URL), ``other`` (a
response that is not full).

Edge cases: records of equal time count as earlier by record id; repeated rows
are records of their own; null times sort first; a null header map is empty; an
empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import sorted_positions

#: Header fields that a 304 must not change in a stored response: those about
#: the connection and those that describe the stored body.
KEPT_FIELDS = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer",
    "transfer-encoding", "upgrade",
)
_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no default port, no fragment, ``/`` for an
    empty path.  What has no ``scheme://`` stays as it is."""
    scheme, host = F.lower(F.regexp_extract(url, _PARTS, 1)), F.lower(F.regexp_extract(url, _PARTS, 2))
    port = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(
        scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    path = F.regexp_extract(url, _PARTS, 3)
    return F.when(scheme == "", url).otherwise(F.concat(
        scheme, F.lit("://"), port, F.when(path == "", F.lit("/")).otherwise(path), F.regexp_extract(url, _PARTS, 4)))


def latest_full(records: DataFrame) -> DataFrame:
    """``records`` (with _url, captured, record_id, _full) plus _prior, the
    latest earlier non-null _full of the same _url."""
    s = sorted_positions(records, ["_url", "captured", "record_id"])
    own = Window.partitionBy("_pid", "_url").orderBy("_local").rowsBetween(Window.unboundedPreceding, -1)
    # first and last URL of each partition and its last full response of the latter
    ends = s.groupBy("_pid").agg(
        F.min_by(F.struct("_url"), "_local").alias("first"), F.max_by(F.struct("_url"), "_local").alias("last"),
        F.max_by(F.struct("_url", "_full"), F.when(F.col("_full").isNotNull(), F.col("_local"))).alias("full"))
    steps = ends.select(F.inline(F.array(
        F.struct(F.col("first._url").alias("_url"), (2 * F.col("_pid")).alias("at"), F.lit(None).cast(records.schema["_full"].dataType).alias("v")),
        F.struct(F.col("last._url").alias("_url"), (2 * F.col("_pid") + 1).alias("at"),
                 F.when(F.col("full._url") == F.col("last._url"), F.col("full._full")).alias("v")))))
    before = Window.partitionBy("_url").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    carried = (steps.withColumn("_carry", F.last("v", ignorenulls=True).over(before)).filter("at % 2 = 0")
               .select(F.expr("cast(at div 2 as bigint)").alias("_pid"), F.col("_url").alias("_curl"), "_carry"))
    return (s.withColumn("_own", F.last("_full", ignorenulls=True).over(own))
            .join(F.broadcast(carried), "_pid", "left")  # one row a partition
            .withColumn("_prior", F.coalesce("_own", F.when(F.col("_url") == F.col("_curl"), F.col("_carry"))))
            .drop("_pid", "_local", "_own", "_curl", "_carry"))


def resolve(records: DataFrame) -> DataFrame:
    """Records (record_id long, uri, captured long, kind 'response' / 'revisit',
    status int, headers map by lower-case name, payload_bytes long,
    payload_digest) -> record_id, url, outcome, refers_to, payload_bytes,
    payload_digest, headers (merged where resolved)."""
    headers = F.coalesce("headers", F.create_map().cast("map<string,string>"))
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    d = records.select("record_id", canonical_url(F.col("uri")).alias("_url"), "captured", "kind", headers.alias("headers"),
                       "payload_bytes", "payload_digest", F.coalesce(full, F.lit(False)).alias("_is_full"))
    d = d.withColumn("_full", F.when(F.col("_is_full") & F.col("_url").isNotNull(), F.struct(
        "record_id", "headers", "payload_bytes", "payload_digest")))
    d = latest_full(d)

    def tag(h: Column) -> Column:
        return F.regexp_replace(h["etag"], "^W/", "")

    mine, stored = F.col("headers"), F.col("_prior.headers")
    agrees = F.when(mine["etag"].isNotNull(), tag(mine) == tag(stored)).otherwise(mine["last-modified"] == stored["last-modified"])
    outcome = (F.when(F.col("kind") == "response", F.when(F.col("_is_full"), "full").otherwise("other"))
               .when(F.col("_prior").isNull(), "no_prior").when(agrees.isNull(), "unvalidated")
               .when(agrees, "resolved").otherwise("mismatch"))
    d = d.withColumn("outcome", outcome)
    done = F.col("outcome") == "resolved"
    news = F.map_filter(mine, lambda k, v: ~k.isin(*KEPT_FIELDS))
    kept = F.map_filter(stored, lambda k, v: ~F.map_contains_key(news, k))
    return d.select(
        "record_id", F.col("_url").alias("url"), "outcome", F.when(done, F.col("_prior.record_id")).alias("refers_to"),
        F.when(done, F.col("_prior.payload_bytes")).when(F.col("kind") == "response", F.col("payload_bytes")).alias("payload_bytes"),
        F.when(done, F.col("_prior.payload_digest")).when(F.col("kind") == "response", F.col("payload_digest")).alias("payload_digest"),
        F.when(done, F.map_concat(kept, news)).otherwise(mine).alias("headers"))


def header_text(headers: Column) -> Column:
    """Headers as lines in order of name."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def attach_payloads(resolved: DataFrame, payloads: DataFrame) -> DataFrame:
    """``resolved`` plus payload, from (record_id, payload) of the responses."""
    source = payloads.select(F.col("record_id").alias("_source"), "payload")
    at = F.coalesce("refers_to", F.when(F.col("outcome").isin("full", "other"), F.col("record_id")))
    return resolved.join(source, at == F.col("_source"), "left").drop("_source")


def captures(pages: DataFrame) -> DataFrame:
    """Records for ``resolve`` derived from the page table: each page is fetched
    up to four times, a day apart, under several spellings of its URL; most
    later fetches are revisits whose validators agree, differ or lack."""
    k, p = F.col("k"), F.col("page_id")
    base, html = F.regexp_replace("url", "#.*$", ""), F.coalesce("html", F.lit(""))
    loud = F.when(base.startswith("https://"), F.regexp_replace(base, "^https://([^/?#]*)", "HTTPS://$1:443")).otherwise(
        F.regexp_replace(base, "^http://([^/?#]*)", "HTTP://$1:80"))
    changed = (k == 2) & (p % 5 == 0)
    absent = (k == 1) & (p % 13 == 0)
    body = F.when(changed, F.concat(html, F.lit("<!-- 2 -->"))).otherwise(html)
    d = (pages.select("page_id", "url", "html", F.explode(F.array(*map(F.lit, range(4)))).alias("k"))
         .filter(~((k == 0) & (p % 11 == 0)))
         .select("page_id", "k", F.when(k == 1, F.concat(base, F.lit("#v1"))).when(k == 2, loud).otherwise(F.col("url")).alias("uri"),
                 body.alias("body"), changed.alias("changed"), absent.alias("absent"),
                 F.concat(F.lit('"'), F.substring(F.md5(html.cast("binary")), 1, 12), F.lit('"')).alias("tag")))
    response = (k == 0) | F.col("changed") | F.col("absent")

    def day(n: Column) -> Column:
        return F.concat(F.lit("Mon, 01 Jan 2024 "), F.lpad((n % 24).cast("string"), 2, "0"), F.lit(":00:00 GMT"))

    def pairs(**named: Column) -> Column:
        entries = F.array(*[F.struct(F.lit(n.replace("_", "-")).alias("k"), v.alias("v")) for n, v in named.items()])
        return F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull()))

    captured = F.lit(1_700_000_000) + (p % 5000) * 3600 + k * 86400
    digest = F.md5(F.col("body").cast("binary"))
    told = pairs(
        content_type=F.lit("text/html"), content_length=F.octet_length("body").cast("string"),
        etag=F.concat(F.lit('"'), F.substring(digest, 1, 12), F.lit('"')),
        last_modified=F.when(F.col("changed"), day(p + 1)).otherwise(day(p)),
        date=captured.cast("string"), cache_control=F.lit("max-age=60"))
    c = p % 6
    again = pairs(
        etag=F.when(c.isin(0, 5), F.col("tag")).when(c == 1, F.concat(F.lit("W/"), F.col("tag"))).when(c == 3, F.lit('"stale"')),
        last_modified=F.when(c.isin(2, 5), day(p)), content_length=F.lit("0"), connection=F.lit("close"),
        date=captured.cast("string"), cache_control=F.concat(F.lit("max-age="), k.cast("string")), server=F.lit("edge"))
    return d.select(
        (p * 4 + k).cast("bigint").alias("record_id"), "uri", captured.cast("bigint").alias("captured"),
        F.when(response, "response").otherwise("revisit").alias("kind"),
        F.when(F.col("absent"), 404).when(response, 200).otherwise(304).alias("status"),
        F.when(response, told).otherwise(again).alias("headers"),
        F.when(response, F.octet_length("body")).otherwise(0).cast("bigint").alias("payload_bytes"),
        F.when(response, digest).alias("payload_digest"))


def revisit_report(pages: DataFrame) -> DataFrame:
    return resolve(captures(pages)).withColumn("headers", header_text(F.col("headers")))
