"""The registered ``opN_<name>`` queries: key -> callable, and oracle SQL where
DuckDB can express the whole result."""
from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ctw, decontaminate, langid, packing, periodic, prefix_tokens, quality, ring, secret_scan, simhash, urlfilter, warc, whitening
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn
    return deco


_CAPTURES = """
WITH k AS (SELECT * FROM (VALUES (0), (1), (2), (3)) t(k)
), f AS (
  SELECT page_id AS p, k, url, coalesce(html, '') AS html, regexp_replace(url, '#.*$', '') AS base,
         k = 2 AND page_id % 5 = 0 AS changed, k = 1 AND page_id % 13 = 0 AS absent
  FROM pages, k WHERE NOT (k = 0 AND page_id % 11 = 0)
), g AS (
  SELECT *, CASE WHEN changed THEN html || '<!-- 2 -->' ELSE html END AS body,
         CASE WHEN k = 1 THEN base || '#v1'
              WHEN k = 2 AND base LIKE 'https://%' THEN regexp_replace(base, '^https://([^/?#]*)', 'HTTPS://\\1:443')
              WHEN k = 2 THEN regexp_replace(base, '^http://([^/?#]*)', 'HTTP://\\1:80') ELSE url END AS uri,
         '"' || substr(md5(html), 1, 12) || '"' AS tag, 1700000000 + (p % 5000) * 3600 + k * 86400 AS captured,
         (k = 0 OR changed OR absent) AS response
  FROM f
), r AS (
  SELECT p * 4 + k AS record_id, captured, response, response AND NOT absent AS is_full, k, uri,
         regexp_extract(uri, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\\?[^#]*)?', 1) AS u1,
         regexp_extract(uri, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\\?[^#]*)?', 2) AS u2,
         regexp_extract(uri, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\\?[^#]*)?', 3) AS u3,
         regexp_extract(uri, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\\?[^#]*)?', 4) AS u4,
         CASE WHEN response THEN octet_length(encode(body)) ELSE 0 END AS bytes, CASE WHEN response THEN md5(body) END AS digest,
         CASE WHEN response THEN '"' || substr(md5(body), 1, 12) || '"'
              WHEN p % 6 IN (0, 5) THEN tag WHEN p % 6 = 1 THEN 'W/' || tag WHEN p % 6 = 3 THEN '"stale"' END AS etag,
         CASE WHEN response OR p % 6 IN (2, 5)
              THEN 'Mon, 01 Jan 2024 ' || lpad(CAST((p + CASE WHEN changed THEN 1 ELSE 0 END) % 24 AS VARCHAR), 2, '0') || ':00:00 GMT' END AS modified
  FROM g
), c AS (
  SELECT *, CASE WHEN u1 = '' THEN uri ELSE lower(u1) || '://' || CASE
              WHEN lower(u1) = 'http' THEN regexp_replace(lower(u2), ':80$', '')
              WHEN lower(u1) = 'https' THEN regexp_replace(lower(u2), ':443$', '') ELSE lower(u2) END
            || CASE WHEN u3 = '' THEN '/' ELSE u3 END || coalesce(u4, '') END AS url
  FROM r
), prior AS (
  SELECT *, last_value(CASE WHEN is_full AND url IS NOT NULL THEN record_id END IGNORE NULLS) OVER (
           PARTITION BY url ORDER BY captured, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_id
  FROM c
), o AS (
  SELECT a.*, b.record_id AS b_id, b.etag AS b_etag, b.modified AS b_modified, b.bytes AS b_bytes, b.digest AS b_digest,
         CASE WHEN a.response THEN CASE WHEN a.is_full THEN 'full' ELSE 'other' END
              WHEN b.record_id IS NULL THEN 'no_prior'
              WHEN a.etag IS NULL AND a.modified IS NULL THEN 'unvalidated'
              WHEN a.etag IS NOT NULL THEN CASE WHEN regexp_replace(a.etag, '^W/', '') = regexp_replace(b.etag, '^W/', '') THEN 'resolved' ELSE 'mismatch' END
              WHEN a.modified = b.modified THEN 'resolved' ELSE 'mismatch' END AS outcome
  FROM prior a LEFT JOIN c b ON b.record_id = a.prior_id
)
SELECT CAST(record_id AS BIGINT) AS record_id, url, outcome,
       CAST(CASE WHEN outcome = 'resolved' THEN b_id END AS BIGINT) AS refers_to,
       CAST(CASE WHEN outcome = 'resolved' THEN b_bytes WHEN response THEN bytes END AS BIGINT) AS payload_bytes,
       CASE WHEN outcome = 'resolved' THEN b_digest WHEN response THEN digest END AS payload_digest,
       CASE WHEN outcome = 'resolved' THEN
         'cache-control: max-age=' || k || chr(10) || 'content-length: ' || b_bytes || chr(10) || 'content-type: text/html' || chr(10)
         || 'date: ' || captured || chr(10) || 'etag: ' || coalesce(etag, b_etag) || chr(10)
         || 'last-modified: ' || coalesce(modified, b_modified) || chr(10) || 'server: edge'
       WHEN response THEN
         'cache-control: max-age=60' || chr(10) || 'content-length: ' || bytes || chr(10) || 'content-type: text/html' || chr(10)
         || 'date: ' || captured || chr(10) || 'etag: ' || etag || chr(10) || 'last-modified: ' || modified
       ELSE
         'cache-control: max-age=' || k || chr(10) || 'connection: close' || chr(10) || 'content-length: 0' || chr(10) || 'date: ' || captured
         || coalesce(chr(10) || 'etag: ' || etag, '') || coalesce(chr(10) || 'last-modified: ' || modified, '') || chr(10) || 'server: edge'
       END AS headers
FROM o"""


@register("op1_revisits", _CAPTURES)
def op1_revisits(spark, sf_dir):
    return warc.revisit_report(table(spark, sf_dir, "pages"))


@register("op2_decontaminate", """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS p FROM i WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM win
), spot AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, lens WHERE len(w) >= n
), hit AS (
  SELECT spot.doc_id, spot.p, spot.n, win.item_id FROM spot JOIN win ON win.n = spot.n AND win.s = array_to_string(spot.w[spot.p:spot.p + spot.n - 1], ' ')
), per AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM hit)) GROUP BY doc_id
), ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(per.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(ids.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids.s, '')) AS items_sha256,
       coalesce(per.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN per ON per.doc_id = d.doc_id LEFT JOIN ids ON ids.doc_id = d.doc_id""")
def op2_decontaminate(spark, sf_dir):
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op3_ring")
def op3_ring(spark, sf_dir):
    return ring.shard_documents(table(spark, sf_dir, "documents"))


@register("op4_language")
def op4_language(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@register("op5_pack")
def op5_pack(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@register("op6_simhash")
def op6_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def _bin(p: str, q: str) -> str:
    """One bin's part of twice the divergence, in bits."""
    return " + ".join(f"CASE WHEN {x} > 0 THEN {x} * log2(2 * ({x}) / ({p} + {q})) ELSE 0.0 END" for x in (f"({p})", f"({q})"))


_QUALITY = rf"""
WITH d AS (
  SELECT doc_id, lang, text IS NOT NULL AS has, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), b AS (
  SELECT *, len(w) AS n, length(t) AS chars, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS inked,
         length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS up, length(regexp_replace(t, '[^0-9]+', '', 'g')) AS dg,
         length(regexp_replace(t, '[^\p{{P}}\p{{S}}]+', '', 'g')) AS mk, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS sy,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln FROM d
), c AS (SELECT *, [up, dg, mk, chars - inked, inked - up - dg - mk] AS k FROM b
), win AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, s) AS twice
  FROM (SELECT doc_id, p, array_to_string(w[p:p + 7], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, n - 6)) AS p FROM b WHERE n >= 8))
), rep AS (
  SELECT doc_id, count(DISTINCT q) AS r FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM win WHERE twice > 1) GROUP BY doc_id
), ref AS (
  SELECT lang, sum(n) AS words, sum(chars) AS ch, list_transform([sum(k[1]), sum(k[2]), sum(k[3]), sum(k[4]), sum(k[5])], lambda x: x / sum(chars)) AS q
  FROM c WHERE lang IS NOT NULL AND has GROUP BY lang HAVING sum(n) >= {quality.REFERENCE_WORDS}
), com AS (
  SELECT u.lang, u.word, count(*) / any_value(ref.words) AS q
  FROM (SELECT lang, unnest(w) AS word FROM b WHERE lang IS NOT NULL AND has) u JOIN ref ON ref.lang = u.lang
  GROUP BY u.lang, u.word HAVING count(*) >= {quality.COMMON_SHARE} * any_value(ref.words)
), listed AS (SELECT lang, sum(q) AS l FROM com GROUP BY lang
), cnt AS (SELECT doc_id, word, count(*) AS m FROM (SELECT doc_id, unnest(w) AS word FROM b) GROUP BY doc_id, word
), hit AS (
  SELECT doc_id, lang, sum({_bin('p', 'q')} - q) AS f, sum(p) AS p
  FROM (SELECT cnt.doc_id, com.lang, cnt.m / b.n AS p, com.q FROM cnt JOIN com ON com.word = cnt.word JOIN b ON b.doc_id = cnt.doc_id)
  GROUP BY doc_id, lang
), pair AS (
  SELECT c.doc_id, c.n, c.chars, ref.lang, coalesce(l.l, 0.0) AS l, greatest(1 - coalesce(hit.p, 0.0), 0.0) AS rest, coalesce(hit.f, 0.0) AS f,
         sqrt(greatest({' + '.join(_bin(f'(c.k[{i}] / c.chars)', f'ref.q[{i}]') for i in range(1, 6))}, 0.0) / 2) AS cd
  FROM c JOIN ref ON c.n > 0 LEFT JOIN listed l ON l.lang = ref.lang LEFT JOIN hit ON hit.doc_id = c.doc_id AND hit.lang = ref.lang
), dist AS (
  SELECT *, CASE WHEN l = 0 THEN 0.0 ELSE sqrt(greatest(l + f + {_bin('rest', 'greatest(1 - l, 0.0)')}, 0.0) / 2)
              / sqrt((l + {_bin('1.0', 'greatest(1 - l, 0.0)')}) / 2) END AS wd FROM pair
), near AS (
  SELECT doc_id, min(greatest(CASE WHEN chars >= {quality.MIN_CHARS} THEN cd ELSE 0.0 END / {quality.CLASS_DISTANCE},
                              CASE WHEN n >= {quality.MIN_WORDS} THEN wd ELSE 0.0 END / ({quality.WORD_DISTANCE} + {quality.WORD_SLACK} / sqrt(n)))) AS far
  FROM dist GROUP BY doc_id
), o AS (
  SELECT c.doc_id, CAST(c.n AS BIGINT) AS n_words, CAST(c.inked AS BIGINT) AS word_chars, CAST(c.sy AS BIGINT) AS n_symbols,
         CAST(len(c.ln) - len(list_distinct(c.ln)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.r, 0) AS BIGINT) AS n_repeat_words, near.far,
         c.lang IS NOT NULL AND c.lang NOT IN (SELECT lang FROM ref) AS unreferenced
  FROM c LEFT JOIN rep ON rep.doc_id = c.doc_id LEFT JOIN near ON near.doc_id = c.doc_id
)
SELECT * EXCLUDE (far, unreferenced), n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words) AND (unreferenced OR coalesce(far <= 1, true)) AS kept
FROM o"""


@register("op7_quality", _QUALITY)
def op7_quality(spark, sf_dir):
    return quality.quality_report(table(spark, sf_dir, "documents"))


@register("op8_prefix_tokens")
def op8_prefix_tokens(spark, sf_dir):
    return prefix_tokens.token_report(table(spark, sf_dir, "documents"))


@register("op9_url_filter")
def op9_url_filter(spark, sf_dir):
    return urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict")


@register("op10_ctw")
def op10_ctw(spark, sf_dir):
    return ctw.score_documents(table(spark, sf_dir, "documents"))


def _either_case(pattern: str) -> str:
    """The pattern with its plain letters in either case."""
    return re.sub(r"\\x..|\\.|\[[^\]]*\]|[a-z]", lambda m: m[0] if len(m[0]) > 1 else f"[{m[0]}{m[0].upper()}]", pattern)


def _secrets_sql() -> str:
    rules = secret_scan.RULES
    quoted = [(_either_case(r.pattern) if r.any_case else r.pattern).replace("'", "''") for r in rules]
    each = "\n  UNION ALL ".join(
        f"SELECT doc_id, {k} AS r, '{r.kind}' AS kind, {r.least} AS least, regexp_extract_all(t, '{q}', 0) AS m, "
        f"regexp_extract_all(t, '{q}', {r.group}) AS g, string_split_regex(t, '{q}') AS gap FROM d" for k, (r, q) in enumerate(zip(rules, quoted)))
    listed = "string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, r)"
    base = len(secret_scan.BASE)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secret_scan.BASE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents
), found AS (
  {each}
), x AS (
  SELECT doc_id, r, kind, least, i, length(gap[i]) + length(m[i]) AS step, length(m[i]) AS size, length(g[i]) AS part
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM found)
), s AS (
  SELECT *, CAST(e - size AS BIGINT) AS b FROM (
    SELECT *, CAST(sum(step) OVER (PARTITION BY doc_id, r ORDER BY i) AS BIGINT) AS e FROM x) WHERE part >= least
)
SELECT d.doc_id, {counts}, sha256(coalesce({listed} FILTER (r < {base}), '')) AS base_sha256, coalesce({listed}, '') AS spans
FROM d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id"""


@register("op11_secrets", _secrets_sql())
def op11_secrets(spark, sf_dir):
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


@register("op12_whitening")
def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    return periodic.run_report(periodic.with_planted_periods(table(spark, sf_dir, "documents")))
