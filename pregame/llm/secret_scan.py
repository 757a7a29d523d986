"""Secret scans through a trigram inverted index.

Every rule is a regular expression.  From its parse a Boolean query of trigrams is
derived that any matching text must satisfy: literal stretches need all of their
trigrams, alternatives one of theirs.  Texts and trigrams are compared in lower
case, so letter case never loses a match.

Index.  Texts are known by a 64-bit hash; copies share it.  The index holds, for
every block of about ``BLOCK_TEXTS`` texts (by hash), the posting list of each
trigram that some rule asks for.  A rule's candidates are the intersections and
unions of the block's posting lists that its query says.

Verification.  Candidates become bitmaps (``marks``) in which every (text, rule) has
its bit.  That table is 8 MB at most, however large the corpus, so it is broadcast,
and texts are verified where they lie: a rule's expression runs on the rows whose
bit is set.  A bit set by another text costs a scan that finds nothing, never a result.
Texts are not shuffled; only trigrams and hashes are.  Rules without a mandatory
trigram run on every text.

Spans are found by splitting a text at a rule's matches and adding up lengths, in
code points.  Only DataFrame functions are used.

Edge cases: a null or empty text has no spans; matches of a rule never overlap,
those of different rules may; matches whose ``group`` is shorter than ``least`` are
dropped after matching; equal texts get equal spans; very long texts are scanned
whole; a null id is kept; an empty table gives an empty result; extra columns are
kept by ``scan`` (one named ``secrets`` is replaced), whatever their names.
"""
from __future__ import annotations

import json
import re
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import marks
from .common import computed, cut, let, quoted, replacing

BLOCK_TEXTS = 256
EXACT = 64  # texts that a stretch of an expression is spelled out in, at most
CLASS = 8  # characters of a class that is spelled out, at most
CHUNK = 256  # lengths added up at a time


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False


# The three base kinds.  A run of the class that is long enough is the
# match of the shorter rule that is not dropped.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (Rule("assign", ASSIGN, 2, 8, any_case=True), Rule("access", "AKIA[A-Z0-9]{12,}"), Rule("hex", "[0-9a-f]{32,}"))
# Added kinds: published token formats.
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("forge_token", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("pay_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("url_login", r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\x20\x09-\x0D/:@]{1,256}:[^\x20\x09-\x0D/:@]{1,256}@"),
)
RULES = BASE + ADDED

# ---- trigram queries: True (no condition), a trigram, or ("and" | "or", queries) ----


def _all_of(queries):
    flat = []
    for q in queries:
        flat += q[1] if isinstance(q, tuple) and q[0] == "and" else [] if q is True else [q]
    flat = list(dict.fromkeys(flat))
    return True if not flat else flat[0] if len(flat) == 1 else ("and", tuple(flat))


def _one_of(queries):
    flat = []
    for q in queries:
        if q is True:
            return True
        flat += q[1] if isinstance(q, tuple) and q[0] == "or" else [q]
    flat = list(dict.fromkeys(flat))
    return flat[0] if len(flat) == 1 else ("or", tuple(flat))


def _spelled(texts):
    """Query of the texts, one of which must occur."""
    return _one_of(_all_of(t[i:i + 3] for i in range(len(t) - 2)) for t in sorted(texts))


def _sequence(items):
    """(all texts that match, or None; query) of a sequence of parsed items."""
    texts, needed, whole = {""}, [], True
    for op, arg in items:
        own, query = _item(str(op), arg)
        if own is not None and len(own) * len(texts) <= EXACT:
            texts = {a + b for a in texts for b in own}
            continue
        needed += [_spelled(texts), query]
        texts, whole = own or {""}, False
    return (texts, True) if whole else (None, _all_of([*needed, _spelled(texts)]))


def _letter(code: int):
    return chr(code).lower() if code < 128 else None


def _item(op: str, arg):
    if op == "LITERAL":
        c = _letter(arg)
        return ({c}, True) if c else (None, True)
    if op == "IN":
        codes: set = set()
        for kind, value in arg:
            if str(kind) == "LITERAL":
                codes.add(value)
            elif str(kind) == "RANGE" and value[1] - value[0] < CLASS * 2:
                codes.update(range(value[0], value[1] + 1))
            else:
                return None, True
        letters = {_letter(c) for c in codes}
        return (letters, True) if None not in letters and len(letters) <= CLASS else (None, True)
    if op == "SUBPATTERN":
        return _sequence(arg[3])
    if op == "BRANCH":
        parts = [_sequence(p) for p in arg[1]]
        if all(t is not None for t, _ in parts):
            texts = set().union(*(t for t, _ in parts))
            if len(texts) <= EXACT:
                return texts, True
        return None, _one_of([q if t is None else _spelled(t) for t, q in parts])
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, inner = arg
        texts, query = _sequence(inner)
        if texts is not None and (least, most) == (0, 1):
            return texts | {""}, True
        if texts is not None and least == most and len(texts) ** least <= EXACT:
            return reduce(lambda a, b: {x + y for x in a for y in b}, [texts] * least, {""}), True
        if not least:
            return None, True
        return None, query if texts is None else _spelled(texts)
    if op in ("AT", "ASSERT", "ASSERT_NOT"):
        return {""}, True
    return None, True


def trigram_query(pattern: str):
    """The Boolean trigram query that every match of ``pattern`` satisfies, in lower
    case; True if it has no mandatory trigram."""
    texts, query = _sequence(re._parser.parse(pattern))
    return _spelled(texts) if texts is not None else query


def trigrams_of(query) -> set:
    return {query} if isinstance(query, str) else set() if query is True else set().union(*map(trigrams_of, query[1]))


# ---- index ----------------------------------------------------------------------


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def build_index(docs: DataFrame, trigrams: list[str], text_col: str = "text", block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """(block, postings): for every block of texts a map from trigram to the hashes
    of the texts that hold it.  A list has as many entries as a block has texts, at
    most; copies are one entry."""
    blocks = max(1, -(-docs.count() // block_texts))
    text = F.col(quoted(text_col)).cast("string")
    d = computed(docs.select(text.alias("t")).filter("t <> ''"), low=F.lower("t"), key=text_key(F.col("t")))
    held = F.filter(F.array(*[F.lit(g) for g in trigrams]), lambda g: F.contains(F.col("low"), g))
    postings = d.select("key", F.explode(held).alias("gram"))
    lists = (postings.groupBy(F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"), "gram")
             .agg(F.collect_set("key").alias("keys")))
    return lists.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("gram", "keys"))).alias("postings"))


def options_of(query) -> list[frozenset]:
    """The query as alternatives, each a set of trigrams that must all be there.  A
    conjunction with too many combinations keeps its first parts: more candidates,
    never fewer matches."""
    if isinstance(query, str):
        return [frozenset([query])]
    parts = [options_of(q) for q in query[1]]
    if query[0] == "or":
        return list(dict.fromkeys(o for p in parts for o in p))
    out = parts[0]
    for p in sorted(parts[1:], key=len):
        if len(out) * len(p) <= EXACT:
            out = list(dict.fromkeys(a | b for a in out for b in p))
    return out


def candidates(index: DataFrame, queries: dict[int, object]) -> DataFrame:
    """(key, rule) of the texts that satisfy a rule's query (rule number -> query):
    posting lists intersected within an alternative, and joined over alternatives."""
    asked = F.from_json(F.lit(json.dumps([{"rule": r, "options": [sorted(o) for o in options_of(q)]} for r, q in queries.items()])),
                        "array<struct<rule:int,options:array<array<string>>>>")
    none = F.array().cast("array<bigint>")
    held = lambda g: F.coalesce(F.try_element_at(F.col("postings"), g), none)
    both = lambda o: F.aggregate(F.slice(o, F.lit(2), F.size(o)), held(F.get(o, F.lit(0))), lambda acc, g: F.array_intersect(acc, held(g)))
    found = index.select(F.inline(F.transform(asked, lambda a: F.struct(
        a["rule"].alias("rule"), F.array_distinct(F.flatten(F.transform(a["options"], both))).alias("keys")))))
    return found.select(F.explode("keys").alias("key"), "rule")


# ---- verification ---------------------------------------------------------------


def running_sums(x: Column) -> Column:
    """Sums up to and including each element, in chunks, so that a list is copied a
    bounded number of times however long it is."""
    last = lambda a: F.element_at(a, -1)
    grown = lambda acc, v: F.concat(acc, F.array(last(acc) + v))
    nought = F.array(F.lit(0).cast("bigint"))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / CHUNK).cast("int")),
                         lambda c: F.slice(x, c * CHUNK + 1, F.lit(CHUNK)))
    within = F.transform(chunks, lambda c: F.aggregate(c, nought, grown))
    sums = let(within, lambda w: let(F.aggregate(w, nought, lambda acc, c: grown(acc, last(c))), lambda base: F.flatten(
        F.transform(w, lambda c, i: F.transform(F.slice(c, F.lit(2), F.lit(CHUNK)), lambda v: v + F.get(base, i))))))
    return F.when(F.size(x) > 0, sums).otherwise(F.array().cast("array<bigint>"))


def spans(text: Column, rule: Rule) -> Column:
    """Array of (start, end) of a rule's matches, in code points."""
    pattern = F.lit(("(?i)" if rule.any_case else "") + rule.pattern)
    found = F.struct(F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"),
                     F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("g"), F.split(text, pattern, -1).alias("gap"))
    ends = lambda f: running_sums(F.transform(f["m"], lambda m, i: (F.length(F.get(f["gap"], i)) + F.length(m)).cast("bigint")))
    return let(found, lambda f: F.filter(
        F.zip_with(ends(f), F.arrays_zip(f["m"].alias("m"), f["g"].alias("g")), lambda e, x: F.when(
            F.length(x["g"]) >= rule.least, F.struct((e - F.length(x["m"])).alias("start"), e.alias("end")))),
        lambda s: s.isNotNull()))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """``docs`` plus secrets: array of (start, rule number, end, kind) of all spans,
    by start, then by the rules' order."""
    queries = {r: trigram_query(rule.pattern) for r, rule in enumerate(rules)}
    indexed = {r: q for r, q in queries.items() if q is not True}
    own = replacing(docs, ["secrets"])
    d = own.select(F.struct(*[F.col(quoted(c)) for c in own.columns]).alias("row"), F.col(quoted(text_col)).cast("string").alias("t"))
    d = d.select("row", F.coalesce("t", F.lit("")).alias("t"))
    if indexed:
        index = build_index(docs, sorted(set().union(*map(trigrams_of, indexed.values()))), text_col, block_texts)
        found = cut(marks.bitmaps(candidates(index, indexed), "key", "rule"))  # 8 MB at most
        d = d.withColumn("key", text_key(F.col("t"))).withColumn("_slot", marks.slot(F.col("key"))).join(
            F.broadcast(found), "_slot", "left")

    def of(r: int, rule: Rule) -> Column:
        pattern = F.lit(("(?i)" if rule.any_case else "") + rule.pattern)
        ask = F.rlike(F.col("t"), pattern) if queries[r] is True else marks.is_set(F.col("_bits"), marks.bit(F.col("key"), r))
        return F.when(ask, F.transform(spans(F.col("t"), rule), lambda s: F.struct(
            s["start"].alias("start"), F.lit(r).alias("rule"), s["end"].alias("end"), F.lit(rule.kind).alias("kind")))).otherwise(
            F.array().cast("array<struct<start:bigint,rule:int,end:bigint,kind:string>>"))

    every = F.sort_array(F.flatten(F.array(*[of(r, rule) for r, rule in enumerate(rules)])))
    return d.select("row", every.alias("secrets")).select(*[F.col("row")[c].alias(c) for c in own.columns], "secrets")


def _written(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each base kind, a digest of the base spans, and
    all spans."""
    d = computed(scan(docs.select("doc_id", "text")).select("doc_id", "secrets"),
                 base=F.filter("secrets", lambda s: s["rule"] < len(BASE)), spans=_written(F.col("secrets")))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return d.select("doc_id", *[count(r.kind) for r in BASE],
                    F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"), "spans")
