"""Quality rules: counts of repetition, and distance from language references.

Base rules (too short, too much repeated in 8-word windows) are counted inside
each row.  The method's verdict compares two histograms of a document, those of
its character classes and of its common words, with the references of every
language by Jensen-Shannon distance (square root of the divergence in bits, 0
to 1).  A document is kept if it is near enough to any one language in both.

References are statistics of all documents that have a language: class shares,
and the words with at least ``COMMON_SHARE`` of the language's words, of which
there can be ``1 / COMMON_SHARE`` at most; the rest is one further bin.  Every
language with ``REFERENCE_WORDS`` words is a reference, however many there are.
They come out of pre-aggregated counts, and only those small tables (a row a
label, 250 words each at most) reach the driver, to be one literal of the plan.
Documents are never shuffled.

Minimum-length guards: short histograms are noise, those of references as those of
documents.  A language with fewer than ``reference_words`` words in the whole table
is no reference, and a document with such a label is decided by the base rules (the
same document is judged by distance where its language has more).  The class
distance needs ``MIN_CHARS`` characters and the word distance ``MIN_WORDS`` words,
with a limit that is wider the fewer they are; a document short of both is decided
by the base rules.

Only DataFrame functions are used.  A window of eight words is known by a
64-bit hash, combined from halves (words, pairs, fours, eights).

Edge cases: a null, empty or blank text has no words and fails the base rules;
without any reference language the base rules decide; a null language adds to
no reference and is measured against all; repeated rows get equal results; very
long texts are counted whole; extra columns, whatever their names, are kept by
``judge`` (those named like an output are replaced) and ``keep_good``.
"""
from __future__ import annotations

import json
from functools import reduce
from math import log2
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, by_place, computed, let, quoted, replacing

WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30
COMMON_SHARE = 0.004
REFERENCE_WORDS = 1000  # minimum-length guard: a language with fewer words in all is no reference
MIN_CHARS = 500
MIN_WORDS = 60
CLASS_DISTANCE = 0.24
WORD_DISTANCE = 0.80  # of the distance of a text without any common word ...
WORD_SLACK = 1.3  # ... and this much more, over the root of the number of words
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
ADDED = [*BASE, "base_failed", "kept", "class_distance", "word_distance", "near_lang"]
CLASSES = ["_upper", "_digit", "_mark", "_space", "_rest"]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def _left(text: Column, dropped: str) -> Column:
    """Characters that stay when runs of a class are dropped."""
    return F.length(F.regexp_replace(text, f"[{dropped}]+", ""))


def _neighbours(a: Column, step: int, f) -> Column:
    """f(a[i], a[i + step]) for every i."""
    n = F.greatest(F.size(a) - step, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(step + 1), n), f)


def repeated_words(words: Column) -> Column:
    """Words inside 8-word windows found twice or more, first ones included."""
    def covered(windows: Column) -> Column:
        ranked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        no = F.array(F.lit(False))
        starts = let(ranked, lambda s: let(
            _neighbours(s, 1, lambda a, b: a["h"] == b["h"]),
            lambda same: F.sort_array(F.filter(F.zip_with(
                s, F.zip_with(F.concat(same, no), F.concat(no, same), lambda a, b: a | b),
                lambda x, twice: F.when(twice, x["i"])), lambda i: i.isNotNull()))))
        return let(starts, lambda p: F.lit(WINDOW) + F.aggregate(
            _neighbours(p, 1, lambda a, b: F.least(b - a, F.lit(WINDOW))), F.lit(0), lambda acc, n: acc + n))

    windows = F.transform(words, lambda w: F.xxhash64(w))
    for step in (1, 2, 4):
        windows = (lambda a, step: let(a, lambda x: _neighbours(x, step, lambda p, q: F.xxhash64(p, q))))(windows, step)
    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def _literal(value, kind: str) -> Column:
    """A nested value as a single literal (the text is parsed once, by constant folding)."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _among(word: Column, listed: list[str]) -> Column:
    """Is a word one of those listed?  They lie in as many buckets as there are words."""
    buckets: list[list[str]] = [[] for _ in listed]
    for w in listed:
        buckets[crc32(w.encode()) % len(listed)].append(w)
    return F.array_contains(_literal(buckets, "array<array<string>>")[(F.crc32(word.cast("binary")) % len(listed)).cast("int")], word)


def measured(docs: DataFrame, text_col: str, listed: list[str]) -> DataFrame:
    """``docs`` plus the base counts, the class counts, and how often each of the
    listed words occurs (_counted)."""
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    d = computed(docs, _words=words_of(text), _chars=F.length(text), _inked=_left(text, SPACE),
                 _upper=_left(text, "^\\p{Lu}"), _digit=_left(text, "^0-9"), _mark=_left(text, "^\\p{P}\\p{S}"),
                 n_symbols=_left(text, "^#*$%&|<>").cast("long"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    found = F.filter("_words", lambda w: _among(w, listed)) if listed else F.array_repeat(F.lit(""), 0)
    return computed(
        d, _counted=let(found, lambda f: F.transform(F.array_distinct(f), lambda w: F.struct(
            w.alias("w"), (F.size(f) - F.size(F.array_remove(f, w))).alias("n")))),
        n_words=F.size("_words").cast("long"), word_chars=F.col("_inked").cast("long"),
        n_dup_lines=let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        n_repeat_words=repeated_words(F.col("_words")).cast("long"), _space=F.col("_chars") - F.col("_inked"),
        _rest=F.col("_inked") - F.col("_upper") - F.col("_digit") - F.col("_mark"))


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", reference_words: int = REFERENCE_WORDS) -> list[dict]:
    """Per language: shares of the character classes and of its common words,
    over all documents of that language."""
    text, lang = F.col(quoted(text_col)), F.col(quoted(lang_col)).cast("string").alias("lang")
    own = docs.filter(lang.isNotNull() & text.isNotNull()).select(lang, text.alias("text"))
    n = {c: F.sum(x.cast("double")).alias(c) for c, x in (
        ("_chars", F.length("text")), ("_inked", _left(F.col("text"), SPACE)), ("_upper", _left(F.col("text"), "^\\p{Lu}")),
        ("_digit", _left(F.col("text"), "^0-9")), ("_mark", _left(F.col("text"), "^\\p{P}\\p{S}")))}
    totals = (own.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.size(words_of(F.col("text")))).alias("words"), *n.values())
              .filter(F.col("words") >= reference_words).collect())
    if not totals:
        return []
    least = docs.sparkSession.range(1).select(F.inline(_literal(
        [{"lang": t.lang, "least": COMMON_SHARE * t.words} for t in totals], "array<struct<lang:string,least:double>>")))
    common = (own.select("lang", F.explode(words_of(F.col("text"))).alias("word")).groupBy("lang", "word").count()
              .join(F.broadcast(least), "lang").filter(F.col("count") >= F.col("least")).collect())
    shares: dict[str, dict] = {t.lang: {} for t in totals}
    words = {t.lang: t.words for t in totals}
    for r in common:
        shares[r.lang][r.word] = r["count"] / words[r.lang]
    out = []
    for t in sorted(totals, key=lambda t: t.lang):
        parts = [t._upper, t._digit, t._mark, t._chars - t._inked, t._inked - t._upper - t._digit - t._mark]
        out.append({"lang": t.lang, "classes": [p / t._chars for p in parts], "words": dict(sorted(shares[t.lang].items()))})
    return out


def _apart(p: Column, q: Column) -> Column:
    """One bin's part of twice the divergence, in bits."""
    part = lambda x: F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(F.lit(0.0))
    return part(p) + part(q)


def _apart_of(p: float, q: float) -> float:
    return sum(x * log2(2 * x / (p + q)) for x in (p, q) if x > 0)


def _root(twice: Column) -> Column:
    return F.sqrt(F.greatest(twice, F.lit(0.0)) / 2)


REF = "array<struct<lang:string,classes:array<double>,listed:double,rest:double,none:double,words:map<string,double>>>"


def _as_rows(refs: list[dict]) -> Column:
    """References as an array; with each the share of its common words, that of
    the rest, and the distance of a text without any of them."""
    rows = []
    for r in refs:
        listed = sum(r["words"].values())
        rest = max(0.0, 1 - listed)
        rows.append({**r, "listed": listed, "rest": rest, "none": ((listed + _apart_of(1.0, rest)) / 2) ** 0.5})
    return _literal(rows, REF)


def class_distance(ref: Column) -> Column:
    return _root(reduce(lambda a, b: a + b, [_apart(F.col(c) / F.greatest(F.col("_chars"), F.lit(1)), ref["classes"][i]) for i, c in enumerate(CLASSES)]))


def word_distance(counted: Column, n_words: Column, ref: Column) -> Column:
    """Distance of the common-word histograms, as a share of the distance that a
    text without any of the language's common words has (languages differ in how
    much such words say).  ``counted``: array of (w, n) of common words."""
    own = F.filter(F.transform(counted, lambda x: F.struct((x["n"] / F.greatest(n_words, F.lit(1))).alias("p"), ref["words"][x["w"]].alias("q"))),
                   lambda x: x["q"].isNotNull())
    zero = F.lit(0.0)
    return F.when(F.size(ref["words"]) == 0, zero).otherwise(let(own, lambda bins: (1 / ref["none"]) * _root(
        # bins that the document lacks have a part of q each
        ref["listed"] + F.aggregate(bins, zero, lambda acc, x: acc + _apart(x["p"], x["q"]) - x["q"])
        + let(F.greatest(F.lit(1.0) - F.aggregate(bins, zero, lambda acc, x: acc + x["p"]), zero),
              lambda rest: _apart(rest, ref["rest"])))))


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", refs: list[dict] | None = None,
          reference_words: int = REFERENCE_WORDS) -> DataFrame:
    """``docs`` plus the base counts, base_failed, kept, and the distances from
    the nearest language (class_distance, word_distance, near_lang)."""
    rest = replacing(docs, ADDED).columns
    own, at = by_place(docs)
    refs = references(own, at[text_col], at[lang_col], reference_words) if refs is None else refs
    listed = sorted({w for r in refs for w in r["words"]})
    lang = F.col(at[lang_col]).cast("string") if lang_col in at else F.lit(None).cast("string")
    foreign = lang.isNotNull() & ~_among(lang, [r["lang"] for r in refs]) if refs else F.lit(True)
    d = measured(own.withColumn("_foreign", foreign), at[text_col], listed).drop("_words")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    def far(x: Column) -> Column:
        return F.greatest(F.when(F.col("_chars") >= MIN_CHARS, x["c"]).otherwise(F.lit(0.0)) / CLASS_DISTANCE,
                          F.when(F.col("n_words") >= MIN_WORDS, x["w"]).otherwise(F.lit(0.0))
                          / (WORD_DISTANCE + WORD_SLACK / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))))

    each = F.transform(_as_rows(refs), lambda r: F.struct(
        r["lang"].alias("lang"), class_distance(r).alias("c"), word_distance(F.col("_counted"), F.col("n_words"), r).alias("w")))
    near = F.array_min(F.transform(each, lambda x: F.struct(far(x).alias("far"), x["lang"].alias("lang"), x["c"].alias("c"), x["w"].alias("w"))))
    none = "cast(null as struct<far:double,lang:string,c:double,w:double>)"
    d = computed(d, _near=F.when(F.col("n_words") > 0, near) if refs else F.expr(none))
    d = d.withColumns({"base_failed": failed, "kept": ~failed & (F.col("_foreign") | F.coalesce(F.col("_near.far") <= 1, F.lit(True))),
                       "class_distance": F.col("_near.c"), "word_distance": F.col("_near.w"), "near_lang": F.col("_near.lang")})
    return d.select(*[F.col(at[c]).alias(c) for c in rest], *ADDED)


def quality_report(docs: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "text", "lang")).select("doc_id", *BASE, "base_failed", "kept")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """``docs`` without the documents the rules reject."""
    own, at = by_place(docs)
    return judge(own, at[text_col], at[lang_col], **options).filter("kept").select(*[F.col(v).alias(c) for c, v in at.items()])
