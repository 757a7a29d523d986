from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pregame.llm import marks
from pregame.llm import secret_scan as S


def slow_spans(text, rules=S.RULES):
    out = []
    for k, r in enumerate(rules):
        p = re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0))
        out += [(m.start(), k, m.end(), r.kind) for m in p.finditer(text or "") if len(m.group(r.group)) >= r.least]
    return sorted(out)


def planted(rng):
    """Secrets, near misses and text around them."""
    word = lambda n, a: "".join(rng.choice(a) for _ in range(n))
    hexa, big, mixed = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCxyz019"
    makers = [
        lambda: f"password{rng.choice(['', chr(34), chr(39)])}{' ' * rng.randrange(3)}{rng.choice(':=')}{' ' * rng.randrange(2)}{word(rng.choice([7, 8, 20]), mixed)}",
        lambda: f"Api_Key={word(9, mixed)}", lambda: f"APIKEY: \"{word(12, mixed + '+/_.=-')}\"", lambda: "token=secret:abcdefghij", lambda: "token==abcdefghi",
        lambda: f"AKIA{word(rng.choice([0, 11, 12, 16]), big)}", lambda: "AKIAAKIA" + word(12, big), lambda: word(rng.choice([31, 32, 33, 64]), hexa),
        lambda: "-----BEGIN RSA PRIVATE KEY-----", lambda: "-----BEGIN PUBLIC KEY-----", lambda: f"ghp_{word(rng.choice([35, 36]), mixed)}",
        lambda: f"eyJ{word(12, mixed)}.eyJ{word(12, mixed)}.{word(12, mixed)}", lambda: f"xoxb-{word(12, mixed)}", lambda: "AIza" + word(35, mixed),
        lambda: "sk_live_" + word(16, mixed), lambda: "https://me:pass@host/", lambda: "http://host/a:b@c", lambda: "plain words é漢\U0001F600", lambda: "\n",
        lambda: "ſecret=abcdefghij", lambda: "toKen=abcdefghij", lambda: "PASSWD = 'abc.def-ghi'", lambda: "the token was here", lambda: "secret secret secret"]
    return rng.choice(["", " ", "é "]).join(rng.choice(makers)() for _ in range(rng.randrange(1, 12)))


def test_queries():
    q = S.trigram_query
    assert q("AKIA[A-Z0-9]{12,}") == ("and", ("aki", "kia")) and q("[0-9a-f]{32,}") is True and q("ab") is True
    assert q("(abc|de)") is True and q("x(abc|bcd)?y") is True and q("(foo|bar)+") == ("or", ("bar", "foo"))
    assert q("ab[cd]e") == ("or", (("and", ("abc", "bce")), ("and", ("abd", "bde")))) and q("[^a]abcd") == ("and", ("abc", "bcd"))
    assert S.trigrams_of(q(S.ASSIGN)) >= {"pas", "swo", "tok", "ken", "pi_", "ret"}


@pytest.mark.parametrize("seed", range(3))
def test_every_match_satisfies_its_query(seed):
    rng = random.Random(seed)

    def holds(q, low):
        return q is True or (q in low if isinstance(q, str) else (all if q[0] == "and" else any)(holds(x, low) for x in q[1]))
    for _ in range(500):
        text = planted(rng)
        for _, k, _, _ in slow_spans(text):
            assert holds(S.trigram_query(S.RULES[k].pattern), text.lower())


def test_spans_against_definition(spark):
    rng = random.Random(11)
    texts = [planted(rng) for _ in range(400)] + [None, "", "token=abcdefgh " * 2000, "ab " * 5000]
    docs = spark.createDataFrame([(i % 390, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    for block in (3, 256):
        got = S.scan(docs, block_texts=block).collect()
        assert len(got) == len(texts)
        for r in got:
            assert [tuple(s) for s in r.secrets] == slow_spans(r.text), r.text


def test_report(spark, small_docs, odd_docs):
    for docs in (small_docs, odd_docs):
        want = []
        for r in docs.collect():
            s = slow_spans(r.text)
            line = lambda xs: ",".join(f"{x[3]}:{x[0]}:{x[2]}" for x in xs)
            want.append((r.doc_id, *[sum(x[3] == b.kind for x in s) for b in S.BASE],
                         hashlib.sha256(line([x for x in s if x[1] < 3]).encode()).hexdigest(), line(s)))
        assert sorted(map(tuple, S.secret_report(docs).collect()), key=str) == sorted(want, key=str)


def test_index_and_candidates(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["my Token", "tok then ken", "oke", "toke", None, "", "my Token"])], "doc_id long, text string")
    index = S.build_index(docs, ["tok", "oke", "ken"], block_texts=2)
    assert all(len(v) <= 7 for r in index.collect() for v in r.postings.values())
    got = {r.key for r in S.candidates(index, {0: S.trigram_query("token")}).collect()}
    assert got == {r[0] for r in docs.filter("doc_id IN (0, 6)").select(S.text_key(F.col("text"))).collect()} and len(got) == 1


def test_only_marked_texts_run_indexed_rules(spark):
    """A rule's expression does not run on texts whose bit is not set."""
    docs = spark.createDataFrame([(1, "token=abcdefgh"), (2, "nothing here")], "doc_id long, text string")
    found = S.candidates(S.build_index(docs, ["tok", "oke", "ken"]), {0: S.trigram_query("token")})
    d = docs.withColumn("key", S.text_key(F.col("text"))).withColumn("_slot", marks.slot(F.col("key")))
    hit = d.join(marks.bitmaps(found, "key", "rule"), "_slot", "left").select(
        "doc_id", marks.is_set(F.col("_bits"), marks.bit(F.col("key"), 0)).alias("hit"))
    assert {r.doc_id: r.hit for r in hit.collect()} == {1: True, 2: False}


def test_marks(spark):
    keys = spark.range(0, 3000, 3).select((F.xxhash64("id")).alias("key"))
    d = spark.range(3000).select("id", F.xxhash64("id").alias("key")).withColumn("_slot", marks.slot(F.col("key")))
    got = d.join(marks.bitmaps(keys), "_slot", "left").select("id", marks.is_set(F.col("_bits"), marks.bit(F.col("key"))).alias("hit")).collect()
    assert all(r.hit for r in got if r.id % 3 == 0) and sum(r.hit for r in got if r.id % 3) < 5


def test_native_and_clashing(spark, clashing, no_docs):
    d = clashing.select("*", *[F.lit("x").alias(c) for c in ("gram", "low", "Secrets", "postings", "keys", "block")])
    out = S.scan(d)
    assert out.columns == [c for c in d.columns if c != "Secrets"] + ["secrets"] and out.count() == d.count()
    assert S.scan(no_docs).count() == 0 and S.secret_report(no_docs).count() == 0
    plan = S.secret_report(clashing)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
