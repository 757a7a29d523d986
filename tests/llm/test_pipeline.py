from __future__ import annotations

import pytest

import corpus_pipeline as P
from pregame.llm import decontaminate, langid, packing, quality
from test_simhash import groups, slow_print

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in quality.judge(docs).collect() if r.kept}
    first = docs.filter(docs.doc_id.isin(*good))
    ids = sorted(good)
    named = langid.Scorer(langid.train(first)).texts([rows[d] for d in ids])
    known = {d for d, (lang, _, certainty) in zip(ids, named) if lang != "und" and certainty >= langid.MIN_CERTAINTY}
    prints = {d: slow_print(rows[d]) for d in known}
    comp = groups([(d, p) for d, p in prints.items()])
    single = {d for d in known if comp[prints[d]] == d}
    items = [w for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() for w in decontaminate.windows(r.text.encode())]
    clean = set()
    for d in single:
        norm = " " + " ".join(x.decode("latin-1") for x in rows[d].encode().translate(decontaminate.NORMAL).split()) + " "
        if not any(w in norm for w in items):
            clean.add(d)
    out = P.run(spark, SF)
    got = out.collect()
    assert {r.doc_id for r in got} == clean and len(clean) > 50
    want = packing.pieces(docs.filter(docs.doc_id.isin(*clean)))
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, got)) == sorted(map(key, want.collect()))


def test_stages_keep_the_columns(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in P.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns
        assert P.STAGES[-1][1](spark, docs, SF).filter("piece = 0").count() == docs.count()


def test_registered():
    import __spark_entry__ as E
    names = E.queries()
    assert "pipeline" in names and [n for n in range(1, 14) if not any(k.startswith(f"op{n}_") for k in names)] == []
    assert set(E.oracle_sql()) <= set(names)


@pytest.mark.parametrize("key", ["op1_revisits", "op2_decontaminate", "op7_quality", "op11_secrets"])
def test_oracles(spark, key):
    import __spark_entry__ as E
    from oracle_check import compare, duck
    r = compare(spark, duck(SF), key, E.queries()[key], E.oracle_sql()[key], SF)
    assert r["cols_match"] and r["rows"] == r["oracle_rows"] and r["hash_match"], r
