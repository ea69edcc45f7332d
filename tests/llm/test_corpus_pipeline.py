"""The corpus pipeline against a plain version built from DuckDB, all pairs, regular expressions and the tokenizers library."""

import numpy as np
import public_tokenizers
import tokenizers

import corpus_pipeline
import duck
import messy
from conftest import SF_SMALL
from tastemap.llm import contain, pii, quality
from test_minhash import brute
from test_pii import plain


def expected(docs, benchmark):
    """doc_id -> text after the first three stages."""
    judged = duck.rows(quality.OP8_SQL, documents=docs.select("doc_id", "text", "lang", "source").toArrow())
    good = {r["doc_id"] for r in judged if r["kept"]}
    text = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    groups = brute(list(text.items()), 5)
    text = {i: t for i, t in text.items() if groups[i][1] == i}
    left = docs.filter(docs.doc_id.isin(list(text))).select("doc_id", "text").toArrow()
    leaked = {r["doc_id"] for r in duck.rows(contain.OP7_SQL, documents=left, benchmark=benchmark.toArrow())}
    return {i: t for i, t in text.items() if i not in leaked}


def test_run_matches_plain_version(spark):
    docs, bench = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    want = expected(docs, bench)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert got.keys() == want.keys() and 0 < len(got) < docs.count()
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    masked = 0
    for i, text in want.items():
        r = got[i]
        assert r.ids == library.encode(r.text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        assert r.n_chars == len(r.text) and not plain(r.text)
        spans = plain(text)
        if not spans and not np.isin(pii.codes_of(text), [pii.CODE[ord(c)] for c in "0123456789@"]).any():
            assert r.text == text
        masked += bool(spans)
        assert all(r.text.count(f"<{k.upper()}>") >= sum(s[1] == n for s in spans if not any(
            o[0] < s[0] < o[2] for o in spans)) for n, k in enumerate(pii.KINDS))
    assert masked > 0


def test_stage_list_and_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontaminate", "pii", "bpe"]
    docs = messy.docs(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == messy.docs(spark).columns, name
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert {"doc_id", "text", "ids", "n_tokens"} <= set(out.columns) and out.count() >= 0


def test_near_duplicates_are_told_by_text_not_by_id(spark):
    out = corpus_pipeline.dedup_stage(spark, messy.docs(spark), SF_SMALL).collect()
    ids = [r.doc_id for r in out]
    assert ids.count(1) == 1 and 2 not in ids and ids.count(12) == 2
    assert {3, 4, 5, 6} <= set(ids) and (None, "one two") not in [(r.doc_id, r.text) for r in out]
    assert all(r["_row_key"] == messy.CLASHES.index("_row_key") and r["_row"] == messy.CLASHES.index("_row") for r in out)
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(None, long + " x", "en", "a"), (9, long, "en", "a"), (5, long + " y", "en", "a"), (5, "quite another text", "en", "a"), (None, None, None, None), (None, None, None, None)]
    out = corpus_pipeline.dedup_stage(spark, messy.docs(spark, rows), SF_SMALL)
    assert sorted([(r.doc_id, r.text) for r in out.collect()], key=str) == sorted([(5, long + " y"), (5, "quite another text"), (None, None), (None, None)], key=str)


def test_stages_on_an_empty_table(spark):
    docs = messy.docs(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0
