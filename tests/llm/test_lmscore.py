import collections
import math
import re
import types
import uuid
import zlib

import numpy as np
import pytest
from pyspark import cloudpickle

import messy
from conftest import SF_MID
from tastemap.llm import gru, lmscore
from tastemap.llm.frames import crc_mod

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")) + ["\0"]


def check_base(rows, got):
    """``got``: (id, n_tokens, n_known, train_tokens, base_score) in any order, against plain counting."""
    c = collections.Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2 or i is None:
            c.update(words(t))
    n, v = sum(c.values()), len(c)
    want = sorted(((i, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
                   for i, w in ((i, words(t)) for i, t in rows)), key=str)
    got = sorted(got, key=str)
    assert [w[:4] for w in want] == [g[:4] for g in got]
    assert np.allclose([w[4] for w in want], [g[4] for g in got], rtol=1e-9)


def score(spark, docs):
    learn = docs.filter(crc_mod("doc_id", 7) != 2)
    counts = lmscore.word_counts(learn).cache()
    vocab = lmscore.vocabulary(counts)
    return lmscore.score(docs, counts, vocab, lmscore.fit(learn, vocab)).collect(), vocab


@pytest.mark.parametrize("common", [lmscore.COMMON, 20])
def test_awkward_rows_and_tail_words(spark, monkeypatch, common):
    monkeypatch.setattr(lmscore, "COMMON", common)
    got, _ = score(spark, messy.docs(spark))
    check_base([(i, t) for i, t, _, _ in messy.TEXTS], [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got])
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_empty_tables(spark):
    assert score(spark, messy.docs(spark, []))[0] == []
    learn = messy.docs(spark, [])
    counts = lmscore.word_counts(learn)
    vocab = lmscore.vocabulary(counts)
    got = lmscore.score(messy.docs(spark), counts, vocab, lmscore.fit(learn, vocab)).collect()
    assert {r.train_tokens for r in got} == {0} and {r.base_score for r in got} == {0.0} and len(got) == len(messy.TEXTS)


def small(seed=0):
    r = np.random.default_rng(seed)
    p = gru.new(r.integers(0, 50, gru.FREQ), r.integers(1, 50, gru.RARE))
    return {k: (v + 0.1 * r.standard_normal(v.shape)).astype(np.float32) for k, v in p.items()}, r


def test_state_is_carried_over_windows(monkeypatch):
    p, r = small()
    ids = r.integers(0, gru.FREQ + gru.RARE, 500)
    bound = np.array([0, 1, 200, 200, 350, 500])
    whole = gru.log_likelihood(p, ids, bound)
    monkeypatch.setattr(gru, "SCORE_WINDOW", 7)
    assert np.allclose(whole, gru.log_likelihood(p, ids, bound), rtol=1e-5)
    assert whole[2] == 0


def test_token_shares_sum_to_one():
    p, _ = small()
    for before in ([], [5], [gru.FREQ + 3, 9]):
        docs = [before + [i] for i in range(gru.FREQ + gru.RARE)]
        bound = np.append(0, np.cumsum([len(d) for d in docs]))
        with_ = gru.log_likelihood(p, np.concatenate(docs).astype(int), bound)
        rest = gru.log_likelihood(p, np.array(before, int), np.array([0, len(before)]))[0] if before else 0.0
        assert abs(np.exp(with_ - rest).sum() - 1) < 1e-3


def test_gradients():
    p, r = small(1)
    p = {k: v.astype(np.float64) for k, v in p.items()}
    ids = r.integers(0, gru.FREQ + gru.RARE, (2, 6))
    before = np.concatenate([np.full((2, 1), gru.START), ids[:, :-1]], 1)
    fresh = np.zeros((2, 6), bool)
    fresh[:, 0] = True
    zero = lambda: {k: np.zeros_like(v) for k, v in p.items()}
    m = zero()
    gru._update(dict(p), m, zero(), 1, before, ids, fresh, np.zeros((2, gru.HIDDEN)), 0.0)
    loss = lambda q: -gru.log_likelihood(q, ids.ravel(), np.array([0, 6, 12])).sum() / 12
    for k in p:
        at = tuple(np.argwhere(np.abs(m[k]) == np.abs(m[k]).max())[0])
        q = {n: v.copy() for n, v in p.items()}
        q[k][at] += 1e-3
        up = loss(q)
        q[k][at] -= 2e-3
        assert abs((up - loss(q)) / 2e-3 - 10 * m[k][at]) < 1e-2 * abs(10 * m[k][at]) + 2e-4, k


def test_model_beats_counts_on_held_out_documents(spark):
    got = lmscore.op4(spark, SF_MID).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert sum(r.score > r.base_score for r in held) > 0.75 * len(held)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()]
    check_base(rows, [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got])


def test_every_training_document_is_trained_on_once(spark, monkeypatch, tmp_path):
    """The tokens that pass through training are those of the training table, rows without an id among them."""
    docs = messy.docs(spark, messy.TEXTS + [(None, f"no number {i} here", "en", "a") for i in range(40)]
                      + [(100 + i, f"the text of number {i}", "en", "a") for i in range(200)])
    train, out = gru.train, str(tmp_path)

    def noted(p, ids, first, rate):
        with open(f"{out}/{uuid.uuid4().hex}", "w") as f:
            f.write(f"{len(ids)} {int(first.sum())}")
        return train(p, ids, first, rate)

    monkeypatch.setattr(lmscore, "gru", types.SimpleNamespace(**{**vars(gru), "train": noted}))
    # tasks get ``fit`` by value, so that what is noted is what they run
    cloudpickle.register_pickle_by_value(lmscore)
    try:
        vocab = lmscore.vocabulary(lmscore.word_counts(docs))
        lmscore.fit(docs, vocab)
    finally:
        cloudpickle.unregister_pickle_by_value(lmscore)
    seen = [tuple(map(int, f.read_text().split())) for f in tmp_path.iterdir()]
    assert sum(n for n, _ in seen) == vocab.total
    assert sum(d for _, d in seen) == docs.count()


@pytest.mark.parametrize("shard", [lmscore.SHARD_TOKENS, 2000])
def test_scores_do_not_follow_the_partitions(spark, monkeypatch, shard):
    """The same rows in 1, 4 and 9 partitions, with copies and rows without an id, give the same scores."""
    monkeypatch.setattr(lmscore, "SHARD_TOKENS", shard)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").filter("doc_id < 120")
    docs = docs.union(spark.createDataFrame([(None, "the same few words again")] * 70 + [(5000, "a copy of a row")] * 9, docs.schema))
    seen = []
    for n in (1, 4, 9):
        got, _ = score(spark, docs.repartition(n))
        seen.append(sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 6), r.score) for r in got))
    for other in seen[1:]:
        assert [r[:3] for r in other] == [r[:3] for r in seen[0]]
        assert np.allclose([r[3] for r in other], [r[3] for r in seen[0]], rtol=1e-4)


def test_copies_are_dealt_over_all_shards(spark, monkeypatch):
    """No shard takes more than its share of a group of equal rows, and none is lost."""
    monkeypatch.setattr(lmscore, "SHARD_TOKENS", 100)
    kept, real = [], lmscore.saved
    monkeypatch.setattr(lmscore, "saved", lambda df, name: kept.append((name, real(df, name))) or kept[-1][1])
    docs = spark.createDataFrame([(None, "one two three")] * 301 + [(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    lmscore.fit(docs, lmscore.vocabulary(lmscore.word_counts(docs)))
    dealt = next(d for n, d in kept if n == "lm-dealt")
    rows = dealt.groupBy("key", "slot").agg({"times": "sum"}).collect()
    hot = [r[2] for r in rows if r.key == max(rows, key=lambda x: x[2]).key]
    assert sum(r[2] for r in rows) == 351
    assert sum(hot) == 301 and max(hot) - min(hot) <= 1 and len(hot) > 10


def test_long_documents_share_their_softmax(monkeypatch):
    """The windows of a few long documents wait for one another: few calls, whatever the number of windows."""
    r = np.random.default_rng(0)
    p = gru.new(np.arange(gru.FREQ, 0, -1), np.ones(gru.RARE))
    ids, calls, plain = r.integers(0, gru.FREQ + gru.RARE, 20_000), [], gru._softmax
    monkeypatch.setattr(gru, "_softmax", lambda *a: calls.append(1) or plain(*a))
    assert np.isfinite(gru.log_likelihood(p, ids, np.array([0, 19_000, 20_000]))).all()
    assert len(calls) < 200


@pytest.mark.parametrize("scale", [1, 2000])
def test_scores_beyond_the_range_of_exp(scale):
    """Scores that could overflow are moved by their largest; others give the same without it."""
    r = np.random.default_rng(1)
    p = gru.new(np.arange(gru.FREQ, 0, -1), np.ones(gru.RARE))
    p["Wc"] = (r.standard_normal(p["Wc"].shape) * 0.2 * scale).astype(np.float32)
    p["Ww"] = (r.standard_normal(p["Ww"].shape) * 0.2 * scale).astype(np.float32)
    assert gru._small(gru._join(p["Wc"], p["bc"])) == gru._small(gru._join(p["Ww"], p["bw"])) == (scale == 1)
    ids = r.integers(0, gru.FREQ + gru.RARE, 40)
    h, before, want = np.zeros(gru.HIDDEN), gru.START, 0.0
    share = lambda x, i: x[i] - x.max() - np.log(np.exp(x - x.max()).sum())
    for i in ids:
        x, y = p["E"][before].astype(float) @ p["Wx"] + p["bx"], h @ p["Wh"]
        g = 1 / (1 + np.exp(-(x + y)[:2 * gru.HIDDEN]))
        cand = np.tanh(x[2 * gru.HIDDEN:] + g[:gru.HIDDEN] * y[2 * gru.HIDDEN:])
        h, before = (h - cand) * g[gru.HIDDEN:] + cand, i
        c = i // gru.CLASS_WORDS if i < gru.FREQ else i - gru.FREQ + gru.CLASSES
        want += share(h @ p["Wc"] + p["bc"], c)
        if i < gru.FREQ:
            want += share(h @ p["Ww"][c] + p["bw"][c], i % gru.CLASS_WORDS)
    assert np.allclose(gru.log_likelihood(p, ids, np.array([0, 40])), want, rtol=1e-4)
