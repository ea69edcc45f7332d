import hashlib
import random
import re

import numpy as np
import pytest

import messy
from tastemap.llm import pii
from tastemap.llm.tagger import Tagger

SF_LARGE = "/root/testdata/sf0.1"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return sorted(out + [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15])


def test_patterns_match_plain_expressions():
    r = random.Random(5)
    bits = ["a", "b.", "@", "x", "1", "22", "333", "0", "4111 1111 1111 1111", "-", " ", ".", "+1", "(", "1.2.3.4", "é", "a@b.c", "\n", "@@"]
    for _ in range(5000):
        text = "".join(r.choice(bits) for _ in range(r.randrange(1, 25)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_are_linear():
    assert pii.base_spans("a" * 300_000 + "@" + "b" * 300_000 + ".c") == [(0, 0, 600_003)]
    assert pii.base_spans("1" * 300_000) == []


def test_gradients():
    m = Tagger(9, 5, np.ones((5, 5), bool), width=3, hidden=2)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    codes, tags = np.random.default_rng(0).integers(0, 9, (3, 6)), np.random.default_rng(1).integers(0, 5, (3, 6))
    _, grad = m.step(codes, tags)
    for k in m.p:
        at = tuple(np.argwhere(np.abs(grad[k]) == np.abs(grad[k]).max())[0])
        m.p[k][at] += 1e-4
        up = m.step(codes, tags)[0]
        m.p[k][at] -= 2e-4
        down = m.step(codes, tags)[0]
        m.p[k][at] += 1e-4
        assert abs((up - down) / 2e-4 - grad[k][at]) < 1e-3 * max(1, abs(grad[k][at])), k


def test_windows_cover_every_trigger():
    r = np.random.default_rng(2)
    for _ in range(100):
        code = np.where(r.random(r.integers(1, 900)) < 0.02, pii.CODE[ord("5")], pii.CODE[ord("a")]).astype(np.uint8)
        covered = np.zeros(len(code), bool)
        for s in pii.window_starts(code):
            covered[s:s + pii.LENGTH] = True
        for t in np.flatnonzero(code == pii.CODE[ord("5")]):
            assert covered[max(0, t - pii.REACH):t + pii.REACH + 1].all()


def test_reconcile():
    text = "     4111 1111 1112 x@y.zz" + " " * 15 + "1.1.1.1" + "5" * 40
    found = [(5, 12, 2, 0.95), (10, 19, 2, 0.99), (18, 26, 0, 0.97), (41, 48, 1, 0.5), (60, 70, 3, 0.99), (24, 30, 2, 0.99)]
    assert pii.reconcile(found, [(65, 0, 80)], text) == [(5, 2, 19)]


@pytest.fixture(scope="module")
def params(spark):
    docs = spark.read.parquet(f"{SF_LARGE}/documents.parquet")
    return pii.train(docs.filter("crc32(cast(doc_id as string)) % 3 <> 1"))


def test_tagger_alone_finds_held_out_spans(spark, params):
    docs = spark.read.parquet(f"{SF_LARGE}/documents.parquet").filter("crc32(cast(doc_id as string)) % 3 = 1").select("text").collect()
    model, hit, wrong, total = pii.load(params), 0, 0, 0
    for (text,) in docs:
        code = pii.codes_of(text)
        starts = pii.window_starts(code)
        if len(starts):
            path, sure = model.decode(pii.cut(code, starts).astype(np.int64))
            got = set(pii.reconcile([(int(starts[w]) + a, int(starts[w]) + b, k, s) for w, a, b, k, s in pii.window_spans(path, sure)], [], text))
            want = set(pii.base_spans(text))
            hit, wrong, total = hit + len(got & want), wrong + len(got - want), total + len(want)
    assert total > 100 and hit >= 0.85 * total and wrong <= 0.1 * total


@pytest.mark.parametrize("with_model", [True, False])
def test_awkward_rows(spark, params, with_model):
    got = pii.find(messy.docs(spark), params if with_model else None).collect()
    base = messy.by_row([{"i": r.doc_id, "b": [tuple(x) for x in r.base]} for r in got], "i", "b")
    assert base == sorted(((i, plain(t or "")) for i, t, _, _ in messy.TEXTS), key=str)
    assert all({tuple(x) for x in r.base} <= {tuple(x) for x in r.all_spans} for r in got)


def test_query_against_plain_patterns(spark, tmp_path):
    messy.docs(spark).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    got = pii.op5(spark, str(tmp_path)).collect()
    assert len(got) == len(messy.TEXTS)
    assert list(pii.KINDS) == ["email", "ip", "card", "phone"]
    want = []
    for i, text, _, _ in messy.TEXTS:
        spans = plain(text or "")
        said = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans]
        want.append((i, *[sum(k == n for _, k, _ in spans) for n in range(4)], hashlib.sha256(",".join(said).encode()).hexdigest(), tuple(said)))
    have = [(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got]
    assert sorted(have, key=str) == sorted((w[:6] for w in want), key=str)
    base = {w[0]: set(w[6]) for w in want if w[0] is not None and w[0] not in (1, 12)}
    for r in got:
        every = [x for x in r.spans.split(",") if x]
        place = [(int(x.split(":")[1]), pii.KINDS.index(x.split(":")[0])) for x in every]
        assert place == sorted(place) and base.get(r.doc_id, set()) <= set(every) and len(every) - r.n_added == r.n_email + r.n_ip + r.n_card + r.n_phone


def test_redact_keeps_everything_else(spark, params):
    docs = messy.docs(spark)
    out = pii.redact(docs, params)
    assert out.schema == docs.schema
    rows = {(r.doc_id, r.lang): r.text for r in out.collect()}
    assert rows[9, "en"] == "mail <EMAIL> or <IP>, card <CARD> or <PHONE>"
    assert rows[3, "en"] is None and rows[4, None] == "" and rows[7, "en"] == messy.LONG


def test_empty_table(spark):
    assert pii.train(messy.docs(spark, [])) is None
    assert pii.find(messy.docs(spark, []), None).count() == 0
