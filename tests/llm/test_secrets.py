import contextlib
import hashlib
import io
import math
import random
import re
import string
import time

import pytest
from pyspark.sql import functions as F

import messy
from conftest import SF_SMALL
from tastemap.llm import secrets

PATTERNS = [("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
            ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
            ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24)]


def plain(text):
    return sorted((m.start(), i, m.end()) for i, (_, p, ok) in enumerate(PATTERNS) for m in p.finditer(text) if ok(m))


def as_text(spans):
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_places_of_patterns(spark):
    r = random.Random(3)
    bits = ["token", "secret=", "PassWord : ", '"', "=", ":", "abcdef", "apikey", "api_key='", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "é", " ",
            "\n", "x", ".", "😀"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randrange(1, 20))), "en", "s") for i in range(1500)]
    got = secrets.find_secrets(spark.createDataFrame(rows, messy.SCHEMA)).collect()
    want = {i: plain(t) for i, t, _, _ in rows}
    assert sum(map(len, want.values())) > 300
    for x in got:
        assert [tuple(s) for s in x.base] == want[x.doc_id], rows[x.doc_id][1]
        assert (x.n_assign, x.n_access, x.n_hex) == tuple(sum(s[1] == k for s in want[x.doc_id]) for k in range(3))


def ordinary(r, n):
    syl = ["th", "an", "er", "on", "in", "ed", "es", "tion", "ble", "ha", "at"]
    return ["".join(r.choices(syl, k=9))[:r.randrange(16, 24)].ljust(16, "e") for _ in range(n)]


def test_battery_finds_random_tokens_and_leaves_names_alone(spark):
    r = random.Random(1)
    keys = ["".join(r.choices(string.ascii_letters + string.digits, k=r.choice([24, 32, 40]))) for _ in range(300)]
    names = [f"my_variable_name_{i}_of_things" for i in range(100)] + [f"2024-01-{i % 30:02d}_report-final-v{i}" for i in range(60)]
    rows = [(i, f"see {k} and {w}", "en", "s") for i, (k, w) in enumerate(zip(keys + names + ordinary(r, 4000), ordinary(r, 4460)))]
    got = secrets.find_secrets(spark.createDataFrame(rows, messy.SCHEMA)).collect()
    hit = {x.doc_id: [tuple(s) for s in x.all_spans] for x in got if len(x.all_spans)}
    assert sum(i < 300 for i in hit) > 100 and sum(i >= 300 for i in hit) <= 0.1 * len(hit)
    assert all(v == [(4, 3, 4 + len(keys[i]))] for i, v in hit.items() if i < 300)


def test_statistic_by_hand(spark):
    """One token against a plain computation."""
    token = "Ab9" * 7
    s = secrets.ALPHABETS["base64"][1]
    x = [s.index(c) + 1 for c in token]
    n, a = len(x), len(s)
    chi = a / n * sum(x.count(v) ** 2 for v in set(x)) - n
    df = a - 1
    z1 = max(0, ((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / (2 / (9 * df)) ** 0.5)
    h = [2 * v > a for v in x]
    n1 = sum(h)
    mu = 2 * n1 * (n - n1) / n + 1
    z2 = (1 + sum(p != q for p, q in zip(h, h[1:])) - mu) / max((mu - 1) * (mu - 2) / (n - 1), 0.25) ** 0.5
    d = [v - sum(x) / n for v in x]
    z3 = sum(p * q for p, q in zip(d, d[1:])) / sum(v * v for v in d) * n ** 0.5
    got = secrets.battery(spark.createDataFrame([(token,)], "m string")).first()
    assert got.encoding == "base64" and not got.plain and abs(got.statistic - (z1 ** 2 + z2 ** 2 + z3 ** 2)) < 1e-6


def test_awkward_rows(spark):
    got = secrets.find_secrets(messy.docs(spark)).collect()
    have = messy.by_row([{"i": r.doc_id, "b": [tuple(s) for s in r.base]} for r in got], "i", "b")
    assert have == sorted(((i, plain(t or "")) for i, t, _, _ in messy.TEXTS), key=str)


def test_query_digest(spark):
    docs = dict(tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    got = secrets.op10(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        want = as_text(plain(docs[r.doc_id] or ""))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest() and (r.n_random or r.spans == want)


def test_empty_table(spark):
    assert secrets.find_secrets(messy.docs(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        secrets.scan(messy.docs(spark)).explain()
        secrets.discoveries(secrets.battery(spark.createDataFrame([("abc" * 8,)], "m string"))).explain()
    assert "Python" not in buf.getvalue() and "Arrow" not in buf.getvalue()


@pytest.mark.parametrize("n", [20, 24, 32, 40, 64])
def test_recall_per_length_without_words_of_that_length(spark, n):
    """Random strings are found at every length, also in a table of a few rows and with no ordinary token beside them."""
    r = random.Random(n)
    keys = ["".join(r.choices(string.ascii_letters + string.digits, k=n)) for _ in range(60)]
    words = "".join(f"the_name_of_variable_{i}_and_its_long_other_name_in_the_table"[:n].ljust(n, "e") + " " for i in range(10)).split()
    ramp = (string.ascii_lowercase + string.digits) * 2
    rows = [(i, f"see {k} here", "en", "s") for i, k in enumerate(keys + words + [ramp[:n - 1] + "7", "Ab9" * (n // 3)])]
    hit = {x.doc_id for x in secrets.find_secrets(spark.createDataFrame(rows, messy.SCHEMA)).collect() if len(x.all_spans)}
    assert sum(i < 60 for i in hit) >= (54 if n >= 32 else 40) and not any(i >= 60 for i in hit)


def test_places_of_very_many_matches(spark):
    """Blocks of the walk: numbers of matches around their width, and 20,000 in one text."""
    r = random.Random(9)
    hexes = ["".join(r.choices("0123456789abcdef", k=r.randrange(24, 40))) for _ in range(20_000)]
    n = secrets.WALK
    rows = [(i, ("" if i % 2 else "ü ") + " -😀".join(hexes[:k]) + ("" if i % 3 else " end"), "en", "s")
            for i, k in enumerate([0, 1, n - 1, n, n + 1, 2 * n, 3 * n - 1, 20_000])]
    docs = spark.createDataFrame(rows, messy.SCHEMA)
    t = time.time()
    got = docs.select("doc_id", secrets.places(F.col("text"), secrets.HEX).alias("x")).collect()
    assert time.time() - t < 15
    for x in got:
        assert [(s.s, s.e, s.m) for s in x.x] == [(m.start(), m.end(), m[0]) for m in re.finditer(r"[0-9a-f]{24,}", rows[x.doc_id][1])]


def test_one_document_alone(spark):
    key = "q7Zt0LxV9bKd3RmWc5YhTn8JpEu2GsAf"
    got = secrets.find_secrets(spark.createDataFrame([(1, f"see {key}", "en", "s")], messy.SCHEMA)).first()
    assert [tuple(s) for s in got.all_spans] == [(4, 3, 36)]


def test_normal_shares(spark):
    xs = [-8.0, -5.0, -3.0, -1.0, 0.0, 0.5, 2.0, 6.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", secrets.normal(F.col("x")).alias("p")).collect()
    assert all(abs(r.p / (0.5 * math.erfc(-r.x / 2 ** 0.5)) - 1) < (1e-4 if r.x > -4 else 0.02) for r in got)
