import hashlib
import random
import zlib

import duckdb
import pytest

from conftest import SF_SMALL
from tastemap.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """The trie as nested dictionaries."""
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        full[c] = own.get(base, [])[:h] + own[c][h:]
    members = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    out, memo = [], {}
    for path in sorted(members, key=len, reverse=True):
        below = [memo[k] for k in kids.get(path, [])]
        size = len(path[-1][1].encode()) if path else 0
        memo[path] = (sum(b[0] for b in below) if below else 1, sum(b[1] for b in below) + (len(members[path]) - 1) * size)
        ends = ",".join(str(c) for c in sorted(members[path]) if len(full[c]) == len(path))
        out.append((min(members[path]), len(path), min(members[path[:-1]]) if path else None, len(members[path]), len(below), *memo[path],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, parts=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts).selectExpr("*", "1 as conv", "2 as depth", "'k' as key", "3 as place", "4 as n", "5 as up")
    got = trie.prefix_trie(df)
    assert got.columns == COLUMNS
    got = sorted(map(tuple, got.collect()), key=str)
    assert got == plain(rows)
    return got


def family(seed, convs=60, longest=12, words=3):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(r.randrange(1, longest)):
            rows.append((c, t, r.choice(["user", "bot"]) if t % 3 else "user", f"{'é' * (t % 4)}{r.randrange(words) if t > 4 else 'same'}"))
    return rows


@pytest.mark.parametrize("limit, block, stretch, few", [(1 << 14, 256, 4096, 1024), (20, 256, 2, 1024), (1, 256, 4096, 0), (6, 4, 3, 1024), (1 << 14, 3, 1, 1024), (2, 1, 4096, 2)])
def test_against_nested_dictionaries(spark, monkeypatch, limit, block, stretch, few):
    for name, value in (("LIMIT", limit), ("BLOCK", block), ("STRETCH", stretch), ("FEW", few)):
        monkeypatch.setattr(trie, name, value)
    check(spark, family(limit + block))


def test_awkward_rows(spark, monkeypatch):
    rows = [(0, 0, None, None), (0, None, "user", "first"), (0, 0, None, None), (1, 0, "user", "x"), (None, 0, "user", "lost"), (4, 3, "a", "1:b"),
            (4, 3, "a1", ":b"), (9, 0, "user", ""), (2**40 + 1, 1, "user", "far"), (-3, 0, "user", "x"), (-3, 1, "bot", "y"), (-5, 0, "user", "z"),
            (-1, 0, "user", "z"), (7, 0, "", "q" * 3000), (7, 1, "", "q" * 3000)]
    rows += [(c, t, "user", "copy") for c in range(20, 60) for t in range(9)]
    check(spark, rows)
    monkeypatch.setattr(trie, "LIMIT", 3)
    check(spark, rows)
    check(spark, rows[:1])
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).collect() == []
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_conversation_and_snapshots_of_it(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 16)
    turns = [("user" if i % 2 else "bot", f"t{i}") for i in range(100)]
    rows = [(c * 5, t, *turns[t]) for c, size in enumerate([100, 100, 3, 16, 32, 33, 99, 48, 100]) for t in range(size)]
    rows += [(500, 16 + t, "user", "other") for t in range(70)]
    check(spark, rows)


def test_query_matches_duckdb(spark):
    con = duckdb.connect()
    con.register("conversations", spark.read.parquet(f"{SF_SMALL}/conversations.parquet").toArrow())
    want = con.execute(trie.OP12_SQL).fetchall()
    got = trie.op12(spark, SF_SMALL).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
