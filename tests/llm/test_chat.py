import duckdb

from tastemap.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def turns(n, tag="t"):
    return [("user" if i % 2 == 0 else "assistant", f"{tag}{i}") for i in range(n)]


def log(*convs):
    return [(c, i, r, t) for c, ts in convs for i, (r, t) in enumerate(ts)]


def both(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, chat.render(df.selectExpr("*", "1 as key", "2 as place", "3 as size")).collect()), key=str)
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    if rows:
        con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    assert got == sorted(con.execute(chat.OP2_SQL).fetchall(), key=str)
    return got


def test_snapshots_collapse_to_the_longest(spark):
    full = turns(6)
    rows = log(*[(i, full[:i]) for i in range(1, 7)], (20, full[:3] + turns(2, "other")), (21, full), (22, turns(3, "new")))
    assert {r[0] for r in both(spark, rows)} == {6, 20, 22}


def test_awkward_rows(spark):
    rows = log((1, turns(2)), (2, turns(2))) + [(3, 0, None, None), (3, 1, "user", ""), (None, 0, "user", "x"), (None, None, "user", "y"),
                                               (4, 0, "user", "t0"), (4, 0, "user", "t0"), (4, 0, "user", "a tie"), (5, None, None, None)]
    both(spark, rows)


def test_empty_table(spark):
    assert both(spark, []) == []


def test_long_conversation_spans_blocks(spark):
    full = turns(700)
    got = both(spark, log((1, full), (2, full[:600]), (3, full[:256]), (4, full[:257] + turns(1, "z")), (5, full[300:])))
    assert {(r[0], r[1]) for r in got} == {(1, 0), (1, 1), (1, 2), (4, 0), (4, 1), (5, 0), (5, 1)}
