"""DuckDB side of the comparisons."""

import duckdb


def rows(sql, **tables):
    """Rows of ``sql`` over pandas or Arrow ``tables``, each a dict by column name."""
    con = duckdb.connect()
    for name, t in tables.items():
        con.register(name, t)
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    return [dict(zip(names, r)) for r in rel.fetchall()]


def same(got, want):
    key = lambda r: sorted((k, str(v)) for k, v in r.items())
    assert sorted(map(key, (r.asDict() for r in got))) == sorted(map(key, want))
