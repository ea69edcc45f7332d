"""DuckDB text of the fixtures and shared steps, for the oracle queries.

Each entry is one CTE; :func:`with_ctes` puts the needed ones, with their
dependencies, in front of a query body. The rules mirror
:mod:`tastemap.sources.fixtures` and the operators, written independently
as plain SQL so that the two engines check each other.
"""

from __future__ import annotations

CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "ratings": ("""ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(ceil(l_quantity / 10) AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""", ()),
    "clean": ("""clean AS (
  SELECT DISTINCT user_id, item_id, rating FROM ratings
  WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND rating IS NOT NULL
    AND NOT isnan(rating) AND rating BETWEEN 1 AND 5)""", ("ratings",)),
    "picks": ("""picks AS (
  SELECT user_id, item_id, rating FROM (
    SELECT user_id, item_id, rating,
           row_number() OVER (PARTITION BY user_id
             ORDER BY md5(concat_ws('|', user_id, item_id, 42)), item_id, rating) AS rn,
           count(*) OVER (PARTITION BY user_id) AS n
    FROM clean) s
  WHERE n >= 2 AND rn = 1)""", ("clean",)),
    "test": ("test AS (SELECT user_id, item_id, rating FROM picks)", ("picks",)),
    "train": ("""train AS (
  SELECT c.user_id, c.item_id, c.rating FROM clean c
  WHERE NOT EXISTS (SELECT 1 FROM picks p WHERE p.user_id = c.user_id
                    AND p.item_id = c.item_id AND p.rating = c.rating))""", ("clean", "picks")),
    "truth": ("truth AS (SELECT DISTINCT user_id, item_id FROM test WHERE rating >= 3)", ("test",)),
    "istats": ("""istats AS (
  SELECT item_id, count(*) AS item_rating_count, avg(rating) AS item_rating_mean
  FROM clean GROUP BY item_id)""", ("clean",)),
    "ustats": ("""ustats AS (
  SELECT user_id, count(*) AS user_rating_count, avg(rating) AS user_rating_mean
  FROM clean GROUP BY user_id)""", ("clean",)),
    "items": ("""items AS (
  SELECT p_partkey AS item_id,
         CASE WHEN p_brand = 'Brand#7' THEN NULL ELSE p_brand END AS authors,
         CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 1950 + p_size END AS original_publication_year,
         CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_retailprice / 300 END AS average_rating
  FROM part)""", ()),
    "enriched": ("""enriched AS (
  SELECT c.user_id, c.item_id, c.rating, i.authors, i.original_publication_year, i.average_rating
  FROM clean c LEFT JOIN items i USING (item_id))""", ("clean", "items")),
    "factors": ("factors AS (SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS factor FROM embeddings)", ()),
    "pop": ("""pop AS (SELECT item_id, round(avg(rating), 9) AS score FROM train GROUP BY item_id)""", ("train",)),
    "tusers": ("tusers AS (SELECT DISTINCT user_id FROM test)", ("test",)),
    "lists": ("""lists AS (
  SELECT user_id, item_id, score, rank FROM (
    SELECT u.user_id, p.item_id, p.score,
           row_number() OVER (PARTITION BY u.user_id ORDER BY p.score DESC, p.item_id) AS rank
    FROM tusers u CROSS JOIN pop p
    WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = p.item_id)) s
  WHERE rank <= 10)""", ("tusers", "pop", "train")),
    "uidx": ("uidx AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS u_idx FROM (SELECT DISTINCT user_id FROM clean) s)", ("clean",)),
    "iidx": ("iidx AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS i_idx FROM (SELECT DISTINCT item_id FROM clean) s)", ("clean",)),
    # user factors: rating-weighted mean of the item factors of the user's train rows
    "ufac": ("""ufac AS (
  SELECT user_id, list(v ORDER BY d) AS factor, max(n_seen) AS n_seen FROM (
    SELECT t.user_id, f.d, sum(t.rating * f.x) / sum(t.rating) AS v, count(*) AS n_seen
    FROM train t JOIN (SELECT item_id, unnest(factor) AS x,
                              unnest(generate_series(1, len(factor))) AS d FROM factors) f
      USING (item_id)
    GROUP BY t.user_id, f.d) s
  GROUP BY user_id)""", ("train", "factors")),
    "neighbors": ("""neighbors AS (
  SELECT item_id, neighbor_id, score, rank FROM (
    SELECT a.item_id, b.item_id AS neighbor_id,
           round(list_inner_product(a.factor, b.factor), 9) AS score,
           row_number() OVER (PARTITION BY a.item_id
             ORDER BY round(list_inner_product(a.factor, b.factor), 9) DESC, b.item_id) AS rank
    FROM factors a JOIN factors b ON a.item_id <> b.item_id) s
  WHERE rank <= 50)""", ("factors",)),
    "liked": ("liked AS (SELECT DISTINCT user_id, item_id FROM train)", ("train",)),
    "cands": ("""cands AS (
  SELECT l.user_id, n.neighbor_id AS item_id FROM liked l JOIN neighbors n USING (item_id)
  WHERE NOT EXISTS (SELECT 1 FROM liked s WHERE s.user_id = l.user_id AND s.item_id = n.neighbor_id))""",
              ("liked", "neighbors")),
    "votes": ("votes AS (SELECT user_id, item_id, count(*) AS votes FROM cands GROUP BY user_id, item_id)", ("cands",)),
    "knn": ("""knn AS (
  SELECT user_id, item_id, votes, rank FROM (
    SELECT v.user_id, v.item_id, v.votes,
           row_number() OVER (PARTITION BY v.user_id ORDER BY v.votes DESC, v.item_id) AS rank
    FROM votes v JOIN tusers u USING (user_id)) s
  WHERE rank <= 10)""", ("votes", "tusers")),
    "idcg": ("""idcg AS (
  SELECT i AS n, sum(1.0 / log2(i + 1)) OVER (ORDER BY i) AS idcg FROM range(1, 51) r(i))""", ()),
}


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in CTES[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_ctes(body: str, *names: str, extra: str | None = None) -> str:
    """``WITH <needed ctes>[, extra] <body>``."""
    parts = [CTES[n][0] for n in _order(names)]
    if extra:
        parts.append(extra)
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


def ranking_sql(lists_cte: str, k: int = 10, list_users: str | None = None, prefix: str = "") -> str:
    """Per-user ranking metrics over a lists CTE and ``truth``; returns the
    text of CTEs ending in one named ``<prefix>pu``."""
    p = prefix
    lu = list_users or f"SELECT DISTINCT user_id FROM {lists_cte}"
    return f"""{p}lu AS ({lu}),
{p}nrel AS (SELECT user_id, count(*) AS n_relevant FROM truth GROUP BY user_id),
{p}hits AS (SELECT l.user_id, count(*) AS hits, sum(1.0 / log2(l.rank + 1)) AS dcg
         FROM {lists_cte} l JOIN truth t USING (user_id, item_id) WHERE l.rank <= {k} GROUP BY l.user_id),
{p}pu AS (SELECT lu.user_id, coalesce(h.hits, 0) AS hits, n.n_relevant, coalesce(h.dcg, 0.0) AS dcg, g.idcg
       FROM {p}lu lu JOIN {p}nrel n USING (user_id) LEFT JOIN {p}hits h USING (user_id)
       JOIN idcg g ON g.n = least(n.n_relevant, {k}))"""


def metric_rows_sql(model: str, pu: str, k: int = 10) -> str:
    """(model, metric, value) rows of the three ranking metrics of a ``pu`` CTE."""
    return f"""SELECT '{model}' AS model, 'precision_at_k' AS metric, coalesce(avg(hits / {float(k)}), 0.0) AS value FROM {pu}
UNION ALL SELECT '{model}', 'recall_at_k', coalesce(avg(hits / n_relevant), 0.0) FROM {pu}
UNION ALL SELECT '{model}', 'ndcg_at_k', coalesce(avg(CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0.0 END), 0.0) FROM {pu}"""
