"""Truncated SVD of the user x item rating matrix.

One solver at every size: block Lanczos on A.T A with a stop by residuals. The matrix lies in cells and all
tall matrices in strips of rows (:mod:`tastemap.operators.strips`); products, orthogonalisation and the triangular
factors (TSQR) are passes over strips on the executors. The driver holds only matrices of the basis size (at most
``MAX_BASIS`` blocks of ``WIDTH`` x k columns), whatever the number of users and items.

Each step multiplies the last block by A and A.T, takes the coefficients on the last two blocks, which complete
the projected matrix, and subtracts them; what is left is the next block. With the older blocks it has nothing in
common but rounding, which grows only along Ritz vectors that have converged: those are locked (written once) and
subtracted in each step too, so no step reads the whole basis. A Ritz pair's residual is the norm of its part in the
last block times the rest. The run stops when the first k residuals are below ``tol`` times the largest eigenvalue,
or when nothing is left (the basis is invariant, as for a matrix of low rank). A full basis is restarted from its
leading Ritz vectors, which stay among the blocks of every later step.

That the basis has stayed orthogonal is read from the Gram matrix of the final vectors. If it has not, the run is made
again with every step orthogonalised against the whole basis. The vectors are made orthonormal by the Gram matrix's
factor, and values are taken from A V itself, not from squares.

The start is A.T times random numbers that depend on the strip number and the seed, so an item without
ratings has a zero row throughout, and results do not follow the layout.

Scores: ``use_sigma=True`` gives U diag(s) V^T (a rank-k reconstruction);
``use_sigma=False`` gives U V^T, the reference formula. Missing ratings
are zeros; ``center="user"`` subtracts each user's mean first and adds it
back in predictions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.config import DEFAULTS
from tastemap.functions.exprs import dot
from tastemap.operators import strips as ST
from tastemap.operators.scoring import pair_scores

WIDTH = 1           # columns of a block, in multiples of k: wider blocks need fewer steps, but move more numbers in all
MAX_BASIS = 64      # blocks of the basis before a restart keeps a quarter of its columns
LOCK = 1e-8         # a residual below this part of the largest eigenvalue: the vector is locked
DROP = 1e-7         # directions of the rest below this part of the largest eigenvalue are no new directions
EACH = 16           # up to this step the Ritz pairs are looked at in each step, then in every second one
MAX_STEPS = 300


def sparse_rows(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """One row per user index: entries sorted by item index.
    ``pairs`` must hold one rating per (user, item) (see ``dedup_pairs``)."""
    idx = pairs.join(users, "user_id", "inner").join(items, "item_id", "inner")
    return (idx.groupBy("u_idx")
            .agg(F.array_sort(F.collect_list(F.struct(F.col("i_idx"), F.col("rating").alias("value"))))
                 .alias("entries")))


def sparse_row_chunks(pairs: DataFrame, users: DataFrame, items: DataFrame, width: int = 32_768) -> DataFrame:
    """:func:`sparse_rows` cut at every ``width`` item indices: ``(u_idx, chunk, entries)``. No row holds more than
    ``width`` entries and a user's chunks go to different tasks, so a user who rated most items is no large row."""
    idx = pairs.join(users, "user_id", "inner").join(items, "item_id", "inner")
    return (idx.groupBy("u_idx", F.floor(F.col("i_idx") / width).cast("bigint").alias("chunk"))
            .agg(F.array_sort(F.collect_list(F.struct(F.col("i_idx"), F.col("rating").alias("value"))))
                 .alias("entries")))


@dataclass
class SvdResult:
    status: str
    singular_values: list
    user_factors: DataFrame | None = None   # (user_id, factor)  scaled by s when use_sigma
    item_factors: DataFrame | None = None   # (item_id, factor)  V rows
    user_means: DataFrame | None = None     # (user_id, mean) when centred
    k: int = 0


def _steps(a: ST.Ratings, k: int, tol: float, seed: int, whole: bool = False) -> tuple[list[ST.Block], list[int], np.ndarray, int]:
    """(blocks S, widths, M, steps): the first k Ritz vectors are S @ M. ``whole``: each step meets all blocks."""
    users, items = a.side(True), a.side(False)
    width = min(a.n_items, max(WIDTH * k, 8))
    start = ST.times(a, ST.random_rows(a.cells.sparkSession, users, width, seed), width, by_user=False)
    block, r = ST.reduce_by(start, width, [], [], items, None)
    _, s, vt = np.linalg.svd(r)
    keep = s > DROP * s[0] if s.size and s[0] > 0 else np.zeros(len(s), bool)
    if not keep.any():
        return [], [], np.zeros((0, 0)), 0
    # a stored block times its small matrix has orthonormal columns
    blocks, widths, smalls = [block], [width], [vt[keep].T / s[keep]]
    h, top, kept, locked, n_locked = np.zeros((0, 0)), 0.0, 0, [], 0
    for step in range(1, MAX_STEPS + 1):
        last = smalls[-1].shape[1]
        at = np.cumsum([0, *(m.shape[1] for m in smalls)])
        d = at[-1]
        # the kept block of a restart and the last two; all others are orthogonal to the product
        near = sorted({*range(kept), *range(0 if whole else max(0, len(blocks) - 2), len(blocks))})
        held, of = [blocks[i] for i in near] + locked, [widths[i] for i in near] + [n_locked] * len(locked)
        w = _diagonal([smalls[i] for i in near] + [np.eye(n_locked)] * len(locked))
        y = ST.summed(ST.times(a, blocks[-1].rows, widths[-1], by_user=True, small=smalls[-1]), last, users)
        z, c = ST.project(ST.times(a, y, last, by_user=False), last, held, of, items)
        c = w.T @ c
        own = np.concatenate([np.arange(at[i], at[i + 1]) for i in near])
        grown = np.zeros((d, d))
        grown[:d - last, :d - last] = h
        grown[own, d - last:] = c[:len(own)]
        grown[d - last:, own] = c[:len(own)].T
        h = (grown + grown.T) / 2
        rest, r = ST.reduce_by(z.rows, last, held, of, items, w @ c)
        _, s, vt = np.linalg.svd(r)
        full = len(blocks) >= (MAX_BASIS // 2 if whole else MAX_BASIS)
        look = step <= EACH or step % 2 == 0 or full
        if look or not (s > DROP * top).any():
            value, vec = np.linalg.eigh(h)
            value, vec, look, top = value[::-1], vec[:, ::-1], True, value[-1]
            if top <= 0:
                return [], [], np.zeros((0, 0)), step
        keep = s > DROP * top
        if look:
            left = s[keep, None] * vt[keep]
            wanted = min(k, d)
            short = np.linalg.norm(left @ vec[d - last:, :wanted], axis=0) if keep.any() else np.zeros(wanted)
            everything = _diagonal(smalls)
            if not keep.any() or (d >= k and short.max() <= tol * top):
                return blocks, widths, everything @ vec[:, :wanted], step
            done = int(np.argmin(np.append(short <= LOCK * top, False)))
            if full:
                # thick restart: the leading Ritz vectors become one block, joined to the rest by the residuals
                size = min(d, max(2 * k, d // 4))
                block, _ = ST.combined(blocks, widths, items, everything @ vec[:, :size])
                blocks, widths, smalls, kept = [block], [size], [np.eye(size)], 1
                h, locked, n_locked = np.diag(value[:size]), [], 0
            elif done > n_locked and len(blocks) > 2 and not whole:
                block, _ = ST.combined(blocks, widths, items, everything @ vec[:, :done])
                locked, n_locked = [block], done
        # the next block's rows of h, its link to the basis among them, come with its products
        blocks, widths, smalls = [*blocks, rest], [*widths, last], [*smalls, vt[keep].T / s[keep]]
    raise ArithmeticError(f"the first {k} singular values have not settled in {MAX_STEPS} steps")


def _vectors(a: ST.Ratings, k: int, tol: float, seed: int) -> tuple[ST.Block, int, np.ndarray] | None:
    """(block, width, small): block @ small are the first k right singular vectors, up to a rotation."""
    for whole in (False, True):
        blocks, widths, m, _ = _steps(a, k, tol, seed, whole)
        if not blocks:
            return None
        v, r = ST.combined(blocks, widths, a.side(False), m)
        _, s, vt = np.linalg.svd(r)
        if whole or np.abs(s * s - 1).max() <= tol:
            return v, m.shape[1], vt.T / s


def _diagonal(smalls: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((sum(m.shape[0] for m in smalls), sum(m.shape[1] for m in smalls)))
    i = j = 0
    for m in smalls:
        out[i:i + m.shape[0], j:j + m.shape[1]] = m
        i, j = i + m.shape[0], j + m.shape[1]
    return out


def svd_factors(pairs: DataFrame, users: DataFrame, items: DataFrame, k: int = DEFAULTS.svd_k,
                use_sigma: bool = True, center: str | None = None, tol: float = 1e-5, rcond: float = 1e-8,
                seed: int = DEFAULTS.seed) -> SvdResult:
    """Fit a rank-k SVD on train ``pairs (user_id, item_id, rating)`` with
    dense indices ``users (user_id, u_idx)`` and ``items (item_id, i_idx)``.

    ``tol`` bounds the residuals of A.T A relative to its largest eigenvalue; an error of a singular value is of the
    order of its square. Values below ``rcond`` times the largest count as zero."""
    if center not in (None, "user"):
        raise ValueError("center must be None or 'user'")
    n_users = users.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    n_items = items.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if n_users <= 1 or n_items <= 1:
        return SvdResult("skipped: fewer than two users or items", [])
    k_eff = min(k, n_users - 1, n_items - 1)
    if k_eff <= 0:
        return SvdResult("skipped: k <= 0", [])
    means = None
    if center == "user":
        means = pairs.groupBy("user_id").agg(F.avg("rating").alias("mean"))
        pairs = pairs.join(means, "user_id").select("user_id", "item_id", (F.col("rating") - F.col("mean")).alias("rating"))
    # rows of the tables in use: a user without training ratings gets no factors
    idx = pairs.join(users, "user_id", "inner").join(items, "item_id", "inner").select("u_idx", "i_idx", "rating")
    idx = ST.saved(idx, "svd-entries")
    a = ST.pack(idx, n_users, n_items)
    found = _vectors(a, k_eff, tol, seed)
    if found is None:
        return SvdResult("skipped: matrix has rank 0", [])
    v, v_width, small = found[0].rows, *found[1:]
    width = small.shape[1]
    y, r = ST.reduce_by(ST.times(a, v, v_width, by_user=True, small=small), width, [], [], a.side(True), None)
    _, s, vt = np.linalg.svd(r)
    keep = s > rcond * s[0] if s.size and s[0] > 0 else np.zeros(len(s), bool)
    if not keep.any():
        return SvdResult("skipped: matrix has rank 0", [])
    s, turn = s[keep], vt[keep].T
    scale = turn if use_sigma else turn / s
    have = idx.select("u_idx").distinct()
    uf = ST.vectors(y.rows, width, a.u_rows, scale, "u_idx").join(have, "u_idx", "left_semi").join(users, "u_idx", "inner").select(
        "user_id", F.col("v").alias("factor"))
    vf = ST.vectors(v, v_width, a.i_rows, small @ turn, "i_idx").join(items, "i_idx", "inner").select("item_id", F.col("v").alias("factor"))
    return SvdResult("ok", [float(x) for x in s], ST.saved(uf, "user-factors"), ST.saved(vf, "item-factors"), means, len(s))


def predict_with_factors(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
                         user_means: DataFrame | None = None, many: bool = False) -> DataFrame:
    """Pairs joined to both factor tables; pairs without factors drop out (J11). ``many``: there are many pairs of
    a user, which would each carry a factor through a shuffle (see :func:`tastemap.operators.scoring.pair_scores`)."""
    if many:
        out = pair_scores(pairs, user_factors, item_factors)
        if user_means is not None:
            out = out.join(user_means, "user_id", "left").withColumn("prediction", F.col("prediction") + F.coalesce(F.col("mean"), F.lit(0.0))).drop("mean")
        return out
    uf = user_factors.withColumnRenamed("factor", "_uf")
    vf = item_factors.withColumnRenamed("factor", "_vf")
    out = pairs.join(uf, "user_id", "inner").join(vf, "item_id", "inner")
    pred = dot("_uf", "_vf")
    if user_means is not None:
        out = out.join(user_means, "user_id", "left")
        pred = pred + F.coalesce(F.col("mean"), F.lit(0.0))
    return out.withColumn("prediction", pred).drop("_uf", "_vf", "mean")
