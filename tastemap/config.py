"""Default parameters of the analytics.

Fixed values that must equal the behaviour being reproduced: rating range
1 to 5, list length 10, relevance threshold 3.0, train fraction 0.8,
seed 42, ALS grid ranks {40, 80} x regularisation {0.05, 0.1} x iterations
{8, 12} with 3 folds and parallelism 8, small grid ranks {20, 40} x {0.1}
x {6} with 2 folds, SVD rank 50, 50 neighbours, 200 top categories,
5 % plot sample, 50 histogram bins.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Defaults:
    # fixed values
    rating_min: float = 1.0
    rating_max: float = 5.0
    top_k: int = 10
    relevant_threshold: float = 3.0
    train_fraction: float = 0.8
    seed: int = 42
    als_ranks: tuple = (40, 80)
    als_regs: tuple = (0.05, 0.1)
    als_iters: tuple = (8, 12)
    als_folds: int = 3
    als_parallelism: int = 8
    als_blocks: int = 10
    als_small_ranks: tuple = (20, 40)
    als_small_regs: tuple = (0.1,)
    als_small_iters: tuple = (6,)
    als_small_folds: int = 2
    svd_k: int = 50
    knn_neighbors: int = 50
    top_categories: int = 200
    sample_fraction: float = 0.05
    hist_bins: int = 50
    # engine-side bounds (ours)
    max_broadcast_bytes: int = 64 << 20


DEFAULTS = Defaults()
