"""Column expressions. All of them are built-in Spark functions, so they stay
inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scores are rounded to this many decimals before ranking, so that the
# summation order of a dot product cannot flip a tie.
SCORE_DECIMALS = 9


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_key(*cols, seed: int = 42) -> Column:
    """md5 of the columns and the seed joined by a bar: a repeatable random
    order that does not depend on row layout (``md5('1|2|42')``)."""
    parts = [_c(c).cast("string") for c in cols] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts))


def hash_number(*cols, seed: int = 42) -> Column:
    """First 8 hex digits of :func:`hash_key` as a number in [0, 2**32)."""
    return F.conv(F.substring(hash_key(*cols, seed=seed), 1, 8), 16, 10).cast("bigint")


def dot(a, b) -> Column:
    """Dot product of two equal-length numeric arrays."""
    prod = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prod, F.lit(0.0), lambda s, z: s + z)


def array_norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda s, z: s + z.cast("double") * z.cast("double")))


def clip(x, lo: float = 1.0, hi: float = 5.0) -> Column:
    return F.least(F.lit(float(hi)), F.greatest(F.lit(float(lo)), _c(x)))


def log_discount(rank) -> Column:
    """1 / log2(rank + 1) for a 1-based rank (= log2(i + 2) for 0-based i)."""
    return F.lit(1.0) / F.log2(_c(rank).cast("double") + F.lit(1.0))


def round_score(x, decimals: int = SCORE_DECIMALS) -> Column:
    return F.round(_c(x), decimals)
