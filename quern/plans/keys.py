"""Joins on key columns that treat NULL as a key of its own, as grouping does."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left.join(right, keys, how)`` with null-safe equality; the keys come
    from ``left``."""
    names = [f"_nk{i}" for i in range(len(keys))]
    r = right.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], *[F.col(c) for c in right.columns if c not in keys])
    cond = F.lit(True)
    for k, n in zip(keys, names):
        cond = cond & F.col(k).eqNullSafe(F.col(n))
    return left.join(r, cond, how).drop(*names)
