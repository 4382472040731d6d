"""Joins on group keys that treat NULL as a key value (like GROUP BY does).

A null-safe equality (``<=>``) is still an equi-join key for Spark: it plans a hash
or sort-merge join on (coalesced value, is-null) pairs, never a nested loop.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    keys = list(keys)
    if not keys:
        raise ValueError("join_on needs at least one key")
    r = right.select(*[F.col(k).alias(f"__rk_{k}") for k in keys],
                     *[F.col(c) for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__rk_{k}")) for k in keys])
    return left.join(r, cond, how).drop(*[f"__rk_{k}" for k in keys])
