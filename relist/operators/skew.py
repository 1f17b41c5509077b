"""Joins of rows that may share one key to a side with one row per key.

The adaptive skew join splits a large partition only where both join inputs come straight
from a shuffle, which the result of a grouping does not. Keys with many rows are therefore
taken apart and joined to their own small, stored side: it is broadcast by its measured
size, and beyond that size the join is one the adaptive split applies to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relist.session import materialize

# Keys with more rows than this are not brought together in one task.
KEY_LIMIT = 200_000


def larger_keys(rows: DataFrame, keys: Sequence[str], limit: int = KEY_LIMIT, stage: str | None = None) -> DataFrame | None:
    """Keys with more rows than the limit, at most total / limit of them; None without any."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    large = counts.where(F.col("n") > limit).select(*keys)
    return None if large.isEmpty() else materialize(large, "large-keys", stage)


def join_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                limit: int = KEY_LIMIT, stage: str | None = None, large: DataFrame | None = None) -> DataFrame:
    """left join right, where right holds one row per key and left any number.

    `large` names the keys to take apart where they are known; otherwise they are counted,
    which reads `left` once more, so an expensive `left` should be a stored stage.
    """
    keys = list(keys)
    large = larger_keys(left, keys, limit, stage) if large is None else large
    if large is None:
        return left.join(right, keys, how)
    few = materialize(right.join(large, keys, "left_semi"), "large-side", stage)
    ordinary = left.join(large, keys, "left_anti").join(right, keys, how)
    return ordinary.unionByName(left.join(large, keys, "left_semi").join(few, keys, how))
