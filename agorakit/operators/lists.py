"""Members of groups in row form, and joins on keys that may be NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    matches = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    joined = left.join(renamed, matches, how)
    if how == "full":
        joined = joined.withColumns({k: F.coalesce(k, f"_r_{k}") for k in keys})
    return joined.drop(*[f"_r_{k}" for k in keys])


def listed(members: DataFrame, keys: Sequence[str], value: str, count_col: str) -> DataFrame:
    """The distinct values of each group, one row each, with the size of the group. The shape is the same for a group of any size."""
    keys = list(keys)
    distinct = members.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    sizes = distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    return null_safe_join(distinct, sizes, keys)
