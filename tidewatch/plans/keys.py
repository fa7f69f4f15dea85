"""Joins on keys that may be NULL: a NULL key is a key like any other and meets its like."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """`left.join(right, keys, how)` with NULL equal to NULL; full joins keep either side's key."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys])
    joined = left.join(renamed, same, how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how == "full":
        joined = joined.withColumns({key: F.coalesce(key, f"_right_{key}") for key in keys})
    return joined.drop(*[f"_right_{key}" for key in keys])
