"""Joins in which null keys are keys like others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def beside(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Each row of a with that of b, which has one row a group; null groups are groups. Without groups b is one row."""
    if not by:
        return a.crossJoin(b)
    renamed = b.withColumnsRenamed({c: f"_b_{c}" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    return a.join(renamed, same, "left").drop(*(f"_b_{c}" for c in by))
