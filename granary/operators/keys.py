"""Surrogate keys: dense numbers over sorted distinct identities, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from granary.sources.shared import written

UNKNOWN = -1


def surrogate_keys(df: DataFrame, identity: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Distinct identities numbered from start in their sorted order.

    They are dealt out and sorted by ranges: a row's number is its rank in its range plus the rows of the ranges before.
    The table that is written holds the ranges, so the count of each and the numbering see the same ones, and what stands
    before it runs once. Few identities are one range.
    """
    ranged = df.select(*identity).distinct().repartitionByRange(*identity).sortWithinPartitions(*identity)
    placed = written(ranged.withColumn("_at", F.monotonically_increasing_id()), "identities")
    placed = placed.select(*identity, F.shiftright("_at", 33).alias("_part"), F.expr("_at & ((1L << 33) - 1)").alias("_nth"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # a row for each range
    base = placed.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return placed.join(F.broadcast(base), "_part").select((F.col("_base") + F.col("_nth") + start).alias(name), *identity)


def with_unknown(dim: DataFrame, key: str, values: dict) -> DataFrame:
    """The dimension and its Unknown member; columns not given are null."""
    member = dim.limit(0).sparkSession.range(1).select(*(F.lit(UNKNOWN if c == key else values.get(c)).cast(t).alias(c) for c, t in dim.dtypes))
    return dim.unionByName(member)


def unique_match(df: DataFrame, source: Sequence[str], target: str) -> DataFrame:
    """The target of each source key that has exactly one."""
    return df.groupBy(*source).agg(F.min(target).alias(target), F.max(target).alias("_max")).where(F.col(target) == F.col("_max")).drop("_max")


def attach_key(fact: DataFrame, mapping: DataFrame, on: Sequence[str], key: str) -> DataFrame:
    """The fact with the key of its unique match, or that of the Unknown member."""
    return fact.join(mapping, list(on), "left").withColumn(key, F.coalesce(key, F.lit(UNKNOWN)))
