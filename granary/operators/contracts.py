"""Fail-fast checks, and joins that hold their declared cardinality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.columns import finite

SAMPLE = 20


class ContractError(ValueError):
    """Data that breaks a declared rule."""


def require_columns(df: DataFrame, names: Sequence[str], exact: bool = True) -> DataFrame:
    missing, extra = set(names) - set(df.columns), set(df.columns) - set(names)
    if missing or (exact and extra):
        raise ContractError(f"missing columns {sorted(missing)}, unexpected columns {sorted(extra) if exact else []}")
    return df


def violations_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that stand on several rows; nulls are values."""
    return df.groupBy(*key).count().where("count > 1")


def require_unique(df: DataFrame, key: Sequence[str], name: str = "table") -> DataFrame:
    if found := violations_unique(df, key).limit(SAMPLE).collect():
        raise ContractError(f"{name}: key {list(key)} is repeated: {[tuple(r)[:-1] for r in found]}")
    return df


def require_date(df: DataFrame, *names: str) -> DataFrame:
    if wrong := [n for n in names if not isinstance(df.schema[n].dataType, T.DateType)]:
        raise ContractError(f"not of type date: {wrong}")
    return df


def require_finite(df: DataFrame, *names: str) -> DataFrame:
    counts = df.agg(*(F.count_if(F.col(n).isNotNull() & ~finite(F.col(n))).alias(n) for n in names)).first()
    if wrong := {n: counts[n] for n in names if counts[n]}:
        raise ContractError(f"values that are not finite: {wrong}")
    return df


def fail_if_any(counts: dict[str, int], name: str = "table") -> None:
    if wrong := {k: v for k, v in counts.items() if v}:
        raise ContractError(f"{name}: {wrong}")


def require_known(df: DataFrame, column: str, known: DataFrame, name: str = "value") -> DataFrame:
    """Every non-null value of the column is in the one column of known."""
    unknown = df.select(F.col(column).alias("v")).where("v is not null").distinct().join(known.toDF("v"), "v", "left_anti")
    if found := unknown.limit(SAMPLE).collect():
        raise ContractError(f"unknown {name}: {[r[0] for r in found]}")
    return df


def join_checked(left: DataFrame, right: DataFrame, key: Sequence[str], validate: str = "m:1", how: str = "left") -> DataFrame:
    """A join that fails where a side declared `1` repeats a key, so that it can't multiply rows."""
    before, after = validate.split(":")
    if before == "1":
        require_unique(left, key, "left side")
    if after == "1":
        require_unique(right, key, "right side")
    return left.join(right, list(key), how)


def orphans(fact: DataFrame, dimension: DataFrame, key: str, dimension_key: str) -> DataFrame:
    """Rows of the fact whose key the dimension lacks."""
    return fact.join(dimension.select(F.col(dimension_key).alias(key)), key, "left_anti")


def dimension_violations(dim: DataFrame, key: str, natural: Sequence[str], unknown: int | None = None) -> DataFrame:
    """One row: empty, repeated surrogate and natural keys, and a wrong number of Unknown members."""
    rows = dim.groupBy(key).agg(F.count("*").alias("_n"))
    same = dim.groupBy(*natural).agg(F.count("*").alias("_n"))
    a = rows.agg((F.count("*") == 0).cast("long").alias("empty"), F.count_if(F.col("_n") > 1).alias("repeated_keys"), F.count_if(F.col(key) == F.lit(unknown)).alias("members"))
    b = same.agg(F.count_if(F.col("_n") > 1).alias("repeated_natural_keys"))
    expected = 0 if unknown is None else 1
    return a.crossJoin(b).select("empty", "repeated_keys", "repeated_natural_keys", F.abs(F.col("members") - expected).alias("unknown_members"))
