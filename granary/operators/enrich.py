"""Filling gaps from a reference table, only where the context matches, and recording what was done."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.columns import flag
from granary.operators.contracts import join_checked


def fallback(df: DataFrame, reference: DataFrame, key: Sequence[str], attributes: Sequence[str], context: Sequence[str], numeric: dict[str, float] | None = None) -> DataFrame:
    """df with null attributes filled from the one reference row of its key where all context columns agree.

    Adds is_X_enriched and dq_X_conflict (both filled and different; numbers by more than a tolerance) per
    attribute, and dq_enrichment_context_mismatch. Populated values are never replaced; rows never multiply.
    """
    theirs = reference.select(*key, *(F.col(c).alias(f"_ref_{c}") for c in (*context, *attributes)), F.lit(True).alias("_found"))
    joined = join_checked(df, theirs, key, "m:1")
    found = flag(F.col("_found"))
    same = found
    for c in context:
        same = same & flag(F.col(c) == F.col(f"_ref_{c}"))

    def differs(c: str) -> Column:
        a, b = F.col(c), F.col(f"_ref_{c}")
        return flag(F.abs(a - b) > numeric[c]) if numeric and c in numeric else flag(a != b)

    out = joined.select(
        *(c for c in df.columns if c not in attributes),
        *(F.when(F.col(c).isNull() & same, F.col(f"_ref_{c}")).otherwise(F.col(c)).alias(c) for c in attributes),
        (found & ~same).alias("dq_enrichment_context_mismatch"),
        *(flag(F.col(c).isNull() & same & F.col(f"_ref_{c}").isNotNull()).alias(f"is_{c}_enriched") for c in attributes),
        *((found & differs(c)).alias(f"dq_{c}_conflict") for c in attributes),
    )
    return out


def without_collisions(reference: DataFrame, key: Sequence[str]) -> DataFrame:
    """Reference rows whose key stands once; the others can't be told apart."""
    once = reference.groupBy(*key).agg(F.count("*").alias("_n")).where("_n = 1").drop("_n")
    return reference.join(once, list(key), "left_semi")


def describe(ids: DataFrame, first: DataFrame, second: DataFrame, key: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Attributes field by field from the first source, else the second, and which sources had the identity."""
    a = first.select(*key, *(F.col(c).alias(f"_a_{c}") for c in attributes), F.lit(True).alias("_a"))
    b = second.select(*key, *(F.col(c).alias(f"_b_{c}") for c in attributes), F.lit(True).alias("_b"))
    rows = join_checked(join_checked(ids, a, key, "m:1"), b, key, "m:1")
    source = F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), "first").when(F.col("_b"), "second").otherwise("none")
    return rows.select(*ids.columns, *(F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in attributes), source.alias("descriptive_source"))
