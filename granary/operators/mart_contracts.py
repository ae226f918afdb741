"""Contracts of a star schema: counts of violations, all 0 in a sound mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.contracts import fail_if_any, violations_unique


def bridge_violations(bridge: DataFrame, members: DataFrame, categories: DataFrame, member: str, category: str) -> dict[str, int]:
    return {
        "repeated memberships": violations_unique(bridge, [member, category]).count(),
        "members unknown": bridge.join(members.select(member), member, "left_anti").count(),
        "categories unknown": bridge.join(categories.select(category), category, "left_anti").count(),
        "categories unused": categories.join(bridge.select(category), category, "left_anti").count(),
        "Unknown in the bridge": bridge.where(F.col(member) == -1).count(),
    }


def fact_violations(fact: DataFrame, grain: Sequence[str], dims: dict[str, DataFrame], unknown_allowed: Sequence[str] = ()) -> dict[str, int]:
    """Repeated grains, keys that a dimension lacks, and uses of the Unknown member; one pass over the fact for the last two."""
    found = {"repeated grain": violations_unique(fact, grain).count()}
    rows, counts = fact.select(*dims), []
    for key, dim in dims.items():
        rows = rows.join(dim.select(key, F.lit(True).alias(f"_{key}")), key, "left")
        counts += [F.count_if(F.col(f"_{key}").isNull()).alias(f"{key} orphans")]
        if key not in unknown_allowed:
            counts.append(F.count_if(F.col(key) == -1).alias(f"{key} unknown"))
    return found | rows.agg(*counts).first().asDict()


def scope_violations(fact: DataFrame, dim: DataFrame, key: str, one_value: Sequence[str] = (), domain: dict[str, Sequence] | None = None) -> dict[str, int]:
    """Members that no row uses, columns that should have one value, and values outside their domain; Unknown is left out."""
    known = dim.where(F.col(key) != -1)
    found = {f"{key} unused": known.join(fact.select(key), key, "left_anti").count()}
    aggs = [(F.greatest(F.count_distinct(c) - 1, F.lit(0))).alias(f"{c} has several values") for c in one_value]
    aggs += [F.count_if(~F.col(c).isin(*values)).alias(f"{c} outside its domain") for c, values in (domain or {}).items()]
    return found | (known.agg(*aggs).first().asDict() if aggs else {})


def latest_violations(fact: DataFrame, series: Sequence[str], date: str, name: str = "is_latest_observation") -> dict[str, int]:
    """Series without a latest date, and with several."""
    per = fact.groupBy(*series).agg(F.count_distinct(F.when(F.col(name), F.col(date))).alias("n"))
    return per.agg(F.count_if(F.col("n") == 0).alias("no latest"), F.count_if(F.col("n") > 1).alias("several latest")).first().asDict()


def reconcile(source: DataFrame, fact: DataFrame, grain: Sequence[str]) -> dict[str, int]:
    """Grains of the source that the fact lacks, and the other way round."""
    a, b = source.select(*grain).distinct(), fact.select(*grain).distinct()
    return {"source grains missing": a.join(b, list(grain), "left_anti").count(), "fact grains from nowhere": b.join(a, list(grain), "left_anti").count()}


def check_mart(**violations: dict[str, int]) -> None:
    for name, found in violations.items():
        fail_if_any(found, name)
