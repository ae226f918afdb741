"""Quantiles that add up: a sketch for each fine group, merged for any coarser one without the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.joins import beside

#: Size of a sketch: some K values are kept, however many went in.
K = 800


def rank_error(k: int = K) -> float:
    """How far the rank of a value told is from that asked for, as a share of all values, in 99 of 100 sketches (merged ones too).

    Fixed values: the published constants of this kind of sketch.
    """
    return 2.296 / k**0.9723


def quantile_sketches(df: DataFrame, by: Sequence[str], value: str, k: int = K) -> DataFrame:
    """by, sketch: the values of each group, combined before the shuffle.

    Null and undefined values are left out; groups without others have no row. A sketch holds all values while they are few,
    then a sample drawn at random, so two runs may tell different values within the error.
    """
    v = F.col(value).cast("double")
    return df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*by).agg(F.kll_sketch_agg_double(v, k).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: Sequence[str], k: int = K) -> DataFrame:
    """The sketches of coarser groups; by is of the columns of the finer ones, or of what was derived from these."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def told(sketches: DataFrame, quantiles: Mapping[str, float], keep: Sequence[str]) -> DataFrame:
    """keep, n, least, greatest, which are exact, and the quantiles (name -> share of values not above) of each sketch."""
    at = lambda q: F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))
    return sketches.select(*keep, F.kll_sketch_get_n_double("sketch").alias("n"), at(0).alias("least"), at(1).alias("greatest"), *(at(q).alias(name) for name, q in quantiles.items()))


def spans(sketches: DataFrame, by: Sequence[str], month: str, quantiles: Mapping[str, float]) -> DataFrame:
    """by, span, span_start, n, least, greatest and the quantiles of each month, of each year and of all months, from monthly sketches; rows without a month are in none."""
    m = F.col(month)
    kinds = {"month": m, "year": F.trunc(m, "year"), "all": F.lit(None).cast("date")}
    each = F.explode(F.array(*(F.struct(F.lit(name).alias("span"), start.alias("span_start")) for name, start in kinds.items())))
    rows = sketches.where(m.isNotNull()).select(*by, "sketch", each.alias("_s")).select(*by, "_s.*", "sketch")
    return told(merged_sketches(rows, [*by, "span", "span_start"]), quantiles, [*by, "span", "span_start"])


def rank_intervals(df: DataFrame, by: Sequence[str], month: str, value: str, points: DataFrame, names: Sequence[str]) -> DataFrame:
    """by, span, span_start, and for each name the exact shares of values below and not above what points (of spans) tells, as name_below and name_upto.

    Each row meets the points of its month, its year and all months at once and is counted against all of them in one
    aggregate by month, so nothing is expanded; years are sums of months.
    """
    v, year = F.col("_v"), F.trunc("_month", "year")
    own = df.select(*by, F.col(month).alias("_month"), F.col(value).cast("double").alias("_v")).where(v.isNotNull() & ~F.isnan(v) & F.col("_month").isNotNull())
    months = points.where("span = 'month'").select(*by, F.col("span_start").alias("_month"), *(F.col(n).alias(f"month_{n}") for n in names)).withColumn("_year", year)
    years = points.where("span = 'year'").select(*by, F.col("span_start").alias("_year"), *(F.col(n).alias(f"year_{n}") for n in names))
    every = points.where("span = 'all'").select(*by, *(F.col(n).alias(f"all_{n}") for n in names))
    wide = beside(beside(months, years, [*by, "_year"]), every, by)
    asked = [f"{s}_{n}" for s in ("month", "year", "all") for n in names]
    counts = [c for a in asked for c in (F.count_if(v < F.col(a)).alias(f"{a}_below"), F.count_if(v <= F.col(a)).alias(f"{a}_upto"))]
    per = beside(own, wide, [*by, "_month"]).groupBy(*by, "_month").agg(F.count("*").alias("n"), *counts)
    per = per.select(*by, "n", F.explode(F.array(*(
        F.struct(F.lit(s).alias("span"), start.alias("span_start"), *(F.col(f"{s}_{n}_{side}").alias(f"{n}_{side}") for n in names for side in ("below", "upto")))
        for s, start in (("month", F.col("_month")), ("year", year), ("all", F.lit(None).cast("date")))
    ))).alias("_s")).select(*by, "n", "_s.*")
    sides = [f"{n}_{side}" for n in names for side in ("below", "upto")]
    return per.groupBy(*by, "span", "span_start").agg(*((F.sum(c) / F.sum("n")).alias(c) for c in sides))
