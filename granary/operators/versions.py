"""Several rows of one grain: exact duplicates, versions, the canonical one and the latest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from granary.operators.joins import beside


def collapse_duplicates(df: DataFrame, columns: Sequence[str] | None = None, name: str = "dq_source_exact_duplicate") -> DataFrame:
    """One row of each set equal in all columns, and whether there were several."""
    return df.groupBy(*(columns or df.columns)).agg((F.count("*") > 1).alias(name))


def version_count(df: DataFrame, grain: Sequence[str], name: str = "price_version_count") -> DataFrame:
    """Each row with the number of rows of its grain."""
    return df.withColumn(name, F.count("*").over(W.partitionBy(*grain)))


def price_versions(obs: DataFrame, grain: Sequence[str], price: str = "price", promo: str = "price_promo") -> DataFrame:
    """Exact duplicates collapsed, versions of a grain kept and counted, flags set and never repaired.

    The observation id hashes the grain and both prices, prices as decimals so that it doesn't depend on how an
    engine prints a double.
    """
    rows = version_count(collapse_duplicates(obs, [*grain, price, promo]), grain)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in grain]
    text += [F.coalesce(F.col(c).cast("decimal(18,6)").cast("string"), F.lit("")) for c in (price, promo)]
    many = F.col("price_version_count") > 1
    return rows.withColumns({
        "price_observation_id": F.md5(F.concat_ws("|", *text)),
        "is_promotion": F.col(promo) < F.col(price),
        "dq_non_positive_price": F.col(price) <= 0,
        "dq_non_positive_promo_price": F.col(promo) <= 0,
        "dq_promo_above_price": F.col(promo) > F.col(price),
        "has_multiple_price_versions": many,
        "price_resolution_rule": F.when(many, "multiple_price_observations").when(F.col("dq_source_exact_duplicate"), "exact_duplicate_collapsed").otherwise("single_observation"),
    })


def canonical(df: DataFrame, grain: Sequence[str], completeness: Sequence[str], payload: str, ties: Sequence[Column]) -> DataFrame:
    """The most complete row of each grain, by a total order, with the reason it was taken.

    completeness: columns, more is better; then the payload's hash and further ties decide, nulls first. The best row of
    each completeness of a grain is kept and counted before anything is shuffled, and then the best of these: rows of a
    frequent grain meet in one task as one row for each task and completeness, and are never sorted there.
    """
    tie = F.struct(F.md5(F.col(payload)), *ties)
    best = df.groupBy(*grain, *(F.col(c).alias(f"_by{i}") for i, c in enumerate(completeness))).agg(F.min_by(F.struct(*df.columns), tie).alias("_row"), F.count("*").alias("_tied"))
    order = F.struct(F.lit(0), *(F.col(f"_by{i}") for i in range(len(completeness))))
    kept = best.groupBy(*grain).agg(F.max_by(F.struct("_row", "_tied"), order).alias("_best"), F.sum("_tied").alias("grain_rows"))
    rows = kept.select(F.col("_best._row").alias("_row"), "grain_rows", F.col("_best._tied").alias("tied_rows")).select("_row.*", "grain_rows", "tied_rows")
    repeated = F.col("grain_rows") > 1
    reason = F.when(repeated & (F.col("tied_rows") > 1), "deterministic_hash_tiebreak").when(repeated, "completeness_first")
    if "dq_source_exact_duplicate" in df.columns:
        reason = reason.when(F.col("dq_source_exact_duplicate"), "exact_duplicate_collapsed")
    return rows.withColumn("selection_reason", reason.otherwise("single_observation"))


def latest_flag(df: DataFrame, series: Sequence[str], at: str, name: str = "is_latest_observation") -> DataFrame:
    """Whether a row is of its series' last date; all rows of that date are.

    The last dates, one row a series, combine before the shuffle and join the rows back: as a broadcast where series are few,
    else in a join that Spark splits where a series is frequent. A row without a date has none.
    """
    last = df.groupBy(*series).agg(F.max(at).alias("_last"))
    return beside(df, last, series).withColumn(name, F.col(at) == F.col("_last")).drop("_last")


def latest_rows(df: DataFrame, series: Sequence[str], at: str, ties: Sequence[str]) -> DataFrame:
    """One row of each series: that of the last date and, among these, the greatest in the columns `ties`; and how many rows have that date.

    Nulls are below all else. Nothing is sorted or joined: each task keeps its best row of a series.
    """
    best = df.groupBy(*series, F.col(at).alias("_at")).agg(F.max_by(F.struct(*df.columns), F.struct(*ties)).alias("_row"), F.count("*").alias("_n"))
    kept = best.groupBy(*series).agg(F.max_by(F.struct("_row", "_n"), F.struct("_at")).alias("_best"))
    return kept.select("_best._row.*", F.col("_best._n").alias("rows_of_last_date"))
