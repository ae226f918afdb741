"""The weekly price fact and like-for-like ratios over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from granary.functions.columns import flag, n_values


def weekly_fact(obs: DataFrame, grain: Sequence[str], price: str = "price", promo: str = "price_promo") -> DataFrame:
    """One row per grain. A value is given only where all versions of the week agree; ranges and counts always.

    Whether versions agree, and how many there are where a grain has two rows at most, follows from the least and the
    greatest value, in one hash aggregate. Values are counted in sets only for grains of more rows that differ, which are few;
    where nothing asks for the numbers of versions, the optimizer leaves that join out.
    """
    promotion = F.col(promo) < F.col(price)
    rows = obs.select(*grain, F.col(price).alias("regular"), F.col(promo).alias("promo"), F.coalesce(promotion, F.lit(False)).alias("on"))
    rows = rows.withColumn("effective", F.when(F.col("on"), F.col("promo")).otherwise(F.col("regular")))
    kinds = ("regular", "promo", "effective")
    agg = rows.groupBy(*grain).agg(
        F.count("*").alias("price_observation_versions"), *(f(F.col(k)).alias(f"{k}_price_{s}") for k in kinds for s, f in (("min", F.min), ("max", F.max))),
        F.bool_and("on").alias("all_on"), F.bool_or("on").alias("any_on"),
    )
    differ = lambda k: F.col(f"{k}_price_min") != F.col(f"{k}_price_max")
    several = agg.where((F.col("price_observation_versions") > 2) & (differ("regular") | differ("promo") | differ("effective"))).select(*grain)
    counted = rows.join(several, list(grain), "left_semi").groupBy(*grain).agg(*(n_values(F.col(k)).alias(f"_{k}") for k in kinds))
    agg = agg.join(counted, list(grain), "left")
    versions = lambda k: F.coalesce(f"_{k}", F.when(F.col(f"{k}_price_min").isNull(), 0).when(differ(k), 2).otherwise(1).cast("long"))
    agg = agg.withColumns({f"{k}_price_versions": versions(k) for k in kinds})
    one = lambda k: F.col(f"{k}_price_min") == F.col(f"{k}_price_max")
    state = F.when(F.col("all_on") == F.col("any_on"), F.col("any_on"))
    promoted = state & one("promo")
    both = promoted & one("regular")
    off = F.col("regular_price_min") - F.col("promo_price_min")
    return agg.select(
        *grain,
        F.when(one("regular"), F.col("regular_price_min")).alias("regular_price"),
        F.when(promoted, F.col("promo_price_min")).alias("promo_price"),
        F.when(one("effective"), F.col("effective_price_min")).alias("effective_price"),
        F.when(both, off).alias("discount_amount"),
        F.when(both & (F.col("regular_price_min") > 0), off / F.col("regular_price_min")).alias("discount_pct"),
        *(f"{k}_price_{s}" for k in kinds for s in ("min", "max")),
        "price_observation_versions", *(f"{k}_price_versions" for k in kinds),
        state.alias("is_promotion"),
        flag(differ("regular")).alias("has_intraweek_price_variation"),
        flag(differ("effective")).alias("has_effective_price_variation"),
        (F.col("all_on") != F.col("any_on")).alias("promotion_state_conflict"),
    )


def log_ratio(now: Column, then: Column) -> Column:
    """Of positive values only."""
    return F.when((now > 0) & (then > 0), F.ln(now / then))


def _all_known(columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def lag_ratios(fact: DataFrame, series: Sequence[str], at: str, days: int, ratios: dict[str, str]) -> DataFrame:
    """fact with the log ratio of each column to that of the same series exactly `days` before; null without such a row,
    where there are several, and where the series or the date is null.

    The row before is a frame of one date in the series' own order, so the fact is read once and not joined with itself;
    over a table in buckets of the series (sources/shared.py) nothing is shuffled. A series has a row a date, not more.
    """
    then = W.partitionBy(*series).orderBy(F.unix_date(at)).rangeBetween(-days, -days)
    known = _all_known([*series, at]) & (F.count(F.lit(1)).over(then) == 1)
    return fact.withColumns({name: F.when(known, log_ratio(F.col(c), F.min(c).over(then))) for name, c in ratios.items()})


def reference_ratio(fact: DataFrame, keys: Sequence[str], place: str, reference, column: str, name: str) -> DataFrame:
    """fact with the log ratio of the column to that of the reference place, for rows elsewhere; null where the reference
    has no row or several, or a key is null.

    The rows of a key, one for each place, stand together; the fact is not joined with itself.
    """
    here, there = W.partitionBy(*keys), F.col(place) == reference
    known = _all_known(keys) & (F.col(place) != reference) & (F.count_if(there).over(here) == 1)
    return fact.withColumn(name, F.when(known, log_ratio(F.col(column), F.min(F.when(there, F.col(column))).over(here))))


def matched_changes(df: DataFrame, by: Sequence[str], columns: dict[str, str], least: int = 500) -> DataFrame:
    """For each name and column of log ratios: the geometric mean change, null below `least` pairs, and the number of pairs (name_pairs); one aggregate for all."""
    aggs = []
    for name, column in columns.items():
        n = F.count(column)
        aggs += [n.alias(f"{name}_pairs"), F.when(n >= least, F.exp(F.avg(column)) - 1).alias(name)]
    return df.groupBy(*by).agg(*aggs)
