"""Profiles of tables: grains, coverage, missing values, consistency and joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.columns import NULL_TOKENS


def grain_ladder(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, and distinct values of each longer prefix of the columns; nulls are values.

    Prefixes nest, so the distinct rows of one are found among those of the next longer, never from the table again.
    """
    out, rows = None, df.select(*columns)
    total = rows.agg(F.lit(0).alias("n_columns"), F.lit("rows").alias("grain"), F.count("*").alias("n"))
    for n in range(len(columns), 0, -1):
        rows = rows.select(*columns[:n]).distinct()
        own = rows.agg(F.lit(n).alias("n_columns"), F.lit(",".join(columns[:n])).alias("grain"), F.count("*").alias("n"))
        out = own if out is None else out.unionByName(own)
    return out.unionByName(total)


def repeated_grains(df: DataFrame, grain: Sequence[str], values: Sequence[str], by: Column | None = None) -> DataFrame:
    """Grains that stand on several rows, split into rows that are equal and rows that differ."""
    per = df.groupBy(*grain).agg(F.count("*").alias("n"), F.min(F.struct(*values)).alias("lo"), F.max(F.struct(*values)).alias("hi"), F.min(by if by is not None else F.lit("all")).alias("part"))
    same = F.col("lo").eqNullSafe(F.col("hi"))
    return per.where("n > 1").groupBy("part").agg(F.count("*").alias("repeated_grains"), F.count_if(same).alias("exact"), F.count_if(~same).alias("differing"), F.sum("n").alias("rows"))


def temporal_coverage(df: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    """First and last day, days and weeks observed, and those expected between them."""
    d = F.col(date).cast("date")
    week = F.trunc(d, "week")
    rows = df.groupBy(*by).agg(F.min(d).alias("first_day"), F.max(d).alias("last_day"), F.count_distinct(d).alias("observed_days"), F.count_distinct(week).alias("observed_weeks"), F.min(week).alias("_a"), F.max(week).alias("_b"))
    return rows.withColumns({"expected_days": F.datediff("last_day", "first_day") + 1, "expected_weeks": (F.datediff("_b", "_a") / 7).cast("int") + 1}).drop("_a", "_b")


def missingness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row per column: nulls, blanks, placeholder texts and their share; one pass over the table."""
    text = {c: F.lower(F.trim(F.col(c).cast("string"))) for c in columns}
    placeholders = [t for t in NULL_TOKENS if t]
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(columns):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"n{i}"), F.count_if(text[c] == "").alias(f"b{i}"), F.count_if(text[c].isin(*placeholders)).alias(f"p{i}")]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', n{i}, b{i}, p{i}" for i, c in enumerate(columns))
    rows = one.select("rows", F.expr(f"stack({len(columns)}, {stack}) as (column_name, null_rows, blank_rows, placeholder_rows)"))
    return rows.withColumn("missing_pct", F.round(F.try_divide((F.col("null_rows") + F.col("blank_rows") + F.col("placeholder_rows")) * 100.0, F.col("rows")), 2))


def promotion_logic(obs: DataFrame, by: Sequence[str], price: str = "price", promo: str = "price_promo") -> DataFrame:
    """Rows whose promotional price is missing, below, equal to and above the regular one."""
    a, b = F.col(promo), F.col(price)
    return obs.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(a.isNull()).alias("missing"), F.count_if(a < b).alias("below"), F.count_if(a == b).alias("equal"), F.count_if(a > b).alias("above"))


def validity(df: DataFrame, column: str, least: float | None = None, most: float | None = None) -> DataFrame:
    c = F.col(column)
    return df.agg(
        F.lit(column).alias("column_name"), F.count(c).alias("rows"), F.min(c).alias("least"), F.max(c).alias("greatest"), F.count_if(c <= 0).alias("non_positive"),
        (F.count_if(c < least) if least is not None else F.lit(0).cast("long")).alias("below"), (F.count_if(c > most) if most is not None else F.lit(0).cast("long")).alias("above"),
    )


def top_rows(df: DataFrame, column: str, key: Sequence[str], n: int = 20, descending: bool = True) -> DataFrame:
    """The n rows with the greatest (or least) values, ties by key."""
    c = F.col(column)
    return df.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last(), *key).limit(n)


def consistency(df: DataFrame, entity: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Per entity: rows and distinct values of each attribute."""
    return df.groupBy(*entity).agg(F.count("*").alias("rows"), *(F.count_distinct(a).alias(f"{a}_values") for a in attributes))


def combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("rows"))


def reused(df: DataFrame, value: Sequence[str], entity: str) -> DataFrame:
    """Values that several entities share."""
    return df.groupBy(*value).agg(F.count_distinct(entity).alias("entities"), F.min(entity).alias("first_entity")).where("entities > 1")


def join_profile(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows and keys of both sides, those with a match, and how many rows a join has; from the two key counts alone."""
    a = left.groupBy(*key).agg(F.count("*").alias("a"))
    b = right.groupBy(*key).agg(F.count("*").alias("b"))
    both = a.join(b, list(key), "full_outer")
    got = F.col("a").isNotNull() & F.col("b").isNotNull()
    zero = lambda c: F.coalesce(c, F.lit(0))
    return both.agg(
        zero(F.sum("a")).alias("left_rows"), zero(F.sum("b")).alias("right_rows"), F.count("a").alias("left_keys"), F.count("b").alias("right_keys"), F.count_if(got).alias("matched_keys"),
        zero(F.sum(F.when(got, F.col("a")))).alias("left_rows_matched"), zero(F.sum(F.when(got, F.col("b")))).alias("right_rows_matched"),
        zero(F.sum(F.when(got, F.col("a") * F.col("b")))).alias("joined_rows"), zero(F.max(F.when(got, F.col("b")))).alias("most_rows_a_key"),
    )


def key_audit(keys: Sequence[tuple[str, DataFrame, str, DataFrame, str]], key_type: str = "long") -> DataFrame:
    """For each foreign key (name, table, column, table referred to, its column): rows without a member, and members without a row.

    The keys of all tables go through one aggregate by name and key, combined before its exchange, so a hot key is no task of
    its own and there is no join. Missing keys match nothing; a foreign key of empty tables has a row of zeros.
    """
    spark, names = keys[0][1].sparkSession, F.array(*(F.lit(key[0]) for key in keys))
    rows = spark.range(1).select(F.explode(names).alias("foreign_key"), F.lit(None).cast(key_type).alias("k"), F.lit(0).alias("a"), F.lit(0).alias("b"))
    for name, fact, column, dim, other in keys:
        for df, c, side in ((fact, column, 1), (dim, other, 0)):
            rows = rows.unionAll(df.select(F.lit(name), F.col(c).cast(key_type), F.lit(side), F.lit(1 - side)))
    per = rows.groupBy("foreign_key", "k").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    alone = lambda side, against: F.sum(F.when(F.col("k").isNull() | (F.col(against) == 0), F.col(side)).otherwise(0))
    return per.groupBy("foreign_key").agg(alone("a", "b").alias("orphan_rows"), alone("b", "a").alias("unused_members"))


def agreement(left: DataFrame, right: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """Of a left join by a unique key: rows matched, unmatched, and matched with another value, in per cent too."""
    other = right.select(*key, F.col(column).alias("_other"), F.lit(True).alias("_found"))
    rows = left.join(other, list(key), "left")
    differs = F.col("_found") & ~F.col(column).eqNullSafe(F.col("_other"))
    return rows.agg(F.count("*").alias("rows"), F.count_if("_found").alias("matched"), F.count_if(F.col("_found").isNull()).alias("unmatched"), F.count_if(differs).alias("mismatched")).withColumn("matched_pct", F.round(F.try_divide(F.col("matched") * 100.0, F.col("rows")), 2))


def cardinality(df: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Rows per entity: how many entities, and average, median, least and most rows."""
    per = df.groupBy(*entity).agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("entities"), F.round(F.avg("n"), 6).alias("avg_rows"), F.percentile("n", F.lit(0.5)).alias("median_rows"), F.min("n").alias("min_rows"), F.max("n").alias("max_rows"))


def summarize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row per numeric column: values, nulls, approximate distinct values and quartiles, mean and spread, in one pass."""
    parts = {"n": F.count, "nulls": lambda c: F.count_if(c.isNull()), "lo": F.min, "hi": F.max, "mean": F.avg, "sd": F.stddev, "ndv": F.approx_count_distinct, "q50": lambda c: F.percentile_approx(c, 0.5)}
    one = df.agg(*(f(F.col(c).cast("double")).alias(f"{p}_{i}") for i, c in enumerate(columns) for p, f in parts.items()))
    stack = ", ".join(f"'{c}', " + ", ".join(f"{p}_{i}" for p in parts) for i, c in enumerate(columns))
    return one.select(F.expr(f"stack({len(columns)}, {stack}) as (column_name, {', '.join(parts)})"))


def pivot_counts(df: DataFrame, row: Column, column: str, values: Sequence[str]) -> DataFrame:
    """Counts by row with a column for each value, 0 where there is none. The values are given, so one pass is enough."""
    return df.groupBy(row.alias("row_value")).pivot(column, list(values)).count().na.fill(0)
