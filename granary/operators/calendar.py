"""The date dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.columns import iso_week_label, week_of


def date_dimension(sources: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Every day of the calendar years that the given date columns span; no source value is below the first or above the last day."""
    bounds = None
    for df, column in sources:
        own = df.agg(F.min(F.col(column).cast("date")).alias("lo"), F.max(F.col(column).cast("date")).alias("hi"))
        bounds = own if bounds is None else bounds.unionByName(own)
    span = bounds.agg(F.trunc(F.min("lo"), "year").alias("lo"), F.date_sub(F.add_months(F.trunc(F.max("hi"), "year"), 12), 1).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    d = F.col("date")
    year, month, quarter = F.year(d), F.month(d), F.quarter(d)
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), d, year.alias("year"), quarter.alias("quarter"),
        F.concat(F.lit("Q"), quarter).alias("quarter_label"), (year * 10 + quarter).alias("year_quarter_key"),
        month.alias("month"), F.date_format(d, "MMMM").alias("month_name"), (year * 100 + month).alias("year_month_key"), F.date_format(d, "yyyy-MM").alias("year_month"),
        F.extract(F.lit("yearofweek"), d).alias("iso_year"), F.weekofyear(d).alias("iso_week"), iso_week_label(d).alias("year_week"),
        week_of(d).alias("week_start_date"), F.date_add(week_of(d), 6).alias("week_end_date"),
        F.dayofmonth(d).alias("day_of_month"), F.extract(F.lit("dayofweek_iso"), d).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"),
        F.extract(F.lit("dayofweek_iso"), d).isin(6, 7).alias("is_weekend"),
    )
