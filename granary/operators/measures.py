"""Business measures over the weekly fact, each for any list of grouping columns.

A measure that looks beyond its own group (all weeks, the whole range, the month before) says which grouping columns it
keeps when it does; the wider figure is aggregated at that grain and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from granary.operators.bitmaps import counted, counted_masks, merged_masks, ordinal_masks, presence, week_ordinal
from granary.operators.joins import beside


def share(a: Column, b: Column) -> Column:
    """Null where there is nothing to divide by."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def overview(fact: DataFrame, by: Sequence[str], product: str = "product_id", location: str = "location", week: str = "week") -> DataFrame:
    """Observations, observed members and promotions of each group.

    Rows are first brought to one for each product of a group, which combines before the shuffle; places and weeks are
    counted from distinct pairs, so that no row is expanded once for each count.
    """
    on = F.col("is_promotion")
    per = fact.groupBy(*by, product).agg(
        F.count("*").alias("n"), F.count_if(on).alias("on"), F.sum(F.when(on, F.col("discount_pct"))).alias("depth"), F.count(F.when(on, F.col("discount_pct"))).alias("deep"), F.min(week).alias("first_week"),
    )
    products = per.groupBy(*by).agg(
        F.sum("n").alias("price_observations"), F.count(product).alias("observed_products"), F.sum("on").alias("promotion_observations"), F.count_if((F.col("on") > 0) & F.col(product).isNotNull()).alias("products_on_promotion"),
        F.round(F.try_divide(F.sum("depth"), F.sum("deep")), 6).alias("average_promo_depth"), F.min("first_week").alias("first_week"),
    )
    out = products.withColumns({"promotion_rate": share(F.col("promotion_observations"), F.col("price_observations")), "share_of_products_promoted": share(F.col("products_on_promotion"), F.col("observed_products"))})
    return beside(out, observed(fact, by, {"observed_locations": location, "observed_weeks": week}), by)


def observed(fact: DataFrame, by: Sequence[str], members: dict[str, str]) -> DataFrame:
    """How many values of each column (name -> column) a group has, from distinct pairs of group and value."""
    out = None
    for name, column in members.items():
        pairs = fact.select(*by, F.col(column).alias("_member")).distinct()
        own = pairs.groupBy(*by).agg(F.count("_member").alias(name))
        out = own if out is None else beside(out, own, by)
    return out


def first_observation(fact: DataFrame, by: Sequence[str], week: str = "week") -> DataFrame:
    """The earliest date of each group's rows, whatever dates are asked about elsewhere: those of the rows themselves count."""
    return fact.groupBy(*by).agg(F.min(week).alias("first_observation"))


def products_index(fact: DataFrame, by: Sequence[str], week: str = "week", product: str = "product_id") -> DataFrame:
    """Products of every week of each group, and as an index to those of the group's first week (100).

    Weeks are few beside rows: their products are counted once, and the first week's count joins them back.
    """
    weekly = fact.select(*by, week, product).distinct().groupBy(*by, week).agg(F.count(product).alias("observed_products"))
    base = weekly.groupBy(*by).agg(F.min_by("observed_products", week).alias("_base"))
    rows = beside(weekly, base, by)
    return rows.withColumn("observed_products_index", share(F.col("observed_products"), F.col("_base")) * 100).drop("_base")


def usable_products(labels: DataFrame, by: Sequence[str], product: str = "product_key", usable: str = "is_value_usable") -> DataFrame:
    """Products with a usable label entry in each group."""
    return labels.where(F.col(usable)).select(*by, product).distinct().groupBy(*by).agg(F.count(product).alias("products_with_usable_labels"))


def average_value(
    labels: DataFrame, by: Sequence[str], entry: str, value: str, basis: str = "nutrition_basis", usable: str = "is_value_usable", latest: str = "is_latest_observation", per: str = "per_100g",
) -> DataFrame:
    """The average value per 100 g of each group that has one entry only: usable ones of each product's latest observation."""
    wanted = F.col(usable) & F.col(latest) & (F.col(basis) == per)
    rows = labels.groupBy(*by).agg(F.min(entry).alias("_a"), F.max(entry).alias("_b"), F.avg(F.when(wanted, F.col(value))).alias("_v"))
    return rows.select(*by, F.when(F.col("_a") == F.col("_b"), F.col("_v")).alias("average_value_per_100g"))


# Colours of bars.
TEAL, LIGHT_TEAL, GREY = "#12A19B", "#A8DCD9", "#B4B2A9"


def category_colour(category: Column, muted: Sequence[str] = ("Other / Unclassified", "Non-FMCG / General Merchandise")) -> Column:
    """Grey for groups that say nothing; where there is no one category the colour is that of all others."""
    return F.when(category.isin(*muted), GREY).otherwise(TEAL)


def premium_colour(index: Column, above: float = 0.01) -> Column:
    """Teal above the reference price, light at or below it and where there is no index."""
    return F.when(index > above, TEAL).otherwise(LIGHT_TEAL)


def weekly_presence(fact: DataFrame, by: Sequence[str], week: str = "week", product: str = "product_id") -> DataFrame:
    """Bitmaps of the products of each group and week, beside observations and promotions. Products are whole numbers."""
    return presence(fact, [*by, week], product, sums={"n": F.lit(1), "promoted": F.coalesce(F.col("is_promotion"), F.lit(False)).cast("long")})


def per_week(fact: DataFrame, by: Sequence[str], week: str = "week", product: str = "product_id") -> DataFrame:
    """Of each group: the least weekly promotion rate, the average products a week (weeks without rows skipped), the share of
    weeks that a product is listed, and products a week indexed to the first week.

    Both counts of products, of weeks and of all weeks, come from one table of bitmaps.
    """
    there = weekly_presence(fact, by, week, product)
    weekly = counted(there, [*by, week], sums=["n", "promoted"]).withColumnRenamed("keys", "products").withColumn("rate", share(F.col("promoted"), F.col("n")))
    rows = weekly.groupBy(*by).agg(F.min("rate").alias("lowest_weekly_promotion_rate"), F.avg("products").alias("average_weekly_products"), F.min_by("products", week).alias("first_products"), F.max_by("products", week).alias("last_products"))
    rows = beside(rows, counted(there, by).withColumnRenamed("keys", "observed_products"), by)
    return rows.withColumns({"share_of_weeks_listed": share(F.col("average_weekly_products"), F.col("observed_products")), "last_products_index": share(F.col("last_products") * 100, F.col("first_products"))})


def average_weekly(there: DataFrame, by: Sequence[str], name: str, week: str = "week") -> DataFrame:
    """Average products a week of each group of a table of weekly_presence by these columns and others."""
    return counted(there, [*by, week]).groupBy(*by).agg(F.avg("keys").alias(name))


def range_share(fact: DataFrame, by: Sequence[str], within: Sequence[str], week: str = "week", product: str = "product_id") -> DataFrame:
    """Average weekly products of a group as a share of those of the wider group `within`, which is by some of its columns.

    The wider group's bitmaps are those of its parts put together.
    """
    there = weekly_presence(fact, by, week, product)
    rows = beside(average_weekly(there, by, "average_weekly_products", week), average_weekly(there, within, "wider", week), within)
    return rows.withColumn("share_of_weekly_range", share(F.col("average_weekly_products"), F.col("wider"))).drop("wider")


def listing_bands(fact: DataFrame, by: Sequence[str], week: str = "week", product: str = "product_id") -> DataFrame:
    """Shares of products by the weeks they are listed, against all weeks of the group: at most 4; more, but under half; half to under 90 %; 90 % and more.

    Weeks of a product are bits of a few numbers, of which the group's are an OR; products are then one row for each number of weeks.
    """
    masks = ordinal_masks(fact, [*by, product], week_ordinal(F.col(week)))
    per = counted_masks(masks, [*by, product], "w").groupBy(*by, "w").agg(F.count("*").alias("n"))
    rows = beside(per, counted_masks(merged_masks(masks, by), by, "all_weeks"), by)
    w, half, most = F.col("w"), F.col("all_weeks") * 0.5, F.col("all_weeks") * 0.9
    bands = {"listed_4_weeks_or_less": w <= 4, "listed_under_half": (w > 4) & (w < half), "listed_half_to_90": (w >= half) & (w < most), "core_range": w >= most}
    return rows.groupBy(*by).agg(*(share(F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)), F.sum("n")).alias(n) for n, c in bands.items()))


#: Months of one number in churn: bits 1 to 62, behind bit 0 for the month before them.
MONTHS = 62


def churn(fact: DataFrame, by: Sequence[str], week: str = "week", product: str = "product_id") -> DataFrame:
    """By month: products new against the calendar month before, and gone since; null where the group has no such month.

    A product's months are bits of a few numbers, in a hash aggregate whose groups don't grow with the rows of a product; the
    months before are the same bits shifted by one, so no table is joined with itself. The last month of a number is also bit
    0 of the next one. How often a product stands in a month changes nothing. A missing product is one like others.
    """
    month = (F.year(week) * 12 + F.month(week) - 1).cast("long")
    seen = fact.select(*by, product, F.floor(month / MONTHS).alias("_word"), F.coalesce(F.pmod(month, F.lit(MONTHS)) + 1, F.lit(1)).cast("int").alias("_bit"))
    place = F.struct("_word", "_bit")
    next_one = F.struct((F.col("_word") + 1).alias("_word"), F.lit(0).alias("_bit"))
    seen = seen.select(*by, product, F.explode(F.when(F.col("_bit") == MONTHS, F.array(place, next_one)).otherwise(F.array(place))).alias("_at"))
    masks = seen.groupBy(*by, product, F.col("_at._word").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, _at._bit)")).alias("_here"))
    # Rows without a week are a month that has itself before it.
    masks = masks.withColumn("_before", F.when(F.col("_word").isNull(), F.col("_here")).otherwise(F.shiftleft("_here", 1)))
    bits = masks.select(*by, "_word", "_here", "_before", F.explode(F.sequence(F.lit(1), F.lit(MONTHS))).alias("_bit"))
    has = lambda c: F.expr(f"(shiftright({c}, _bit) & 1L) = 1L")
    own = bits.select(*by, "_word", "_bit", has("_here").alias("here"), has("_before").alias("before")).where("here or before")
    rows = own.groupBy(*by, "_word", "_bit").agg(
        F.count_if(F.col("here") & ~F.col("before")).alias("new"),
        F.count_if(F.col("before") & ~F.col("here")).alias("gone"),
        F.bool_or("here").alias("known"),
        F.bool_or("before").alias("there"),
    )
    n = F.col("_word") * MONTHS + F.col("_bit") - 1
    rows = rows.withColumn("month", F.make_date(F.floor(n / 12).cast("int"), (F.pmod(n, F.lit(12)) + 1).cast("int"), F.lit(1)))
    when = lambda c, name: F.when(F.col("there"), c).alias(name)
    new, gone = F.col("new"), F.col("gone")
    return rows.where("known").select(*by, "month", when(new, "newly_observed"), when(gone, "no_longer_observed"), when(-gone, "products_leaving"))


def average_churn(monthly: DataFrame, by: Sequence[str]) -> DataFrame:
    """Averages over the months that have a month before."""
    return monthly.where("newly_observed is not null").groupBy(*by).agg(F.avg("newly_observed").alias("avg_entering"), F.avg("no_longer_observed").alias("avg_leaving"))


def category_benchmark(values: DataFrame, product: str, category: Sequence[str], value: str) -> DataFrame:
    """Each product's average, its category's mean of products' averages (each product weighs the same), and the difference in per cent."""
    own = values.groupBy(product, *category).agg(F.avg(value).alias("product_average"))
    mean = own.groupBy(*category).agg(F.avg("product_average").alias("category_average"))
    return own.join(mean, list(category)).withColumn("vs_category", share(F.col("product_average"), F.col("category_average")) - 1)


def high_shares(values: DataFrame, product: str, by: Sequence[str], basis: str, halved: str, entry: str, value: str, limits: dict[str, float]) -> DataFrame:
    """Share of products with a value of an entry above its limit (half of it on the basis `halved`), and of any entry.

    One aggregate by product has a flag for each limit.
    """
    scale = F.when(F.col(basis) == halved, 0.5).otherwise(1.0)
    flags = []
    for i, (name, most) in enumerate(limits.items()):
        own = F.col(entry) == name
        flags += [F.bool_or(own).alias(f"_has{i}"), F.bool_or(own & (F.col(value) > most * scale)).alias(f"_high{i}")]
    per = values.where(F.col(entry).isin(*limits)).groupBy(*by, product).agg(*flags)
    n = range(len(limits))
    counts = [F.count_if(f"_{k}{i}").alias(f"_{k}{i}") for i in n for k in ("high", "has")]
    per = per.withColumn("_any", F.coalesce(F.greatest(*(F.coalesce(f"_high{i}", F.lit(False)) for i in n)) if len(limits) > 1 else F.col("_high0"), F.lit(False)))
    rows = per.groupBy(*by).agg(*counts, F.count_if("_any").alias("_high_any"), F.count("*").alias("_has_any"))
    each = [F.struct(F.lit(name).alias(entry), F.col(f"_high{i}").alias("high_products"), F.col(f"_has{i}").alias("products")) for i, name in enumerate(limits)]
    each.append(F.struct(F.lit("any").alias(entry), F.col("_high_any").alias("high_products"), F.col("_has_any").alias("products")))
    rows = rows.select(*by, F.explode(F.array(*each)).alias("_e")).select(*by, "_e.*").where("products > 0")
    return rows.withColumn("share_high", share(F.col("high_products"), F.col("products")))


def store_index(fact: DataFrame, ratio: str, store: str, by: Sequence[str] = (), least: int = 500, above: float = 0.01) -> DataFrame:
    """Stores with enough pairs, those above the national price, and the greatest premium, of each group."""
    per = fact.groupBy(*by, store).agg(F.count(ratio).alias("pairs"), F.avg(ratio).alias("m"))
    index = F.when(F.col("pairs") >= least, F.exp("m") - 1)
    return per.withColumn("index", index).groupBy(*by).agg(F.sum("pairs").alias("pairs"), F.count("index").alias("stores_compared"), F.count_if(F.col("index") > above).alias("stores_above"), F.round(F.max("index"), 6).alias("highest_premium"))


def ratio_histogram(df: DataFrame, log_ratio: str, edges: Sequence[float], name: str = "bucket") -> DataFrame:
    """Pairs in each bucket of the ratio, from 0 up to the first edge, and their share of all."""
    r = F.exp(log_ratio)
    bucket = F.lit(0)
    for e in edges:
        bucket = bucket + F.when(r >= e, 1).otherwise(0)
    rows = df.where(F.col(log_ratio).isNotNull()).groupBy(bucket.alias(name)).agg(F.count("*").alias("pairs"))
    return rows.withColumn("pair_share", share(F.col("pairs"), F.sum("pairs").over(W.partitionBy())))


def filtered_share(fact: DataFrame, by: Sequence[str], condition: Column, product: str = "product_id") -> DataFrame:
    """Rows and products that hold the condition, and their share of all rows."""
    rows = fact.groupBy(*by).agg(F.count("*").alias("observations"), F.count_if(condition).alias("matching"), F.count_distinct(F.when(condition, F.col(product))).alias("matching_products"))
    return rows.withColumn("matching_share", share(F.col("matching"), F.col("observations")))
