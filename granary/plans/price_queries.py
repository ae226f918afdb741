"""Queries over weekly prices: line items are read as observations of a product's price at a place in a week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.columns import week_of
from granary.operators import measures as M
from granary.operators import profiling as P
from granary.operators.bitmaps import MASK, counted_sets, cube, ordinal_masks, presence, rollup, week_ordinal
from granary.operators.facts import lag_ratios, matched_changes, reference_ratio, weekly_fact
from granary.operators.versions import price_versions
from granary.plans.registry import Tables, query
from granary.sources.shared import write_layout, written

PLACE = ["product_id", "location", "week"]
YEAR = 364


def observations(t: Tables, location: str = "l_linestatus") -> DataFrame:
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return t.lineitem.select(
        F.col("l_partkey").alias("product_id"), F.col("l_returnflag").alias("shop"), F.col(location).alias("location"), week_of(F.col("l_shipdate")).alias("week"),
        price.alias("price"), (price * (1 - F.col("l_discount"))).alias("price_promo"),
    )


def obs_sql(location: str = "l_linestatus") -> str:
    return f"""obs AS (SELECT l_partkey AS product_id, l_returnflag AS shop, {location} AS location, CAST(date_trunc('week', l_shipdate) AS DATE) AS week,
  l_extendedprice / l_quantity AS price, l_extendedprice / l_quantity * (1 - l_discount) AS price_promo FROM lineitem)"""


FACT_SQL = """versions AS (SELECT product_id, location, week, price AS regular, price_promo AS promo, price_promo < price AS is_on,
  CASE WHEN price_promo < price THEN price_promo ELSE price END AS effective FROM obs),
grouped AS (SELECT product_id, location, week, count(*) AS price_observation_versions,
  count(DISTINCT regular) AS regular_price_versions, count(DISTINCT promo) AS promo_price_versions, count(DISTINCT effective) AS effective_price_versions,
  min(regular) AS regular_price_min, max(regular) AS regular_price_max, min(promo) AS promo_price_min, max(promo) AS promo_price_max,
  min(effective) AS effective_price_min, max(effective) AS effective_price_max, bool_and(is_on) AS all_on, bool_or(is_on) AS any_on
  FROM versions GROUP BY product_id, location, week),
fact AS (SELECT product_id, location, week,
  CASE WHEN regular_price_versions = 1 THEN regular_price_min END AS regular_price,
  CASE WHEN all_on AND promo_price_versions = 1 THEN promo_price_min END AS promo_price,
  CASE WHEN effective_price_versions = 1 THEN effective_price_min END AS effective_price,
  CASE WHEN all_on AND promo_price_versions = 1 AND regular_price_versions = 1 THEN regular_price_min - promo_price_min END AS discount_amount,
  CASE WHEN all_on AND promo_price_versions = 1 AND regular_price_versions = 1 AND regular_price_min > 0 THEN (regular_price_min - promo_price_min) / regular_price_min END AS discount_pct,
  regular_price_min, regular_price_max, promo_price_min, promo_price_max, effective_price_min, effective_price_max,
  price_observation_versions, regular_price_versions, promo_price_versions, effective_price_versions,
  CASE WHEN all_on = any_on THEN any_on END AS is_promotion,
  regular_price_versions > 1 AS has_intraweek_price_variation, effective_price_versions > 1 AS has_effective_price_variation, all_on <> any_on AS promotion_state_conflict
  FROM grouped)"""


def fact(t: Tables, location: str = "l_linestatus") -> DataFrame:
    return weekly_fact(observations(t, location), PLACE)


def fact_sql(location: str = "l_linestatus") -> str:
    return f"WITH {obs_sql(location)},\n{FACT_SQL}"


@query(fact_sql() + """
SELECT location, count(*) AS price_observations, count(*) FILTER (WHERE is_promotion) AS promotion_observations,
  count(*) FILTER (WHERE is_promotion) / CAST(count(*) AS DOUBLE) AS promotion_rate, round(avg(discount_pct) FILTER (WHERE is_promotion), 6) AS average_promo_depth
FROM fact GROUP BY location""")
def promo_by_location(t: Tables) -> DataFrame:
    rows = fact(t).groupBy("location").agg(F.count("*").alias("price_observations"), F.count_if("is_promotion").alias("promotion_observations"), F.round(F.avg(F.when(F.col("is_promotion"), F.col("discount_pct"))), 6).alias("average_promo_depth"))
    return rows.withColumn("promotion_rate", M.share(F.col("promotion_observations"), F.col("price_observations")))


@query(fact_sql() + "\nSELECT * FROM fact")
def weekly_price_fact(t: Tables) -> DataFrame:
    return fact(t)


@query(f"""WITH {obs_sql()},
twice AS (SELECT * FROM obs UNION ALL SELECT * FROM obs WHERE location = 'F'),
collapsed AS (SELECT product_id, shop, location, week, price, price_promo, count(*) > 1 AS dup FROM twice GROUP BY ALL),
counted AS (SELECT *, count(*) OVER (PARTITION BY product_id, shop, location, week) AS n FROM collapsed)
SELECT CASE WHEN n > 1 THEN 'multiple_price_observations' WHEN dup THEN 'exact_duplicate_collapsed' ELSE 'single_observation' END AS price_resolution_rule,
  n > 1 AS has_multiple_price_versions, count(*) AS n_rows, count(*) FILTER (WHERE price_promo < price) AS promotions, count(*) FILTER (WHERE price <= 0) AS non_positive, max(n) AS most_versions
FROM counted GROUP BY 1, 2""")
def price_versions_profile(t: Tables) -> DataFrame:
    obs = observations(t)
    rows = price_versions(obs.unionByName(obs.where("location = 'F'")), ["product_id", "shop", "location", "week"])
    return rows.groupBy("price_resolution_rule", "has_multiple_price_versions").agg(F.count("*").alias("n_rows"), F.count_if("is_promotion").alias("promotions"), F.count_if("dq_non_positive_price").alias("non_positive"), F.max("price_version_count").alias("most_versions"))


@query(fact_sql() + f""",
earlier AS (SELECT product_id, location, CAST(week + {YEAR} AS DATE) AS week, min(effective_price) AS e, min(regular_price) AS r FROM fact GROUP BY product_id, location, week HAVING count(*) = 1),
ratios AS (SELECT f.location, CASE WHEN f.effective_price > 0 AND e > 0 THEN ln(f.effective_price / e) END AS paid, CASE WHEN f.regular_price > 0 AND r > 0 THEN ln(f.regular_price / r) END AS shelf
  FROM fact f LEFT JOIN earlier USING (product_id, location, week))
SELECT location, count(paid) AS pairs, round(CASE WHEN count(paid) >= 50 THEN exp(avg(paid)) - 1 END, 6) AS paid_change, round(CASE WHEN count(shelf) >= 50 THEN exp(avg(shelf)) - 1 END, 6) AS shelf_change,
  round(CASE WHEN count(paid) >= 50 AND count(shelf) >= 50 THEN (exp(avg(paid)) - exp(avg(shelf))) * 100 END, 6) AS promotion_effect_pp FROM ratios GROUP BY location""")
def yoy_ratio(t: Tables) -> DataFrame:
    rows = lag_ratios(fact(t), ["product_id", "location"], "week", YEAR, {"log_paid": "effective_price", "log_shelf": "regular_price"})
    both = matched_changes(rows, ["location"], {"paid": "log_paid", "shelf": "log_shelf"}, 50)
    return both.select("location", F.col("paid_pairs").alias("pairs"), F.round("paid", 6).alias("paid_change"), F.round("shelf", 6).alias("shelf_change"), F.round((F.col("paid") - F.col("shelf")) * 100, 6).alias("promotion_effect_pp"))


@query(fact_sql("l_returnflag") + """,
base AS (SELECT product_id, week, min(effective_price) AS b FROM fact WHERE location = 'N' GROUP BY product_id, week HAVING count(*) = 1),
ratios AS (SELECT location, CASE WHEN location <> 'N' AND effective_price > 0 AND b > 0 THEN ln(effective_price / b) END AS r FROM fact LEFT JOIN base USING (product_id, week)),
stores AS (SELECT location, count(r) AS pairs, CASE WHEN count(r) >= 20 THEN exp(avg(r)) - 1 END AS idx FROM ratios WHERE location <> 'N' GROUP BY location)
SELECT CAST(sum(pairs) AS BIGINT) AS pairs, count(idx) AS stores_compared, count(*) FILTER (WHERE idx > 0.01) AS stores_above, round(max(idx), 6) AS highest_premium FROM stores""")
def store_vs_national(t: Tables) -> DataFrame:
    rows = reference_ratio(fact(t, "l_returnflag"), ["product_id", "week"], "location", "N", "effective_price", "log_store")
    return M.store_index(rows.where("location != 'N'"), "log_store", "location", least=20)


@query(fact_sql() + """,
earlier AS (SELECT product_id, location, CAST(week + 7 AS DATE) AS week, min(regular_price) AS r FROM fact GROUP BY product_id, location, week HAVING count(*) = 1),
ratios AS (SELECT CASE WHEN f.regular_price > 0 AND r > 0 THEN exp(ln(f.regular_price / r)) END AS x FROM fact f LEFT JOIN earlier USING (product_id, location, week)),
buckets AS (SELECT CAST((x >= 0.5)::INT + (x >= 0.8)::INT + (x >= 0.95)::INT + (x >= 0.999)::INT + (x >= 1.001)::INT + (x >= 1.05)::INT + (x >= 1.25)::INT AS INTEGER) AS bucket FROM ratios WHERE x IS NOT NULL)
SELECT bucket, count(*) AS pairs, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS pair_share FROM buckets GROUP BY bucket""")
def wow_ratio_histogram(t: Tables) -> DataFrame:
    rows = lag_ratios(fact(t), ["product_id", "location"], "week", 7, {"log_shelf": "regular_price"})
    return M.ratio_histogram(rows, "log_shelf", (0.5, 0.8, 0.95, 0.999, 1.001, 1.05, 1.25))


@query(fact_sql() + """
SELECT location, count(*) AS price_observations, count(DISTINCT product_id) AS observed_products, count(DISTINCT week) AS observed_weeks, count(*) FILTER (WHERE is_promotion) AS promotion_observations,
  count(DISTINCT product_id) FILTER (WHERE is_promotion) AS products_on_promotion, min(week) AS first_week, round(avg(discount_pct) FILTER (WHERE is_promotion), 6) AS average_promo_depth,
  count(*) FILTER (WHERE is_promotion) / CAST(count(*) AS DOUBLE) AS promotion_rate, count(DISTINCT product_id) FILTER (WHERE is_promotion) / CAST(count(DISTINCT product_id) AS DOUBLE) AS share_of_products_promoted
FROM fact GROUP BY location""")
def measure_overview(t: Tables) -> DataFrame:
    return M.overview(fact(t), ["location"]).drop("observed_locations")


@query(fact_sql() + """,
months AS (SELECT DISTINCT location, CAST(date_trunc('month', week) AS DATE) AS month, product_id FROM fact),
known AS (SELECT DISTINCT location, month FROM months),
prior AS (SELECT location, CAST(month + INTERVAL 1 MONTH AS DATE) AS month, product_id FROM months),
new AS (SELECT location, month, count(*) AS n FROM months ANTI JOIN prior USING (location, month, product_id) GROUP BY ALL),
gone AS (SELECT location, month, count(*) AS g FROM prior ANTI JOIN months USING (location, month, product_id) GROUP BY ALL)
SELECT k.location, k.month, CASE WHEN p.month IS NOT NULL THEN coalesce(n, 0) END AS newly_observed, CASE WHEN p.month IS NOT NULL THEN coalesce(g, 0) END AS no_longer_observed, CASE WHEN p.month IS NOT NULL THEN -coalesce(g, 0) END AS products_leaving
FROM known k LEFT JOIN (SELECT DISTINCT location, month FROM prior) p USING (location, month) LEFT JOIN new USING (location, month) LEFT JOIN gone USING (location, month)""")
def assortment_churn(t: Tables) -> DataFrame:
    return M.churn(observations(t), ["location"])


@query(fact_sql() + """,
months AS (SELECT DISTINCT CAST(date_trunc('month', week) AS DATE) AS month, product_id, location FROM fact),
prior AS (SELECT CAST(month + INTERVAL 1 MONTH AS DATE) AS month, product_id, location FROM months),
known AS (SELECT DISTINCT k.location, k.month FROM months k SEMI JOIN prior USING (location, month)),
new AS (SELECT location, month, count(*) AS n FROM months ANTI JOIN prior USING (location, month, product_id) GROUP BY ALL),
gone AS (SELECT location, month, count(*) AS g FROM prior ANTI JOIN months USING (location, month, product_id) GROUP BY ALL)
SELECT location, round(avg(coalesce(n, 0)), 6) AS avg_entering, round(avg(coalesce(g, 0)), 6) AS avg_leaving FROM known LEFT JOIN new USING (location, month) LEFT JOIN gone USING (location, month) GROUP BY location""")
def average_monthly_churn(t: Tables) -> DataFrame:
    rows = M.average_churn(M.churn(observations(t), ["location"]), ["location"])
    return rows.select("location", F.round("avg_entering", 6).alias("avg_entering"), F.round("avg_leaving", 6).alias("avg_leaving"))


@query(fact_sql() + """,
w AS (SELECT location, product_id, count(DISTINCT week) AS w FROM fact GROUP BY ALL),
a AS (SELECT location, count(DISTINCT week) AS n FROM fact GROUP BY location)
SELECT location, count(*) FILTER (WHERE w <= 4) / CAST(count(*) AS DOUBLE) AS listed_4_weeks_or_less, count(*) FILTER (WHERE w > 4 AND w < n * 0.5::DOUBLE) / CAST(count(*) AS DOUBLE) AS listed_under_half,
  count(*) FILTER (WHERE w >= n * 0.5::DOUBLE AND w < n * 0.9::DOUBLE) / CAST(count(*) AS DOUBLE) AS listed_half_to_90, count(*) FILTER (WHERE w >= n * 0.9::DOUBLE) / CAST(count(*) AS DOUBLE) AS core_range
FROM w JOIN a USING (location) GROUP BY location""")
def listing_bands(t: Tables) -> DataFrame:
    return M.listing_bands(fact(t), ["location"])


@query(fact_sql() + """,
w AS (SELECT location, week, count(DISTINCT product_id) AS p, count(*) FILTER (WHERE is_promotion) / CAST(count(*) AS DOUBLE) AS r FROM fact GROUP BY ALL),
o AS (SELECT location, count(DISTINCT product_id) AS observed_products FROM fact GROUP BY location)
SELECT location, min(r) AS lowest_weekly_promotion_rate, round(avg(p), 6) AS average_weekly_products, observed_products, round(avg(p) / observed_products, 6) AS share_of_weeks_listed,
  round(100.0 * max_by(p, week) / CAST(min_by(p, week) AS DOUBLE), 6) AS last_products_index FROM w JOIN o USING (location) GROUP BY location, observed_products""")
def weekly_average_products(t: Tables) -> DataFrame:
    rows = M.per_week(fact(t), ["location"])
    return rows.select("location", "lowest_weekly_promotion_rate", "observed_products", *(F.round(c, 6).alias(c) for c in ("average_weekly_products", "share_of_weeks_listed", "last_products_index")))


@query(fact_sql() + """,
typed AS (SELECT f.product_id, f.week, p.p_type FROM fact f JOIN part p ON f.product_id = p.p_partkey),
own AS (SELECT p_type, avg(n) AS a FROM (SELECT p_type, week, count(DISTINCT product_id) AS n FROM typed GROUP BY ALL) GROUP BY p_type),
wide AS (SELECT avg(n) AS b FROM (SELECT week, count(DISTINCT product_id) AS n FROM typed GROUP BY week))
SELECT p_type, round(a, 6) AS average_weekly_products, round(a / b, 6) AS share_of_weekly_range FROM own, wide""")
def share_of_range(t: Tables) -> DataFrame:
    typed = fact(t).join(t.part.select(F.col("p_partkey").alias("product_id"), "p_type"), "product_id").withColumn("is_promotion", F.lit(False))
    rows = M.range_share(typed, ["p_type"], [])
    return rows.select("p_type", F.round("average_weekly_products", 6).alias("average_weekly_products"), F.round("share_of_weekly_range", 6).alias("share_of_weekly_range"))


@query(f"""WITH {obs_sql()}
SELECT shop, count(*) AS rows, count(*) FILTER (WHERE price_promo IS NULL) AS missing, count(*) FILTER (WHERE price_promo < price) AS below, count(*) FILTER (WHERE price_promo = price) AS equal, count(*) FILTER (WHERE price_promo > price) AS above FROM obs GROUP BY shop""")
def promotion_logic(t: Tables) -> DataFrame:
    return P.promotion_logic(observations(t), ["shop"])


@query("""SELECT p_type, p_partkey, round(pa, 6) AS product_average, round(ca, 6) AS category_average, round(pa / ca - 1, 6) AS vs_category FROM (
  SELECT *, avg(pa) OVER (PARTITION BY p_type) AS ca FROM (SELECT p_type, p_partkey, avg(l_quantity) AS pa FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL))""")
def category_benchmark(t: Tables) -> DataFrame:
    values = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_quantity").join(t.part.select("p_partkey", "p_type"), "p_partkey")
    rows = M.category_benchmark(values, "p_partkey", ["p_type"], "l_quantity")
    return rows.select("p_type", "p_partkey", *(F.round(c, 6).alias(c) for c in ("product_average", "category_average", "vs_category")))


@query("""WITH v AS (SELECT l_partkey, l_linestatus AS basis, l_returnflag AS part, unnest(['quantity', 'discount', 'tax']) AS entry, unnest([l_quantity, l_discount, l_tax]) AS value FROM lineitem),
top AS (SELECT part, l_partkey, basis, entry, max(value) AS v FROM v GROUP BY ALL),
high AS (SELECT part, l_partkey, entry, bool_or(v > CASE entry WHEN 'quantity' THEN 45 WHEN 'discount' THEN 0.08::DOUBLE ELSE 0.07::DOUBLE END * CASE WHEN basis = 'O' THEN 0.5::DOUBLE ELSE 1 END) AS h FROM top GROUP BY ALL),
every AS (SELECT part, entry, count(*) FILTER (WHERE h) AS high_products, count(*) AS products FROM high GROUP BY ALL
  UNION ALL SELECT part, 'any', count(*) FILTER (WHERE h), count(*) FROM (SELECT part, l_partkey, bool_or(h) AS h FROM high GROUP BY ALL) GROUP BY part)
SELECT part, entry, high_products, products, high_products / CAST(products AS DOUBLE) AS share_high FROM every""")
def threshold_flags(t: Tables) -> DataFrame:
    stack = "stack(3, 'quantity', l_quantity, 'discount', l_discount, 'tax', l_tax) as (entry, value)"
    values = t.lineitem.select("l_partkey", F.col("l_linestatus").alias("basis"), F.col("l_returnflag").alias("part"), F.expr(stack))
    return M.high_shares(values, "l_partkey", ["part"], "basis", "O", "entry", "value", {"quantity": 45, "discount": 0.08, "tax": 0.07})


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY ROLLUP (1, 2, 3)""")
def calendar_rollup(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    rows = t.orders.select(F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), "o_totalprice")
    return rows.rollup("year", "quarter", "month").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(fact_sql() + """
SELECT location, count(*) AS observations, count(*) FILTER (WHERE p_size <= 25) AS matching, count(DISTINCT product_id) FILTER (WHERE p_size <= 25) AS matching_products, count(*) FILTER (WHERE p_size <= 25) / CAST(count(*) AS DOUBLE) AS matching_share
FROM fact LEFT JOIN part ON product_id = p_partkey GROUP BY location""")
def classified_share(t: Tables) -> DataFrame:
    """Share of observations whose product is of a class; the same measure gives that of inferred products."""
    rows = fact(t).join(t.part.select(F.col("p_partkey").alias("product_id"), "p_size"), "product_id", "left")
    return M.filtered_share(rows, ["location"], F.col("p_size") <= 25)


@query(fact_sql() + """,
s AS (SELECT f.location, f.product_id, f.week, p_brand FROM fact f JOIN part ON product_id = p_partkey)
SELECT p_brand, location, count(DISTINCT product_id) AS products, count(*) AS observations, min(week) AS first_week FROM s GROUP BY ROLLUP (p_brand, location)""")
def brand_rollup(t: Tables) -> DataFrame:
    """The drill from brand to place, with its totals: products of the upper levels are an OR of the bitmaps below.

    The weeks of a product at a place, which are its observations, are bits of a few numbers; only these meet brands and bitmaps.
    """
    week = F.col("week")
    weeks = ordinal_masks(observations(t), ["product_id", "location"], F.floor(F.datediff(week, F.lit("1970-01-05").cast("date")) / 7), {"first_week": week})
    per = weeks.withColumn("n", F.coalesce(F.bit_count(MASK), F.lit(1)).cast("long"))  # without a week it is one observation too
    rows = per.join(t.part.select(F.col("p_partkey").alias("product_id"), "p_brand"), "product_id")
    there = presence(rows, ["p_brand", "location"], "product_id", sums={"observations": F.col("n")}, least={"first_week": F.col("first_week")})
    return counted_sets(there, rollup("p_brand", "location"), sums=["observations"], least=["first_week"]).withColumnRenamed("keys", "products")


@query(fact_sql() + """
SELECT location, year, count(DISTINCT product_id) AS products, count(DISTINCT product_id) FILTER (WHERE is_promotion) AS promoted_products, count(DISTINCT week) AS weeks, count(*) AS observations, min(week) AS first_week
FROM (SELECT *, CAST(year(week) AS INTEGER) AS year FROM fact) GROUP BY CUBE (location, year)""")
def presence_cube(t: Tables) -> DataFrame:
    """Products, promoted products and weeks of every grouping of place and year, from one written table of bitmaps."""
    rows = fact(t).withColumn("year", F.year("week"))
    there = presence(
        rows, ["location", "year"], "product_id", narrow={"weeks": week_ordinal(F.col("week"))}, where={"promoted_products": F.col("is_promotion")},
        sums={"observations": F.lit(1)}, least={"first_week": F.col("week")},
    )
    found = counted_sets(written(there, "presence"), cube("location", "year"), wide=["keys", "promoted_products"], narrow=["weeks"], sums=["observations"], least=["first_week"])
    return found.withColumnRenamed("keys", "products")


@query(fact_sql("l_returnflag") + f""",
earlier AS (SELECT product_id, location, CAST(week + {YEAR} AS DATE) AS week, min(effective_price) AS e FROM fact GROUP BY product_id, location, week HAVING count(*) = 1),
base AS (SELECT product_id, week, min(effective_price) AS b FROM fact WHERE location = 'N' GROUP BY product_id, week HAVING count(*) = 1),
years AS (SELECT location, CASE WHEN effective_price > 0 AND e > 0 THEN ln(effective_price / e) END AS r FROM fact LEFT JOIN earlier USING (product_id, location, week)),
stores AS (SELECT location, CASE WHEN location <> 'N' AND effective_price > 0 AND b > 0 THEN ln(effective_price / b) END AS r FROM fact LEFT JOIN base USING (product_id, week))
SELECT 'year' AS against, location, count(r) AS pairs, round(exp(avg(r)) - 1, 6) AS change FROM years GROUP BY location
UNION ALL SELECT 'reference', location, count(r), round(exp(avg(r)) - 1, 6) FROM stores GROUP BY location""")
def published_ratios(t: Tables) -> DataFrame:
    """Both kinds of ratio over one table in buckets of the product: neither shuffles a row of the fact."""
    rows = fact(t, "l_returnflag").select(*PLACE, "effective_price")
    layout = write_layout(rows, ["product_id"], PLACE, int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    return bucketed_ratios(layout)


def bucketed_ratios(layout: DataFrame) -> DataFrame:
    year = lag_ratios(layout, ["product_id", "location"], "week", YEAR, {"r": "effective_price"})
    reference = reference_ratio(layout, ["product_id", "week"], "location", "N", "effective_price", "r")
    out = None
    for name, ratios in (("year", year), ("reference", reference)):
        own = ratios.groupBy("location").agg(F.count("r").alias("pairs"), F.round(F.exp(F.avg("r")) - 1, 6).alias("change")).withColumn("against", F.lit(name))
        out = own if out is None else out.unionByName(own)
    return out
