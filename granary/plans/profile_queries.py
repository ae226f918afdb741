"""Further profiles: conflicts, codes, conversions, structure of paths, and deterministic samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions import columns as C
from granary.operators import labels, paths
from granary.operators import sketches as S
from granary.operators.joins import beside
from granary.operators.measures import share
from granary.operators.versions import canonical
from granary.plans.registry import Tables, query
from granary.plans.table_queries import page_paths, part_labels
from granary.sources.shared import written


@query("""SELECT c_mktsegment, count(*) AS customers, count(*) FILTER (WHERE e.user_id IS NULL) AS without_events, count(*) FILTER (WHERE e.user_id IS NULL) / CAST(count(*) AS DOUBLE) AS missing_share
FROM customer LEFT JOIN (SELECT DISTINCT user_id FROM events) e ON c_custkey = user_id GROUP BY c_mktsegment""")
def missing_by_group(t: Tables) -> DataFrame:
    seen = t.events.select(F.col("user_id").alias("c_custkey")).distinct().withColumn("seen", F.lit(True))
    rows = t.customer.join(seen, "c_custkey", "left").groupBy("c_mktsegment").agg(F.count("*").alias("customers"), F.count_if(F.col("seen").isNull()).alias("without_events"))
    return rows.withColumn("missing_share", share(F.col("without_events"), F.col("customers")))


@query("""WITH c AS (SELECT c_nationkey * 5.0::DOUBLE - 20 AS lat, CASE WHEN c_acctbal >= 0 THEN c_nationkey * 10.0::DOUBLE - 30 END AS lon, c_custkey AS z FROM customer)
SELECT count(*) AS rows, count(*) FILTER (WHERE lat NOT BETWEEN -90 AND 90) AS bad_latitude, count(*) FILTER (WHERE lon NOT BETWEEN -180 AND 180) AS bad_longitude, count(*) FILTER (WHERE (lat IS NULL) <> (lon IS NULL)) AS incomplete,
  count(*) FILTER (WHERE lat NOT BETWEEN 49.4::DOUBLE AND 53.6::DOUBLE OR lon NOT BETWEEN 2.5::DOUBLE AND 7.3::DOUBLE) AS outside, count(*) FILTER (WHERE regexp_matches(CAST(z AS VARCHAR), '^[0-9]{4}$')) AS four_digit_codes, min(lat) AS south, max(lat) AS north FROM c""")
def coordinate_validity(t: Tables) -> DataFrame:
    lat, lon = F.col("c_nationkey") * F.lit(5.0) - 20, F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey") * F.lit(10.0) - 30)
    rows = t.customer.select(lat.alias("lat"), lon.alias("lon"), F.col("c_custkey").cast("string").alias("z"))
    a, b = F.col("lat"), F.col("lon")
    return rows.agg(F.count("*").alias("rows"), F.count_if(~a.between(-90, 90)).alias("bad_latitude"), F.count_if(~b.between(-180, 180)).alias("bad_longitude"), F.count_if(a.isNull() != b.isNull()).alias("incomplete"), F.count_if(C.outside_box(a, b)).alias("outside"), F.count_if(F.col("z").rlike("^[0-9]{4}$")).alias("four_digit_codes"), F.min(a).alias("south"), F.max(a).alias("north"))


@query("SELECT k AS entry, u AS unit, count(*) AS n, count(*) FILTER (WHERE num) AS numeric_values FROM (SELECT unnest(['size', 'price', 'brand', 'kj', 'kcal']) AS k, unnest(['g', 'cent', 'text', 'kj', 'kcal']) AS u, unnest([TRUE, TRUE, FALSE, TRUE, TRUE]) AS num FROM part) GROUP BY ALL")
def unit_pairs(t: Tables) -> DataFrame:
    rows = labels.unpivot(part_labels(t), "payload", "$.nutrients")
    return rows.groupBy("entry", F.col("raw_unit").alias("unit")).agg(F.count("*").alias("n"), F.count_if(F.col("raw_value").try_cast("double").isNotNull()).alias("numeric_values"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 3)")
def duplicate_key_rows(t: Tables) -> DataFrame:
    key = ["l_orderkey", "l_linenumber"]
    many = t.lineitem.groupBy(*key).count().where("count > 3").drop("count")
    return t.lineitem.select(*key, "l_partkey", "l_quantity").join(many, key, "left_semi")


@query("""SELECT CASE WHEN p > 1 AND v > 1 THEN 'both' WHEN p > 1 THEN 'payload' WHEN v > 1 THEN 'value' ELSE 'none' END AS conflict, count(*) AS grains, CAST(sum(n) AS BIGINT) AS rows FROM (
  SELECT count(*) AS n, count(DISTINCT props) AS p, count(DISTINCT value) AS v FROM events GROUP BY user_id, event_type, CAST(ts AS DATE) HAVING count(*) > 1) GROUP BY 1""")
def conflict_types(t: Tables) -> DataFrame:
    per = t.events.groupBy("user_id", "event_type", F.col("ts").cast("date")).agg(F.count("*").alias("n"), (F.min("props") != F.max("props")).alias("p"), (F.min("value") != F.max("value")).alias("v")).where("n > 1")
    kind = F.when(F.col("p") & F.col("v"), "both").when(F.col("p"), "payload").when(F.col("v"), "value").otherwise("none")
    return per.groupBy(kind.alias("conflict")).agg(F.count("*").alias("grains"), F.sum("n").alias("rows"))


_KEYS = (("p_partkey", ["p_partkey"]), ("p_name", ["p_name"]), ("p_name+p_brand", ["p_name", "p_brand"]))


@query(" UNION ALL ".join(f"SELECT '{name}' AS candidate_key, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(k)} FROM part)) AS keys, (SELECT count(*) FROM part a JOIN part b USING ({', '.join(k)})) AS joined_rows" for name, k in _KEYS))
def candidate_join_keys(t: Tables) -> DataFrame:
    """How many rows a self-join by each candidate has, from the rows per key."""
    out = None
    for name, key in _KEYS:
        row = t.part.groupBy(*key).agg(F.count("*").alias("n")).agg(F.lit(name).alias("candidate_key"), F.count("*").alias("keys"), F.sum(F.col("n") * F.col("n")).alias("joined_rows"))
        out = row if out is None else out.unionByName(row)
    return out


@query("""WITH p AS (SELECT regexp_extract(url, '^[a-z]+://([^/]+)/', 1) AS host, list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1), '/'), lambda s: s <> '') AS s FROM pages)
SELECT s[1] AS root, count(*) AS paths, count(DISTINCT host) AS hosts, median(len(s)) AS median_depth, max(len(s)) AS max_depth FROM p GROUP BY s[1]""")
def path_structure(t: Tables) -> DataFrame:
    rows = page_paths(t).select("host", F.col("paths")[1].alias("s"))
    return rows.groupBy(F.get("s", F.lit(0)).alias("root")).agg(F.count("*").alias("paths"), F.count_distinct("host").alias("hosts"), F.percentile(F.size("s"), F.lit(0.5)).alias("median_depth"), F.max(F.size("s")).cast("bigint").alias("max_depth"))


@query("""SELECT raw, count(*) AS n FROM (SELECT CASE WHEN p_size < 5 THEN ' N/A ' WHEN p_size < 10 THEN 'unknown' WHEN p_size < 15 THEN 'UNKNOWN brand' ELSE p_brand END AS raw FROM part) WHERE lower(trim(raw)) IN ('', 'null', 'none', 'n/a', '#n/a', 'not provided', 'no brand', 'unknown', '*', '.', 'geen') GROUP BY raw""")
def semantic_nulls(t: Tables) -> DataFrame:
    """Raw values that cleaning turns into null."""
    size = F.col("p_size")
    rows = t.part.select(F.when(size < 5, " N/A ").when(size < 10, "unknown").when(size < 15, "UNKNOWN brand").otherwise(F.col("p_brand")).alias("raw"))
    return rows.where(F.col("raw").isNotNull() & C.normalize_text(F.col("raw"), C.COLUMN_TOKENS["brand"]).isNull()).groupBy("raw").agg(F.count("*").alias("n"))


@query("SELECT n_name, count(*) FILTER (WHERE s = 'customer') AS customer, count(*) FILTER (WHERE s = 'supplier') AS supplier FROM (SELECT c_nationkey AS k, 'customer' AS s FROM customer UNION ALL SELECT s_nationkey, 'supplier' FROM supplier) JOIN nation ON k = n_nationkey GROUP BY n_name")
def code_presence(t: Tables) -> DataFrame:
    rows = t.customer.select(F.col("c_nationkey").alias("n_nationkey"), F.lit("customer").alias("source")).unionByName(t.supplier.select(F.col("s_nationkey").alias("n_nationkey"), F.lit("supplier").alias("source")))
    return rows.join(t.nation.select("n_nationkey", "n_name"), "n_nationkey").groupBy("n_name").pivot("source", ["customer", "supplier"]).count().na.fill(0)


@query("""SELECT CASE WHEN n > 1 AND tied > 1 THEN 'deterministic_hash_tiebreak' WHEN n > 1 THEN 'completeness_first' ELSE 'single_observation' END AS selection_reason, count(*) AS grains FROM (
  SELECT user_id, event_type, CAST(ts AS DATE) AS d, count(*) AS n, count(*) FILTER (WHERE length(props) = m) AS tied FROM (SELECT *, max(length(props)) OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)) AS m FROM events) GROUP BY ALL) GROUP BY 1""")
def selection_reasons(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "event_type", F.col("ts").cast("date").alias("day"), "props", F.length("props").alias("complete"))
    return canonical(rows, ["user_id", "event_type", "day"], ["complete"], "props", [F.col("event_id")]).groupBy("selection_reason").agg(F.count("*").alias("grains"))


@query("""SELECT region, r_name, count(*) AS n FROM (SELECT CASE WHEN c_custkey BETWEEN 1000 AND 1299 THEN 'Brussels' WHEN c_custkey BETWEEN 1300 AND 1499 OR c_custkey BETWEEN 4000 AND 7999 THEN 'Wallonia' WHEN c_custkey BETWEEN 1500 AND 3999 OR c_custkey BETWEEN 8000 AND 9999 THEN 'Flanders' END AS region, r_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) GROUP BY ALL""")
def region_cross_check(t: Tables) -> DataFrame:
    rows = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy(C.region(F.col("c_custkey").cast("string")).alias("region"), "r_name").agg(F.count("*").alias("n"))


@query("""WITH p AS (SELECT regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]*)', 1) AS label, page_id FROM pages)
SELECT label, count(*) AS support, count(DISTINCT page_id) AS pages FROM p WHERE label NOT IN ('en', 'de') GROUP BY label HAVING count(*) >= 5""")
def unmapped_labels(t: Tables) -> DataFrame:
    """Labels without an anchor that stand often enough to be reviewed."""
    rows = paths.usable_paths(paths.category_paths(page_paths(t), ["page_id"], "paths"))
    rows = rows.select("page_id", F.get("category_path_normalized", F.lit(0)).alias("label"))
    anchors = t.spark.createDataFrame([("en",), ("de",)], "label string")
    return rows.join(F.broadcast(anchors), "label", "left_anti").groupBy("label").agg(F.count("*").alias("support"), F.count_distinct("page_id").alias("pages")).where("support >= 5")


@query("SELECT event_type, count(*) AS n FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY event_type")
def last_day_rows(t: Tables) -> DataFrame:
    day = F.col("ts").cast("date")
    last = t.events.agg(F.max(day).alias("last"))
    return t.events.crossJoin(F.broadcast(last)).where(day == F.col("last")).groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 25")
def seeded_sample(t: Tables) -> DataFrame:
    """The same 25 orders at any partitioning: those with the least hash of their key."""
    return t.orders.select("o_orderkey", "o_custkey").orderBy(F.md5(F.col("o_orderkey").cast("string")), "o_orderkey").limit(25)


@query("SELECT CASE WHEN substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 1) < '8' THEN 'train' ELSE 'held_out' END AS part, count(*) AS n, min(o_orderkey) AS first_order FROM orders GROUP BY 1")
def seeded_split(t: Tables) -> DataFrame:
    part = F.when(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 1) < "8", "train").otherwise("held_out")
    return t.orders.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_order"))


_QUANTILES = {"lower_quartile": 0.25, "median": 0.5, "upper_quartile": 0.75}


@query("""WITH v AS (SELECT l_returnflag, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(l_extendedprice AS DOUBLE) AS price FROM lineitem),
s AS (SELECT l_returnflag, 'month' AS span, month AS span_start, price FROM v UNION ALL SELECT l_returnflag, 'year', CAST(date_trunc('year', month) AS DATE), price FROM v UNION ALL SELECT l_returnflag, 'all', NULL, price FROM v)
SELECT l_returnflag, span, span_start, count(*) AS n, min(price) AS least, max(price) AS greatest, true AS lower_quartile_near, true AS median_near, true AS upper_quartile_near FROM s GROUP BY ALL""")
def price_quantiles(t: Tables) -> DataFrame:
    """Prices of months, years and all time from sketches of months: size and bounds, and whether quartiles have their rank among
    all rows, which are counted for it. Near is three times the error of 99 of 100 sketches."""
    by, month = ["l_returnflag"], F.trunc("l_shipdate", "month")
    rows = t.lineitem.select(*by, month.alias("month"), "l_extendedprice")
    monthly = written(S.quantile_sketches(rows, [*by, "month"], "l_extendedprice"), "sketches")
    found = written(S.spans(monthly, by, "month", _QUANTILES), "spans")  # random, so told once
    ranks = S.rank_intervals(rows, by, "month", "l_extendedprice", found, list(_QUANTILES))
    near = 3 * S.rank_error()
    within = lambda name, q: ((F.col(f"{name}_below") - near <= q) & (F.col(f"{name}_upto") + near >= q)).alias(f"{name}_near")
    both = beside(found, ranks, [*by, "span", "span_start"])
    return both.select(*by, "span", "span_start", "n", "least", "greatest", *(within(*q) for q in _QUANTILES.items()))
