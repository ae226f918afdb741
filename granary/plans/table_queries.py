"""Queries over keys, coverage, labels, paths and contracts of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions import columns as C
from granary.operators import contracts as Q
from granary.operators import decisions, enrich, labels, paths
from granary.operators import profiling as P
from granary.operators.calendar import date_dimension
from granary.operators.keys import attach_key, surrogate_keys, unique_match, with_unknown
from granary.operators.versions import canonical, latest_flag, latest_rows
from granary.plans.fingerprint import fingerprint
from granary.plans.registry import Tables, query


@query("""WITH b AS (SELECT min(d) AS lo, max(d) AS hi FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem)),
days AS (SELECT CAST(unnest(generate_series(date_trunc('year', lo)::TIMESTAMP, (date_trunc('year', hi) + INTERVAL 1 YEAR - INTERVAL 1 DAY)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter, 'Q' || quarter(date) AS quarter_label,
  CAST(year(date) * 10 + quarter(date) AS INTEGER) AS year_quarter_key, CAST(month(date) AS INTEGER) AS month, strftime(date, '%B') AS month_name, CAST(year(date) * 100 + month(date) AS INTEGER) AS year_month_key, strftime(date, '%Y-%m') AS year_month,
  CAST(isoyear(date) AS INTEGER) AS iso_year, CAST(week(date) AS INTEGER) AS iso_week, printf('%04d-W%02d', isoyear(date), week(date)) AS year_week,
  CAST(date_trunc('week', date) AS DATE) AS week_start_date, CAST(date_trunc('week', date) + INTERVAL 6 DAY AS DATE) AS week_end_date,
  CAST(day(date) AS INTEGER) AS day_of_month, CAST(isodow(date) AS INTEGER) AS day_of_week, strftime(date, '%A') AS day_name, isodow(date) IN (6, 7) AS is_weekend FROM days""")
def calendar_dim(t: Tables) -> DataFrame:
    return date_dimension([(t.orders, "o_orderdate"), (t.lineitem, "l_shipdate")])


@query("""SELECT printf('%04d-W%02d', isoyear(o_orderdate), week(o_orderdate)) AS year_week, count(*) AS orders, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders GROUP BY 1""")
def iso_week_labels(t: Tables) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    return t.orders.groupBy(C.iso_week_label(d).alias("year_week")).agg(F.count("*").alias("orders"), F.min(d).alias("first_day"), F.max(d).alias("last_day"))


@query("""WITH d AS (SELECT row_number() OVER (ORDER BY s_nationkey, s_name) AS supplier_key, s_nationkey, s_name FROM (SELECT DISTINCT s_nationkey, s_name FROM supplier))
SELECT supplier_key, s_nationkey, s_name FROM d UNION ALL SELECT -1, NULL, 'Unknown supplier'""")
def dim_supplier_keys(t: Tables) -> DataFrame:
    return with_unknown(surrogate_keys(t.supplier, ["s_nationkey", "s_name"], "supplier_key"), "supplier_key", {"s_name": "Unknown supplier"})


@query("""SELECT in_customers, in_events, count(*) AS n, min(id) AS least_id, max(id) AS greatest_id FROM (
  SELECT coalesce(c.id, e.id) AS id, c.id IS NOT NULL AS in_customers, e.id IS NOT NULL AS in_events FROM (SELECT DISTINCT c_custkey AS id FROM customer) c FULL JOIN (SELECT DISTINCT user_id AS id FROM events) e ON c.id = e.id) GROUP BY ALL""")
def identity_full_outer(t: Tables) -> DataFrame:
    a = t.customer.select(F.col("c_custkey").alias("id")).distinct().withColumn("in_customers", F.lit(True))
    b = t.events.select(F.col("user_id").alias("id")).distinct().withColumn("in_events", F.lit(True))
    rows = a.join(b, "id", "full_outer").na.fill(False, ["in_customers", "in_events"])
    return rows.groupBy("in_customers", "in_events").agg(F.count("*").alias("n"), F.min("id").alias("least_id"), F.max("id").alias("greatest_id"))


_FKS = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"), ("nation", "n_regionkey", "region", "r_regionkey"), ("events", "user_id", "customer", "c_custkey"), ("labels", "doc_id", "documents", "doc_id"),
]


@query(" UNION ALL ".join(f"SELECT '{f}.{k}' AS foreign_key, (SELECT count(*) FROM {f} ANTI JOIN {d} ON {f}.{k} = {d}.{x}) AS orphan_rows, (SELECT count(*) FROM {d} ANTI JOIN {f} ON {f}.{k} = {d}.{x}) AS unused_members" for f, k, d, x in _FKS))
def fk_audit(t: Tables) -> DataFrame:
    return P.key_audit([(f"{fact}.{key}", getattr(t, fact), key, getattr(t, dim), other) for fact, key, dim, other in _FKS])


@query("SELECT o_orderstatus, count(*) AS orders_without_items, min(o_orderkey) AS first_order FROM orders ANTI JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderstatus")
def orphan_audit(t: Tables) -> DataFrame:
    return Q.orphans(t.orders, t.lineitem, "o_orderkey", "l_orderkey").groupBy("o_orderstatus").agg(F.count("*").alias("orders_without_items"), F.min("o_orderkey").alias("first_order"))


@query("""SELECT c_mktsegment, count(*) AS customers, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS with_orders,
  count(*) FILTER (WHERE c_acctbal < 0 OR EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)) AS flagged FROM customer GROUP BY c_mktsegment""")
def exists_or_flag(t: Tables) -> DataFrame:
    rows = t.customer.join(t.orders.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("o", F.lit(True)), "c_custkey", "left")
    rows = rows.join(t.events.select(F.col("user_id").alias("c_custkey")).distinct().withColumn("e", F.lit(True)), "c_custkey", "left")
    return rows.groupBy("c_mktsegment").agg(F.count("*").alias("customers"), F.count_if("o").alias("with_orders"), F.count_if((F.col("c_acctbal") < 0) | F.col("e")).alias("flagged"))


@query("""SELECT p_brand, p_size, count(*) AS n, CASE WHEN count(DISTINCT p_type) <= 1 THEN min(p_type) END AS only_type FROM part GROUP BY ALL""")
def only_value(t: Tables) -> DataFrame:
    return t.part.groupBy("p_brand", "p_size").agg(F.count("*").alias("n"), C.only_value(F.col("p_type")).alias("only_type"))


@query("""WITH m AS (SELECT p_name, p_brand, min(p_partkey) AS k FROM part GROUP BY ALL HAVING count(DISTINCT p_partkey) = 1)
SELECT p_brand, count(*) AS n, count(k) AS matched, count(*) FILTER (WHERE coalesce(k, -1) = -1) AS unknown FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN m USING (p_name, p_brand) GROUP BY p_brand""")
def unique_match_map(t: Tables) -> DataFrame:
    mapping = unique_match(t.part, ["p_name", "p_brand"], "p_partkey").withColumnRenamed("p_partkey", "product_key")
    rows = t.lineitem.select(F.col("l_partkey").alias("p_partkey")).join(t.part.select("p_partkey", "p_name", "p_brand"), "p_partkey")
    rows = attach_key(rows, mapping, ["p_name", "p_brand"], "product_key")
    return rows.groupBy("p_brand").agg(F.count("*").alias("n"), F.count_if(F.col("product_key") != -1).alias("matched"), F.count_if(F.col("product_key") == -1).alias("unknown"))


@query("""WITH ids AS (SELECT DISTINCT user_id AS c_custkey FROM events UNION SELECT c_custkey FROM customer),
a AS (SELECT user_id AS c_custkey, min(event_type) AS label FROM events GROUP BY ALL HAVING count(DISTINCT event_type) = 1),
b AS (SELECT c_custkey, c_mktsegment AS label FROM customer)
SELECT CASE WHEN a.label IS NOT NULL AND b.label IS NOT NULL THEN 'both' WHEN a.label IS NOT NULL THEN 'first' WHEN b.label IS NOT NULL THEN 'second' ELSE 'none' END AS descriptive_source, coalesce(a.label, b.label) AS label, count(*) AS n
FROM ids LEFT JOIN a USING (c_custkey) LEFT JOIN b USING (c_custkey) GROUP BY ALL""")
def recover_unmatched(t: Tables) -> DataFrame:
    first = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(C.only_value(F.col("event_type")).alias("label")).where("label is not null")
    second = t.customer.select("c_custkey", F.col("c_mktsegment").alias("label"))
    ids = t.events.select(F.col("user_id").alias("c_custkey")).union(t.customer.select("c_custkey")).distinct()
    return enrich.describe(ids, first, second, ["c_custkey"], ["label"]).groupBy("descriptive_source", "label").agg(F.count("*").alias("n"))


_LADDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("SELECT 0 AS n_columns, 'rows' AS grain, count(*) AS n FROM lineitem " + " ".join(f"UNION ALL SELECT {n}, '{','.join(_LADDER[:n])}', count(*) FROM (SELECT DISTINCT {', '.join(_LADDER[:n])} FROM lineitem)" for n in range(1, 5)))
def tuple_distinct_ladder(t: Tables) -> DataFrame:
    return P.grain_ladder(t.lineitem, _LADDER)


@query("""SELECT part, count(*) AS repeated_grains, count(*) FILTER (WHERE d = 1) AS exact, count(*) FILTER (WHERE d > 1) AS differing, CAST(sum(n) AS BIGINT) AS rows FROM (
  SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT (l_partkey, l_suppkey, l_quantity)) AS d, min(l_returnflag) AS part FROM lineitem GROUP BY ALL HAVING count(*) > 1) GROUP BY part""".replace("GROUP BY ALL HAVING", "GROUP BY l_orderkey, l_linenumber HAVING"))
def repeated_grain_split(t: Tables) -> DataFrame:
    return P.repeated_grains(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity"], F.col("l_returnflag"))


@query("""SELECT o_orderpriority, min(d) AS first_day, max(d) AS last_day, count(DISTINCT d) AS observed_days, count(DISTINCT date_trunc('week', d)) AS observed_weeks,
  CAST(max(d) - min(d) + 1 AS INTEGER) AS expected_days, CAST(date_diff('day', date_trunc('week', min(d)), date_trunc('week', max(d))) // 7 + 1 AS INTEGER) AS expected_weeks FROM (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY o_orderpriority""")
def temporal_coverage(t: Tables) -> DataFrame:
    return P.temporal_coverage(t.orders, "o_orderdate", ["o_orderpriority"])


_MISSING = ["doc_id", "lang", "source", "quality", "toxic"]


@query("WITH d AS (SELECT doc_id, lang, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)) " + " UNION ALL ".join(
    f"SELECT count(*) AS rows, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows, count(*) FILTER (WHERE trim(CAST({c} AS VARCHAR)) = '') AS blank_rows, count(*) FILTER (WHERE lower(trim(CAST({c} AS VARCHAR))) IN ('null', 'none', 'n/a', '#n/a')) AS placeholder_rows, "
    f"round(count(*) FILTER (WHERE {c} IS NULL OR lower(trim(CAST({c} AS VARCHAR))) IN ('', 'null', 'none', 'n/a', '#n/a')) * 100.0::DOUBLE / count(*), 2) AS missing_pct FROM d" for c in _MISSING))  # fmt: skip
def missingness_report(t: Tables) -> DataFrame:
    return P.missingness(t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left"), _MISSING)


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS rows, min({c}) AS least, max({c}) AS greatest, count(*) FILTER (WHERE {c} <= 0) AS non_positive, count(*) FILTER (WHERE {c} < {lo}) AS below, count(*) FILTER (WHERE {c} > {hi}::DOUBLE) AS above FROM lineitem" for c, lo, hi in (("l_quantity", 1, 50), ("l_discount", 0, 0.1), ("l_extendedprice", 100, 50000))))
def validity_bounds(t: Tables) -> DataFrame:
    a, b, c = (P.validity(t.lineitem, *x) for x in (("l_quantity", 1.0, 50.0), ("l_discount", 0.0, 0.1), ("l_extendedprice", 100.0, 50000.0)))
    return a.unionByName(b).unionByName(c)


@query("SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20")
def validity_bounds_topk(t: Tables) -> DataFrame:
    return P.top_rows(t.part.select("p_partkey", "p_name", "p_retailprice"), "p_retailprice", ["p_partkey"])


@query("SELECT p_brand, count(*) AS rows, count(DISTINCT p_type) AS p_type_values, count(DISTINCT p_size) AS p_size_values FROM part GROUP BY p_brand")
def attribute_consistency(t: Tables) -> DataFrame:
    return P.consistency(t.part, ["p_brand"], ["p_type", "p_size"])


@query("SELECT l_returnflag, l_linestatus, count(*) AS rows FROM lineitem GROUP BY ALL")
def combination_counts(t: Tables) -> DataFrame:
    return P.combinations(t.lineitem, ["l_returnflag", "l_linestatus"])


@query("SELECT p_name, count(DISTINCT p_partkey) AS entities, min(p_partkey) AS first_entity FROM part GROUP BY p_name HAVING count(DISTINCT p_partkey) > 1")
def reused_names(t: Tables) -> DataFrame:
    return P.reused(t.part, ["p_name"], "p_partkey")


def _profile_sql(a: str, ka: str, b: str, kb: str) -> str:
    return f"""WITH a AS (SELECT {ka} AS k, count(*) AS a FROM {a} GROUP BY 1), b AS (SELECT {kb} AS k, count(*) AS b FROM {b} GROUP BY 1), j AS (SELECT a, b FROM a FULL JOIN b ON a.k = b.k)
SELECT CAST(coalesce(sum(a), 0) AS BIGINT) AS left_rows, CAST(coalesce(sum(b), 0) AS BIGINT) AS right_rows, count(a) AS left_keys, count(b) AS right_keys, count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS matched_keys,
  CAST(coalesce(sum(a) FILTER (WHERE b IS NOT NULL), 0) AS BIGINT) AS left_rows_matched, CAST(coalesce(sum(b) FILTER (WHERE a IS NOT NULL), 0) AS BIGINT) AS right_rows_matched, CAST(coalesce(sum(a * b), 0) AS BIGINT) AS joined_rows, coalesce(max(b) FILTER (WHERE a IS NOT NULL), 0) AS most_rows_a_key FROM j"""


@query(_profile_sql("orders", "o_orderkey", "lineitem", "l_orderkey"))
def row_explosion(t: Tables) -> DataFrame:
    return P.join_profile(t.orders.select(F.col("o_orderkey").alias("k")), t.lineitem.select(F.col("l_orderkey").alias("k")), ["k"])


@query(_profile_sql("documents", "doc_id", "labels", "doc_id"))
def coverage_both_ways(t: Tables) -> DataFrame:
    return P.join_profile(t.documents.select("doc_id"), t.labels.select("doc_id"), ["doc_id"])


@query("""SELECT count(*) AS rows, count(n_nationkey) AS matched, count(*) FILTER (WHERE n_nationkey IS NULL) AS unmatched, count(*) FILTER (WHERE c_custkey % 5 <> n_regionkey) AS mismatched, round(count(n_nationkey) * 100.0::DOUBLE / count(*), 2) AS matched_pct
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def join_agreement(t: Tables) -> DataFrame:
    left = t.customer.select(F.col("c_nationkey").alias("n_nationkey"), (F.col("c_custkey") % 5).cast("int").alias("n_regionkey"))
    return P.agreement(left, t.nation, ["n_nationkey"], "n_regionkey")


@query("SELECT count(*) AS entities, round(avg(n), 6) AS avg_rows, median(n) AS median_rows, min(n) AS min_rows, max(n) AS max_rows FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)")
def cardinality_stats(t: Tables) -> DataFrame:
    return P.cardinality(t.orders, ["o_custkey"])


@query("SELECT event_type, key, count(*) AS n, round(sum(CAST(value AS DOUBLE)), 6) AS total FROM (SELECT event_type, unnest(json_keys(props)) AS key, json_extract_string(props, '$.' || unnest(json_keys(props))) AS value FROM events) GROUP BY ALL")
def json_props_unpivot(t: Tables) -> DataFrame:
    rows = t.events.select("event_type", F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))
    return rows.groupBy("event_type", "key").agg(F.count("*").alias("n"), F.round(F.sum(F.col("value").try_cast("double")), 6).alias("total"))


@query("SELECT array_to_string(list_sort(json_keys(props)), ',') AS keys, json_valid(props) AS valid, count(*) AS n FROM events GROUP BY ALL")
def json_schema_profile(t: Tables) -> DataFrame:
    keys = F.array_join(F.array_sort(F.json_object_keys("props")), ",")
    return t.events.groupBy(keys.alias("keys"), F.try_parse_json("props").isNotNull().alias("valid")).agg(F.count("*").alias("n"))


#: Entries of the labels built from parts: (entry, unit, standard unit, factor, status).
LABEL_MAPPING = (
    ("size", "g", "g", 1.0, "identity"), ("price", "cent", "unit", 0.01, "converted"), ("brand", "text", "g", None, "incompatible_unit"), ("kj", "kj", "kj", 1.0, "identity"), ("kcal", "kcal", "kcal", 1.0, "identity"),
)


def part_labels(t: Tables) -> DataFrame:
    """A JSON label for each part."""
    value = lambda v, u: F.concat(F.lit('{"value":"'), v, F.lit(f'","unit":"{u}"}}'))
    size = F.col("p_size").cast("string")
    entries = {"size": value(size, "g"), "price": value((F.col("p_size") * 100).cast("string"), "cent"), "brand": value(F.col("p_brand"), "text"), "kj": value((F.col("p_size") * 4).cast("string"), "kj"), "kcal": value(size, "kcal")}
    body = F.concat_ws(",", *(F.concat(F.lit(f'"{k}":'), v) for k, v in entries.items()))
    return t.part.select("p_partkey", F.concat(F.lit('{"nutrients":{'), body, F.lit('},"portion":{"value":100,"unit":"g"}}')).alias("payload"))


@query("""WITH l AS (SELECT p_partkey, '{"size":{"value":"' || p_size || '","unit":"g"},"price":{"value":"' || p_size * 100 || '","unit":"cent"},"brand":{"value":"' || p_brand || '","unit":"text"},"kj":{"value":"' || p_size * 4 || '","unit":"kj"},"kcal":{"value":"' || p_size || '","unit":"kcal"}}' AS n FROM part),
e AS (SELECT p_partkey, k AS entry, json_extract_string(n, '$.' || k || '.value') AS v, json_extract_string(n, '$.' || k || '.unit') AS u FROM (SELECT p_partkey, n, unnest(json_keys(n)) AS k FROM l)),
s AS (SELECT *, TRY_CAST(v AS DOUBLE) AS x, CASE entry WHEN 'size' THEN 1.0::DOUBLE WHEN 'price' THEN 0.01::DOUBLE WHEN 'kj' THEN 1 WHEN 'kcal' THEN 1 END AS f, CASE entry WHEN 'price' THEN 'converted' WHEN 'brand' THEN 'incompatible_unit' ELSE 'identity' END AS status FROM e)
SELECT entry, status, count(*) AS n, round(sum(x * f), 6) AS total, count(*) FILTER (WHERE entry = 'brand') AS incompatible, count(*) FILTER (WHERE x IS NULL) AS non_numeric FROM s GROUP BY ALL""")
def label_unpivot_units(t: Tables) -> DataFrame:
    mapping = t.spark.createDataFrame(labels.check_mapping(LABEL_MAPPING), labels.MAPPING)
    rows = labels.standardize(labels.unpivot(part_labels(t), "payload", "$.nutrients"), mapping)
    return rows.groupBy("entry", "status").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"), F.count_if("dq_incompatible_unit").alias("incompatible"), F.count_if("dq_non_numeric_value").alias("non_numeric"))


@query("""SELECT kj >= 0 AND kcal >= 0 AND abs(kj - kcal * 4.184::DOUBLE) > greatest(1.0::DOUBLE, kcal * 4.184::DOUBLE * 0.02::DOUBLE) AS mismatch, count(*) AS n FROM (SELECT CAST(p_size * 4 AS DOUBLE) AS kj, CAST(p_size AS DOUBLE) AS kcal FROM part) GROUP BY 1""")
def label_energy_check(t: Tables) -> DataFrame:
    rows = part_labels(t).withColumn("e", labels.entries(F.col("payload"), "$.nutrients"))
    number = lambda k: F.col("e")[k]["value"].try_cast("double")
    return rows.groupBy(labels.energy_mismatch(number("kj"), number("kcal")).alias("mismatch")).agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, d ORDER BY complete DESC, md5(props), event_id) AS rn, count(*) OVER (PARTITION BY user_id, event_type, d) AS n, count(*) OVER (PARTITION BY user_id, event_type, d, complete) AS tied
  FROM (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS d, props, CAST(length(props) AS INTEGER) AS complete FROM events))
SELECT user_id, event_type, d AS day, event_id, n AS grain_rows, CASE WHEN n > 1 AND tied > 1 THEN 'deterministic_hash_tiebreak' WHEN n > 1 THEN 'completeness_first' ELSE 'single_observation' END AS selection_reason FROM r WHERE rn = 1""")
def canonical_version(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "event_type", F.col("ts").cast("date").alias("day"), "props", F.length("props").alias("complete"))
    return canonical(rows, ["user_id", "event_type", "day"], ["complete"], "props", [F.col("event_id")]).select("user_id", "event_type", "day", "event_id", "grain_rows", "selection_reason")


@query("""WITH r AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY CAST(ts AS DATE) DESC, ts DESC, event_id DESC) AS rn,
  count(*) OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)) AS n FROM events)
SELECT event_id, user_id, event_type, day, value, n AS rows_of_last_date FROM r WHERE rn = 1""")
def last_event(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "event_type", F.col("ts").cast("date").alias("day"), "ts", "value")
    return latest_rows(rows, ["user_id", "event_type"], "day", ["ts", "event_id"]).drop("ts")


@query("SELECT user_id, event_type, CAST(ts AS DATE) AS day, count(*) AS n, round(avg(value), 6) AS value FROM events QUALIFY true GROUP BY ALL".replace(" QUALIFY true", "") .replace("FROM events GROUP BY ALL", "FROM (SELECT *, CAST(ts AS DATE) = max(CAST(ts AS DATE)) OVER (PARTITION BY user_id, event_type) AS latest FROM events) WHERE latest GROUP BY ALL"))
def latest_observation(t: Tables) -> DataFrame:
    rows = latest_flag(t.events.withColumn("day", F.col("ts").cast("date")), ["user_id", "event_type"], "day").where("is_latest_observation")
    return rows.groupBy("user_id", "event_type", "day").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("value"))


def page_paths(t: Tables) -> DataFrame:
    """For each page, the paths of its URL's segments and of their first alone."""
    segments = F.filter(F.split(F.regexp_extract("url", "^[a-z]+://[^/]+/([^?#]*)", 1), "/"), lambda s: s != "")
    rows = t.pages.select("page_id", F.regexp_extract("url", "^[a-z]+://([^/]+)/", 1).alias("host"), segments.alias("s"))
    return rows.select("page_id", "host", F.array(F.slice("s", 1, 1), F.col("s")).alias("paths"))


_PATHS_SQL = """p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)/', 1) AS host, list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1), '/'), lambda s: s <> '') AS s FROM pages),
paths AS (SELECT page_id, host, list_slice(s, 1, 1) AS path, 1 AS position, s AS other FROM p UNION ALL SELECT page_id, host, s, 2, list_slice(s, 1, 1) FROM p),
flagged AS (SELECT *, len(path) AS depth, path = other AS dup, len(path) < len(other) AND path = list_slice(other, 1, len(path)) AS is_prefix, len(list_distinct(path)) < len(path) AS repeated FROM paths)"""


@query(f"""WITH {_PATHS_SQL} SELECT CAST(position AS INTEGER) AS category_path_position, CAST(depth AS INTEGER) AS category_path_depth,
  CASE WHEN repeated THEN 'repeated_label_review_required' WHEN dup THEN 'duplicate_path_occurrence' WHEN is_prefix THEN 'ancestor_path' ELSE 'unmapped' END AS path_review_status, count(*) AS n FROM flagged GROUP BY ALL""")
def category_paths(t: Tables) -> DataFrame:
    rows = paths.category_paths(page_paths(t), ["page_id"], "paths")
    return rows.groupBy("category_path_position", "category_path_depth", "path_review_status").agg(F.count("*").alias("n"))


@query(f"""WITH {_PATHS_SQL}, usable AS (SELECT * FROM flagged WHERE NOT dup AND NOT is_prefix AND NOT repeated),
dim AS (SELECT row_number() OVER (ORDER BY host, text) AS category_key, host, text FROM (SELECT DISTINCT host, array_to_string(path, ' > ') AS text FROM usable))
SELECT category_key, d.host AS host, d.text AS category_path_text, count(DISTINCT page_id) AS members FROM usable u JOIN dim d ON u.host = d.host AND array_to_string(u.path, ' > ') = d.text GROUP BY ALL""")
def category_bridge(t: Tables) -> DataFrame:
    rows = paths.categories(paths.category_paths(page_paths(t), ["page_id", "host"], "paths"), ["page_id", "host"])
    dim = surrogate_keys(rows, ["host", "category_path_text"], "category_key")
    return rows.join(dim, ["host", "category_path_text"]).groupBy("category_key", "host", "category_path_text").agg(F.count_distinct("page_id").alias("members"))


@query("""WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]*)', 1) AS label, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS name FROM pages),
c AS (SELECT page_id, CASE label WHEN 'en' THEN 'germanic' WHEN 'de' THEN 'germanic' WHEN 'fr' THEN 'romance' END AS code, CASE name WHEN 'en' THEN 'germanic' WHEN 'de' THEN 'germanic' WHEN 'fr' THEN 'romance' WHEN 'es' THEN 'romance' END AS by_name FROM p)
SELECT coalesce(code, by_name, 'unclassified') AS code, CASE WHEN code IS NULL AND by_name IS NULL THEN 'no_supported_match' ELSE 'classified' END AS status, CASE WHEN code IS NOT NULL THEN 'paths' WHEN by_name IS NOT NULL THEN 'name' END AS basis, count(*) AS n FROM c GROUP BY ALL""")
def evidence_decision(t: Tables) -> DataFrame:
    anchors = t.spark.createDataFrame([("en", "germanic"), ("de", "germanic"), ("fr", "romance")], "label string, code string")
    names = t.spark.createDataFrame([("en", "germanic"), ("de", "germanic"), ("fr", "romance"), ("es", "romance")], "name string, code string")
    votes = decisions.path_votes(paths.category_paths(page_paths(t), ["page_id"], "paths"), ["page_id"], F.broadcast(anchors))
    named = t.pages.select("page_id", F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("name")).join(F.broadcast(names), "name").select("page_id", F.array("code").alias("name_codes"))
    return decisions.decide(votes, ["page_id"], named).groupBy("code", "status", "basis").agg(F.count("*").alias("n"))


_TOKENS_SQL = "tok AS (SELECT doc_id, lang, unnest(list_distinct(regexp_extract_all(lower(nfc_normalize(text)), '[a-zà-ÿ]{4,}'))) AS token FROM documents)"
_MINED_SQL = """per AS (SELECT token, lang, count(*) AS n FROM {source} GROUP BY ALL),
best AS (SELECT token, CAST(sum(n) AS BIGINT) AS support, max(n) AS top, arg_min(lang, (-n, lang)) AS code FROM per GROUP BY token),
mined AS (SELECT token, code, support, top FROM best WHERE support >= 20 AND top >= 0.98::DOUBLE * support)"""


@query(f"WITH {_TOKENS_SQL}, {_MINED_SQL.format(source='tok')} SELECT token, code, support, top FROM mined")
def token_mining(t: Tables) -> DataFrame:
    return paths.mine_tokens(C.composed(t.documents.select("lang", "text"), "text"), "text", "lang")


@query(f"""WITH {_TOKENS_SQL}, train AS (SELECT * FROM tok WHERE doc_id % 2 = 0), {_MINED_SQL.format(source='train')},
named AS (SELECT doc_id, lang, count(DISTINCT code) AS n, min(code) AS code FROM tok JOIN mined USING (token) WHERE doc_id % 2 = 1 GROUP BY ALL)
SELECT lang, count(*) AS documents, count(*) FILTER (WHERE n = 1) AS decided, count(*) FILTER (WHERE n = 1 AND code = lang) AS agreed FROM (SELECT doc_id, d.lang, n, code FROM documents d LEFT JOIN named USING (doc_id) WHERE doc_id % 2 = 1) GROUP BY lang""")
def holdout_agreement(t: Tables) -> DataFrame:
    docs = C.composed(t.documents.select("doc_id", "lang", "text"), "text")
    even = F.col("doc_id") % 2 == 0
    words = paths.mine_tokens(docs.where(even), "text", "lang")
    held = docs.where(~even)
    named = paths.name_codes(held, ["doc_id"], "text", words)
    one = F.size("name_codes") == 1
    rows = held.select("doc_id", "lang").join(named, "doc_id", "left")
    return rows.groupBy("lang").agg(F.count("*").alias("documents"), F.count_if(one).alias("decided"), F.count_if(one & (F.get("name_codes", F.lit(0)) == F.col("lang"))).alias("agreed"))


@query("""WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]*)', 1) AS label FROM pages)
SELECT label, count(*) AS pages, count(*) FILTER (WHERE label IN ('es') AND label NOT IN ('en', 'de', 'fr')) AS gained, 0::BIGINT AS changed FROM p GROUP BY label""")
def rule_what_if(t: Tables) -> DataFrame:
    """What one more anchor would decide, and whether it would change what is decided now."""
    now = [("en", "germanic"), ("de", "germanic"), ("fr", "romance")]
    rows = paths.category_paths(page_paths(t), ["page_id"], "paths")

    def decided(anchors: list, name: str) -> DataFrame:
        votes = decisions.path_votes(rows, ["page_id"], F.broadcast(t.spark.createDataFrame(anchors, "label string, code string")))
        return votes.select("page_id", F.when(F.size("candidates") == 1, F.get("candidates", F.lit(0))).alias(name))

    both = decided(now, "before").join(decided([*now, ("es", "romance")], "after"), "page_id")
    label = page_paths(t).select("page_id", F.col("paths")[0][0].alias("label"))
    return both.join(label, "page_id").groupBy("label").agg(F.count("*").alias("pages"), F.count_if(F.col("before").isNull() & F.col("after").isNotNull()).alias("gained"), F.count_if(F.col("before").isNotNull() & ~F.col("before").eqNullSafe(F.col("after"))).alias("changed"))


@query("""WITH s AS (SELECT s_suppkey AS k, s_nationkey AS ctx, CASE WHEN s_acctbal < 0 THEN NULL ELSE s_name END AS name, s_acctbal AS bal FROM supplier),
r AS (SELECT c_custkey AS k, c_nationkey AS ctx, c_name AS name, c_acctbal AS bal FROM customer)
SELECT count(*) AS n, count(*) FILTER (WHERE s.name IS NULL AND r.ctx = s.ctx) AS filled, count(*) FILTER (WHERE s.name <> r.name) AS conflicts, count(*) FILTER (WHERE abs(s.bal - r.bal) > 0.00001::DOUBLE) AS balance_conflicts, count(*) FILTER (WHERE r.k IS NOT NULL AND r.ctx <> s.ctx) AS mismatches, count(CASE WHEN s.name IS NULL AND r.ctx = s.ctx THEN r.name ELSE s.name END) AS names
FROM s LEFT JOIN r USING (k)""")
def fallback_enrichment(t: Tables) -> DataFrame:
    mine = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("ctx"), F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("name"), F.col("s_acctbal").alias("bal"))
    other = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("ctx"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    rows = enrich.fallback(mine, enrich.without_collisions(other, ["k"]), ["k"], ["name", "bal"], ["ctx"], {"bal": 1e-5})
    return rows.agg(F.count("*").alias("n"), F.count_if("is_name_enriched").alias("filled"), F.count_if("dq_name_conflict").alias("conflicts"), F.count_if("dq_bal_conflict").alias("balance_conflicts"), F.count_if("dq_enrichment_context_mismatch").alias("mismatches"), F.count("name").alias("names"))


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("SELECT c_mktsegment AS segment, CAST(sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS BIGINT) AS decoded, count(*) AS n FROM customer GROUP BY 1")
def decode_codes(t: Tables) -> DataFrame:
    """Codes of half the customers are written backwards first, then decoded."""
    backwards = F.col("c_acctbal") < 0
    rows = t.customer.select(F.when(backwards, F.reverse("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("raw"))
    decoded = C.decode_code(F.col("raw"), [s[::-1] for s in _SEGMENTS], _SEGMENTS)
    return rows.select(decoded.alias("segment"), "raw").groupBy("segment").agg(F.count_if(F.col("raw") != F.col("segment")).alias("decoded"), F.count("*").alias("n"))


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS row_value, count(*) FILTER (WHERE o_orderstatus = 'F') AS \"F\", count(*) FILTER (WHERE o_orderstatus = 'O') AS \"O\", count(*) FILTER (WHERE o_orderstatus = 'P') AS \"P\" FROM orders GROUP BY 1")
def pivot_status(t: Tables) -> DataFrame:
    return P.pivot_counts(t.orders, F.year("o_orderdate"), "o_orderstatus", ["F", "O", "P"])


@query("""SELECT region, type, outside, count(*) AS n FROM (SELECT CASE WHEN z BETWEEN 1000 AND 1299 THEN 'Brussels' WHEN z BETWEEN 1300 AND 1499 OR z BETWEEN 4000 AND 7999 THEN 'Wallonia' WHEN z BETWEEN 1500 AND 3999 OR z BETWEEN 8000 AND 9999 THEN 'Flanders' END AS region,
  CASE WHEN c_acctbal < 0 THEN 'National price (online)' ELSE 'Store' END AS type, NOT (lat BETWEEN 49.4::DOUBLE AND 53.6::DOUBLE) AS outside FROM (SELECT c_acctbal, c_custkey AS z, 45 + c_nationkey / 2.0::DOUBLE AS lat FROM customer)) GROUP BY ALL""")
def geography_rules(t: Tables) -> DataFrame:
    rows = t.customer.select(C.region(F.col("c_custkey").cast("string")).alias("region"), C.location_type(F.when(F.col("c_acctbal") < 0, " Default ")).alias("type"), C.outside_box(45 + F.col("c_nationkey") / 2.0, F.lit(4.0)).alias("outside"))
    return rows.groupBy("region", "type", "outside").agg(F.count("*").alias("n"))


_CONTENTS = {"region": "r_regionkey", "nation": "n_nationkey", "supplier": "s_suppkey", "part": "p_partkey", "customer": "c_custkey", "orders": "o_orderkey"}
#: A hash that both engines have: the first 15 hexadecimal digits of a text's MD5, as a number.
_MD5_SQL = "CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 15) AS BIGINT)"


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows, CAST(sum(CAST({_MD5_SQL.format(key=k)} AS HUGEINT)) AS VARCHAR) AS hash_sum, bit_xor({_MD5_SQL.format(key=k)}) AS hash_xor FROM {t}" for t, k in _CONTENTS.items()))
def content_fingerprint(t: Tables) -> DataFrame:
    """The fingerprint of each table's keys by a hash that is the same in every engine."""
    out = None
    for name, key in _CONTENTS.items():
        row = fingerprint(getattr(t, name).select(key), lambda c: F.conv(F.substring(F.md5(c.cast("string").cast("binary")), 1, 15), 16, 10).cast("long")).withColumn("table_name", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


_DIM_SQL = """SELECT '{name}' AS table_name, (count(*) = 0)::BIGINT AS empty, (SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {key} HAVING count(*) > 1)) AS repeated_keys,
  (SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {natural} HAVING count(*) > 1)) AS repeated_natural_keys, abs(count(DISTINCT {key}) FILTER (WHERE {key} = {unknown}) - {expected}) AS unknown_members FROM {source}"""


@query(" UNION ALL ".join(_DIM_SQL.format(name=n, source=s, key=k, natural=x, unknown=u, expected=e) for n, s, k, x, u, e in (
    ("part", "part", "p_partkey", "p_name, p_brand", "NULL", 0), ("supplier", "supplier", "s_suppkey", "s_name", -1, 1), ("orders", "orders", "o_custkey", "o_orderkey", 7, 1), ("nothing", "(SELECT * FROM part WHERE p_size < 0)", "p_partkey", "p_name", "NULL", 0))))
def contract_suite(t: Tables) -> DataFrame:
    """A sound dimension, one without its Unknown member, one whose key is not unique, and an empty one."""
    out = Q.dimension_violations(t.part, "p_partkey", ["p_name", "p_brand"]).withColumn("table_name", F.lit("part"))
    out = out.unionByName(Q.dimension_violations(t.supplier, "s_suppkey", ["s_name"], -1).withColumn("table_name", F.lit("supplier")))
    out = out.unionByName(Q.dimension_violations(t.orders, "o_custkey", ["o_orderkey"], 7).withColumn("table_name", F.lit("orders")))
    return out.unionByName(Q.dimension_violations(t.part.where("p_size < 0"), "p_partkey", ["p_name"]).withColumn("table_name", F.lit("nothing")))


@query("SELECT c AS column_name, count(v) AS n, count(*) FILTER (WHERE v IS NULL) AS nulls, min(v) AS lo, max(v) AS hi, round(avg(v), 6) AS mean, round(stddev(v), 6) AS sd, TRUE AS ndv_close, TRUE AS median_close FROM (SELECT unnest(['l_quantity', 'l_discount', 'l_tax']) AS c, unnest([l_quantity, l_discount, l_tax]) AS v FROM lineitem) GROUP BY c")
def summarize(t: Tables) -> DataFrame:
    """The approximate figures are held against exact ones: distinct values within 10 %, the median between the 48th and 52nd percentile."""
    names = ["l_quantity", "l_discount", "l_tax"]
    parts = [t.lineitem.agg(F.lit(c).alias("column_name"), F.count_distinct(c).alias("d"), F.percentile(c, F.lit(0.48)).alias("a"), F.percentile(c, F.lit(0.52)).alias("b")) for c in names]
    rows = P.summarize(t.lineitem, names).join(parts[0].unionByName(parts[1]).unionByName(parts[2]), "column_name")
    close = (F.abs(F.col("ndv") - F.col("d")) <= F.greatest(F.lit(1.0), F.col("d") * 0.1)).alias("ndv_close")
    return rows.select("column_name", "n", "nulls", "lo", "hi", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"), close, F.col("q50").between(F.col("a"), F.col("b")).alias("median_close"))
