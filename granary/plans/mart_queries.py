"""A small star schema over the driver's tables, and its contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators import labels, mart, paths
from granary.operators import mart_contracts as MC
from granary.operators.keys import surrogate_keys
from granary.plans.price_queries import fact, fact_sql
from granary.plans.registry import Tables, query
from granary.plans.table_queries import LABEL_MAPPING, page_paths, part_labels


def customer_dimension(t: Tables) -> DataFrame:
    """Customers with events: named by segment where their balance is not negative, else by their one event type, else after their id."""
    identity = ["id"]
    used = t.events.select(F.col("user_id").alias("id"))
    own = mart.used_members(t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name")), [used], identity)
    described = t.events.select(F.col("user_id").alias("id"), F.date_format("ts", "yyyy").alias("ctx"), F.col("event_type").alias("name"))
    missing = used.distinct().join(own.select("id"), "id", "left_anti")
    found = mart.recover(missing.withColumn("ctx", F.lit("2024")), described, identity, "ctx", ["name"]).where("name is not null").select("id", "name")
    rest = missing.join(found.select("id"), "id", "left_anti")
    return mart.entity_dimension("customer_key", identity, [(own, "weekly"), (found, "recovered"), (mart.infer(rest, identity, "name", "Unmatched customer (%s)"), "inferred")], ["name"], {"name": "Unknown"})


@query("""WITH used AS (SELECT DISTINCT user_id AS id FROM events),
own AS (SELECT c_custkey AS id, c_mktsegment AS name, 'weekly' AS descriptive_source FROM customer SEMI JOIN used ON c_custkey = id WHERE c_acctbal >= 0),
one AS (SELECT user_id AS id, min(event_type) AS name FROM events GROUP BY 1 HAVING count(DISTINCT event_type) = 1 AND count(DISTINCT year(ts)) = 1),
every AS (SELECT * FROM own UNION ALL SELECT id, name, 'recovered' FROM one ANTI JOIN own USING (id) UNION ALL
  SELECT id, 'Unmatched customer (' || id || ')', 'inferred' FROM used WHERE id NOT IN (SELECT id FROM own) AND id NOT IN (SELECT id FROM one))
SELECT row_number() OVER (ORDER BY id) AS customer_key, id, name, descriptive_source, descriptive_source = 'inferred' AS is_inferred FROM every UNION ALL SELECT -1, NULL, 'Unknown', 'unknown', FALSE""")
def dim_customer(t: Tables) -> DataFrame:
    return customer_dimension(t)


@query("SELECT row_number() OVER (ORDER BY n_name, s_name) AS location_key, n_name, s_name, s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey SEMI JOIN (SELECT l_suppkey FROM lineitem WHERE l_quantity >= 45) u ON s_suppkey = l_suppkey")
def dim_location(t: Tables) -> DataFrame:
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("n_name", "s_name", "s_acctbal", "s_suppkey")
    prices = t.lineitem.where("l_quantity >= 45").join(places.select(F.col("s_suppkey").alias("l_suppkey"), "n_name", "s_name"), "l_suppkey").select("n_name", "s_name")
    return mart.location_dimension(places.drop("s_suppkey"), prices, ["n_name", "s_name"], "location_key")


@query("SELECT row_number() OVER (ORDER BY entry, standard_unit) AS entry_key, entry, standard_unit FROM (VALUES ('size', 'g'), ('price', 'unit'), ('brand', 'g'), ('kj', 'kj'), ('kcal', 'kcal')) v(entry, standard_unit)")
def dim_entry(t: Tables) -> DataFrame:
    return surrogate_keys(t.spark.createDataFrame(labels.check_mapping(LABEL_MAPPING), labels.MAPPING), ["entry", "standard_unit"], "entry_key")


@query("""WITH e AS (SELECT p_partkey, unnest(['size', 'price', 'brand', 'kj', 'kcal']) AS entry, unnest([p_size, p_size, NULL, p_size * 4, p_size]) AS v FROM part)
SELECT entry, 'per_100g' AS basis, count(*) AS n, count(*) FILTER (WHERE v >= 0) AS usable, count(*) AS latest, round(sum(v::DOUBLE), 6) AS total FROM e GROUP BY entry""")
def entry_fact(t: Tables) -> DataFrame:
    mapping = t.spark.createDataFrame(labels.check_mapping(LABEL_MAPPING), labels.MAPPING)
    rows = labels.standardize(labels.unpivot(part_labels(t), "payload", "$.nutrients"), mapping)
    portion = F.get_json_object("payload", "$.portion.value").try_cast("double")
    rows = rows.withColumns({"portion": portion, "portion_unit": F.get_json_object("payload", "$.portion.unit"), "day": F.lit("2024-01-01").cast("date")})
    dim = surrogate_keys(mapping, ["entry", "standard_unit"], "entry_key")
    found = mart.entry_fact(rows, {"entry_key": (dim, ["entry", "standard_unit"])}, ["p_partkey", "entry_key"], "day", "portion", "portion_unit", "value")
    return found.groupBy("entry", "basis").agg(F.count("*").alias("n"), F.count_if("is_value_usable").alias("usable"), F.count_if("is_latest_observation").alias("latest"), F.round(F.sum("value"), 6).alias("total"))


@query("""WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)/', 1) AS host, list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1), '/'), lambda s: s <> '') AS s FROM pages),
u AS (SELECT host, array_to_string(s, ' > ') AS text, s[-1] AS leaf, len(s) AS depth FROM p)
SELECT depth AS category_path_depth, count(DISTINCT (host, text)) AS categories, count(*) AS memberships FROM u GROUP BY depth""")
def category_bridge_profile(t: Tables) -> DataFrame:
    rows = paths.categories(paths.category_paths(page_paths(t), ["page_id", "host"], "paths"), ["page_id", "host"])
    members = rows.select("page_id", "host", "category_path_text", "category_leaf", "category_path_depth")
    dim, bridge = mart.category_dimension(members, ["host", "category_path_text"], "category_key", "page_id")
    per = bridge.groupBy("category_key").agg(F.count("*").alias("m"))
    return dim.join(per, "category_key").groupBy(F.col("category_path_depth").cast("bigint").alias("category_path_depth")).agg(F.count("*").alias("categories"), F.sum("m").alias("memberships"))


@query("""WITH items AS (SELECT l_orderkey AS o, l_partkey AS p, l_suppkey AS s, l_shipdate AS d FROM lineitem),
bridge AS (SELECT p, s FROM items UNION ALL SELECT p, s FROM items WHERE s % 7 = 0 UNION ALL SELECT -1, s FROM items WHERE s % 5 = 0),
facts AS (SELECT CASE WHEN p % 11 = 0 THEN -1 WHEN p % 13 = 0 THEN -p ELSE p END AS p, s, o FROM items),
latest AS (SELECT s, d, d = max(d) OVER (PARTITION BY s) OR p % 3 = 0 AS is_latest FROM items WHERE s % 2 = 0 UNION ALL SELECT s, d, FALSE FROM items WHERE s % 2 = 1)
SELECT 'bridge' AS contract, 'repeated memberships' AS rule, (SELECT count(*) FROM (SELECT 1 FROM bridge GROUP BY p, s HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'bridge', 'members unknown', (SELECT count(*) FROM bridge ANTI JOIN part ON p = p_partkey)
UNION ALL SELECT 'bridge', 'categories unknown', (SELECT count(*) FROM bridge WHERE s NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0))
UNION ALL SELECT 'bridge', 'categories unused', (SELECT count(*) FROM supplier WHERE s_suppkey % 3 <> 0 AND s_suppkey NOT IN (SELECT s FROM bridge))
UNION ALL SELECT 'bridge', 'Unknown in the bridge', (SELECT count(*) FROM bridge WHERE p = -1)
UNION ALL SELECT 'fact', 'repeated grain', (SELECT count(*) FROM (SELECT 1 FROM facts GROUP BY p, s HAVING count(*) > 1))
UNION ALL SELECT 'fact', 'p orphans', (SELECT count(*) FROM facts WHERE p < 0)
UNION ALL SELECT 'fact', 'p unknown', (SELECT count(*) FROM facts WHERE p = -1)
UNION ALL SELECT 'latest', 'no latest', (SELECT count(*) FROM (SELECT s FROM latest GROUP BY s HAVING NOT bool_or(is_latest)))
UNION ALL SELECT 'latest', 'several latest', (SELECT count(*) FROM (SELECT s FROM latest GROUP BY s HAVING count(DISTINCT d) FILTER (WHERE is_latest) > 1))
UNION ALL SELECT 'reconciled', 'source grains missing', (SELECT count(*) FROM (SELECT DISTINCT p FROM items) WHERE p NOT IN (SELECT p FROM facts))
UNION ALL SELECT 'reconciled', 'fact grains from nowhere', (SELECT count(*) FROM (SELECT DISTINCT p FROM facts) WHERE p NOT IN (SELECT p FROM items))
UNION ALL SELECT 'scope', 'p unused', (SELECT count(*) FROM part WHERE p_partkey NOT IN (SELECT p FROM facts))
UNION ALL SELECT 'scope', 'p_size outside its domain', (SELECT count(*) FROM part WHERE p_size NOT IN (1, 2, 3))
UNION ALL SELECT 'scope', 'p_brand has several values', (SELECT count(DISTINCT p_brand) - 1 FROM part)""")
def mart_contract_suite(t: Tables) -> DataFrame:
    """The mart's contracts over a mart with planted faults of every kind: copies, Unknown members, keys of nothing, wrong flags."""
    items = t.lineitem.select(F.col("l_orderkey").alias("o"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.col("l_shipdate").alias("d"))
    bridge = items.select("p", "s").unionByName(items.where("s % 7 = 0").select("p", "s")).unionByName(items.where("s % 5 = 0").select(F.lit(-1).cast("long").alias("p"), "s"))
    facts = items.select(F.when(F.col("p") % 11 == 0, -1).when(F.col("p") % 13 == 0, -F.col("p")).otherwise(F.col("p")).alias("p"), "s", "o")
    parts, suppliers = t.part.select(F.col("p_partkey").alias("p"), "p_size", "p_brand"), t.supplier.where("s_suppkey % 3 != 0").select(F.col("s_suppkey").alias("s"))
    even = mart.latest_flag(items.where("s % 2 = 0"), ["s"], "d").withColumn("is_latest_observation", F.col("is_latest_observation") | (F.col("p") % 3 == 0))
    latest = even.unionByName(items.where("s % 2 = 1").withColumn("is_latest_observation", F.lit(False)))
    found = {
        "bridge": MC.bridge_violations(bridge, parts, suppliers, "p", "s"), "fact": MC.fact_violations(facts, ["p", "s"], {"p": parts}), "latest": MC.latest_violations(latest, ["s"], "d"),
        "reconciled": MC.reconcile(items, facts, ["p"]), "scope": MC.scope_violations(facts, parts, "p", ["p_brand"], {"p_size": [1, 2, 3]}),
    }
    return t.spark.createDataFrame([(c, k, int(n)) for c, rules in found.items() for k, n in rules.items()], "contract string, rule string, violations long")


@query(fact_sql() + """
SELECT 'distinct_grains' AS metric, CAST(count(*) AS VARCHAR) AS value FROM fact UNION ALL SELECT 'intraweek_variation_rows', CAST(count(*) FILTER (WHERE has_intraweek_price_variation) AS VARCHAR) FROM fact
UNION ALL SELECT 'effective_variation_rows', CAST(count(*) FILTER (WHERE has_effective_price_variation) AS VARCHAR) FROM fact UNION ALL SELECT 'promotion_conflicts', CAST(count(*) FILTER (WHERE promotion_state_conflict) AS VARCHAR) FROM fact
UNION ALL SELECT 'usable_effective_rows', CAST(count(effective_price) AS VARCHAR) FROM fact UNION ALL SELECT 'calculable_discount_rows', CAST(count(discount_pct) AS VARCHAR) FROM fact
UNION ALL SELECT 'first_week', CAST(min(week) AS VARCHAR) FROM fact UNION ALL SELECT 'last_week', CAST(max(week) AS VARCHAR) FROM fact""")
def named_metrics(t: Tables) -> DataFrame:
    """The regression metrics of the fact, in one pass."""
    one = fact(t).agg(
        F.count("*").alias("distinct_grains"), F.count_if("has_intraweek_price_variation").alias("intraweek_variation_rows"), F.count_if("has_effective_price_variation").alias("effective_variation_rows"), F.count_if("promotion_state_conflict").alias("promotion_conflicts"),
        F.count("effective_price").alias("usable_effective_rows"), F.count("discount_pct").alias("calculable_discount_rows"), F.min("week").alias("first_week"), F.max("week").alias("last_week"),
    )
    stack = ", ".join(f"'{c}', cast({c} as string)" for c in one.columns)
    return one.select(F.expr(f"stack({len(one.columns)}, {stack}) as (metric, value)"))
