"""Queries over the rules, contracts and measures of the layers, on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators import decisions as D
from granary.operators import labels, paths
from granary.operators import layer_contracts as LC
from granary.operators import measures as M
from granary.operators import profiling as P
from granary.operators.versions import price_versions
from granary.plans.price_queries import fact, fact_sql, obs_sql, observations
from granary.plans.registry import Tables, query
from granary.plans.table_queries import LABEL_MAPPING, page_paths, part_labels

#: The segments of a page's URL as labels of a path: languages, and words that stand in second place.
_ANCHORS = (("en", "germanic"), ("de", "germanic"), ("fr", "romance"), ("es", "romance"))
_RULES = D.PathRules(
    ambiguous=("about",), withheld=(D.Withheld(labels=("contact",)),), precedence=(("germanic", ("germanic", "romance"), "germanic_first"),), boundaries=((("news", "blog"), ("romance",), "press", "press_of_romance"),), prefix="url_",
)
_SEGMENTS = """p AS (SELECT page_id, list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1), '/'), lambda s: s <> '') AS s FROM pages),
k AS (SELECT page_id, s, list_transform(s, lambda x: lower(trim(x))) AS keys FROM p WHERE len(s) > 0),
c AS (SELECT *, list_sort(list_distinct(list_transform(list_filter(keys, lambda x: x IN ('en', 'de', 'fr', 'es')), lambda x: CASE WHEN x IN ('en', 'de') THEN 'germanic' ELSE 'romance' END))) AS codes,
  len(list_distinct(s)) < len(s) AS repeated FROM k),
d AS (SELECT *, CASE WHEN repeated THEN 'structural' WHEN list_has_any(keys, ['about']) OR list_has_any(keys, ['contact']) THEN 'excluded' WHEN len(codes) > 1 THEN 'matched' WHEN list_has_any(keys, ['news', 'blog']) AND len(list_filter(codes, lambda x: x <> 'romance')) = 0 THEN 'matched' WHEN len(codes) > 0 THEN 'matched' ELSE 'no_match' END AS reason,
  CASE WHEN len(codes) > 1 THEN 'germanic_first' WHEN list_has_any(keys, ['news', 'blog']) AND len(list_filter(codes, lambda x: x <> 'romance')) = 0 THEN 'press_of_romance' END AS rule FROM c)"""


@query(f"""WITH {_SEGMENTS}
SELECT reason, CASE WHEN reason = 'matched' THEN CASE rule WHEN 'germanic_first' THEN 'germanic' WHEN 'press_of_romance' THEN 'press' ELSE array_to_string(codes, ',') END ELSE '' END AS codes,
  CASE WHEN reason = 'matched' THEN coalesce(rule, '') ELSE '' END AS rule, count(*) AS paths FROM d GROUP BY ALL""")
def path_rules(t: Tables) -> DataFrame:
    """Whole paths of pages by the rules within a path, and the rule that decided beside the labels' own."""
    rows = paths.category_paths(page_paths(t).select("page_id", F.slice("paths", 2, 1).alias("paths")).where("size(paths[0]) > 0"), ["page_id"], "paths")
    found = D.classify_paths(rows, ["page_id"], t.spark.createDataFrame(list(_ANCHORS), "label string, code string"), _RULES)
    own = F.array_join(F.filter("rules", lambda r: ~r.startswith("url_")), ",")
    return found.groupBy("reason", F.array_join("codes", ",").alias("codes"), own.alias("rule")).agg(F.count("*").alias("paths"))


@query("""WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]*)', 1) AS label FROM pages WHERE regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]*)', 1) IN ('en', 'de', 'fr', 'es'))
SELECT label, 'url_' || substr(sha256(label), 1, 12) AS rule_id, count(*) AS products, 'pages:1,pages:2' AS example_paths FROM p GROUP BY label""")
def evidence_trail(t: Tables) -> DataFrame:
    """The rule ids that decisions rest on, and the paths that they point to."""
    rows = page_paths(t).where(F.col("paths")[0][0].isin("en", "de", "fr", "es")).select("page_id", F.array(F.col("paths")[0], F.concat(F.col("paths")[0], F.array(F.lit("x")))).alias("paths"))
    rows = paths.category_paths(rows, ["page_id"], "paths").withColumns({"source_dataset": F.lit("pages"), "is_prefix_of_another_path": F.lit(False)})
    votes = D.path_votes(rows, ["page_id"], t.spark.createDataFrame(list(_ANCHORS), "label string, code string"), rules=D.PathRules(prefix="url_"))
    label = rows.where("category_path_position = 1").select("page_id", F.col("category_path_normalized")[0].alias("label"))
    rows = votes.join(label, "page_id").withColumn("rule_id", F.explode("matched_rule_ids"))
    return rows.groupBy("label", "rule_id").agg(F.count("*").alias("products"), F.min(F.array_join("evidence_path_references", ",")).alias("example_paths"))


@query("""WITH v AS (SELECT o_custkey AS id, o_orderstatus AS code FROM orders),
per AS (SELECT id, count(DISTINCT code) AS n FROM v GROUP BY id)
SELECT 'conflict_of_one' AS rule, 0::BIGINT AS violations UNION ALL SELECT 'evidence_missing', (SELECT count(*) FROM per WHERE n = 1 AND id % 3 = 0)
UNION ALL SELECT 'code_unknown', (SELECT count(*) FROM per WHERE n = 1 AND id % 5 = 0) + 0 UNION ALL SELECT 'version_stale', (SELECT count(*) FROM per WHERE id % 7 = 0) UNION ALL SELECT 'status_and_code_disagree', (SELECT count(*) FROM per WHERE n > 1 AND id % 11 = 0)""")
def decision_contracts(t: Tables) -> DataFrame:
    """Decisions over the orders of customers, with planted faults: no rule, a code of no group, an old version, a code beside an abstention."""
    per = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.array_sort(F.collect_set("o_orderstatus")).alias("found"))
    one, names = F.size("found") == 1, {"F": "Filled", "O": "Open", "P": "Partial", "unclassified": "Unclassified"}
    code = F.when(one & (F.col("id") % 5 == 0), "?").when(one, F.col("found")[0]).when(F.col("id") % 11 == 0, "O").otherwise("unclassified")
    name = F.lit(None).cast("string")
    for k, v in names.items():
        name = F.when(code == k, v).otherwise(name)
    rows = per.select(
        "id", code.alias("code"), F.when(one, "classified").otherwise("conflicting_evidence").alias("status"), F.when(F.col("id") % 7 == 0, "old").otherwise("new").alias("mapping_version"), name.alias("category_name"),
        F.when(one & (F.col("id") % 5 == 0), F.array(F.lit("?"))).otherwise(F.col("found")).alias("candidates"), F.when(F.col("id") % 3 == 0, D.texts()).otherwise(D.texts(["r"])).alias("matched_rule_ids"),
        D.texts(["orders"]).alias("evidence_source_datasets"), D.texts(["orders:1"]).alias("evidence_path_references"),
    )
    found = LC.decision_violations(rows, ["id"], names, "new")
    return t.spark.createDataFrame([(k, int(found[k])) for k in ("conflict_of_one", "evidence_missing", "code_unknown", "version_stale", "status_and_code_disagree")], "rule string, violations long")


@query(f"""WITH {obs_sql()},
collapsed AS (SELECT DISTINCT product_id, shop, location, week, price, CASE WHEN product_id % 9 = 0 THEN -price_promo ELSE price_promo END AS price_promo FROM obs),
counted AS (SELECT *, count(*) OVER (PARTITION BY product_id, shop, location, week) AS n FROM collapsed),
planted AS (SELECT *, FALSE AS again FROM counted UNION ALL SELECT *, TRUE FROM counted WHERE product_id % 10 = 0)
SELECT count(*) AS rows, count(*) FILTER (WHERE again) AS repeated_ids, 0::BIGINT AS incomplete, 0::BIGINT AS not_finite, 0::BIGINT AS price_not_positive, count(*) FILTER (WHERE price_promo <= 0) AS promo_not_positive, 0::BIGINT AS version_flag_wrong,
  count(*) FILTER (WHERE n > 1) AS multiple_version_rows, count(*) FILTER (WHERE price_promo < price) AS promotion_rows, count(*) FILTER (WHERE price_promo > price) AS promo_above_price_rows FROM planted""")
def price_layer_contracts(t: Tables) -> DataFrame:
    """The contracts of written price versions, over versions with negative promotions and copies planted."""
    grain = ["product_id", "shop", "location", "week"]
    obs = observations(t).withColumn("price_promo", F.when(F.col("product_id") % 9 == 0, -F.col("price_promo")).otherwise(F.col("price_promo")))
    rows = price_versions(obs, grain)
    return LC.price_metrics(rows.unionByName(rows.where("product_id % 10 = 0")), grain).drop("multiple_version_grains")


@query("""WITH e AS (SELECT p_partkey, p_brand, p_size, unnest(['size', 'price', 'brand', 'kj', 'kcal']) AS entry FROM part)
SELECT count(*) AS rows, count(*) FILTER (WHERE entry = 'brand') AS missing_numeric_values, count(*) FILTER (WHERE entry = 'brand') AS unconvertible_unit_rows, count(*) FILTER (WHERE entry = 'price') AS converted_unit_rows, count(*) FILTER (WHERE entry IN ('size', 'kj', 'kcal')) AS identity_unit_rows,
  count(*) FILTER (WHERE entry <> 'brand') AS canonical_numeric_rows, 0::BIGINT AS duplicate_grains, count(DISTINCT p_partkey) AS written_observations, count(DISTINCT p_partkey) AS distinct_products, count(DISTINCT entry) AS distinct_nutrients,
  count(*) FILTER (WHERE entry = 'size' AND p_size > 30) AS mass_exceeds_portion_rows, count(DISTINCT p_partkey) FILTER (WHERE entry = 'size' AND p_size > 30) AS mass_exceeds_portion_products,
  count(*) FILTER (WHERE p_size > 40) AS energy_mismatch_nutrient_rows, count(DISTINCT p_partkey) FILTER (WHERE p_size > 40) AS energy_mismatch_observations, count(*) FILTER (WHERE p_size > 40 AND p_size % 2 = 0) AS invalid_quality_flags FROM e""")
def label_layer_contracts(t: Tables) -> DataFrame:
    """The counters of written label entries, with a mass over the portion and energy flags planted."""
    mapping = t.spark.createDataFrame(labels.check_mapping(LABEL_MAPPING), labels.MAPPING)
    rows = labels.standardize(labels.unpivot(part_labels(t).join(t.part.select("p_partkey", "p_size"), "p_partkey"), "payload", "$.nutrients"), mapping)
    size = F.col("p_size")
    rows = rows.select(
        "p_partkey", F.col("entry").alias("nutrient_name"), F.col("entry").alias("nutrient_name_raw"), F.col("raw_value").alias("nutrient_value_raw"), F.col("raw_unit").alias("nutrient_unit_raw"), F.sha2("payload", 256).alias("source_payload_hash"),
        F.col("value").alias("nutrient_value"), F.col("standard_unit").alias("nutrient_unit"), F.col("factor").alias("unit_conversion_factor"), F.col("status").alias("unit_standardization_status"), "dq_non_numeric_value",
        F.col("dq_incompatible_unit").alias("dq_incompatible_nutrient_unit"), F.when(F.col("raw_value").try_cast("double").isNotNull(), F.col("dq_negative_value")).alias("dq_negative_nutrient_value"), F.lit(False).alias("dq_conflicting_nutrition"),
        ((F.col("entry") == "size") & (size > 30)).alias("dq_mass_exceeds_portion"), (size > 40).alias("dq_energy_kcal_mismatch"), F.when((size <= 40) | (size % 2 == 1), 1.0).alias("energy_pair_difference_kj"),
    )
    wanted = ("rows", "missing_numeric_values", "unconvertible_unit_rows", "converted_unit_rows", "identity_unit_rows", "canonical_numeric_rows", "duplicate_grains", "written_observations", "distinct_products", "distinct_nutrients", "mass_exceeds_portion_rows", "mass_exceeds_portion_products", "energy_mismatch_nutrient_rows", "energy_mismatch_observations", "invalid_quality_flags")
    found = LC.label_metrics(rows, ["p_partkey"], "p_partkey")
    return t.spark.createDataFrame([tuple(int(found[k]) for k in wanted)], ", ".join(f"{k} long" for k in wanted))


@query("""WITH a AS (SELECT l_partkey AS k, l_returnflag AS c FROM lineitem WHERE l_partkey % 4 <> 0), b AS (SELECT p_partkey AS k, CASE WHEN p_size % 2 = 0 THEN 'N' ELSE 'A' END AS c FROM part WHERE p_size < 40 UNION ALL SELECT p_partkey, 'R' FROM part WHERE p_size < 5)
SELECT (SELECT count(*) FROM a) AS rows, count(*) AS joined_rows, count(b.k) AS matched_rows, count(*) FILTER (WHERE b.k IS NULL) AS unmatched_rows, count(*) FILTER (WHERE b.k IS NOT NULL AND a.c IS DISTINCT FROM b.c) AS context_mismatches FROM a LEFT JOIN b USING (k)""")
def cross_table_contracts(t: Tables) -> DataFrame:
    """What a join between layers would do, from counts by key: rows multiplied, unmatched and matched in another context are planted."""
    a = t.lineitem.where("l_partkey % 4 != 0").select(F.col("l_partkey").alias("k"), F.col("l_returnflag").alias("c"))
    b = t.part.where("p_size < 40").select(F.col("p_partkey").alias("k"), F.when(F.col("p_size") % 2 == 0, "N").otherwise("A").alias("c"))
    b = b.unionByName(t.part.where("p_size < 5").select(F.col("p_partkey").alias("k"), F.lit("R").alias("c")))
    found = LC.relationship(a, b, ["k"], ["c"])
    return t.spark.createDataFrame([tuple(int(v) for v in found.values())], ", ".join(f"{k} long" for k in found))


@query(fact_sql("l_returnflag") + """,
w AS (SELECT location, week, count(DISTINCT product_id) AS observed_products FROM fact GROUP BY ALL),
f AS (SELECT location, min(week) AS first_observation FROM fact GROUP BY location)
SELECT w.location, week, observed_products, round(100.0::DOUBLE * observed_products / (SELECT x.observed_products FROM w x WHERE x.location = w.location AND x.week = f.first_observation), 6) AS observed_products_index, first_observation FROM w JOIN f ON w.location = f.location""")
def products_index(t: Tables) -> DataFrame:
    """Products of every week as an index to the first week of their place, and that week, also for the weeks after it."""
    rows = fact(t, "l_returnflag")
    out = M.products_index(rows, ["location"]).join(M.first_observation(rows, ["location"]), "location")
    return out.select("location", "week", "observed_products", F.round("observed_products_index", 6).alias("observed_products_index"), "first_observation")


@query("""WITH e AS (SELECT l_partkey AS product, l_returnflag AS part, l_linestatus AS entry, l_quantity AS value, l_discount < 0.05::DOUBLE AS usable, CAST(l_shipdate AS DATE) = max(CAST(l_shipdate AS DATE)) OVER (PARTITION BY l_partkey, l_linestatus) AS latest, CASE WHEN l_tax < 0.04::DOUBLE THEN 'per_100g' ELSE 'other' END AS basis FROM lineitem)
SELECT part, count(DISTINCT product) FILTER (WHERE usable) AS products_with_usable_labels, round(CASE WHEN min(entry) = max(entry) THEN avg(value) FILTER (WHERE usable AND latest AND basis = 'per_100g') END, 6) AS average_value_per_100g FROM e GROUP BY part""")
def label_measures(t: Tables) -> DataFrame:
    """Products with a usable entry, and the average usable latest value per 100 g where a group has one entry only."""
    from granary.operators.versions import latest_flag

    rows = t.lineitem.select(
        F.col("l_partkey").alias("product_key"), F.col("l_returnflag").alias("part"), F.col("l_linestatus").alias("entry"), F.col("l_quantity").alias("value"), (F.col("l_discount") < 0.05).alias("is_value_usable"),
        F.col("l_shipdate").cast("date").alias("day"), F.when(F.col("l_tax") < 0.04, "per_100g").otherwise("other").alias("nutrition_basis"),
    )
    rows = latest_flag(rows, ["product_key", "entry"], "day")
    usable = M.usable_products(rows, ["part"])
    average = M.average_value(rows, ["part"], "entry", "value")
    return usable.join(average, "part").select("part", "products_with_usable_labels", F.round("average_value_per_100g", 6).alias("average_value_per_100g"))


@query("""SELECT p_brand, CASE WHEN p_brand IN ('Brand#1', 'Brand#11') THEN '#B4B2A9' ELSE '#12A19B' END AS bar_colour, CASE WHEN avg(p_size) / 25 - 1 > 0.01::DOUBLE THEN '#12A19B' ELSE '#A8DCD9' END AS premium_colour FROM part GROUP BY p_brand""")
def bar_colours(t: Tables) -> DataFrame:
    rows = t.part.groupBy("p_brand").agg(F.avg("p_size").alias("a"))
    return rows.select("p_brand", M.category_colour(F.col("p_brand"), ("Brand#1", "Brand#11")).alias("bar_colour"), M.premium_colour(F.col("a") / 25 - 1).alias("premium_colour"))


@query(f"""WITH {_SEGMENTS}, s AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)/', 1) AS host FROM pages)
SELECT host AS row_value, count(*) FILTER (WHERE reason = 'matched') AS matched, count(*) FILTER (WHERE reason = 'excluded') AS excluded, count(*) FILTER (WHERE reason = 'no_match') AS no_match, count(*) FILTER (WHERE reason = 'structural') AS structural,
  round(count(*) FILTER (WHERE reason = 'matched') * 100.0::DOUBLE / count(*), 2) AS coverage_pct FROM d JOIN s USING (page_id) GROUP BY host""")
def status_by_shop(t: Tables) -> DataFrame:
    """Statuses of decisions by host as columns, and the share that is decided."""
    rows = paths.category_paths(page_paths(t).select("page_id", "host", F.slice("paths", 2, 1).alias("paths")).where("size(paths[0]) > 0"), ["page_id", "host"], "paths")
    found = D.classify_paths(rows, ["page_id"], t.spark.createDataFrame(list(_ANCHORS), "label string, code string"), _RULES)
    kinds = ["matched", "excluded", "no_match", "structural"]
    out = P.pivot_counts(found, F.col("host"), "reason", kinds)
    return out.withColumn("coverage_pct", F.round(F.try_divide(F.col("matched") * 100.0, sum((F.col(k) for k in kinds), F.lit(0))), 2))


@query(fact_sql() + """,
e AS (SELECT CAST(ts AS DATE) AS d, user_id % 50 AS product_id FROM events),
span AS (SELECT min(week) AS a, max(week) AS b FROM fact), espan AS (SELECT min(d) AS a, max(d) AS b FROM e)
SELECT (SELECT count(*) FROM fact) AS fact_rows, (SELECT count(*) FROM fact SEMI JOIN (SELECT p_partkey FROM part WHERE p_size <= 25) ON product_id = p_partkey) AS categorised_rows,
  (SELECT count(*) FROM fact ANTI JOIN part ON product_id = p_partkey) AS unmatched_rows, greatest(span.a, espan.a) AS shared_start, least(span.b, espan.b) AS shared_end, greatest(span.a, espan.a) <= least(span.b, espan.b) AS overlap FROM span, espan""")
def mart_evidence(t: Tables) -> DataFrame:
    """What the facts cover: rows with a category, rows without a product, and the period that two facts share."""
    rows, events = fact(t).select("product_id", "week"), t.events.select(F.col("ts").cast("date").alias("d"))
    members = t.part.select(F.col("p_partkey").alias("product_id"), (F.col("p_size") <= 25).alias("categorised"))
    per = rows.groupBy("product_id").agg(F.count("*").alias("n"), F.min("week").alias("a"), F.max("week").alias("b")).join(members, "product_id", "left")
    one = per.agg(F.sum("n").alias("fact_rows"), F.coalesce(F.sum(F.when(F.col("categorised"), F.col("n"))), F.lit(0)).alias("categorised_rows"), F.coalesce(F.sum(F.when(F.col("categorised").isNull(), F.col("n"))), F.lit(0)).alias("unmatched_rows"), F.min("a").alias("a"), F.max("b").alias("b"))
    rows = one.crossJoin(events.agg(F.min("d").alias("c"), F.max("d").alias("e")))  # a row each
    start, end = F.greatest("a", "c"), F.least("b", "e")
    return rows.select("fact_rows", "categorised_rows", "unmatched_rows", start.alias("shared_start"), end.alias("shared_end"), (start <= end).alias("overlap"))


_LOO_TOKENS = "tok AS (SELECT doc_id, lang, source, unnest(list_distinct(regexp_extract_all(lower(nfc_normalize(text)), '[a-zà-ÿ]{4,}'))) AS token FROM documents)"


@query(f"""WITH {_LOO_TOKENS},
per AS (SELECT token, lang, count(*) AS n FROM tok GROUP BY ALL), own AS (SELECT source, token, lang, count(*) AS n FROM tok GROUP BY ALL),
left_out AS (SELECT s.source, per.token, per.lang, per.n - coalesce(own.n, 0) AS n FROM per JOIN (SELECT DISTINCT source, token FROM tok) s USING (token) LEFT JOIN own ON own.source = s.source AND own.token = per.token AND own.lang = per.lang),
mined AS (SELECT source, token, arg_min(lang, (-n, lang)) AS code FROM left_out WHERE n > 0 GROUP BY source, token HAVING sum(n) >= 20 AND max(n) >= 0.98::DOUBLE * sum(n)),
named AS (SELECT doc_id, min(code) AS code, count(DISTINCT code) AS n FROM tok JOIN mined USING (source, token) GROUP BY doc_id)
SELECT source, count(*) AS documents, count(*) FILTER (WHERE n = 1) AS decided, count(*) FILTER (WHERE n = 1 AND code = lang) AS agreed FROM documents LEFT JOIN named USING (doc_id) WHERE source IS NOT NULL GROUP BY source""")
def leave_one_out_agreement(t: Tables) -> DataFrame:
    """Words mined without each source, and how often they agree with what that source says itself."""
    from granary.functions.columns import composed

    return paths.leave_one_out(composed(t.documents.select("doc_id", "lang", "source", "text"), "text"), "doc_id", "text", "lang", "source")


@query(f"""WITH {_SEGMENTS}, leaf AS (SELECT DISTINCT s AS path FROM p WHERE len(s) > 0)
SELECT len(path) AS depth, count(*) AS members, count(DISTINCT path) AS paths FROM k JOIN leaf ON k.s = leaf.path GROUP BY 1""")
def array_join(t: Tables) -> DataFrame:
    """Members joined to their categories by the array of labels itself."""
    rows = page_paths(t).select("page_id", F.col("paths")[1].alias("path")).where("size(path) > 0")
    found = rows.join(rows.select("path").distinct().withColumn("known", F.lit(True)), "path")
    return found.groupBy(F.size("path").cast("long").alias("depth")).agg(F.count("*").alias("members"), F.count_distinct("path").alias("paths"))


@query(f"""WITH {obs_sql()} SELECT CAST(date_trunc('month', week) AS DATE) AS month, count(DISTINCT shop) AS observed_shops, count(DISTINCT location) AS observed_locations, count(DISTINCT product_id) AS observed_products FROM obs GROUP BY 1""")
def observed_members(t: Tables) -> DataFrame:
    rows = observations(t).withColumn("month", F.trunc("week", "month"))
    return M.observed(rows, ["month"], {"observed_shops": "shop", "observed_locations": "location", "observed_products": "product_id"})
