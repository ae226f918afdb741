"""The retail case: nine clean tables of seven raw ones, and the star schema of one market over them.

What depends on the retailers (their codes and names, label units, words that stand for categories) is data in a Spec;
the builders only put the operators together. Builders are pure: tables in, table out. Checks come with the jobs.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import columns as C
from granary.operators import contracts as Q
from granary.operators import decisions, enrich, facts, labels, mart, paths
from granary.operators import layer_contracts as LC
from granary.operators import mart_contracts as MC
from granary.operators.calendar import date_dimension
from granary.operators.keys import attach_key, surrogate_keys, unique_match
from granary.operators.versions import canonical, collapse_duplicates, price_versions
from granary.plans.publish import Job
from granary.plans.reporting_groups import DUTCH, GROUPS, NAVIGATION, NAVIGATION_CONTEXT

PRODUCT = ["product_id", "shop", "name", "brand", "country", "description", "categories", "language"]
RAW = {
    "products": PRODUCT,
    "weekly_prices_products": PRODUCT,
    "locations": ["shop", "id", "country_code", "type", "postcode", "geolocation_latitude", "geolocation_longitude", "sources"],
    "weekly_prices_locations": ["shop", "location", "location_name", "shop_type", "postcode", "locality", "state", "geolocation_latitude", "geolocation_longitude"],
    "prices": ["product_id", "shop", "country", "location", "price", "promo_price", "downloaded_on", "unit_std", "currency"],
    "weekly_prices": ["product_id", "shop", "location", "week", "price", "price_promo"],
    "nutritionals": ["product_id", "shop", "country", "language", "download_date", "nutritional_values_std"],
}
LAT, LON = "geolocation_latitude", "geolocation_longitude"
IDENTITY = ["product_id", "shop", "country"]
GRAIN = ["product_id", "shop", "location", "week"]


@dataclass(frozen=True)
class Spec:
    """What is known of the retailers.

    shops: code -> name. encoded: codes written backwards. shop_types: known labels; those in reversed_types are written
    backwards. units: label entries (see labels.MAPPING). anchors: (label, code) and names: (word, code) of categories, both
    in the rules' language. reviewed: (product_id, shop, country, payload hashes) of products held back. navigation: a
    leading part of paths of no meaning, in navigation_context (shop, country, language).
    """

    shops: dict[str, str]
    encoded: Sequence[str] = ()
    shop_types: Sequence[str] = ()
    reversed_types: Sequence[str] = ()
    units: Sequence[tuple] = ()
    anchors: Sequence[tuple[str, str]] = ()
    names: Sequence[tuple[str, str]] = ()
    rules: decisions.PathRules = decisions.PathRules()
    reviewed: Sequence[tuple[str, str, str, Sequence[str]]] = ()
    navigation: Sequence[str] = ()
    navigation_context: tuple[str, str, str] | None = None
    market: str = "be"
    national: str = C.NATIONAL
    store: str = C.STORE
    category_names: dict[str, str] = field(default_factory=dict)
    mapping_version: str = "1"

    @property
    def categories(self) -> dict[str, str]:
        return {"unclassified": "Unclassified", **self.category_names}

    @classmethod
    def read(cls, path: str | Path) -> Spec:
        """From a JSON file with the fields by name; `rules` may be "dutch" for the rules and group names that come along."""
        said = json.loads(Path(path).read_text())
        if said.get("rules") == "dutch":
            said = {"category_names": GROUPS, "navigation": NAVIGATION, "navigation_context": NAVIGATION_CONTEXT} | said | {"rules": DUTCH}
        elif "rules" in said:
            said["rules"] = decisions.PathRules(**said["rules"] | {"withheld": [decisions.Withheld(**w) for w in said["rules"].get("withheld", ())]})
        return cls(**{k: [tuple(x) for x in v] if k in ("units", "anchors", "names", "reviewed") else v for k, v in said.items()})


def clean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: C.normalize_text(F.col(c).cast("string"), C.COLUMN_TOKENS.get(c, ())) for c in columns})


def with_shop(df: DataFrame, spec: Spec) -> DataFrame:
    return df.withColumn("shop", C.decode_code(F.col("shop"), spec.encoded, list(spec.shops))).withColumn("shop_name", C.lookup(F.col("shop"), spec.shops, "shop"))


def raw(tables: dict[str, DataFrame], name: str) -> DataFrame:
    return Q.require_columns(tables[name], RAW[name]).select(*RAW[name])


def products(tables: dict[str, DataFrame], spec: Spec) -> DataFrame:
    return with_shop(clean(raw(tables, "products"), PRODUCT), spec)


def weekly_products(tables: dict[str, DataFrame], spec: Spec) -> DataFrame:
    own = with_shop(clean(raw(tables, "weekly_prices_products"), PRODUCT), spec)
    return enrich.fallback(own, tables["silver_products"], ["product_id"], ["name", "brand", "description", "categories"], ["shop", "country", "language"])


def _coordinate_flags() -> dict[str, Column]:
    lat, lon = F.col(LAT), F.col(LON)
    return {
        "dq_invalid_latitude": C.flag(~lat.between(-90, 90)), "dq_invalid_longitude": C.flag(~lon.between(-180, 180)),
        "dq_incomplete_coordinates": lat.isNull() != lon.isNull(), "dq_outside_benelux": C.outside_box(lat, lon),
    }


def locations(tables: dict[str, DataFrame], spec: Spec) -> DataFrame:
    """The column `type` is dropped as it is empty; a value in it, and a coordinate that is not finite, fails the build."""
    df = raw(tables, "locations")
    empty = F.when(F.col("type").isNotNull(), F.raise_error(F.lit("locations.type is no longer empty")).cast("string"))
    df = with_shop(clean(df.withColumn("sources", F.coalesce(empty, F.col("sources").cast("string"))), ["shop", "id", "country_code", "postcode", "sources"]), spec)
    df = df.drop("type").withColumns({c: C.must_be_finite(F.col(c).cast("double"), c) for c in (LAT, LON)})
    per_key = df.groupBy("shop", "id").agg((F.count("*") > 1).alias("dq_business_key_collision"))
    return df.join(per_key.withColumnsRenamed({"shop": "_s", "id": "_i"}), F.col("shop").eqNullSafe(F.col("_s")) & F.col("id").eqNullSafe(F.col("_i"))).drop("_s", "_i").withColumns(_coordinate_flags())


def weekly_locations(tables: dict[str, DataFrame], spec: Spec) -> DataFrame:
    df = raw(tables, "weekly_prices_locations")
    df = with_shop(clean(df.withColumn("shop_type_raw", F.col("shop_type")), ["shop", "location", "location_name", "shop_type", "postcode", "locality", "state"]), spec)
    low = F.lower("shop_type")
    backwards = C.flag(low.isin(*spec.reversed_types)) if spec.reversed_types else F.lit(False)
    kind = F.when(backwards, F.reverse(low)).otherwise(low)
    known = F.when(kind.isNull() | kind.isin(*spec.shop_types), kind).otherwise(F.raise_error(F.concat(F.lit("unknown shop type: "), low)))
    df = df.withColumns({"shop_type": known, "is_shop_type_reversed": backwards, **{c: C.must_be_finite(F.col(c).cast("double"), c) for c in (LAT, LON)}})
    theirs = tables["silver_locations"].where("not dq_business_key_collision").select("shop", F.col("id").alias("location"), F.col("country_code").alias("_country"), F.col("postcode").alias("_postcode"), F.col(LAT).alias("_lat"), F.col(LON).alias("_lon"), F.lit(True).alias("_found"))
    df = Q.join_checked(df, theirs, ["shop", "location"], "1:1")
    differs = {"postcode": C.flag(F.col("postcode") != F.col("_postcode")), "latitude": C.flag(F.abs(F.col(LAT) - F.col("_lat")) > 1e-5), "longitude": C.flag(F.abs(F.col(LON) - F.col("_lon")) > 1e-5)}
    conflict = differs["postcode"] | differs["latitude"] | differs["longitude"]
    safe = C.flag(F.col("_found")) & ~conflict
    both = F.col(LAT).isNull() & F.col(LON).isNull()
    pair = safe & both & F.col("_lat").isNotNull() & F.col("_lon").isNotNull()
    df = df.withColumns({f"dq_{k}_conflict": v for k, v in differs.items()} | {
        "dq_enrichment_context_mismatch": C.flag(F.col("_found")) & conflict,
        "is_postcode_enriched": safe & F.col("postcode").isNull() & F.col("_postcode").isNotNull(), "is_coordinates_enriched": pair,
        "_new_postcode": F.when(safe, F.coalesce("postcode", "_postcode")).otherwise(F.col("postcode")), "country_code": F.when(safe, F.col("_country")),
        "_new_lat": F.when(pair, F.col("_lat")).otherwise(F.col(LAT)), "_new_lon": F.when(pair, F.col("_lon")).otherwise(F.col(LON)),
    })
    df = df.drop("postcode", LAT, LON, "_postcode", "_lat", "_lon", "_country", "_found").withColumnsRenamed({"_new_postcode": "postcode", "_new_lat": LAT, "_new_lon": LON})
    return df.withColumns(_coordinate_flags() | {"location_type": C.location_type(F.col("location_name"), spec.national, spec.store), "region": C.region(F.col("postcode"))})


def prices(tables: dict[str, DataFrame], spec: Spec) -> DataFrame:
    df = with_shop(clean(raw(tables, "prices"), ["product_id", "shop", "country", "location", "unit_std", "currency"]), spec)
    df = Q.require_date(df, "downloaded_on").withColumns({"price": F.col("price").cast("double"), "promo_price": F.col("promo_price").cast("double")})
    price, promo = F.col("price"), F.col("promo_price")
    return df.withColumns({"is_promotion": C.flag(promo < price), "dq_non_positive_price": C.flag(price <= 0), "dq_non_positive_promo_price": C.flag(promo <= 0), "dq_promo_not_below_price": C.flag(promo >= price)})


def weekly_prices(tables: dict[str, DataFrame], spec: Spec) -> DataFrame:
    df = Q.require_date(raw(tables, "weekly_prices"), "week")
    df = with_shop(clean(df, ["product_id", "shop", "location"]), spec).withColumns({"price": F.col("price").cast("double"), "price_promo": F.col("price_promo").cast("double")})
    out = price_versions(df.drop("shop_name"), GRAIN)
    return out.withColumn("shop_name", C.lookup(F.col("shop"), spec.shops, "shop"))


def nutritionals(tables: dict[str, DataFrame], spec: Spec) -> DataFrame:
    """One row per entry of each grain's canonical label.

    All labels are checked, also those not taken: JSON with entries, a positive finite portion with a unit, and a known unit
    and finite number for each entry. A label that fails one fails the build.
    """
    path, payload = "$.nutrients", "nutritional_values_std"
    df = with_shop(clean(Q.require_date(raw(tables, "nutritionals"), "download_date"), ["product_id", "shop", "country", "language"]), spec)
    df = collapse_duplicates(df.drop("shop_name"))
    problem = labels.label_problems(F.col(payload), path, "$.portion", spec.units)
    df = df.withColumn(payload, F.when(problem.isNull(), F.col(payload)).otherwise(F.raise_error(F.concat(F.lit("label: "), problem))))
    grain = ["product_id", "shop", "country", "download_date"]
    stats = df.groupBy(*grain).agg(F.count("*").alias("_rows"), F.count_distinct(payload).alias("_payloads"), F.count_distinct("language").alias("_languages"))
    best = canonical(labels.completeness(df, payload, path), grain, ["numeric_entry_count", "entry_count", "populated_unit_count"], payload, [F.coalesce("language", F.lit(""))])
    best = Q.join_checked(best, stats, grain, "1:1")
    portion = F.get_json_object(payload, "$.portion.value").try_cast("double")
    best = best.withColumns({"portion_value": portion, "portion_unit": F.get_json_object(payload, "$.portion.unit"), "source_payload_hash": F.sha2(payload, 256), "_e": labels.entries(F.col(payload), path)})

    def energy(unit: str) -> Column:
        return F.get(F.map_values(F.map_filter("_e", lambda _, e: F.lower(e["unit"]) == unit)), F.lit(0))["value"].try_cast("double")

    kj, kcal = energy("kj"), energy("kcal")
    best = best.withColumns({"energy_pair_difference_kj": F.when((kj >= 0) & (kcal >= 0), F.abs(kj - kcal * labels.KJ_PER_KCAL)), "dq_energy_kcal_mismatch": C.flag(labels.energy_mismatch(kj, kcal)), "dq_repeated_grain": F.col("_rows") > 1, "dq_conflicting_nutrition": F.col("_payloads") > 1, "dq_language_conflict": F.col("_languages") > 1}).drop("_e")
    mapping = best.sparkSession.createDataFrame(labels.check_mapping(spec.units), labels.MAPPING)
    out = labels.standardize(labels.unpivot(best, payload, path), mapping)
    unknown = F.when(F.col("dq_unknown_unit"), F.raise_error(F.concat_ws(" ", F.lit("unmapped entry:"), "entry", "raw_unit")).cast("string"))
    mass = C.flag((F.col("standard_unit") == "g") & (F.col("portion_unit") == "g") & (F.col("value") > F.col("portion_value")))
    out = out.withColumns({"status": F.coalesce(unknown, "status"), "dq_mass_exceeds_portion": mass, "shop_name": C.lookup(F.col("shop"), spec.shops, "shop")})
    return out.select(
        "product_id", "shop", "country", "language", "download_date", F.col("entry").alias("nutrient_name_raw"), F.col("raw_value").alias("nutrient_value_raw"), F.col("raw_unit").alias("nutrient_unit_raw"), "portion_value", "portion_unit", "source_payload_hash",
        F.col("entry_count").alias("nutrient_count"), F.col("numeric_entry_count").alias("numeric_nutrient_count"), "populated_unit_count", "dq_source_exact_duplicate", "dq_repeated_grain", "dq_conflicting_nutrition", "dq_language_conflict", F.col("selection_reason").alias("nutrition_selection_reason"),
        F.col("entry").alias("nutrient_name"), F.col("value").alias("nutrient_value"), F.col("standard_unit").alias("nutrient_unit"), F.col("factor").alias("unit_conversion_factor"), F.col("status").alias("unit_standardization_status"), F.col("dq_negative_value").alias("dq_negative_nutrient_value"),
        "energy_pair_difference_kj", "dq_energy_kcal_mismatch", F.col("dq_missing_value").alias("dq_missing_nutrient_value"), "dq_non_numeric_value", F.col("dq_incompatible_unit").alias("dq_incompatible_nutrient_unit"), "dq_mass_exceeds_portion", "shop_name",
    )


def category_paths(tables: dict[str, DataFrame], spec: Spec) -> DataFrame:
    """Paths of both product tables; labels composed (NFC) and stripped. Each distinct text of paths is parsed once."""
    rows = None
    for source in ("silver_weekly_products", "silver_products"):
        df = tables[source]
        origin = F.when(F.col("is_categories_enriched"), "silver_products").otherwise(source) if "is_categories_enriched" in df.columns else F.lit(source)
        own = df.select(F.lit(source).alias("source_dataset"), *IDENTITY, "language", origin.alias("category_source_dataset"), "categories").where("categories is not null")
        rows = own if rows is None else rows.unionByName(own)
    texts = C.composed(rows.select("categories", F.col("categories").alias("_text")).distinct(), "_text").select("categories", paths.parse_paths(F.col("_text")).alias("_paths"))
    rows = rows.join(texts, "categories").withColumns({"source_categories_sha256": F.sha2("categories", 256), "normalization_rule": F.lit(NORMALIZATION)})
    context = F.lit(False)
    if spec.navigation_context:
        context = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(("shop", "country", "language"), spec.navigation_context, strict=True)))
    keep = ["source_dataset", *IDENTITY, "language", "category_source_dataset", "source_categories_sha256", "normalization_rule"]
    return paths.category_paths(rows, keep, "_paths", spec.navigation, context)


def primary_categories(tables: dict[str, DataFrame], spec: Spec) -> DataFrame:
    """A decision for each identity of the product tables and labels, by paths first and the name where these give no one answer.

    The weekly table's row names a product, where it has one. Reviewed products are held back.
    """
    spark = tables["silver_products"].sparkSession
    found = tables["silver_product_category_paths"]
    identities = tables["silver_weekly_products"].select(*IDENTITY).unionByName(tables["silver_products"].select(*IDENTITY)).unionByName(tables["silver_nutritionals"].select(*IDENTITY)).distinct()
    anchors = spark.createDataFrame(list(spec.anchors), "label string, code string")
    votes = decisions.path_votes(found, IDENTITY, F.broadcast(anchors), rules=spec.rules)  # a list of the Spec
    weekly, other = (tables[n].select(*IDENTITY, "name", "language") for n in ("silver_weekly_products", "silver_products"))
    named = weekly.unionByName(other.join(weekly, IDENTITY, "left_anti"))
    words = spark.createDataFrame(list(spec.names), "token string, code string")
    readable = F.col("language").eqNullSafe(F.lit(spec.rules.language)) if spec.rules.language else None
    names = paths.name_codes(C.composed(named, "name"), IDENTITY, "name", F.broadcast(words), where=readable)
    decided = decisions.decide(votes, IDENTITY, names)
    rows = Q.join_checked(identities, decided, IDENTITY, "1:1")
    rows = rows.withColumns({"code": F.coalesce("code", F.lit("unclassified")), "status": F.coalesce("status", F.lit("missing_evidence"))})
    rows = rows.withColumns({c: F.coalesce(c, decisions.texts()) for c in ("candidates", "name_codes", *decisions.EVIDENCE)} | {c: F.coalesce(c, F.lit(0)) for c in ("source_path_count", "excluded_path_count")})
    if spec.reviewed:
        held = spark.createDataFrame(list(spec.reviewed), "product_id string, shop string, country string, hashes array<string>")
        rows = decisions.withhold(rows, IDENTITY, found, F.broadcast(held))
    return rows.withColumns({"category_name": C.lookup(F.col("code"), spec.categories, "category"), "mapping_version": F.lit(spec.mapping_version)})


#: The rule by which labels of paths are normalised; it goes with each path.
NORMALIZATION = "category_structure_v1"

SILVER = {
    "silver_products": products, "silver_locations": locations, "silver_prices": prices, "silver_nutritionals": nutritionals, "silver_weekly_products": weekly_products, "silver_weekly_locations": weekly_locations,
    "silver_weekly_prices": weekly_prices, "silver_product_category_paths": category_paths, "silver_product_primary_categories": primary_categories,
}
#: Keys of the clean tables, proven while they are written. A price id stands for its grain and both prices.
KEYS = {
    "silver_products": ["product_id"], "silver_weekly_products": ["product_id"], "silver_weekly_locations": ["shop", "location"], "silver_product_primary_categories": IDENTITY,
    "silver_weekly_prices": ["price_observation_id"], "silver_product_category_paths": ["source_dataset", "product_id", "category_path_position"],
}
ENRICHED = ("name", "brand", "description", "categories")


def _fails(name: str, found: dict[str, int]) -> None:
    Q.fail_if_any(found, name)


def observed_silver(spec: Spec) -> dict[str, dict[str, Column]]:
    """What is taken of each clean table while it is written."""
    # The paths of the product tables are counted with them, so that they need not be parsed once more to account for each.
    paths_of = {"category_texts": F.count("categories"), "category_paths": F.coalesce(F.sum(F.json_array_length("categories")), F.lit(0))}
    filled = {f"{c}_enriched": F.count_if(f"is_{c}_enriched") for c in ENRICHED} | {"context_mismatches": F.count_if("dq_enrichment_context_mismatch")}
    return {
        "silver_products": paths_of, "silver_weekly_products": paths_of | filled | LC.enrichment_figures([*IDENTITY, "language"], ENRICHED),
        "silver_weekly_prices": LC.price_figures(GRAIN), "silver_nutritionals": LC.label_figures(spec.units),
        "silver_product_category_paths": LC.path_figures(KEYS["silver_product_category_paths"]) | {c: F.count_if(c) for c in paths.STRUCTURAL},
        "silver_product_primary_categories": LC.decision_figures(IDENTITY, spec.categories, spec.mapping_version) | {f"status_{s}": F.count_if(F.col("status") == s) for s in decisions.STATUSES},
    }


def judge_silver(spec: Spec) -> dict:
    """Contracts and metrics of each clean table from what was observed while it and those before it were written."""

    def weekly_prices(seen: dict, before: dict) -> dict:
        broken = ("incomplete", "not_finite", "price_not_positive", "promo_not_positive", "version_flag_wrong")
        _fails("weekly prices", {"empty": int(not seen["rows"]), **{n: seen[n] for n in broken}})
        return {"multiple_version_grains": round(seen["multiple_version_grains"])}

    def category_paths(seen: dict, before: dict) -> dict:
        expected = {f"{n}_paths": before[n]["category_paths"] for n in ("silver_products", "silver_weekly_products")}
        _fails("category paths", {"unaccounted": abs(seen["rows"] - sum(expected.values())), **{n: seen[n] for n in ("depth_wrong", "lineage_missing")}})
        return expected

    def primary_categories(seen: dict, before: dict) -> dict:
        _fails("primary categories", {n: seen[n] for n in LC.decision_figures(IDENTITY, spec.categories, spec.mapping_version)})
        return {s: n for s in decisions.STATUSES if (n := seen[f"status_{s}"])}

    return {"silver_weekly_prices": weekly_prices, "silver_product_category_paths": category_paths, "silver_product_primary_categories": primary_categories}


def measure_silver(spec: Spec) -> dict:
    """What needs the sources' rows (counted from footers), or groups of the written table, of which one pass is taken."""

    def weekly_products(df: DataFrame, t: dict[str, DataFrame], seen: dict) -> dict:
        broken = {n: seen[n] for n in LC.enrichment_figures([*IDENTITY, "language"], ENRICHED)}
        _fails("weekly products", {"rows_changed": abs(seen["rows"] - t["weekly_prices_products"].count()), **broken})
        return {}

    def weekly_prices(df: DataFrame, t: dict[str, DataFrame], seen: dict) -> dict:
        raw_rows = t["weekly_prices"].count()
        return {"raw_rows": raw_rows, "exact_duplicates_removed": raw_rows - seen["rows"]}

    def nutritionals(df: DataFrame, t: dict[str, DataFrame], seen: dict) -> dict:
        observation = ["product_id", "shop", "country", "download_date"]
        found = LC.label_counts(df, observation, entries="nutrient_count") | seen
        labelled = with_shop(clean(raw(t, "nutritionals"), ["product_id", "shop", "country"]), spec).select(*observation).distinct().count()
        _fails("nutritionals", LC.label_violations(df, found, spec.units, found.pop("entries_of_labels"), labelled))
        return found

    return {"silver_weekly_products": weekly_products, "silver_weekly_prices": weekly_prices, "silver_nutritionals": nutritionals}


def silver_jobs(spec: Spec) -> list[Job]:
    observed, judged, measured = observed_silver(spec), judge_silver(spec), measure_silver(spec)
    return [
        Job(name, lambda t, f=f: f(t, spec), observe=observed.get(name, {}), key=KEYS.get(name, ()), judge=judged.get(name, Job.judge), measure=measured.get(name, Job.measure))
        for name, f in SILVER.items()
    ]


def check_silver(spec: Spec):
    """The contracts between the clean tables, for publish: shops of the domain, decisions, and joins that neither multiply nor lose rows."""

    def check(t: dict[str, DataFrame]) -> dict:
        _fails("shops", LC.code_violations({n: t[n] for n in SILVER if "shop_name" in t[n].columns}, spec.shops))
        violations, metrics = LC.cross_table(t["silver_weekly_prices"], t["silver_weekly_products"], t["silver_weekly_locations"], t["silver_nutritionals"])
        _fails("clean tables", violations)
        return metrics

    return check


def dim_date(t: dict[str, DataFrame], spec: Spec) -> DataFrame:
    return date_dimension([(t["silver_weekly_prices"], "week"), (t["silver_nutritionals"].where(F.col("country") == spec.market), "download_date")])


def dim_shop(t: dict[str, DataFrame], spec: Spec) -> DataFrame:
    rows = t["silver_weekly_prices"].select("shop", "shop_name").union(t["silver_nutritionals"].where(F.col("country") == spec.market).select("shop", "shop_name")).distinct()
    return Q.join_checked(surrogate_keys(rows, ["shop"], "shop_key"), rows, ["shop"], "1:1", "inner")


def dim_product(t: dict[str, DataFrame], spec: Spec) -> DataFrame:
    """Weekly products first, then those of the market's labels, then identities recovered and inferred for prices."""
    attributes = ["language", "name", "brand", "description"]
    market = F.col("country") == spec.market
    labelled = t["silver_nutritionals"].where(market).select(*IDENTITY).distinct()
    priced = t["silver_weekly_prices"].select("product_id", "shop").distinct()
    weekly = t["silver_weekly_products"].where(market)
    weekly = weekly.join(priced, ["product_id", "shop"], "left_semi").unionByName(weekly.join(labelled, IDENTITY, "left_semi")).distinct()
    reference = t["silver_products"].where(market).join(labelled, IDENTITY, "left_semi")
    described = enrich.describe(weekly.select(*IDENTITY).unionByName(reference.select(*IDENTITY)).unionByName(labelled).distinct(), weekly, reference, IDENTITY, attributes)
    rest = priced.join(described.select("product_id", "shop").distinct(), ["product_id", "shop"], "left_anti")
    others = t["silver_weekly_products"].select(*IDENTITY, *attributes).unionByName(t["silver_products"].select(*IDENTITY, *attributes))
    recovered = mart.recover(rest.withColumn("country", F.lit(spec.market)), others, ["product_id", "shop"], "country", attributes)
    inferred = mart.infer(rest.join(recovered, ["product_id", "shop"], "left_anti"), ["shop", "product_id"], "name", "Unmatched product (%s %s)").withColumn("country", F.lit(spec.market))
    dim = mart.entity_dimension("product_key", ["shop", "country", "product_id"], [(described.drop("descriptive_source"), "described"), (recovered, "recovered"), (inferred, "inferred")], attributes, {"name": "Unknown"})
    return mart.attach_decision(dim, t["silver_product_primary_categories"].select(*IDENTITY, "code", "status"), ["shop", "country", "product_id"], "product_key")


def dim_location(t: dict[str, DataFrame], spec: Spec) -> DataFrame:
    return mart.location_dimension(t["silver_weekly_locations"].drop("shop_name"), t["silver_weekly_prices"], ["shop", "location"], "location_key")


def dim_nutrient(t: dict[str, DataFrame], spec: Spec) -> DataFrame:
    rows = t["silver_nutritionals"].where(F.col("country") == spec.market).groupBy("nutrient_name").agg(C.only_value(F.col("nutrient_unit")).alias("standard_unit"))
    return Q.join_checked(surrogate_keys(rows, ["nutrient_name"], "nutrient_key"), rows, ["nutrient_name"], "1:1", "inner")


def _categories(t: dict[str, DataFrame], spec: Spec) -> tuple[DataFrame, DataFrame]:
    own = paths.categories(t["silver_product_category_paths"].where((F.col("source_dataset") == "silver_weekly_products") & (F.col("country") == spec.market)), [*IDENTITY, "language"])
    members = own.join(t["dim_product"].select("product_key", *IDENTITY), IDENTITY).drop("product_id")
    return mart.category_dimension(members.withColumn("category_path_normalized", F.col("category_path")), ["shop", "country", "category_path_text"], "category_key", "product_key")


def fact_weekly_prices(t: dict[str, DataFrame], spec: Spec) -> DataFrame:
    fact = facts.weekly_fact(t["silver_weekly_prices"], GRAIN)
    mapping = unique_match(t["dim_product"].where("product_key != -1"), ["product_id", "shop"], "product_key")
    fact = attach_key(fact, mapping, ["product_id", "shop"], "product_key")
    places = t["dim_location"].select("location_key", "shop", "location", "location_type")
    fact = fact.join(t["dim_shop"].select("shop_key", "shop"), "shop").join(places, ["shop", "location"]).join(t["dim_date"].select("date_key", F.col("date").alias("week")), "week")
    known = fact.where("product_key != -1")
    series = ["product_key", "location_key"]
    ratios = facts.lag_ratios(known, series, "week", 364, {"log_paid_yoy_ratio": "effective_price", "log_shelf_yoy_ratio": "regular_price"})
    ratios = facts.reference_ratio(ratios, ["product_key", "shop", "week"], "location_type", spec.national, "effective_price", "log_store_vs_national_ratio")
    grain = [*series, "week", "product_id"]
    extra = ratios.select(*grain, "log_paid_yoy_ratio", "log_shelf_yoy_ratio", "log_store_vs_national_ratio")
    return Q.join_checked(fact, extra, grain, "m:1").drop("location_type", "shop", "location", "week").withColumnRenamed("product_id", "source_product_id")


def fact_product_nutrition(t: dict[str, DataFrame], spec: Spec) -> DataFrame:
    rows = t["silver_nutritionals"].where(F.col("country") == spec.market).withColumn("date", F.col("download_date"))
    dims = {"product_key": (t["dim_product"], IDENTITY), "shop_key": (t["dim_shop"], ["shop"]), "date_key": (t["dim_date"], ["date"]), "nutrient_key": (t["dim_nutrient"], ["nutrient_name"])}
    out = mart.entry_fact(rows, dims, ["product_key", "nutrient_key"], "date", "portion_value", "portion_unit", "nutrient_value")
    return out.drop("shop", "country", "language", "date", "download_date", "shop_name", "nutrient_name", "nutrient_name_raw", "nutrient_value_raw", "nutrient_unit_raw").withColumnsRenamed({"product_id": "source_product_id", "basis": "nutrition_basis"})


GOLD = {
    "dim_date": dim_date, "dim_shop": dim_shop, "dim_product": dim_product, "dim_location": dim_location, "dim_nutrient": dim_nutrient,
    "dim_category": lambda t, s: _categories(t, s)[0], "bridge_product_category": lambda t, s: _categories(t, s)[1], "fact_weekly_prices": fact_weekly_prices, "fact_product_nutrition": fact_product_nutrition,
}


def gold_jobs(spec: Spec) -> list[Job]:
    return [Job(name, lambda t, f=f: f(t, spec)) for name, f in GOLD.items()]


def gold_violations(t: dict[str, DataFrame], market: str, location_types: Sequence[str] = (C.NATIONAL, C.STORE)) -> dict[str, dict[str, int]]:
    """Each contract of the mart and how often it is broken, over published tables."""
    dims = {"product_key": t["dim_product"], "shop_key": t["dim_shop"], "date_key": t["dim_date"]}
    prices, nutrition = t["fact_weekly_prices"], t["fact_product_nutrition"]
    used = lambda key: prices.select(key).unionByName(nutrition.select(key)).distinct()
    known = t["dim_product"].where("product_key != -1")
    of_shops = prices.groupBy("source_product_id").agg((F.min("shop_key") != F.max("shop_key")).alias("several"))
    return {
        "prices": MC.fact_violations(prices, ["product_key", "shop_key", "location_key", "date_key", "source_product_id"], dims | {"location_key": t["dim_location"]}),
        "nutrition": MC.fact_violations(nutrition, ["product_key", "date_key", "nutrient_key", "nutrition_basis"], dims | {"nutrient_key": t["dim_nutrient"]}),
        "bridge": MC.bridge_violations(t["bridge_product_category"], t["dim_product"], t["dim_category"], "product_key", "category_key"),
        "locations": MC.scope_violations(prices, t["dim_location"], "location_key", domain={"location_type": list(location_types)}),
        "latest": MC.latest_violations(nutrition, ["product_key", "nutrient_key"], "date_key"),
        "product": Q.dimension_violations(t["dim_product"], "product_key", ["shop", "country", "product_id"], -1).first().asDict(),
        "scope": {
            "products of another market": known.where(~F.col("country").eqNullSafe(F.lit(market))).count(), "ids in several shops": of_shops.where("several").count(),
            "products unused": known.join(used("product_key"), "product_key", "left_anti").count(), "shops unused": t["dim_shop"].join(used("shop_key"), "shop_key", "left_anti").count(),
            "nutrients unused": t["dim_nutrient"].join(nutrition, "nutrient_key", "left_anti").count(), "inferred products with evidence": known.where("is_inferred and category_status != 'missing_evidence'").count(),
            "locations without a type": t["dim_location"].where("location_type is null").count(),
        },
    }


def check_gold(t: dict[str, DataFrame], market: str = "be", location_types: Sequence[str] = (C.NATIONAL, C.STORE)) -> None:
    """The mart's contracts over its published tables."""
    MC.check_mart(**gold_violations(t, market, location_types))
