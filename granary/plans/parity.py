"""The figures that a rebuilt set is held to: named metrics of the clean tables and the star schema, and invariants that must be 0.

Metrics of one table are taken in one pass over it; what needs another grain says so.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.contracts import ContractError
from granary.operators.layer_contracts import repeats

Tables = dict[str, DataFrame]
IDENTITY = ("product_id", "shop", "country")


def _flag(name: str) -> Column:
    return F.count_if(F.col(name))




def _one_pass() -> dict[str, dict[str, Column]]:
    return {
        "silver_nutritionals": {"mass_exceeds_portion_rows": _flag("dq_mass_exceeds_portion"), "negative_value_rows": _flag("dq_negative_nutrient_value"), "energy_mismatch_rows": _flag("dq_energy_kcal_mismatch")},
        "silver_product_category_paths": {"duplicate_paths": _flag("dq_duplicate_category_path"), "repeated_label_paths": _flag("dq_repeated_category_label"), "prefix_paths": _flag("is_prefix_of_another_path"), "navigation_paths": _flag("dq_navigation_contamination")},
        "fact_weekly_prices": {
            "intraweek_variation_rows": _flag("has_intraweek_price_variation"), "effective_price_variation_rows": _flag("has_effective_price_variation"), "promotion_state_conflict_rows": _flag("promotion_state_conflict"),
            "usable_effective_price_rows": F.count("effective_price"), "calculable_discount_rows": F.count("discount_pct"), "unknown_product_rows": F.count_if(F.col("product_key") == -1),
        },
        "fact_product_nutrition": {
            "usable_value_rows": _flag("is_value_usable"), "unusable_value_rows": F.count_if(~F.col("is_value_usable")), "plausibility_flag_rows": _flag("dq_mass_exceeds_portion"),
            "negative_value_rows": _flag("dq_negative_nutrient_value"), "latest_observation_rows": _flag("is_latest_observation"), "energy_mismatch_rows": _flag("dq_energy_kcal_mismatch"),
        },
        "dim_product": {"inferred_members": _flag("is_inferred"), "unknown_member_unclassified": F.count_if((F.col("product_key") == -1) & (F.col("category_code") == "unclassified") & (F.col("category_status") == "unknown_product"))},
    }


#: Metric -> (table, key): distinct keys; the members of a dimension without Unknown.
DISTINCT = {
    "silver_products.distinct_products": ("silver_products", ("product_id",)),
    "silver_prices.distinct_source_grains": ("silver_prices", ("product_id", "shop", "location", "downloaded_on")),
    "silver_weekly_products.distinct_identities": ("silver_weekly_products", IDENTITY),
    "silver_weekly_locations.distinct_locations": ("silver_weekly_locations", ("shop", "location")),
    "dim_product.identified_natural_keys": ("dim_product", IDENTITY),
    "dim_category.natural_keys": ("dim_category", ("shop", "country", "category_path_text")),
    "dim_location.natural_keys": ("dim_location", ("shop", "location")),
    "dim_nutrient.natural_keys": ("dim_nutrient", ("nutrient_name",)),
    "bridge.products_with_category": ("bridge_product_category", ("product_key",)),
}


def period(fact: DataFrame, dates: DataFrame) -> tuple:
    """The first and last date of a fact; date keys are ordered like dates, so the dimension is asked for two rows only."""
    ends = fact.agg(F.min("date_key").alias("a"), F.max("date_key").alias("b"))
    found = dates.join(ends, F.col("date_key").isin(F.col("a"), F.col("b")), "left_semi").agg(F.min("date"), F.max("date")).first()
    return found[0], found[1]


def _periods(t: Tables) -> dict:
    prices, labels = period(t["fact_weekly_prices"], t["dim_date"]), period(t["fact_product_nutrition"], t["dim_date"])
    both = all(d is not None for d in (*prices, *labels))
    out = {
        "pricing.first_week": prices[0], "pricing.last_week": prices[1], "nutrition.first_observation": labels[0], "nutrition.last_observation": labels[1],
        "shared_period.start": max(prices[0], labels[0]) if both else None, "shared_period.end": min(prices[1], labels[1]) if both else None,
    }
    return {k: str(v) if v is not None else None for k, v in out.items()}


def _bridge(t: Tables) -> dict:
    per = t["bridge_product_category"].groupBy("product_key").count()
    row = per.agg(F.count_if(F.col("count") > 1).alias("products_with_multiple_categories"), F.max("count").alias("max_categories_per_product")).first()
    return {f"bridge.{k}": v for k, v in row.asDict().items()}


def _distinct(t: Tables, name: str) -> dict:
    table, key = DISTINCT[name]
    rows = t[table].where("product_key != -1") if table == "dim_product" else t[table]
    return {name: rows.select(*key).distinct().count()}


def _inferred_rows(t: Tables) -> dict:
    inferred = t["dim_product"].where("is_inferred").select("product_key")
    return {"fact_weekly_prices.inferred_product_rows": t["fact_weekly_prices"].join(inferred, "product_key", "left_semi").count()}


def _of_table(t: Tables, name: str, aggs: dict[str, Column]) -> dict:
    row = t[name].agg(*(c.alias(n) for n, c in aggs.items())).first()
    label = "silver_category_paths" if name == "silver_product_category_paths" else name
    return {f"{label}.{n}": row[n] for n in aggs}


def metrics(t: Tables) -> dict:
    """All 39 by name. An error of Spark's or of a contract is kept as text under what was asked, so that one does not hide the others; all else is raised."""
    parts = {name: (lambda name=name, aggs=aggs: _of_table(t, name, aggs)) for name, aggs in _one_pass().items()}
    parts |= {name: (lambda name=name: _distinct(t, name)) for name in DISTINCT}
    parts |= {"bridge": lambda: _bridge(t), "inferred rows": lambda: _inferred_rows(t), "periods": lambda: _periods(t)}
    out = {}
    for name, f in parts.items():
        try:
            out |= f()
        except (PySparkException, ContractError) as e:
            out[name] = f"error: {type(e).__name__}: {str(e)[:200]}"
    return out


def _orphans(fact: DataFrame, dims: dict[str, DataFrame]) -> int:
    """Rows with a key that some dimension lacks, by distinct key tuples joined to the dimensions, each row counted once."""
    rows, bad = fact.groupBy(*dims).count(), F.lit(False)
    for key, dim in dims.items():
        rows = rows.join(dim.select(key, F.lit(True).alias(f"_{key}")), key, "left")
        bad = bad | F.col(f"_{key}").isNull()
    return rows.where(bad).agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]


def _decisions_differ(t: Tables) -> int:
    own = t["dim_product"].where("product_key != -1 and not is_inferred").select(*IDENTITY, F.col("category_code").alias("_c"), F.col("category_status").alias("_s"))
    rows = own.join(t["silver_product_primary_categories"].select(*IDENTITY, "code", "status"), list(IDENTITY), "left")
    return rows.where("code is null or not (code <=> _c) or not (status <=> _s)").count()


#: All 16; each counts violations.
INVARIANTS: dict[str, Callable[[Tables], int]] = {
    **{f"{d}: {k} unique": (lambda t, d=d, k=k: repeats(t[d], [k])) for d, k in (("dim_date", "date_key"), ("dim_shop", "shop_key"), ("dim_product", "product_key"), ("dim_category", "category_key"), ("dim_location", "location_key"), ("dim_nutrient", "nutrient_key"))},
    "fact_weekly_prices: grain unique": lambda t: repeats(t["fact_weekly_prices"], ["source_product_id", "shop_key", "location_key", "date_key"]),
    "fact_product_nutrition: grain unique": lambda t: repeats(t["fact_product_nutrition"], ["product_key", "shop_key", "date_key", "nutrient_key", "nutrition_basis"]),
    "fact_weekly_prices: orphan foreign keys": lambda t: _orphans(t["fact_weekly_prices"], {"product_key": t["dim_product"], "shop_key": t["dim_shop"], "location_key": t["dim_location"], "date_key": t["dim_date"]}),
    "fact_product_nutrition: orphan foreign keys": lambda t: _orphans(t["fact_product_nutrition"], {"product_key": t["dim_product"], "shop_key": t["dim_shop"], "date_key": t["dim_date"], "nutrient_key": t["dim_nutrient"]}),
    "bridge: duplicate memberships": lambda t: repeats(t["bridge_product_category"], ["product_key", "category_key"]),
    "bridge: orphan product keys": lambda t: _orphans(t["bridge_product_category"], {"product_key": t["dim_product"]}),
    "bridge: orphan category keys": lambda t: _orphans(t["bridge_product_category"], {"category_key": t["dim_category"]}),
    "bridge: unused categories": lambda t: t["dim_category"].join(t["bridge_product_category"], "category_key", "left_anti").count(),
    "bridge: Unknown Product memberships": lambda t: t["bridge_product_category"].where("product_key = -1").count(),
    "dim_product: decision differs from the clean table": _decisions_differ,
}
