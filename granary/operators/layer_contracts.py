"""Contracts of the clean tables: counts of violations, 0 in a sound layer, and metrics; all read from the written tables.

Each function takes one pass over a table, or a join that its keys make safe. Names of columns are parameters where a
table of another case may call them otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.columns import finite, flag
from granary.operators.decisions import BY_NAME, STATUSES


def _one(df: DataFrame, aggs: Mapping[str, Column]) -> dict:
    row = df.agg(*(c.alias(n) for n, c in aggs.items())).first().asDict()
    return {k: v if v is not None else 0 for k, v in row.items()}


def _null(columns: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | F.col(c).isNull()
    return out


def _sound(c: Column) -> Column:
    return c.isNotNull() & finite(c)


def repeats(df: DataFrame, key: Sequence[str]) -> int:
    """Rows beyond the first of each key; nulls are values."""
    return df.groupBy(*key).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0))).first()[0]


def price_figures(grain: Sequence[str], price: str = "price", promo: str = "price_promo") -> dict[str, Column]:
    """Aggregates over single rows of price versions: they can be observed while the table is written, or summed up by key."""
    many = F.col("has_multiple_price_versions")
    a, b = F.col(price), F.col(promo)
    return {
        "incomplete": F.count_if(_null([*grain, price, promo])), "not_finite": F.count_if((a.isNotNull() & ~finite(a)) | (b.isNotNull() & ~finite(b))),
        "price_not_positive": F.count_if("dq_non_positive_price"), "promo_not_positive": F.count_if("dq_non_positive_promo_price"),
        "version_flag_wrong": F.count_if(~many.eqNullSafe(F.col("price_version_count") > 1)), "multiple_version_rows": F.count_if(many),
        "promotion_rows": F.count_if("is_promotion"), "promo_above_price_rows": F.count_if("dq_promo_above_price"),
        "multiple_version_grains": F.sum(F.when(many, 1 / F.col("price_version_count"))),  # a fraction for each row, to be rounded
    }


def price_metrics(df: DataFrame, grain: Sequence[str], price: str = "price", promo: str = "price_promo", key: str = "price_observation_id") -> DataFrame:
    """One row: what price_violations and a report ask of a written table of price versions."""
    figures = price_figures(grain, price, promo)
    per = df.groupBy(key).agg(F.count("*").alias("_n"), *(c.alias(n) for n, c in figures.items()))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per.agg(
        zero(F.col("_n")).alias("rows"), zero(F.col("_n") - 1).alias("repeated_ids"), *(zero(n).alias(n) for n in figures if n != "multiple_version_grains"),
        F.round(zero("multiple_version_grains")).cast("long").alias("multiple_version_grains"),
    )


def price_violations(df: DataFrame, metrics: Mapping, grain: Sequence[str], price: str = "price", promo: str = "price_promo") -> dict[str, int]:
    names = ("incomplete", "not_finite", "repeated_ids", "price_not_positive", "promo_not_positive", "version_flag_wrong")
    return {"empty": int(not metrics["rows"]), **{n: metrics[n] for n in names}, "exact_duplicates": repeats(df, [*grain, price, promo])}


def enrichment_figures(identity: Sequence[str], attributes: Sequence[str]) -> dict[str, Column]:
    """Parts of an identity that are missing, and rows filled where the context differs."""
    filled = F.lit(False)
    for a in attributes:
        filled = filled | F.col(f"is_{a}_enriched")
    return {**{f"{c}_missing": F.count_if(F.col(c).isNull()) for c in identity}, "unsafe_enrichment": F.count_if(F.col("dq_enrichment_context_mismatch") & filled)}


def enrichment_violations(df: DataFrame, source_rows: int, identity: Sequence[str], attributes: Sequence[str], key: Sequence[str]) -> dict[str, int]:
    """An enriched table has the rows of its source, whole identities, unique keys, and filled nothing where the context differs."""
    out = _one(df, {"rows": F.count("*"), **enrichment_figures(identity, attributes)})
    return {"rows_changed": abs(out.pop("rows") - source_rows), **out, "repeated_keys": repeats(df, key)}


#: Columns of a path that say where it comes from.
LINEAGE = ("source_dataset", "shop", "country", "language", "category_source_dataset", "source_categories_sha256", "normalization_rule", "path_review_status")


def path_figures(key: Sequence[str], lineage: Sequence[str] = LINEAGE) -> dict[str, Column]:
    return {"depth_wrong": F.count_if(F.col("category_path_depth") != F.size("category_path")), "lineage_missing": F.count_if(_null([*lineage, *key]))}


def path_violations(paths: DataFrame, expected: int, key: Sequence[str], lineage: Sequence[str] = LINEAGE) -> dict[str, int]:
    """All paths of the parents are there once, as deep as they say, with their lineage."""
    out = _one(paths, {"rows": F.count("*"), **path_figures(key, lineage)})
    return {"unaccounted": abs(out.pop("rows") - expected), **out, "repeated_occurrences": repeats(paths, key)}


def decision_figures(identity: Sequence[str], names: Mapping[str, str], version: str | None = None, statuses: Sequence[str] = STATUSES) -> dict[str, Column]:
    """Codes and names of the domain, known statuses, one version, and decisions that their evidence bears."""
    code, status, found, ids = F.col("code"), F.col("status"), F.col("candidates"), F.col("matched_rule_ids")
    classified = status == "classified"
    by_name = F.array_contains("evidence_source_datasets", "product_name")
    named = F.lit(None).cast("string")
    for k, v in names.items():
        named = F.when(code == k, v).otherwise(named)
    unborne = classified & (
        (F.size(ids) == 0) | ~F.array_contains(found, code) | ((F.size("evidence_path_references") == 0) & ~by_name) | ((F.size(found) > 1) & ~F.array_contains(ids, BY_NAME))
    )
    aggs = {
        "incomplete": F.count_if(_null([*identity, "code", "status", "category_name"])), "code_unknown": F.count_if(~code.isin(*names)), "name_wrong": F.count_if(~F.col("category_name").eqNullSafe(named)),
        "status_unknown": F.count_if(~status.isin(*statuses)), "status_and_code_disagree": F.count_if(classified != (code != "unclassified")), "evidence_missing": F.count_if(unborne),
        "conflict_of_one": F.count_if((status == "conflicting_evidence") & (F.size(found) < 2)),
    }
    if version is not None:
        aggs["version_stale"] = F.count_if(~F.col("mapping_version").eqNullSafe(version))
    return aggs


def decision_violations(df: DataFrame, identity: Sequence[str], names: Mapping[str, str], version: str | None = None, statuses: Sequence[str] = STATUSES) -> dict[str, int]:
    """Counts of decision_figures, and of identities that stand twice."""
    return {"repeated_identities": repeats(df, identity), **_one(df, decision_figures(identity, names, version, statuses))}


def label_metrics(df: DataFrame, observation: Sequence[str], product: str = "product_id") -> dict:
    """label_counts, and the distinct names of entries."""
    return label_counts(df, observation, product) | {"distinct_nutrients": df.select("nutrient_name").distinct().count()}


def label_figures(units: Sequence[tuple]) -> dict[str, Column]:
    """Entries in units that the mapping doesn't give, and how many of the mapping's names occur; over single rows."""
    known = F.struct("nutrient_name", "nutrient_unit").isin([F.struct(F.lit(e).alias("nutrient_name"), F.lit(u).alias("nutrient_unit")) for e, u in sorted({(x[0], x[2]) for x in units})])
    there = F.lit(0)
    for name in sorted({x[0] for x in units}):
        there = there + F.coalesce(F.max((F.col("nutrient_name") == name).cast("int")), F.lit(0))
    return {"units_wrong": F.count_if(~flag(known)), "distinct_nutrients": there}


def label_counts(df: DataFrame, observation: Sequence[str], product: str = "product_id", entries: str | None = None) -> dict:
    """Counters of the written label entries, in one pass over observations of few entries each; a product is part of its observation.

    entries: a column with the number of a label's entries; `entries_of_labels` is their sum over observations.
    """
    value, raw, factor = F.col("nutrient_value"), F.col("nutrient_value_raw").try_cast("double"), F.col("unit_conversion_factor")
    odd = F.col("dq_incompatible_nutrient_unit")
    wrong = (odd & (value.isNotNull() | factor.isNotNull())) | (~odd & (value.isNull() | factor.isNull() | ~flag(finite(factor)) | flag(factor <= 0) | ~value.eqNullSafe(raw * factor)))
    energy, mismatch = F.col("energy_pair_difference_kj").isNotNull(), F.col("dq_energy_kcal_mismatch")
    rows = {
        "rows": F.count("*"), "missing_numeric_values": F.count_if(value.isNull()), "non_numeric_values": F.count_if("dq_non_numeric_value"), "missing_units": F.count_if(F.col("nutrient_unit").isNull()),
        "unconvertible_unit_rows": F.count_if(odd), "identity_unit_rows": F.count_if(F.col("unit_standardization_status") == "identity"), "converted_unit_rows": F.count_if(F.col("unit_standardization_status") == "converted"),
        "canonical_numeric_rows": F.count(value), "mass_exceeds_portion_rows": F.count_if("dq_mass_exceeds_portion"), "negative_nutrient_rows": F.count_if(value < 0), "negative_source_nutrient_rows": F.count_if("dq_negative_nutrient_value"),
        "energy_mismatch_nutrient_rows": F.count_if(mismatch), "invalid_quality_flags": F.count_if(~F.col("dq_negative_nutrient_value").eqNullSafe(raw < 0) | (mismatch & ~energy)),
        "missing_lineage_rows": F.count_if(_null(["nutrient_name_raw", "nutrient_value_raw", "nutrient_unit_raw", "source_payload_hash"])), "invalid_conversion_rows": F.count_if(wrong),
        "rows_from_resolved_conflicts": F.count_if("dq_conflicting_nutrition"), "non_finite_values": F.count_if(value.isNotNull() & ~finite(value)),
        "missing_nutrient_names": F.count_if(F.col("nutrient_name").isNull() | (F.trim("nutrient_name") == "")),
    }
    # Entries of an observation are few: its distinct names come from a set, and observations are counted as rows.
    per = df.groupBy(*observation).agg(
        *(c.alias(n) for n, c in rows.items()), F.size(F.collect_set("nutrient_name")).alias("_names"), F.max(energy).alias("_energy"), F.max(mismatch).alias("_mismatch"), F.max("dq_mass_exceeds_portion").alias("_mass"),
        F.max(F.col(entries) if entries else F.lit(0)).alias("_entries"),
    )
    summed = {n: F.sum(n) for n in rows} | {
        "duplicate_grains": F.sum(F.col("rows") - F.col("missing_nutrient_names") - F.col("_names")), "written_observations": F.count("*"), "entries_of_labels": F.sum("_entries"),
        "comparable_energy_observations": F.count_if("_energy"), "energy_mismatch_observations": F.count_if("_mismatch"),
    }
    # Observations of a product meet next, so that products are counted in the same pass.
    products = per.groupBy(product).agg(*(c.alias(n) for n, c in summed.items()), F.max("_mass").alias("_mass"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return _one(products, {**{n: zero(n) for n in summed}, "distinct_products": F.count("*"), "mass_exceeds_portion_products": F.count_if("_mass")})


def label_violations(df: DataFrame, metrics: Mapping, units: Sequence[tuple], expected_rows: int, expected_observations: int) -> dict[str, int]:
    """units: entries of labels.MAPPING. The expected figures come from the labels that were chosen."""
    wrong = metrics["units_wrong"] if "units_wrong" in metrics else df.agg(label_figures(units)["units_wrong"]).first()[0]
    return {
        "rows_not_reconciled": abs(metrics["rows"] - expected_rows), "observations_not_reconciled": abs(metrics["written_observations"] - expected_observations),
        "repeated_grain": metrics["duplicate_grains"], "quality_flags_wrong": metrics["invalid_quality_flags"], "not_finite": metrics["non_finite_values"], "names_missing": metrics["missing_nutrient_names"],
        "units_wrong": wrong, "lineage_missing": metrics["missing_lineage_rows"], "conversion_wrong": metrics["invalid_conversion_rows"],
        "unknown_beyond_incompatible": abs(metrics["missing_numeric_values"] - metrics["unconvertible_unit_rows"]),
    }


def relationship(left: DataFrame, right: DataFrame, key: Sequence[str], context: Sequence[str] = ()) -> dict:
    """A left join by key: rows before and after, matched, unmatched, and matched in another context; from counts by key alone.

    Both sides are reduced to keys and contexts before they meet, so that no large side is multiplied.
    """
    a = left.groupBy(*key, *context).agg(F.count("*").alias("_a"))
    renamed = {c: f"_r_{c}" for c in context}
    b = right.groupBy(*key, *context).agg(F.count("*").alias("_b")).withColumnsRenamed(renamed)
    rows = a.join(b, list(key), "left")
    differs = F.lit(False)
    for c, r in renamed.items():
        differs = differs | ~F.col(c).eqNullSafe(F.col(r))
    there, weight = F.col("_b").isNotNull(), F.col("_a") * F.coalesce("_b", F.lit(1))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    out = _one(rows, {"joined_rows": zero(weight), "matched_rows": zero(F.when(there, weight)), "unmatched_rows": zero(F.when(~there, weight)), "context_mismatches": zero(F.when(there & differs, weight))})
    return {"rows": _one(a, {"n": zero(F.col("_a"))})["n"], **out}


def cross_table(prices: DataFrame, products: DataFrame, locations: DataFrame, labels: DataFrame, product: str = "product_id", shop: str = "shop", location: str = "location", country: str = "country") -> tuple[dict[str, int], dict]:
    """Violations and metrics between the clean tables: prices need their locations and one context each, products may lack a description."""
    to_products = relationship(prices, products, [product], [shop])
    to_locations = relationship(prices, locations, [shop, location])
    observed = labels.select(product, shop, country).distinct()
    to_labels = relationship(observed, products.select(product, shop, country), [product], [shop, country])
    matched = observed.join(products.select(product), product, "left_semi").select(product).distinct().count()
    violations = {
        "no prices": int(not to_products["rows"]), "products multiply prices": to_products["joined_rows"] - to_products["rows"], "product of another shop": to_products["context_mismatches"],
        "locations multiply prices": to_locations["joined_rows"] - to_locations["rows"], "locations missing": to_locations["unmatched_rows"], "labels of another context": to_labels["context_mismatches"],
    }
    coverage = round(100.0 * to_products["matched_rows"] / to_products["joined_rows"], 2) if to_products["joined_rows"] else None
    metrics = {
        "weekly_price_rows": to_products["rows"], "weekly_product_joined_rows": to_products["joined_rows"], "weekly_product_matched_rows": to_products["matched_rows"], "weekly_product_unmatched_rows": to_products["unmatched_rows"],
        "weekly_product_context_mismatches": to_products["context_mismatches"], "weekly_product_coverage_pct": coverage, "weekly_location_joined_rows": to_locations["joined_rows"],
        "weekly_location_unmatched_rows": to_locations["unmatched_rows"], "nutrition_product_context_mismatches": to_labels["context_mismatches"], "matched_nutritional_products": matched,
    }
    return violations, metrics


def code_violations(tables: Mapping[str, DataFrame], shops: Mapping[str, str], code: str = "shop", name: str = "shop_name") -> dict[str, int]:
    """Rows of each table whose shop is unknown, or whose name is not that of its shop."""
    known = F.lit(None).cast("string")
    for k, v in shops.items():
        known = F.when(F.col(code) == k, v).otherwise(known)
    return {t: df.groupBy(code, name).count().where(~flag(F.col(name) == known)).agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0] for t, df in tables.items()}
