import math
from datetime import date

import pytest

from granary.operators.contracts import ContractError
from granary.operators.decisions import PathRules
from granary.plans import retail as R
from granary.plans.publish import current, load, publish

SPEC = R.Spec(
    shops={"alpha": "Alpha", "beta": "Beta"}, encoded=["ahpla"], shop_types=["super", "hyper"], reversed_types=["repus"],
    units=[("fat", "g", "g", 1.0, "identity"), ("salt", "mg", "g", 0.001, "converted"), ("energy_kj", "kJ", "kJ", 1.0, "identity"), ("energy_kcal", "kcal", "kcal", 1.0, "identity")],
    anchors=[("dairy", "dairy"), ("bread", "bakery")], names=[("milk", "dairy")], category_names={"dairy": "Dairy", "bakery": "Bakery"},
    rules=PathRules(language="nl"),
)
LABEL = '{"nutrients":{"fat":{"value":3.5,"unit":"g"},"salt":{"value":"100","unit":"mg"},"energy_kj":{"value":418.4,"unit":"kJ"},"energy_kcal":{"value":100,"unit":"kcal"}},"portion":{"value":100,"unit":"ml"}}'
P = "product_id string, shop string, name string, brand string, country string, description string, categories string, language string"


@pytest.fixture
def raw(spark):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "products": df([("1", "ahpla", "Milk", "nan", "be", "x", '[["food"],["food","dairy"]]', "nl"), ("3", "beta", "Rolls", None, "nl", None, None, "nl")], P),
        "weekly_prices_products": df([("1", "alpha", None, "geen", "be", "fresh", None, "nl"), ("2", "alpha", "Milk drink", None, "be", None, None, "nl")], P),
        "locations": df([("alpha", "s1", "be", None, "1000", 50.8, 4.3, "w")], "shop string, id string, country_code string, type string, postcode string, geolocation_latitude double, geolocation_longitude double, sources string"),
        "weekly_prices_locations": df([("alpha", "s1", None, " REPUS", None, None, None, None, None), ("alpha", "nat", "Default", None, None, None, None, None, None), ("beta", "x", None, None, None, None, None, None, None)], "shop string, location string, location_name string, shop_type string, postcode string, locality string, state string, geolocation_latitude double, geolocation_longitude double"),
        "prices": df([("1", "alpha", "be", "s1", 2.0, None, date(2020, 12, 1), "kg", "EUR")], "product_id string, shop string, country string, location string, price double, promo_price double, downloaded_on date, unit_std string, currency string"),
        "weekly_prices": df([("1", "alpha", "s1", date(2020, 1, 6), 2.0, 2.0), ("1", "alpha", "s1", date(2021, 1, 4), 3.0, 2.5), ("1", "alpha", "nat", date(2021, 1, 4), 2.5, 2.5), ("9", "alpha", "s1", date(2021, 1, 4), 1.0, 1.0), ("3", "beta", "x", date(2021, 1, 4), 1.0, 1.0)], "product_id string, shop string, location string, week date, price double, price_promo double"),
        "nutritionals": df([("1", "alpha", "be", "nl", date(2020, 12, 1), LABEL), ("1", "alpha", "be", "nl", date(2020, 12, 1), LABEL), ("1", "alpha", "be", "fr", date(2020, 12, 1), '{"nutrients":{"fat":{"value":"1","unit":"g"}},"portion":{"value":100,"unit":"g"}}')], "product_id string, shop string, country string, language string, download_date date, nutritional_values_std string"),
    }


def rows(df, *by):
    return [r.asDict() for r in df.orderBy(*by).collect()]


def test_snapshot(spark, raw, tmp_path):
    paths = {}
    for name, df in raw.items():
        df.write.parquet(f"{tmp_path}/raw/{name}")
        paths[name] = f"{tmp_path}/raw/{name}"
    publish(spark, f"{tmp_path}/silver", paths, R.silver_jobs(SPEC))
    silver = load(spark, f"{tmp_path}/silver")
    assert rows(silver["silver_products"], "product_id")[0] | {} == {"product_id": "1", "shop": "alpha", "name": "Milk", "brand": "nan", "country": "be", "description": None, "categories": '[["food"],["food","dairy"]]', "language": "nl", "shop_name": "Alpha"}
    one = rows(silver["silver_weekly_products"], "product_id")[0]
    assert (one["name"], one["is_name_enriched"], one["brand"], one["is_brand_enriched"], one["description"], one["categories"]) == ("Milk", True, "nan", True, "fresh", '[["food"],["food","dairy"]]')
    store = rows(silver["silver_weekly_locations"], "location")[1]
    assert (store["shop_type"], store["is_shop_type_reversed"], store["postcode"], store["region"], store["is_coordinates_enriched"], store["location_type"], store["country_code"]) == ("super", True, "1000", "Brussels", True, "Store", "be")
    label = {r["nutrient_name"]: r for r in rows(silver["silver_nutritionals"], "nutrient_name")}
    assert label["salt"]["nutrient_value"] == pytest.approx(0.1) and label["fat"]["nutrition_selection_reason"] == "completeness_first"
    assert label["fat"]["dq_source_exact_duplicate"] and label["fat"]["dq_language_conflict"] and not label["fat"]["dq_energy_kcal_mismatch"]
    found = {(r["product_id"], r["shop"]): (r["code"], r["status"], r["basis"]) for r in rows(silver["silver_product_primary_categories"], "product_id")}
    assert found == {("1", "alpha"): ("dairy", "classified", "paths"), ("2", "alpha"): ("dairy", "classified", "name"), ("3", "beta"): ("unclassified", "missing_evidence", None)}

    paths = current(spark, f"{tmp_path}/silver").paths()
    inputs = {n: paths[n] for n in R.SILVER}
    publish(spark, f"{tmp_path}/gold", inputs, R.gold_jobs(SPEC), cross_check=R.check_gold)
    gold = load(spark, f"{tmp_path}/gold")
    products = {r["product_id"]: r for r in rows(gold["dim_product"], "product_key")}
    assert {k: r["descriptive_source"] for k, r in products.items()} == {None: "unknown", "1": "described", "3": "recovered", "9": "inferred"}
    assert products["9"]["name"] == "Unmatched product (alpha 9)" and products["9"]["category_status"] == "missing_evidence" and products["1"]["category_code"] == "dairy"
    assert R.check_silver(SPEC)(silver)["weekly_location_unmatched_rows"] == 0
    fact = gold["fact_weekly_prices"].join(gold["dim_location"].select("location_key", "location"), "location_key")
    got = {(r["source_product_id"], r["location"], r["date_key"]): r for r in rows(fact, "date_key")}
    assert set(got) == {("1", "s1", 20200106), ("1", "s1", 20210104), ("1", "nat", 20210104), ("9", "s1", 20210104), ("3", "x", 20210104)}
    later = got["1", "s1", 20210104]
    assert later["log_shelf_yoy_ratio"] == pytest.approx(math.log(1.5)) and later["log_paid_yoy_ratio"] == pytest.approx(math.log(1.25)) and later["log_store_vs_national_ratio"] == pytest.approx(0.0)
    assert later["discount_pct"] == pytest.approx(1 / 6)
    assert {r["nutrition_basis"] for r in rows(gold["fact_product_nutrition"], "nutrient_key")} == {"per_100ml"}
    assert rows(gold["dim_category"], "category_key")[0]["category_path_text"] == "food > dairy" and gold["bridge_product_category"].count() == 1
    assert gold["dim_date"].count() == 366 + 365


@pytest.mark.parametrize(("table", "column", "value", "message"), [("products", "shop", "gamma", "unknown code"), ("weekly_prices_locations", "shop_type", "kiosk", "unknown shop type"), ("nutritionals", "nutritional_values_std", "{", "invalid_json"), ("nutritionals", "nutritional_values_std", '{"nutrients":{"odd":{"value":"1","unit":"g"}},"portion":{"value":100,"unit":"g"}}', "unmapped entry: odd g"), ("nutritionals", "nutritional_values_std", '{"nutrients":{"fat":{"value":"1","unit":"g"}}}', "no positive portion"), ("nutritionals", "nutritional_values_std", '{"nutrients":{"fat":{"value":"1","unit":"g"}},"portion":{"value":0,"unit":"g"}}', "no positive portion"), ("nutritionals", "nutritional_values_std", '{"nutrients":{"fat":{"value":"1","unit":"g"}},"portion":{"value":1,"unit":" "}}', "no positive portion"), ("nutritionals", "nutritional_values_std", '{"nutrients":{"fat":{"value":"much","unit":"g"}},"portion":{"value":1,"unit":"g"}}', "no finite number"), ("locations", "geolocation_latitude", float("nan"), "not finite"), ("weekly_prices_locations", "geolocation_longitude", float("inf"), "not finite"), ("locations", "type", "t", "no longer empty")])
def test_drift_fails(spark, raw, table, column, value, message):
    from pyspark.sql import functions as F

    tables = raw | {table: raw[table].withColumn(column, F.lit(value))}
    tables["silver_locations"] = R.locations(tables, SPEC)
    build = {"products": R.products, "weekly_prices_locations": R.weekly_locations, "nutritionals": R.nutritionals, "locations": R.locations}[table]
    with pytest.raises(Exception, match=message):
        build(tables, SPEC).collect()


def test_schema_drift_fails(spark, raw):
    with pytest.raises(ContractError, match="unexpected"):
        R.products(raw | {"products": raw["products"].selectExpr("*", "1 as extra")}, SPEC)
    with pytest.raises(ContractError, match="date"):
        R.weekly_prices(raw | {"weekly_prices": raw["weekly_prices"].selectExpr("product_id", "shop", "location", "cast(week as timestamp) week", "price", "price_promo")}, SPEC)


def test_a_bad_label_that_is_not_taken_fails_too(spark, raw):
    """The canonical label is sound; another version of the same day has an unknown unit."""
    bad = [("1", "alpha", "be", "fr", date(2020, 12, 1), '{"nutrients":{"fat":{"value":"1","unit":"stone"}},"portion":{"value":100,"unit":"g"}}')]
    tables = raw | {"nutritionals": raw["nutritionals"].unionAll(spark.createDataFrame(bad, raw["nutritionals"].schema))}
    with pytest.raises(Exception, match="unmapped entry: fat stone"):
        R.nutritionals(tables, SPEC).collect()


def test_names_are_read_in_the_language_of_the_rules(spark, raw):
    tables = raw | {"weekly_prices_products": raw["weekly_prices_products"].unionAll(spark.createDataFrame([("4", "alpha", "milk", None, "be", None, None, "fr"), ("5", "alpha", "bread", None, "be", None, '[["Dairy"],["x","  DAIRY "]]', "nl"), ("6", "alpha", "milk", None, "be", None, '[["Dairy"],["Bread"]]', "nl")], P))}
    for name in ("silver_products", "silver_locations", "silver_nutritionals", "silver_weekly_products", "silver_product_category_paths"):
        tables[name] = R.SILVER[name](tables, SPEC)
    got = {r["product_id"]: r for r in R.primary_categories(tables, SPEC).collect()}
    assert (got["4"]["code"], got["4"]["status"]) == ("unclassified", "missing_evidence")
    assert (got["5"]["code"], got["5"]["evidence_path_references"]) == ("dairy", ["silver_weekly_products:1", "silver_weekly_products:2"])
    assert got["5"]["matched_rule_ids"][0].startswith("label_") and len(got["5"]["matched_rule_ids"]) == 1
    assert (got["6"]["code"], got["6"]["basis"]) == ("dairy", "name_breaks_path_conflict") and {"name:milk", "name_breaks_path_conflict"} <= set(got["6"]["matched_rule_ids"])
    assert got["6"]["evidence_source_datasets"] == ["product_name", "silver_weekly_products"]


def test_reviewed_products_are_held_back_until_their_paths_change(spark, raw):
    from dataclasses import replace
    from hashlib import sha256

    tables = dict(raw)
    for name in ("silver_products", "silver_locations", "silver_nutritionals", "silver_weekly_products", "silver_product_category_paths"):
        tables[name] = R.SILVER[name](tables, SPEC)
    payload = sha256(b'[["food"],["food","dairy"]]').hexdigest()
    got = {r["product_id"]: r for r in R.primary_categories(tables, replace(SPEC, reviewed=[("1", "alpha", "be", [payload])])).collect()}
    assert (got["1"]["code"], got["1"]["status"], got["1"]["category_name"]) == ("unclassified", "review_required", "Unclassified") and got["1"]["matched_rule_ids"][-1] == "reviewed_source_contradiction"
    with pytest.raises(Exception, match="reviewed evidence has changed"):
        R.primary_categories(tables, replace(SPEC, reviewed=[("1", "alpha", "be", ["0" * 64])])).collect()


def test_commands(spark, raw, tmp_path, monkeypatch, capsys):
    """From a snapshot to the baseline; a step that fails stops those after it."""
    import json
    import subprocess
    from types import SimpleNamespace

    from granary.plans import cli
    from granary.sources.extract import snapshot

    at = {n: f"{tmp_path}/{n}" for n in ("raw", "silver", "gold")}
    spec = {
        "shops": SPEC.shops, "encoded": SPEC.encoded, "shop_types": SPEC.shop_types, "reversed_types": SPEC.reversed_types, "units": SPEC.units, "anchors": SPEC.anchors, "names": SPEC.names,
        "category_names": SPEC.category_names, "rules": {"language": "nl", "withheld": [{"labels": ["none"]}]},
    }
    (tmp_path / "spec.json").write_text(json.dumps(spec))
    whole = raw | {"weekly_prices": raw["weekly_prices"].where("shop = 'alpha'")}
    base = ["--raw", at["raw"], "--silver", at["silver"], "--gold", at["gold"], "--spec", f"{tmp_path}/spec.json", "--baseline", f"{tmp_path}/base.json"]
    monkeypatch.setattr(subprocess, "run", lambda command, **_: SimpleNamespace(returncode=cli.main(command[3:])))
    assert cli.main(["all", *base]) == 1 and "raw failed" in capsys.readouterr().err
    snapshot(spark, at["raw"], {n: (lambda df=df: df) for n, df in whole.items()})
    assert cli.main(["all", *base, "--update-baseline"]) == 0
    said = json.loads((tmp_path / "base.json").read_text())
    assert len(said["metrics"]) == 39 and len(said["invariants"]) == 16 and not any(said["invariants"].values())
    assert said["metrics"]["pricing.first_week"] == "2020-01-06" and said["metrics"]["shared_period.start"] == "2020-12-01" and said["metrics"]["dim_product.unknown_member_unclassified"] == 1
    assert said["metrics"]["silver_category_paths.prefix_paths"] == 2 and said["metrics"]["fact_weekly_prices.inferred_product_rows"] == 1
    assert cli.main(["all", *base]) == 0
    manifest = current(spark, at["silver"]).manifest
    assert manifest["metrics"]["weekly_price_rows"] == 4 and manifest["metrics"]["weekly_product_unmatched_rows"] == 1
    assert manifest["tables"]["silver_nutritionals"]["metrics"]["written_observations"] == 1
    broken = raw | {"weekly_prices": raw["weekly_prices"].selectExpr("product_id", "shop", "'nowhere' location", "week", "price", "price_promo")}
    snapshot(spark, at["raw"], {n: (lambda df=df: df) for n, df in broken.items()}, replace=True)
    assert cli.main(["all", *base]) == 1 and "locations missing" in capsys.readouterr().err
    assert cli.main(["parity", "--silver", at["silver"], "--gold", at["gold"], "--baseline", f"{tmp_path}/base.json"]) == 0  # what was published before stays
    with pytest.raises(SystemExit):
        cli.main(["gold", "--silver", "x"])
