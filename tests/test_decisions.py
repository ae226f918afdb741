import pytest
from pyspark.sql import functions as F

from granary.operators import decisions as D
from granary.operators import layer_contracts as LC
from granary.operators import paths
from granary.plans.reporting_groups import DUTCH, GROUPS, NAVIGATION

ANCHORS = [
    ("Honden", "pet_care"), ("Vlees", "meat_poultry_seafood"), ("Baby", "baby_care"), ("Verzorging", "personal_care"), ("Diepvries", "frozen"), ("Groente", "fresh_produce"), ("Vegan", "plant_based_alternatives"),
    ("Zuivel", "dairy_eggs"), ("Bakkerij", "bakery"), ("Papier", "household_supplies"), ("Schoonmaak", "household_care"), ("Snacks", "confectionery_snacks"), ("Conserven", "pantry_cooking"), ("Granen", "breakfast_cereals"),
    ("Bier", "alcoholic_beverages"), ("Frisdrank", "non_alcoholic_beverages"), ("Straße", "bakery"), ("Make-up", "beauty_cosmetics"), ("Gezondheid", "health_wellness"),
]
CASES = [
    # path, language, shop, codes, rule that is added, reason
    (["Vlees"], "nl", "x", ["meat_poultry_seafood"], None, "matched"),
    (["  VLEES "], "nl", "x", ["meat_poultry_seafood"], None, "matched"),
    (["STRASSE"], "nl", "x", ["bakery"], None, "matched"),
    (["Vlees"], "fr", "x", [], None, "unsupported_language"),
    (["Vlees"], None, "x", [], None, "unsupported_language"),
    (["Onbekend"], "nl", "x", [], None, "no_match"),
    (["Promoties", "Vlees"], "nl", "x", [], None, "excluded"),
    (["1 + 1 gratis", "Vlees"], "nl", "x", [], None, "excluded"),
    (["Actief", "Vlees"], "nl", "x", ["meat_poultry_seafood"], None, "matched"),
    (["Afslankingsproducten", "Vlees"], "nl", "x", [], None, "excluded"),
    (["Koffieverrijkers", "Zuivel"], "nl", "ah", [], None, "excluded"),
    (["Frisdrank, sappen, koffie, thee", "Koffie", "Koffieverrijkers", "Zoetstof"], "nl", "ah", ["pantry_cooking"], "ah_coffee_sweetener_v1", "matched"),
    (["Frisdrank, sappen, koffie, thee", "Koffie", "Koffieverrijkers", "Zoetstof"], "nl", "dll", [], None, "excluded"),
    (["Honden", "Vlees"], "nl", "x", ["pet_care"], "pet_use_over_ingredient", "matched"),
    (["Honden", "Verzorging"], "nl", "x", ["personal_care", "pet_care"], None, "matched"),
    (["Baby", "Verzorging", "Zuivel"], "nl", "x", ["baby_care"], "baby_use_over_ingredient", "matched"),
    (["Diepvries", "Groente"], "nl", "x", ["frozen"], "explicit_frozen_food", "matched"),
    (["Diepvries", "Vegan"], "nl", "x", ["frozen"], "explicit_frozen_food", "matched"),
    (["Vegan", "Vlees"], "nl", "x", ["plant_based_alternatives"], "explicit_plant_alternative", "matched"),
    (["Papier", "Schoonmaak"], "nl", "x", ["household_supplies"], "paper_supplies_over_department", "matched"),
    (["Make-up", "Verzorging"], "nl", "x", ["beauty_cosmetics"], "beauty_over_department", "matched"),
    (["Gezondheid", "Verzorging"], "nl", "x", ["health_wellness"], "health_over_department", "matched"),
    (["Zuivel", "Bakkerij"], "nl", "x", ["dairy_eggs"], "eggs_over_baking_department", "matched"),
    (["Groente", "Gedroogd fruit", "Snacks"], "nl", "x", ["confectionery_snacks"], "dried_fruit_nuts_over_produce_department", "matched"),
    (["Gedroogd fruit"], "nl", "x", ["confectionery_snacks"], "dried_fruit_nuts_over_produce_department", "matched"),
    (["Gedroogd fruit", "Vlees"], "nl", "x", ["meat_poultry_seafood"], None, "matched"),
    (["Vruchtenconserven", "Groente"], "nl", "x", ["pantry_cooking"], "canned_fruit_over_produce_department", "matched"),
    (["Ontbijtrepen", "Granen"], "nl", "x", ["confectionery_snacks"], "cereal_bars_are_snacks", "matched"),
    (["Bier", "Alcoholvrij  bier"], "nl", "x", ["non_alcoholic_beverages"], "explicit_alcohol_free", "matched"),
    (["Vlees", "Schoonmaak"], "nl", "x", ["household_care", "meat_poultry_seafood"], None, "matched"),
]


def rows_of(spark, cases):
    schema = "id int, category_path_normalized array<string>, language string, shop string, category_path_position int, " + ", ".join(f"{c} boolean" for c in paths.STRUCTURAL)
    return spark.createDataFrame([(i, p, lang, shop, 1, False, False, False, False) for i, (p, lang, shop, *_) in enumerate(cases)], schema)


@pytest.fixture
def anchors(spark):
    return spark.createDataFrame(ANCHORS, "label string, code string")


def test_rules_within_a_path(spark, anchors):
    got = {r["id"]: r for r in D.classify_paths(rows_of(spark, CASES), ["id"], anchors, DUTCH).collect()}
    for i, (path, *_, codes, rule, reason) in enumerate(CASES):
        assert (got[i]["codes"], got[i]["reason"]) == (codes, reason), path
        own = [r for r in got[i]["rules"] if not r.startswith("nl_label_")]
        assert own == ([rule] if rule else []), path
        assert all(len(r) == len("nl_label_") + 12 for r in got[i]["rules"] if r not in own)


def test_structural_flags_come_first(spark, anchors):
    for flag in paths.STRUCTURAL:
        rows = rows_of(spark, CASES[:1]).withColumn(flag, F.lit(True))
        got = D.classify_paths(rows, ["id"], anchors, DUTCH).first()
        assert (got["codes"], got["reason"]) == ([], "structural")
        vote = D.path_votes(rows, ["id"], anchors, rules=DUTCH).first()
        assert (vote["candidates"], vote["source_path_count"], vote["excluded_path_count"]) == ([], 1, 1)


def test_paths_of_one_product_must_agree(spark, anchors):
    cases = [(["Honden", "Vlees"], "nl", "x"), (["Vlees"], "nl", "x"), (["Promoties"], "nl", "x")]
    rows = rows_of(spark, cases).withColumn("category_path_position", F.col("id") + 1).withColumn("id", F.lit(7)).withColumn("source_dataset", F.lit("s"))
    vote = D.path_votes(rows, ["id"], anchors, rules=DUTCH).first()
    assert vote["candidates"] == ["meat_poultry_seafood", "pet_care"] and vote["evidence_path_references"] == ["s:1", "s:2"] and vote["evidence_source_datasets"] == ["s"]
    assert (vote["source_path_count"], vote["excluded_path_count"]) == (3, 1) and "pet_use_over_ingredient" in vote["matched_rule_ids"]


def test_navigation_is_of_one_context(spark):
    df = spark.createDataFrame([(1, "crf"), (2, "dll")], "id int, shop string").withColumn("p", F.array(F.array(*map(F.lit, [*NAVIGATION, "x"]))))
    got = {r["id"]: r["path_review_status"] for r in paths.category_paths(df, ["id", "shop"], "p", NAVIGATION, F.col("shop") == "crf").collect()}
    assert got == {1: "navigation_review_required", 2: "repeated_label_review_required"}


DECISION = "id int, code string, category_name string, status string, mapping_version string, candidates array<string>, matched_rule_ids array<string>, evidence_source_datasets array<string>, evidence_path_references array<string>"
SOUND = [
    (1, "frozen", "Frozen Foods", "classified", "v", ["frozen"], ["r"], ["s"], ["s:1"]), (2, "unclassified", "Other / Unclassified", "conflicting_evidence", "v", ["a", "b"], ["r"], ["s"], ["s:1"]),
    (3, "frozen", "Frozen Foods", "classified", "v", ["frozen", "b"], ["name_breaks_path_conflict"], ["product_name"], ["s:1"]), (4, "frozen", "Frozen Foods", "classified", "v", ["frozen"], ["name:x"], ["product_name"], []),
]


@pytest.mark.parametrize(("at", "values", "broken"), [
    (0, {}, set()), (0, {0: 4}, {"repeated_identities"}), (0, {1: "odd"}, {"code_unknown", "name_wrong", "evidence_missing"}), (0, {2: "Frozen"}, {"name_wrong"}), (0, {3: "guessed"}, {"status_unknown", "status_and_code_disagree"}),
    (0, {4: "old"}, {"version_stale"}), (0, {5: ["b"]}, {"evidence_missing"}), (0, {6: []}, {"evidence_missing"}), (0, {8: []}, {"evidence_missing"}), (2, {6: ["r"]}, {"evidence_missing"}), (1, {5: ["a"]}, {"conflict_of_one"}),
    (1, {1: "frozen", 2: "Frozen Foods"}, {"status_and_code_disagree"}), (0, {2: None}, {"incomplete", "name_wrong"}),
])
def test_decision_contract_by_mutation(spark, at, values, broken):
    data = [list(r) for r in SOUND]
    for i, v in values.items():
        data[at][i] = v
    found = LC.decision_violations(spark.createDataFrame(data, DECISION), ["id"], GROUPS, "v")
    assert {k for k, v in found.items() if v} == broken


def test_relationships_count_without_multiplying(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (3, None)], "k int, c string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (2, "x"), (9, "x")], "k int, c string")
    joined = a.alias("a").join(b.alias("b"), "k", "left")
    assert LC.relationship(a, b, ["k"], ["c"]) == {
        "rows": 4, "joined_rows": joined.count(), "matched_rows": joined.where("b.c is not null").count(), "unmatched_rows": 1, "context_mismatches": joined.where("b.c is not null and not (a.c <=> b.c)").count(),
    }


def test_price_contract_by_mutation(spark):
    from granary.operators.versions import price_versions

    obs = spark.createDataFrame([("p", 1, 2.0, 1.5), ("p", 1, 2.0, 1.5), ("q", 1, 2.0, 2.0), ("q", 1, 3.0, 4.0)], "id string, week int, price double, price_promo double")
    good = price_versions(obs, ["id", "week"]).cache()

    def broken(df):
        m = LC.price_metrics(df, ["id", "week"]).first().asDict()
        return m, {k for k, v in LC.price_violations(df, m, ["id", "week"]).items() if v}

    m, wrong = broken(good)
    assert not wrong and (m["rows"], m["multiple_version_rows"], m["multiple_version_grains"], m["promotion_rows"], m["promo_above_price_rows"]) == (3, 2, 1, 1, 1)
    assert broken(good.limit(0))[1] == {"empty"}
    assert broken(good.unionAll(good))[1] == {"repeated_ids", "exact_duplicates"}
    assert broken(good.withColumn("price", F.lit(float("nan"))))[1] == {"not_finite"}
    assert broken(good.withColumn("week", F.lit(None).cast("int")))[1] == {"incomplete"}
    assert broken(good.withColumn("price_version_count", F.lit(5)))[1] == {"version_flag_wrong"}
    assert broken(good.withColumn("dq_non_positive_price", F.lit(True)))[1] == {"price_not_positive"}


def test_path_and_enrichment_contracts_by_mutation(spark):
    rows = paths.category_paths(spark.createDataFrame([("1", [["a"], ["b", "c"]])], "product_id string, p array<array<string>>"), ["product_id"], "p").withColumns({c: F.lit("x") for c in LC.LINEAGE if c != "path_review_status"})
    key = ["source_dataset", "product_id", "category_path_position"]
    wrong = lambda df, n=2: {k for k, v in LC.path_violations(df, n, key).items() if v}
    assert wrong(rows) == set() and wrong(rows, 3) == {"unaccounted"}
    assert wrong(rows.unionAll(rows), 4) == {"repeated_occurrences"} and wrong(rows.withColumn("category_path_depth", F.lit(9))) == {"depth_wrong"} and wrong(rows.withColumn("shop", F.lit(None))) == {"lineage_missing"}
    good = spark.createDataFrame([("1", "s", False, False), ("2", "s", True, False)], "id string, shop string, dq_enrichment_context_mismatch boolean, is_name_enriched boolean")
    wrong = lambda df, n=2: {k for k, v in LC.enrichment_violations(df, n, ["id", "shop"], ["name"], ["id"]).items() if v}
    assert wrong(good) == set() and wrong(good, 3) == {"rows_changed"} and wrong(good.withColumn("is_name_enriched", F.lit(True))) == {"unsafe_enrichment"}
    assert wrong(good.withColumn("shop", F.lit(None).cast("string"))) == {"shop_missing"} and wrong(good.withColumn("id", F.lit("1"))) == {"repeated_keys"}
