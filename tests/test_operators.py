import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from granary.operators import contracts as Q
from granary.operators import decisions, enrich, keys, labels, mart, measures, paths, profiling
from granary.operators import mart_contracts as MC
from granary.operators.facts import lag_ratios, reference_ratio, weekly_fact
from granary.operators.versions import canonical, latest_flag, price_versions


def rows(df, *by):
    return [r.asDict() for r in df.orderBy(*by).collect()]


def test_price_versions_rule(spark):
    obs = spark.createDataFrame([("p", 1, 2.0, 1.5), ("p", 1, 2.0, 1.5), ("q", 1, 2.0, None), ("q", 1, 3.0, 4.0), ("r", 1, 0.0, 1.0), ("q", 1, 3.0, 4.0)], "id string, week int, price double, price_promo double")
    got = rows(price_versions(obs, ["id", "week"]), "id", "price")
    assert [(r["id"], r["price_resolution_rule"], r["price_version_count"]) for r in got] == [("p", "exact_duplicate_collapsed", 1), ("q", "multiple_price_observations", 2), ("q", "multiple_price_observations", 2), ("r", "single_observation", 1)]
    assert [r["is_promotion"] for r in got] == [True, None, False, False]
    assert [r["dq_promo_above_price"] for r in got] == [False, None, True, True]
    assert len({r["price_observation_id"] for r in got}) == 4


def test_weekly_fact_gives_agreed_values_only(spark):
    obs = spark.createDataFrame([("a", 1, 10.0, 8.0), ("b", 1, 10.0, 8.0), ("b", 1, 12.0, 8.0), ("c", 1, 10.0, 8.0), ("c", 1, 10.0, None), ("d", 1, 10.0, 12.0)], "p string, w int, price double, price_promo double")
    got = {r["p"]: r for r in rows(weekly_fact(obs, ["p", "w"]), "p")}
    assert got["a"]["discount_pct"] == pytest.approx(0.2) and got["a"]["effective_price"] == 8
    assert got["b"]["regular_price"] is None and got["b"]["promo_price"] == 8 and got["b"]["effective_price"] == 8 and got["b"]["discount_amount"] is None and got["b"]["has_intraweek_price_variation"]
    assert got["c"]["is_promotion"] is None and got["c"]["promotion_state_conflict"] and got["c"]["effective_price"] is None
    assert got["d"]["is_promotion"] is False and got["d"]["effective_price"] == 10 and got["d"]["promo_price"] is None


def test_ratios_need_the_exact_week_and_positive_prices(spark):
    d = [date(2020, 1, 6), date(2021, 1, 4), date(2021, 1, 11)]  # 364 days, and one week off
    fact = spark.createDataFrame([("p", d[0], 2.0), ("p", d[1], 4.0), ("p", d[2], 4.0), ("z", d[0], 0.0), ("z", d[1], 1.0), ("m", d[0], 1.0), ("m", d[0], 2.0), ("m", d[1], 1.0)], "p string, w date, price double")
    got = lag_ratios(fact, ["p"], "w", 364, {"r": "price"})
    assert got.count() == fact.count()
    found = {(r["p"], r["w"]): r["r"] for r in got.collect() if r["r"] is not None}
    assert found == {("p", d[1]): pytest.approx(math.log(2))}
    places = spark.createDataFrame([("p", "N", 2.0), ("p", "S", 3.0), ("q", "S", 1.0), ("r", "N", 1.0), ("r", "N", 1.0), ("r", "S", 1.0)], "p string, l string, price double")
    got = reference_ratio(places, ["p"], "l", "N", "price", "r")
    assert {(r["p"], r["l"]): r["r"] for r in got.collect() if r["r"] is not None} == {("p", "S"): pytest.approx(math.log(1.5))}


def test_canonical_is_a_total_order(spark):
    data = [(1, "g", 3, "x"), (2, "g", 5, "y"), (3, "h", 5, "x"), (4, "h", 5, "y"), (5, "i", 1, "z")]
    for order in (data, data[::-1]):
        got = rows(canonical(spark.createDataFrame(order, "id int, g string, n int, payload string"), ["g"], ["n"], "payload", [F.col("id")]), "g")
        assert [(r["id"], r["selection_reason"]) for r in got] == [(2, "completeness_first"), (4, "deterministic_hash_tiebreak"), (5, "single_observation")]


def test_latest_flag(spark):
    df = latest_flag(spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 1)], "k string, t int"), ["k"], "t")
    assert sorted(map(tuple, df.collect())) == [("a", 1, False), ("a", 2, True), ("a", 2, True), ("b", 1, True)]


def test_fallback_fills_only_in_context(spark):
    mine = spark.createDataFrame([(1, "be", None, 1.0), (2, "be", "x", None), (3, "nl", None, None), (4, "be", None, 2.0)], "k int, ctx string, name string, lat double")
    other = spark.createDataFrame([(1, "be", "one", 1.0000001), (2, "be", "y", 5.0), (3, "be", "three", 3.0)], "k int, ctx string, name string, lat double")
    got = rows(enrich.fallback(mine, other, ["k"], ["name", "lat"], ["ctx"], {"lat": 1e-5}), "k")
    assert [r["name"] for r in got] == ["one", "x", None, None]
    assert [r["is_name_enriched"] for r in got] == [True, False, False, False]
    assert [r["dq_name_conflict"] for r in got] == [False, True, False, False]
    assert [r["dq_lat_conflict"] for r in got] == [False, False, False, False]
    assert [r["dq_enrichment_context_mismatch"] for r in got] == [False, False, True, False]
    with pytest.raises(Q.ContractError, match="right side"):
        enrich.fallback(mine, other.unionAll(other), ["k"], ["name"], ["ctx"])


def test_surrogate_keys_by_one_range_and_several(spark):
    df = spark.range(1000).select((F.col("id") % 700).alias("a"))
    small = rows(keys.surrogate_keys(df, ["a"], "k"), "k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows(keys.surrogate_keys(df, ["a"], "k"), "k") == small
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert small[0] == {"k": 1, "a": 0} and small[-1] == {"k": 700, "a": 699}
    dim = keys.with_unknown(keys.surrogate_keys(df, ["a"], "k"), "k", {})
    assert dim.where("k = -1").collect()[0]["a"] is None


def test_labels(spark):
    payload = '{"nutrients":{"fat":{"value":"1.5","unit":"g"},"salt":{"value":"NaN","unit":"g"},"vit":{"value":"3","unit":"IU"},"odd":{"value":null,"unit":"g"}}}'
    mapping = spark.createDataFrame(labels.check_mapping([("fat", "g", "g", 1.0, "identity"), ("salt", "g", "g", 1.0, "identity"), ("vit", "IU", "g", None, "incompatible_unit"), ("odd", "g", "g", 1.0, "identity")]), labels.MAPPING)
    df = spark.createDataFrame([(1, payload)], "id int, payload string")
    got = {r["entry"]: r for r in labels.standardize(labels.unpivot(df, "payload", "$.nutrients"), mapping).collect()}
    assert got["fat"]["value"] == 1.5 and got["salt"]["value"] is None and got["salt"]["dq_non_numeric_value"]
    assert got["vit"]["value"] is None and got["vit"]["dq_incompatible_unit"] and got["odd"]["dq_missing_value"]
    done = labels.completeness(df, "payload", "$.nutrients").first()
    assert (done["entry_count"], done["numeric_entry_count"], done["populated_unit_count"]) == (4, 2, 4)
    for bad in ([("a", "g", "g", None, "identity")], [("a", "g", "g", 1.0, "identity")] * 2, [("a", "g", "g", 1.0, "identity"), ("a", "mg", "mg", 1.0, "identity")]):
        with pytest.raises(Q.ContractError):
            labels.check_mapping(bad)
    problems = spark.createDataFrame([("{",), ('{"a":1}',), ('{"nutrients":{}}',), (payload,)], "p string").select(labels.payload_problems(F.col("p"), "$.nutrients"))
    assert [r[0] for r in problems.collect()] == ["invalid_json", "no_entries_object", "empty_entries", None]


@pytest.mark.parametrize(("kj", "kcal", "mismatch"), [(418.4, 100.0, False), (426.7, 100.0, False), (426.8, 100.0, True), (5.1, 1.0, False), (5.2, 1.0, True), (None, 1.0, None), (-1.0, 1.0, None), (0.0, 0.0, False)])
def test_energy(spark, kj, kcal, mismatch):
    assert spark.createDataFrame([(kj, kcal)], "a double, b double").select(labels.energy_mismatch(F.col("a"), F.col("b"))).first()[0] is mismatch


def test_category_paths(spark):
    df = spark.createDataFrame([(1, [["a"], ["a", "b"], [" a", "b "], ["c", "c"]]), (2, [["nav", "x"]]), (3, [["x"], ["y"]])], "id int, paths array<array<string>>")
    got = rows(paths.category_paths(df, ["id"], "paths", ["nav"]), "id", "category_path_position")
    assert [r["path_review_status"] for r in got] == ["ancestor_path", "duplicate_path_occurrence", "duplicate_path_occurrence", "repeated_label_review_required", "navigation_review_required", "multiple_branches_review_required", "multiple_branches_review_required"]
    assert [r["maximal_path_count"] for r in got] == [2, 2, 2, 2, 1, 2, 2]
    assert got[2]["category_path_normalized"] == ["a", "b"] and got[2]["category_path"] == [" a", "b "]


@pytest.mark.parametrize("bad", ["{", "[[null]]", "[[]]", '["a"]', "[null]", "[]", '[[" "]]', "[[1,2]]", '[["a",{"b":1}]]', '[["a"]] trailing', '[["a"],[]]', '[["a",null]]', "{}", '"a"', "1", '[["a", true]]'])
def test_malformed_paths_fail(spark, bad):
    with pytest.raises(Exception, match="malformed paths"):
        spark.createDataFrame([(bad,)], "p string").select(paths.parse_paths(F.col("p"))).collect()


def test_decisions(spark):
    none = []
    votes = [(1, ["a"], 2, 0), (2, ["a", "b"], 2, 0), (3, ["a", "b"], 2, 0), (4, none, 2, 2), (5, none, 2, 1), (6, none, 1, 0)]
    names = [(1, ["b"]), (2, ["b"]), (3, ["c"]), (6, ["d"]), (7, ["e"]), (8, ["e", "f"])]
    got = rows(decisions.decide(spark.createDataFrame(votes, "id int, candidates array<string>, source_path_count long, excluded_path_count long"), ["id"], spark.createDataFrame(names, "id int, name_codes array<string>")), "id")
    assert [(r["code"], r["status"], r["basis"]) for r in got] == [
        ("a", "classified", "paths"), ("b", "classified", "name_breaks_path_conflict"), ("unclassified", "conflicting_evidence", None), ("unclassified", "excluded_evidence", None),
        ("unclassified", "no_supported_match", None), ("d", "classified", "name"), ("e", "classified", "name"), ("unclassified", "missing_evidence", None),
    ]


def test_precedence_first_rule_wins(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a", "c"],), (["a"],), (["a", "b", "z"],)], "c array<string>")
    got = [r[0] for r in df.select(decisions.precedence(F.col("c"), [("b", ["a", "b"]), ("a", ["a", "b", "c"])])).collect()]
    assert got == [["b"], ["a"], ["a"], ["a", "b", "z"]]


def test_mining_counts_a_word_once_a_row(spark):
    df = spark.createDataFrame([("milk milk", "x"), ("milk", "x"), ("milk bread", "y"), ("bread", "y")], "t string, c string")
    assert sorted(map(tuple, paths.mine_tokens(df, "t", "c", 2, 0.6).collect())) == [("bread", "y", 2, 2), ("milk", "x", 3, 2)]


def test_contracts(spark):
    df = spark.createDataFrame([(1, float("nan"), date(2020, 1, 1)), (1, 1.0, None)], "k int, v double, d date")
    for f in (lambda: Q.require_columns(df, ["k", "v"]), lambda: Q.require_columns(df, ["x"], exact=False), lambda: Q.require_unique(df, ["k"]), lambda: Q.require_date(df, "k"), lambda: Q.require_finite(df, "v"), lambda: Q.fail_if_any({"a": 1}), lambda: Q.require_known(df, "k", spark.range(1, 1))):
        with pytest.raises(Q.ContractError):
            f()
    Q.require_columns(df, ["k"], exact=False)
    Q.require_unique(df, ["k", "v"])
    Q.require_date(df, "d")
    Q.require_known(df, "k", spark.range(3))


def test_mart_violations_by_mutation(spark):
    dim = spark.createDataFrame([(-1, "Unknown", "be"), (1, "a", "be"), (2, "b", "be")], "k long, n string, country string")
    fact = spark.createDataFrame([(1, 1), (2, 1)], "k long, w long")
    assert MC.fact_violations(fact, ["k", "w"], {"k": dim}) == {"repeated grain": 0, "k orphans": 0, "k unknown": 0}
    broken = fact.unionAll(spark.createDataFrame([(1, 1), (9, 1), (-1, 1)], fact.schema))
    assert MC.fact_violations(broken, ["k", "w"], {"k": dim}) == {"repeated grain": 1, "k orphans": 1, "k unknown": 1}
    assert MC.scope_violations(fact, dim, "k", ["country"], {"n": ["a"]}) == {"k unused": 0, "country has several values": 0, "n outside its domain": 1}
    bridge, members = spark.createDataFrame([(1, 1), (1, 1), (5, 1), (-1, 2)], "k long, c long"), dim
    found = MC.bridge_violations(bridge, members, spark.range(1, 4).toDF("c"), "k", "c")
    assert list(found.values()) == [1, 1, 0, 1, 1]
    flagged = spark.createDataFrame([("a", 1, False), ("b", 1, True), ("b", 2, True)], "s string, d int, is_latest_observation boolean")
    assert MC.latest_violations(flagged, ["s"], "d") == {"no latest": 1, "several latest": 1}
    assert MC.reconcile(fact, broken, ["k"]) == {"source grains missing": 0, "fact grains from nowhere": 2}
    with pytest.raises(Q.ContractError, match="fact"):
        MC.check_mart(fact={"x": 1})
    assert Q.dimension_violations(dim, "k", ["n"], -1).first().asDict() == {"empty": 0, "repeated_keys": 0, "repeated_natural_keys": 0, "unknown_members": 0}


def test_entity_dimension(spark):
    a = spark.createDataFrame([("2", "own")], "id string, name string")
    b = spark.createDataFrame([("2", "late"), ("1", "ref")], "id string, name string")
    dim = mart.entity_dimension("k", ["id"], [(a, "weekly"), (b, "reference"), (mart.infer(spark.createDataFrame([("3",)], "id string"), ["id"], "name", "Unmatched (%s)"), "inferred")], ["name"], {"name": "Unknown"})
    assert sorted(map(tuple, dim.collect()))[1:] == [(1, "1", "ref", "reference", False), (2, "2", "own", "weekly", False), (3, "3", "Unmatched (3)", "inferred", True)]
    decided = rows(mart.attach_decision(dim, spark.createDataFrame([("1", "c", "classified")], "id string, code string, status string"), ["id"], "k"), "k")
    assert [(r["category_code"], r["category_status"]) for r in decided] == [("unclassified", "unknown_product"), ("c", "classified"), ("unclassified", "missing_evidence"), ("unclassified", "missing_evidence")]
    recovered = mart.recover(spark.createDataFrame([("x", "be"), ("y", "be")], "id string, ctx string"), spark.createDataFrame([("x", "nl", "n"), ("y", "nl", "n"), ("y", "fr", "n")], "id string, ctx string, name string"), ["id"], "ctx", ["name"])
    assert [tuple(r) for r in recovered.collect()] == [("x", "be", "n")]


def test_sound_paths(spark):
    for text, want in (('[["a"]]', [["a"]]), (' [ [ "a" , "b\\"c]" ] ,["é\\u00e9"]]\n', [["a", 'b"c]'], ["éé"]]), (None, None), ('[["' + "x" * 200_000 + '"]]', [["x" * 200_000]])):
        assert spark.createDataFrame([(text,)], "p string").select(paths.parse_paths(F.col("p"))).first()[0] == want


def test_churn_follows_products_of_every_group_from_month_to_month(spark):
    rows = [("a", date(2020, 1, 6), 1), ("a", date(2020, 1, 13), 1), ("a", date(2020, 1, 6), 2), ("a", date(2020, 2, 3), 2), ("a", date(2020, 2, 3), 3)]
    rows += [("a", date(2020, 4, 6), 3), (None, date(2020, 1, 6), 9), (None, date(2020, 2, 3), 9)]
    fact = spark.createDataFrame(rows, "shop string, week date, product_id long")
    found = {(r["shop"], r["month"].month): tuple(r)[2:] for r in measures.churn(fact, ["shop"]).collect()}
    none = (None, None, None)
    assert found == {("a", 1): none, ("a", 2): (1, 1, -1), ("a", 4): none, (None, 1): none, (None, 2): (0, 0, 0)}
    assert measures.churn(fact.where("false"), ["shop"]).collect() == []


def test_key_audit_counts_rows_and_members_without_a_partner(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (4,), (4,), (None,)], "k long")
    dim = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id int")
    none = dim.where("false")
    found = profiling.key_audit([("used", fact, "k", dim, "id"), ("back", dim, "id", fact, "k"), ("void", none, "id", none, "id")])
    assert {r["foreign_key"]: (r["orphan_rows"], r["unused_members"]) for r in found.collect()} == {"used": (3, 2), "back": (2, 3), "void": (0, 0)}


def test_churn_keeps_months_of_a_product_in_few_numbers(spark):
    import random
    from datetime import date, timedelta

    rng = random.Random(3)
    rows = [(rng.choice(["a", None]), rng.choice([1, 2, 3, None]), date(1988, 1, 4) + timedelta(days=7 * rng.randrange(1_000))) for _ in range(600)] + [("a", 1, None)]
    there = {(p, i, w and (w.year, w.month)) for p, i, w in rows}
    last = lambda m: (m[0] - (m[1] == 1), (m[1] - 2) % 12 + 1)
    want = {("a", None): (0, 0)}
    for p, m in {(p, m) for p, _, m in there if m}:
        now, then = ({i for q, i, n in there if q == p and n == at} for at in (m, last(m)))
        want[p, m] = (len(now - then), len(then - now)) if then else (None, None)
    df = spark.createDataFrame(rows, "place string, product_id long, week date")
    found = measures.churn(df, ["place"])
    assert {(r["place"], r["month"] and (r["month"].year, r["month"].month)): tuple(r)[2:4] for r in found.collect()} == want
    # No aggregate has a group for each product and month.
    plan = measures.churn(df, ["place"])._jdf.queryExecution().executedPlan().toString().splitlines()
    by_product = [x for x in plan if "HashAggregate" in x and "product_id" in x]
    assert by_product and not [x for x in by_product if "month" in x]


def test_recover_sets_and_texts_get_distinct_rows_only(spark):
    rows = [("x", "nl", "n"), ("x", "nl", "n"), ("x", None, "n"), ("y", "nl", "n"), ("y", "nl", "m"), ("z", "nl", "n"), ("z", "fr", "n"), ("w", None, "n"), (None, "nl", "n")] * 3
    described = spark.createDataFrame(rows, "id string, ctx string, name string")
    df = mart.recover(spark.createDataFrame([(i, "be") for i in ("x", "y", "z", "w", None)], "id string, ctx string"), described, ["id"], "ctx", ["name"])
    assert {(r["id"], r["name"]) for r in df.collect()} == {("x", "n"), ("y", None)}
    # The aggregate that reads the rows holds neither sets nor least texts.
    plan = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Aggregate(" in x]
    held = [n for n, x in enumerate(plan) if "collect_set" in x]
    assert held and [x for x in plan[max(held) + 1 :] if "HashAggregate" in x and "functions=[partial_count(1)]" in x]
