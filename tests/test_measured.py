"""Figures and keys taken while a table is written: equal to those of the written table, by one exchange and one sort."""

import pytest
from pyspark.sql import functions as F
from test_layouts import executed

from granary.operators import layer_contracts as LC
from granary.operators.contracts import ContractError
from granary.plans.publish import Job, current, publish
from granary.sources.measured import numbered_in_key, write_measured


@pytest.fixture(scope="module")
def rows(spark):
    """Keys once, twice, null, and one with a third of all rows."""
    return spark.range(3000).selectExpr("if(id % 3 = 0, -1, if(id % 50 = 1, null, id - id % 2)) as k", "cast(id % 7 as string) as s", "if(id % 11 = 0, null, id / 4) as v", "id")


@pytest.mark.parametrize("key", [["k"], ["k", "s"], ["v"], ["id"], []])
def test_figures_and_keys_equal_those_of_the_table(spark, rows, tmp_path, key):
    path = f"{tmp_path}/t"
    seen = write_measured(rows, path, {"total": F.sum("v"), "nulls": F.count_if(F.col("k").isNull())}, key)
    back = spark.read.parquet(path)
    assert back.columns == rows.columns and back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    want = {"rows": 3000, "total": pytest.approx(back.agg(F.sum("v")).first()[0]), "nulls": back.where("k is null").count()}
    assert seen == (want | {"repeated_keys": LC.repeats(back, key)} if key else want)


def test_an_empty_table_has_figures_of_nothing(spark, rows, tmp_path):
    assert write_measured(rows.where("id < 0"), f"{tmp_path}/a", {"total": F.sum("v")}, ["k"]) == {"rows": 0, "total": 0, "repeated_keys": 0}
    assert write_measured(rows.limit(0), f"{tmp_path}/b", {"total": F.sum("v")}, ["k"]) == {"rows": 0, "total": 0, "repeated_keys": 0}


def test_the_proof_of_a_key_has_one_exchange_and_one_sort(rows):
    found = executed(numbered_in_key(rows, ["k", "s"]))
    assert found.count("Exchange") == 1 and found.count("Sort") == 1 and "Window" in found


def test_a_column_of_a_clashing_name_is_kept(spark, tmp_path):
    """The helper column takes no part where there is no key."""
    path = f"{tmp_path}/t"
    write_measured(spark.range(3).selectExpr("id", "id as repeated_keys", "id as rows"), path, key=["rows"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(i, i, i) for i in range(3)]


def test_jobs_fail_by_what_was_observed(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/n")
    source, target = {"n": f"{tmp_path}/n"}, f"{tmp_path}/out"

    def judge(seen, before):
        if seen["odd"] > before.get("a", {}).get("odd", 9):
            raise ContractError("more odd numbers")
        return {"share": seen["odd"] / seen["rows"]}

    def jobs(rule, key=("x",)):
        odd = {"odd": F.count_if(F.col("x") % 2 == 1)}
        return [Job("a", lambda t: t["n"].selectExpr("id as x"), observe=odd, key=key, judge=judge), Job("b", lambda t: t["a"].selectExpr(f"{rule} as x"), observe=odd, judge=judge)]

    manifest = publish(spark, target, source, jobs("x"))
    assert manifest["tables"]["a"]["metrics"] == {"rows": 10, "odd": 5, "share": 0.5}
    with pytest.raises(ContractError, match="odd"):
        publish(spark, target, source, jobs("1"))
    repeated = [Job("a", lambda t: t["n"].selectExpr("id % 4 as x"), key=("x",))]
    with pytest.raises(ContractError, match="repeated_keys.*6"):
        publish(spark, target, source, repeated)
    assert current(spark, target).manifest["tables"]["b"]["metrics"]["odd"] == 5
