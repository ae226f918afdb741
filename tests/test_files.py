"""Statistics from footers, and trees of hashes: equal to plain versions, and no data read that need not be."""

import pytest
from conftest import SF
from pyspark.sql import functions as F

from granary.catalog import ORACLES, QUERIES
from granary.operators import hash_tree as H
from granary.sources.footers import file_statistics, footer_aggregate


@pytest.mark.parametrize("name", ["file_statistics", "version_differences"])
def test_equals_sql(spark, same_as_sql, name):
    same_as_sql(QUERIES[name](spark, SF), ORACLES[name])


def test_the_plan_asks_footers_and_the_session_stays_as_it_was(spark):
    one = footer_aggregate(spark, f"{SF}/lineitem.parquet")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)" in plan and "count(*)#" in plan  # the scan gives figures, not columns
    assert "FileScan parquet" in spark.read.parquet(f"{SF}/orders.parquet")._jdf.queryExecution().executedPlan().toString()


def found(df):
    return {r.column_name: tuple(r)[1:] for r in df.collect()}


def test_statistics_of_odd_files(spark, tmp_path):
    """Nulls only, quotes in names, dates, nested columns, many files, NaN (a scan), a row group of nulls, and no rows."""
    rows = spark.range(100).selectExpr(
        "id as `a.b``c`", "date '2024-01-01' + cast(id as int) as d", "if(id < 10, null, timestamp_ntz '2024-01-01 00:00:00.25') as t", "cast(id as double) as f", "'s' as s", "cast('b' as binary) as bin", "id > 5 as flag", "array(id) as x", "-id as late",
    )
    path = f"{tmp_path}/a"
    rows.repartition(5).write.parquet(path)
    text = {k: tuple(map(str, v)) for k, v in found(file_statistics(spark, path)).items()}
    none = ("None", "None")
    assert text == {
        "a.b`c": ("100", "0", "0.0", "99.0", *none, "True"), "d": ("100", "0", *none, "2024-01-01 00:00:00", "2024-04-09 00:00:00", "True"), "t": ("100", "10", *none, *["2024-01-01 00:00:00.250000"] * 2, "True"),
        "f": ("100", "0", "0.0", "99.0", *none, "True"), "s": ("100", "0", *none, *none, "True"), "bin": ("100", "0", *none, *none, "True"), "flag": ("100", "0", *none, *none, "True"), "late": ("100", "0", "-99.0", "0.0", *none, "False"),
    }
    nulls = f"{tmp_path}/nulls"
    rows.select(F.lit(None).cast("int").alias("n"), "d").write.parquet(nulls)
    assert {k: (v[1], v[-1]) for k, v in found(file_statistics(spark, nulls)).items()} == {"n": (100, True), "d": (0, True)}
    nan = f"{tmp_path}/nan"
    rows.select(F.when(F.col("f") == 3, float("nan")).otherwise(F.col("f")).alias("f"), "t", F.col("t").cast("timestamp").alias("u")).write.parquet(nan)
    got = file_statistics(spark, nan)
    assert found(got)["f"][-1] is False and found(got)["t"][:2] == (100, 10)
    assert str(found(got)["f"][3]) == "nan" and str(found(got)["t"][4]) == str(found(got)["u"][4]) == "2024-01-01 00:00:00.250000"
    part = f"{tmp_path}/part"
    rows.select("d", F.when(F.col("f") >= 50, F.col("f")).alias("f")).repartitionByRange(2, "d").write.parquet(part)
    assert {k: (v[1], v[2], v[-1]) for k, v in found(file_statistics(spark, part)).items()} == {"d": (0, None, True), "f": (50, 50.0, False)}
    empty = f"{tmp_path}/empty"
    rows.limit(0).write.parquet(empty)
    assert {v[:4] for v in found(file_statistics(spark, empty)).values()} == {(0, 0, None, None)}


@pytest.fixture(scope="module")
def pair(spark):
    """Keys negative, null, repeated; one row changed, one null set, one added, one away, one repeated once more."""
    a = spark.range(-5000, 20000).selectExpr("if(id = 7, null, id) as k", "id % 10 as v", "cast(id as string) as s").unionByName(spark.range(3).selectExpr("5 as k", "id as v", "'r' as s"))
    b = a.withColumns({"v": F.when(F.col("k") == 100, -1).otherwise(F.col("v")), "s": F.when(F.col("k") != -4000, F.col("s"))}).where("k is null or k <> 9000")
    b = b.unionByName(spark.sql("SELECT 10000000000L as k, 1L as v, 'n' as s UNION ALL SELECT 5L, 0L, 'r' UNION ALL SELECT null, 1L, 'z'"))
    return a, b.select("s", "v", "k")


WANT = {(100, "changed", 1, 1), (-4000, "changed", 1, 1), (9000, "removed", 1, 0), (10**10, "added", 0, 1), (5, "changed", 4, 5), (None, "changed", 1, 2)}


@pytest.mark.parametrize("most", [200, 2])
def test_changed_rows(pair, monkeypatch, most):
    monkeypatch.setattr(H, "MOST_RANGES", most)  # by ranges and by a join
    assert set(map(tuple, H.changed_rows(*pair, "k", shift=6).collect())) == WANT
    assert H.changed_rows(pair[0], pair[0].repartition(7), "k").isEmpty()
    assert H.changed_rows(pair[0].limit(0), pair[0].where("k = 3"), "k").collect()[0][1:] == ("added", 0, 1)


def test_trees_are_additive_and_lead_to_the_leaves(spark, pair, tmp_path):
    a, b = pair
    trees = []
    for name, df in (("a", a), ("b", b.select(a.columns))):
        H.tree(H.leaves(df, "k", 6)).write.parquet(f"{tmp_path}/{name}")
        trees.append(spark.read.parquet(f"{tmp_path}/{name}"))
    assert H.equal(trees[0], trees[0]) and not H.equal(*trees)
    off = H.differing(*trees)
    leaf = {r.node for r in off.where("level = 0").collect()}
    assert leaf == {None if k is None else k >> 6 for k, *_ in WANT}
    for level in range(1, H.LEVELS + 1):  # a node differs where one below it does
        assert {r.node for r in off.where(F.col("level") == level).collect()} == {None if n is None else n >> H.BITS * level for n in leaf}
    assert set(map(tuple, H.changed_rows(a, b, "k", 6, tuple(trees)).collect())) == WANT
    parts = H.leaves(a.where("s > '5'"), "k", 6).unionByName(H.leaves(a.where("not s > '5'"), "k", 6))
    total = parts.groupBy("node").agg(F.sum("rows").alias("rows"), F.sum("hash_sum").alias("hash_sum"), F.bit_xor("hash_xor").alias("hash_xor"))
    assert H.differing(total.withColumn("level", F.lit(0)), trees[0].where("level = 0")).isEmpty()


def test_few_rows_are_compared(spark, tmp_path):
    """Of 600,000 rows with one changed, the scan is asked for one range of 4,096 keys: under 1 %."""
    a = spark.range(600_000).selectExpr("id as k", "id % 97 as v")
    a.repartitionByRange(8, "k").sortWithinPartitions("k").write.parquet(f"{tmp_path}/a")
    a = spark.read.parquet(f"{tmp_path}/a")
    b = a.withColumn("v", F.when(F.col("k") == 345_678, 0).otherwise(F.col("v")))
    nodes = H.differing(*(H.leaves(t, "k").withColumn("level", F.lit(0)) for t in (a, b)))
    part = H.within(a, "k", nodes, 12)
    assert part.count() == 4096
    assert "GreaterThanOrEqual(k,344064)" in part._jdf.queryExecution().executedPlan().toString()
    assert list(map(tuple, H.changed_rows(a, b, "k").collect())) == [(345_678, "changed", 1, 1)]
