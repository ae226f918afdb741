"""Bitmaps, tables in buckets, and best rows without a window: results, and that the plans have no exchange, join or sort that they shouldn't."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from granary.operators import bitmaps as B
from granary.operators import measures as M
from granary.operators.facts import lag_ratios, reference_ratio
from granary.operators.versions import canonical, latest_flag, latest_rows
from granary.plans import price_queries as Q
from granary.plans.registry import Tables
from granary.sources.shared import open_layout, write_layout, written


def executed(df):
    return re.findall(r"^[\s:+\-]*\*?(?:\(\d+\) )?(\w+)", df._jdf.queryExecution().executedPlan().toString(), re.M)


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('layout')}/fact"
    rows = Q.fact(Tables(spark, SF), "l_returnflag").select(*Q.PLACE, "effective_price", "regular_price")
    return write_layout(rows, ["product_id"], Q.PLACE, 8, path), path


def test_ratios_over_buckets_shuffle_no_row_of_the_fact(spark, layout):
    for table in (layout[0], open_layout(spark, layout[1])):
        for rows in (
            lag_ratios(table, ["product_id", "location"], "week", 364, {"r": "effective_price", "s": "regular_price"}),
            reference_ratio(table, ["product_id", "week"], "location", "N", "effective_price", "r"),
            table.groupBy(*Q.PLACE).agg(F.max("effective_price")),
        ):
            found = executed(rows)
            assert "Exchange" not in found and not any("Join" in n for n in found), found
            assert found.count("Scan") + found.count("FileScan") == 1 or "BatchScan" in found
    found = executed(Q.bucketed_ratios(layout[0]))
    assert found.count("Exchange") == 2  # of partial aggregates, a row for each place and task


def test_two_layouts_join_without_a_shuffle(spark, layout):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = open_layout(spark, layout[1])
        sizes = write_layout(spark.read.parquet(f"{SF}/part.parquet").select(F.col("p_partkey").alias("product_id"), "p_size"), ["product_id"], ["product_id"], 8)
        joined = a.join(sizes, "product_id")
        assert "SortMergeJoin" in executed(joined) and "Exchange" not in executed(joined)
        assert joined.count() == a.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_layout_files_and_rows(spark, layout):
    table, path = layout
    assert open_layout(spark, path).exceptAll(table).isEmpty() and table.exceptAll(open_layout(spark, path)).isEmpty()
    assert table.select(F.input_file_name()).distinct().count() <= 8


def test_ratios_of_odd_series(spark):
    """Null series and dates, a date that stands twice, and places without the reference have no ratio."""
    day = "date '2024-01-01' + int(d)"
    rows = spark.createDataFrame(
        [(1, "a", 0, 10.0), (1, "a", 7, 20.0), (1, "a", 15, 5.0), (2, "a", 0, 1.0), (2, "a", 0, 3.0), (2, "a", 7, 4.0), (None, "a", 0, 1.0), (None, "a", 7, 2.0), (3, "b", None, 1.0), (4, "b", 0, -1.0), (4, "b", 7, 2.0)],
        "p int, l string, d int, v double",
    ).withColumn("w", F.expr(day))
    got = {(r.p, r.d, r.v): r.r for r in lag_ratios(rows, ["p", "l"], "w", 7, {"r": "v"}).collect()}
    assert {k for k, v in got.items() if v is not None} == {(1, 7, 20.0)} and len(got) == 11
    got = reference_ratio(rows.withColumn("l", F.when(F.col("d") == 7, "x").otherwise("y")).withColumn("k", F.lit(1)), ["p", "k"], "l", "y", "v", "r").collect()
    assert {(r.p, r.d) for r in got if r.r is not None} == set()  # the reference stands twice, or isn't positive
    one = spark.createDataFrame([(1, "x", 4.0), (1, "y", 2.0), (1, None, 2.0), (2, "x", 1.0)], "k int, l string, v double")
    assert {(r.k, r.l): r.r for r in reference_ratio(one, ["k"], "l", "y", "v", "r").collect()} == {(1, "x"): pytest.approx(0.693147, abs=1e-6), (1, "y"): None, (1, None): None, (2, "x"): None}


@pytest.fixture(scope="module")
def odd(spark):
    """Keys null, negative, 0 and beyond a bitmap; weeks null and centuries apart; null groups."""
    keys = [None, -5, 0, 1, 32_768, 32_769, 10**12]
    rows = [(g, h, keys[(i * 3 + j) % 7], None if i % 5 == 0 else i % 9) for i in range(60) for j, (g, h) in enumerate([("a", 1), ("a", 2), (None, 1)])]
    df = spark.createDataFrame(rows, "g string, h int, k long, n int")
    return df.withColumn("w", F.expr("case when n < 8 then date '2024-01-01' + n * 7 else date '1801-01-05' end"))


def test_bitmaps_equal_distinct_counts(spark, odd):
    there = written(B.presence(odd, ["g", "h"], "k", {"weeks": B.week_ordinal(F.col("w"))}, {"late": F.col("n") > 4}, {"rows": F.lit(1)}, {"first": F.col("w")}), "odd")
    got = B.counted_sets(there, B.cube("g", "h"), wide=["keys", "late"], narrow=["weeks"], sums=["rows"], least=["first"])
    odd.createOrReplaceTempView("odd")
    want = spark.sql("SELECT g, h, count(DISTINCT k) keys, count(DISTINCT CASE WHEN n > 4 THEN k END) late, count(DISTINCT w) weeks, count(*) rows, min(w) first FROM odd GROUP BY CUBE (g, h)")
    names = ["g", "h", "keys", "late", "weeks", "rows", "first"]
    assert sorted(map(str, got.select(names).collect())) == sorted(map(str, want.collect()))
    coarse = B.merged(there, ["h"], ["keys"], ["rows"])  # is a table of presence itself
    assert sorted(map(str, B.counted(coarse, [], sums=["rows"]).collect())) == sorted(map(str, spark.sql("SELECT count(DISTINCT k) keys, count(*) rows FROM odd").collect()))


def test_masks_equal_distinct_counts(spark, odd):
    masks = B.ordinal_masks(odd, ["g", "k"], B.week_ordinal(F.col("w")))
    for by in (["g", "k"], ["g"], []):
        own = masks if len(by) == 2 else B.merged_masks(masks, by)
        want = odd.groupBy(*by).agg(F.count_distinct("w").alias("n"))
        assert sorted(map(str, B.counted_masks(own, by, "n").collect())) == sorted(map(str, want.collect()))
    with pytest.raises(Exception, match="week out of range"):
        spark.sql("SELECT date '2900-01-01' w").select(B.week_ordinal(F.col("w"))).collect()


def test_measures_over_bitmaps_expand_no_row(spark):
    fact = Q.fact(Tables(spark, SF))
    for rows in (M.listing_bands(fact, ["location"]), M.per_week(fact, ["location"]), M.range_share(fact, ["location"], [])):
        assert "Expand" not in executed(rows)
    empty = fact.limit(0)
    assert M.listing_bands(empty, ["location"]).collect() == [] and M.per_week(empty, ["location"]).collect() == []


@pytest.fixture(scope="module")
def versions(spark):
    """A grain with a third of all rows, ties, null grains and repeated rows."""
    return spark.range(3000).selectExpr(
        "if(id % 3 = 0, 0, if(id % 50 = 1, null, id % 40)) as g", "cast(id % 7 as int) as c1", "cast(if(id % 11 = 0, null, id % 5) as int) as c2", "concat('p', id % 90) as payload", "id % 4 as t", "id", "date '2024-01-01' + cast(id % 30 as int) as d",
    )


def test_canonical_rows_equal_a_ranking(spark, versions):
    got = canonical(versions, ["g"], ["c1", "c2"], "payload", [F.col("t"), F.col("id")])
    versions.createOrReplaceTempView("versions")
    want = spark.sql("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY c1 DESC NULLS LAST, c2 DESC NULLS LAST, md5(payload) NULLS FIRST, t NULLS FIRST, id) rn,
      count(*) OVER (PARTITION BY g) grain_rows, count(*) OVER (PARTITION BY g, c1, c2) tied_rows FROM versions)
      SELECT g, c1, c2, payload, t, id, d, grain_rows, tied_rows FROM r WHERE rn = 1""")
    assert sorted(map(str, got.drop("selection_reason").collect())) == sorted(map(str, want.collect()))
    assert "Window" not in executed(got)


def test_latest_rows_and_flags_equal_a_window(spark, versions):
    rows = versions.withColumn("d", F.when(F.col("id") % 13 != 0, F.col("d")))
    got = latest_rows(rows, ["g"], "d", ["c1", "id"])
    rows.createOrReplaceTempView("dated")
    want = spark.sql("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY d DESC NULLS LAST, c1 DESC, id DESC) rn, count(*) OVER (PARTITION BY g, d) rows_of_last_date FROM dated)
      SELECT g, c1, c2, payload, t, id, d, rows_of_last_date FROM r WHERE rn = 1""")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "Window" not in executed(got) and not any("Join" in n for n in executed(got))
    flagged = latest_flag(rows, ["g"], "d", "l").select("id", "l")
    assert sorted(map(str, flagged.collect())) == sorted(map(str, spark.sql("SELECT id, d = max(d) OVER (PARTITION BY g) l FROM dated").collect()))
    assert "Window" not in executed(latest_flag(rows, ["g"], "d"))


def test_brand_rollup_has_no_group_for_each_week(spark, tmp_path):
    lines = [(1, "F", "1601-03-05"), (1, "F", "1601-03-06"), (1, "F", "2020-01-06"), (1, "O", None), (1, "O", None), (2, "F", "2020-01-01"), (3, "F", "2020-01-01"), (None, "F", "2020-01-01")]
    lines = spark.createDataFrame(lines, "l_partkey long, l_linestatus string, d string").selectExpr("*", "cast(d AS timestamp_ntz) AS l_shipdate", "'R' AS l_returnflag", "2.0D AS l_quantity", "4.0D AS l_extendedprice", "0.0D AS l_discount")
    lines.drop("d").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "x"), (2, "x"), (4, "y")], "p_partkey long, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    df = Q.brand_rollup(Tables(spark, str(tmp_path)))
    found = {(r["p_brand"], r["location"]): (r["products"], r["observations"], str(r["first_week"])) for r in df.collect()}
    every = (2, 4, "1601-03-05")
    assert found == {("x", "F"): (2, 3, "1601-03-05"), ("x", "O"): (1, 1, "None"), ("x", None): every, (None, None): every}
    keys = [x.split("keys=[")[1].split("]")[0] for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Aggregate(keys=[" in x]
    assert keys and not [k for k in keys if "week" in k]
