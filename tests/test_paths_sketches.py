"""Flags of category paths against a plain version, and merged quantile sketches against exact ranks."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.operators import paths as P
from granary.operators import sketches as S

PATHS = "id int, p array<array<string>>"
FLAGS = ["category_path_position", "category_path", "category_path_normalized", "category_path_depth", "dq_duplicate_category_path", "is_prefix_of_another_path", "dq_repeated_category_label", "maximal_path_count"]


def plain_flags(paths):
    clean = [[x.strip() for x in p] for p in paths]
    begins = lambda a, b: len(a) < len(b) and b[: len(a)] == a
    distinct = [p for i, p in enumerate(clean) if p not in clean[:i]]
    maximal = sum(not any(begins(p, q) for q in distinct) for p in distinct)
    return [(i + 1, raw, p, len(p), clean.count(p) > 1, any(begins(p, q) for q in clean), len(set(p)) < len(p), maximal) for i, (raw, p) in enumerate(zip(paths, clean, strict=True))]


def test_flags_against_plain_version(spark):
    rng = random.Random(3)
    owners = [[[rng.choice(["a", "b", " a", "c ", "é", ""]) for _ in range(rng.randint(1, 4))] for _ in range(rng.randint(1, 9))] for _ in range(300)]
    rows = [(i % 290, p) for i, p in enumerate(owners)] + [(1000, []), (1001, None)]  # several owners of one id
    got = P.category_paths(spark.createDataFrame(rows, PATHS), ["id"], "p").select("id", *FLAGS).collect()
    want = [(i % 290, *row) for i, p in enumerate(owners) for row in plain_flags(p)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_owner_of_very_many_paths(spark):
    """One owner with 20,000 different paths, half of which begin others, and one with 20,000 copies of one path."""
    many = [["shop", f"aisle {i}"] + ["shelf"] * (j + 1) for i in range(10_000) for j in range(2)]
    df = spark.createDataFrame([(1, many), (2, [["x", "y"]] * 20_000)], PATHS)
    began = time.monotonic()
    rows = P.category_paths(df, ["id"], "p").groupBy("id").agg(
        F.count("*"), F.count_if("is_prefix_of_another_path"), F.count_if("dq_duplicate_category_path"), F.max("maximal_path_count"), F.count_distinct("category_path_position")
    )
    assert sorted(map(tuple, rows.collect())) == [(1, 20_000, 10_000, 0, 10_000, 20_000), (2, 20_000, 0, 20_000, 1, 20_000)]
    assert time.monotonic() - began < 30


def test_paths_are_in_place(spark):
    plan = P.category_paths(spark.createDataFrame([(1, [["a"]])], PATHS), ["id"], "p")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_merged_sketches_keep_their_error(spark):
    """Sketches of 60 days, merged by any grouping, tell ranks within the stated error; sizes and bounds are exact."""
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.lognormal(size=20_000), np.full(10_000, 2.5), rng.normal(size=10_000) * 100])
    df = spark.createDataFrame([(int(i % 60), float(v)) for i, v in enumerate(values)], "day int, v double").repartition(7)
    daily = S.quantile_sketches(df, ["day"], "v")
    asked = {f"q{i}": i / 20 for i in range(1, 20)}
    by_part = {part: np.sort(values[(np.arange(len(values)) % 60) % 3 == part]) for part in range(3)} | {None: np.sort(values)}
    merged = daily.withColumn("part", F.col("day") % 3)
    merged = S.merged_sketches(merged, ["part"]).unionByName(S.merged_sketches(merged.withColumn("part", F.lit(None).cast("int")), ["part"]))
    found = S.told(merged, asked, ["part"]).collect()
    assert len(found) == 4
    for r in found:
        own = by_part[r.part]
        assert (r.n, r.least, r.greatest) == (len(own), own[0], own[-1])
        for name, q in asked.items():
            below, upto = np.searchsorted(own, r[name], "left") / len(own), np.searchsorted(own, r[name], "right") / len(own)
            assert below - 3 * S.rank_error() <= q <= upto + 3 * S.rank_error()


def test_few_values_are_exact_and_odd_ones_left_out(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 3.0), (1, 1.0), (1, 2.0), (1, None), (1, nan), (2, None), (2, nan), (None, 7.0), (None, 7.0)], "g int, v double")
    got = S.told(S.quantile_sketches(df, ["g"], "v"), {"median": 0.5}, ["g"]).collect()
    assert sorted(map(tuple, got), key=str) == [(1, 3, 1.0, 3.0, 2.0), (None, 2, 7.0, 7.0, 7.0)]
    assert S.quantile_sketches(df.limit(0), ["g"], "v").collect() == []


def test_exact_ranks_of_spans(spark):
    """Intervals of ranks tell a median that is off: what spans says is checked by counts, not taken on trust."""
    rows = [("a" if i % 2 else None, f"202{i % 3}-0{1 + i % 5}-01", float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, d string, v double").withColumn("d", F.col("d").cast("date"))
    points = S.spans(S.quantile_sketches(df, ["g", "d"], "v"), ["g"], "d", {"median": 0.5})
    got = {(r.g, r.span, str(r.span_start)): r for r in S.rank_intervals(df, ["g"], "d", "v", points, ["median"]).collect()}
    told = {(r.g, r.span, str(r.span_start)): r for r in points.collect()}
    assert got.keys() == told.keys() and len(got) == 2 * (15 + 3 + 1)
    for (g, span, start), r in got.items():
        own = [v for a, d, v in rows if a == g and (span == "all" or d[:4] == start[:4] and (span == "year" or d == start))]
        m = told[g, span, start]
        assert (m.n, m.least, m.greatest) == (len(own), min(own), max(own))
        assert r.median_below == pytest.approx(sum(v < m.median for v in own) / len(own)) and r.median_upto == pytest.approx(sum(v <= m.median for v in own) / len(own))
    off = points.withColumn("median", F.col("median") + 100)
    assert all(r.median_below > 0.6 for r in S.rank_intervals(df, ["g"], "d", "v", off, ["median"]).where("span = 'all'").collect())
