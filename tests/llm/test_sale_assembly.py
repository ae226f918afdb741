import datetime as dt
import random

import brute
import numpy as np
import pandas as pd
from conftest import SF

from granary.llm import sale_assembly as S
from granary.llm.common import pick

LINES = "sale_id long, line_no int, item_id long, vendor_id long, quantity int, amount double, discount double, flag string, shipped_at timestamp_ntz, AMOUNT int"
SALES = "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority int, Total string"


def by_text(rows):
    return sorted(map(tuple, rows), key=str)


def test_whole_tables(spark):
    lines, sales = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("sale_lines", "sales"))
    got = S.sale_assemblies(lines, sales)
    assert got.schema.simpleString() == "struct<sale_id:bigint,first_day:bigint,last_day:bigint,n_lines:bigint,cents:bigint,due:bigint,status:string,closing_batch:int>"
    want = brute.assemblies(map(tuple, pick(lines, *S.LINE).collect()), map(tuple, pick(sales, *S.SALE).collect()))
    assert by_text(got.collect()) == by_text(want)
    assert {r[6] for r in want} == {"complete", "headless", "orphan", "short", "over"}


def test_odd_rows(spark):
    """Null ids, numbers and times; broken amounts; repeated rows; sales twice; ids beyond what a double holds; days before and after the calendar."""
    rng, big = random.Random(3), (1 << 60) + 1
    when = lambda d: None if d is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    ids = [None, 1, 2, 3, 5, 8, big, big + 1]
    amounts = [None, float("nan"), float("inf"), -5.0, 0.0, 1.25, 99.99, 1e300]
    days = [None, -400, 0, 3, 17, 40, 41, 90, 159, 900]
    lines = [(rng.choice(ids), rng.choice([None, 1, 2, 3]), None, 1, None, rng.choice(amounts), 0.1, rng.choice("ab"), when(rng.choice(days)), 1) for _ in range(150)]
    sales = [(rng.choice(ids), None, "done", rng.choice(amounts), None, when(rng.choice(days)), 1, "x") for _ in range(25)]
    lines, sales = lines + lines[:20], sales + sales[:5]
    got = S.sale_assemblies(spark.createDataFrame(lines, LINES).repartition(3), spark.createDataFrame(sales, SALES)).collect()
    nan = lambda rows: [tuple("nan" if x != x else x for x in r) for r in rows]  # noqa: E731  equal to itself
    back = lambda rows: [tuple(float("nan") if x == "nan" else x for x in r) for r in dict.fromkeys(nan(rows))]
    assert by_text(got) == by_text(brute.assemblies([r[:9] for r in back(lines)], [r[:7] for r in back(sales)]))


def test_empty_tables_and_one_side(spark):
    none, one = spark.createDataFrame([], LINES), spark.createDataFrame([(7, 1, 1, 1, 1, 2.0, 0.0, "a", dt.datetime(2024, 2, 1), 1)], LINES)
    sales = spark.createDataFrame([], SALES)
    assert S.sale_assemblies(none, sales).collect() == []
    assert [tuple(r)[3:7] for r in S.sale_assemblies(one, sales).collect()] == [(1, 200, None, "headless")]


def test_a_sale_of_many_lines_reaches_its_bucket_as_one_row_a_day(spark):
    lines = spark.range(20_000).selectExpr("7L sale_id", "cast(id % 7 as int) line_no", "id item_id", "1L vendor_id", "1 quantity", "1.0D amount", "0.0D discount", "'a' flag", "timestamp_ntz '2024-01-20' shipped_at")
    sales = spark.createDataFrame([(7, 1, "done", 20_000.0, None, dt.datetime(2024, 1, 25), 1, "x")], SALES)
    rows = S.arrivals(lines, sales)
    assert rows.count() <= 8
    assert rows.agg({"n_lines": "sum"}).first()[0] == 20_000


def test_state_holds_what_is_open():
    rng = np.random.default_rng(0)
    rows = pd.DataFrame({"sale_id": rng.integers(0, 40, 200), "day": rng.integers(0, 5, 200), "n_lines": 1, "cents": rng.integers(0, 9, 200), "sold": rng.random(200) < 0.2, "due": rng.integers(0, 30, 200)})
    opened, _ = S.fold(S.Assemblies.none(np.zeros(0, np.int64)), S._daily(rows), 0)
    again = S.Assemblies.read(opened.write())
    for c in S.Assemblies.__dataclass_fields__:
        assert (getattr(again, c) == getattr(opened, c)).all()
    assert (np.diff(again.sale_id) > 0).all()
