import pytest
from conftest import SF

import __spark_entry__ as entry
from granary import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_oracle(spark, same_as_sql, name):
    same_as_sql(catalog.QUERIES[name](spark, SF), catalog.ORACLES[name])


def test_entry(spark):
    assert entry.entry(spark).count() == 2
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_fingerprint_ignores_order_and_layout(spark):
    from granary.plans.fingerprint import fingerprint

    df = spark.read.parquet(f"{SF}/orders.parquet")
    assert fingerprint(df).first() == fingerprint(df.repartition(7).select(*reversed(df.columns))).first()
    assert fingerprint(df).first() != fingerprint(df.where("o_orderkey > 1")).first()


def test_fingerprint_tells_where_a_null_stands(spark):
    from granary.plans.fingerprint import fingerprint

    a, b = (spark.createDataFrame(rows, "x int, y int") for rows in ([(1, None)], [(None, 1)]))
    assert fingerprint(a).first() != fingerprint(b).first()
    assert fingerprint(a.limit(0)).first()["rows"] == 0
