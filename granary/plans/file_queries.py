"""Queries over the files of tables, and over two versions of one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.hash_tree import changed_rows
from granary.plans.registry import Tables, query
from granary.sources.footers import file_statistics as statistics

#: Columns of the tables: numbers, times, texts.
_COLUMNS = {
    "lineitem": (["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"], ["l_shipdate"], ["l_returnflag", "l_linestatus"]),
    "orders": (["o_orderkey", "o_custkey", "o_totalprice"], ["o_orderdate"], ["o_orderstatus", "o_orderpriority"]),
    "clicks": (["click_id", "client_id", "value"], ["ts", "arrived_at"], ["kind", "props"]),
}
_NO_NUMBER, _NO_TIME = "NULL::DOUBLE AS least, NULL::DOUBLE AS greatest", "NULL::TIMESTAMP AS first_time, NULL::TIMESTAMP AS last_time"


def _column_sql(table: str, column: str, kind: int) -> str:
    number = f"(CASE WHEN min({column}) = 0 THEN 0 ELSE min({column}) END)::DOUBLE AS least, (CASE WHEN max({column}) = 0 THEN 0 ELSE max({column}) END)::DOUBLE AS greatest" if kind == 0 else _NO_NUMBER
    time = f"min({column})::TIMESTAMP AS first_time, max({column})::TIMESTAMP AS last_time" if kind == 1 else _NO_TIME
    return f"SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS rows, count(*) - count({column}) AS null_rows, {number}, {time} FROM {table}"


@query(" UNION ALL ".join(_column_sql(t, c, kind) for t, kinds in _COLUMNS.items() for kind, columns in enumerate(kinds) for c in columns))
def file_statistics(t: Tables) -> DataFrame:
    """Rows, nulls and bounds of the columns of three tables, from their footers."""
    out = None
    for name in _COLUMNS:
        own = statistics(t.spark, f"{t.sf_dir}/{name}.parquet").select(F.lit(name).alias("table_name"), "*").drop("from_footers")
        out = own if out is None else out.unionByName(own)
    return out


@query("""WITH b AS (SELECT o_orderkey + CASE WHEN o_orderkey % 5003 = 17 THEN 1000000000 ELSE 0 END AS o_orderkey, o_totalprice + CASE WHEN o_orderkey % 4001 = 5 THEN 1 ELSE 0 END AS o_totalprice FROM orders WHERE o_orderkey % 7001 <> 9)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change, (a.o_orderkey IS NOT NULL)::BIGINT AS a_rows, (b.o_orderkey IS NOT NULL)::BIGINT AS b_rows
FROM orders a FULL JOIN b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_totalprice <> b.o_totalprice""")
def version_differences(t: Tables) -> DataFrame:
    """Orders against a version of them with rows changed, taken away and moved to other keys."""
    key, rest = F.col("o_orderkey"), [c for c in t.orders.columns if c not in ("o_orderkey", "o_totalprice")]
    moved = key + F.when(key % 5003 == 17, F.lit(1_000_000_000)).otherwise(F.lit(0))
    price = F.col("o_totalprice") + F.when(key % 4001 == 5, 1.0).otherwise(0.0)
    after = t.orders.where(key % 7001 != 9).select(moved.alias("o_orderkey"), price.alias("o_totalprice"), *rest)
    return changed_rows(t.orders, after, "o_orderkey", shift=6)
