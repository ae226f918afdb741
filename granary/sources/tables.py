"""Reading and writing tables: Parquet, JDBC, literal rows, sorted and verified sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from granary.operators.contracts import ContractError


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Named views for SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def literal(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def describe_files(df: DataFrame) -> dict:
    """Schema and row count; a count of Parquet reads no column."""
    return {"rows": df.count(), "columns": [[f.name, f.dataType.simpleString(), f.nullable] for f in df.schema]}


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str], timeout_s: int = 60, partition: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A read-only scan with a time limit for each statement. partition: column, lower and upper bound, number of reads."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("queryTimeout", timeout_s).option("readOnly", "true").options(**properties)
    if partition:
        column, lower, upper, n = partition
        reader = reader.option("partitionColumn", column).option("lowerBound", lower).option("upperBound", upper).option("numPartitions", n)
    return reader.load()


#: A catalog's own estimate of each table's rows and size, of one kind of database.
CATALOG_QUERY = "SELECT relname AS table_name, reltuples::bigint AS estimated_rows, pg_total_relation_size(oid) AS bytes FROM pg_class WHERE relkind = 'r'"


def read_catalog(spark: SparkSession, url: str, properties: dict[str, str], query: str = CATALOG_QUERY, timeout_s: int = 60) -> DataFrame:
    """What the database says of its own tables, without a scan of any; the query runs there."""
    return spark.read.format("jdbc").option("url", url).option("query", query).option("queryTimeout", timeout_s).options(**properties).load()


def write_verified(df: DataFrame, path: str, key: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """Write, read back, and compare rows and the key's uniqueness with what was written.

    Rows are counted as they pass the writer; the order is by ranges over many files, never in one task.
    """
    from pyspark.sql import Observation

    seen = Observation()
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    # Behind the exchange: what stands before it is read once more for the bounds of the ranges.
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    n = back.count()
    if n != seen.get["n"]:
        raise ContractError(f"{path}: {n} rows read back of {seen.get['n']}")
    if key and not back.groupBy(*key).count().where("count > 1").isEmpty():
        raise ContractError(f"{path}: key {list(key)} is repeated")
    return back


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows as often."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
