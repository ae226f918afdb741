"""Statistics of Parquet sets from their footers: rows, nulls, least and greatest values, without a scan of data.

Spark answers aggregates of whole columns from the footers where its newer reader is asked to; executors open the files, in any
store that Spark reads. The statistics are one row a column, so they pass the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What footers hold least and greatest values of that Spark takes from there.
NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
TIMES = (T.TimestampType, T.TimestampNTZType)
ORDERED = (*NUMBERS, *TIMES, T.DateType)
NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
SCHEMA = "column_name string, rows long, null_rows long, least double, greatest double, first_time timestamp_ntz, last_time timestamp_ntz, from_footers boolean"



def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _counts(fields: Sequence[T.StructField]) -> list[Column]:
    return [F.count("*").alias("rows"), *(F.count(_quoted(f.name)).alias(f"count {f.name}") for f in fields)]


def _bounds(fields: Sequence[T.StructField]) -> list[Column]:
    """Least and greatest value of each of the columns that have an order here."""
    return [g(_quoted(f.name)).alias(f"{p} {f.name}") for f in fields if isinstance(f.dataType, ORDERED) for p, g in (("min", F.min), ("max", F.max))]


def _split(schema: T.StructType) -> tuple[list[T.StructField], list[T.StructField]]:
    """Columns before the first nested one, and the flat ones behind it: Spark finds a column in a footer by its place, which nested ones shift."""
    first = next((i for i, f in enumerate(schema) if isinstance(f.dataType, NESTED)), len(schema))
    return list(schema[:first]), [f for f in schema[first:] if not isinstance(f.dataType, NESTED)]


def footer_reader(spark: SparkSession, path: str, lead: Sequence[T.StructField]) -> DataFrame:
    """The leading columns of a set in a session of its own, which plans aggregates of whole columns from footers. Times are whole numbers in the files and are asked for as such."""
    own = spark.newSession()  # these settings would change the plans of all other reads
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    stored = T.StructType([T.StructField(f.name, T.LongType() if isinstance(f.dataType, TIMES) else f.dataType) for f in lead])
    return own.read.schema(stored).parquet(path)


def footer_aggregate(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One row with the counts of the leading flat columns and the bounds of those that have some."""
    lead, _ = _split(schema or spark.read.parquet(path).schema)
    return footer_reader(spark, path, lead).agg(*_counts(lead), *_bounds(lead))


def _scanned(spark: SparkSession, path: str, schema: T.StructType, fields: Sequence[T.StructField]) -> dict:
    """Counts and bounds of columns from their values; times as microseconds."""

    def stored(f: T.StructField) -> Column:
        c = _quoted(f.name)
        if isinstance(f.dataType, T.TimestampNTZType):  # the session's zone must not show
            c = F.convert_timezone(F.lit("UTC"), F.current_timezone(), c).cast("timestamp")
        return F.unix_micros(c) if isinstance(f.dataType, TIMES) else c

    df = spark.read.schema(schema).parquet(path).select(*(stored(f).alias(f.name) for f in fields))
    return df.agg(*_counts(fields), *_bounds(fields)).first().asDict()


def file_statistics(spark: SparkSession, path: str, schema: T.StructType | None = None, ticks: int = 1_000_000) -> DataFrame:
    """A row for each column of a Parquet set that is not nested.

    The files must have the same columns in one order, as a write leaves them, since Spark takes a footer's column by place. least
    and greatest: of numbers, as doubles (beyond 2^53 the nearest one), without the sign of a zero; first_time and
    last_time: of dates and times. Texts have rows and nulls only, as writers cut their bounds. Columns behind a nested
    one, and those of which a footer lacks the bounds (a row group of nulls only, NaN among the values, times of 96 bits), are
    scanned, without the others, and their from_footers is false. A set without rows has zeros and nulls. ticks: of the
    files' times in a second; footers don't tell Spark, so files of milliseconds have to be named as such.
    """
    schema = schema or spark.read.parquet(path).schema
    lead, scanned = _split(schema)
    df, said = footer_reader(spark, path, lead), {}
    if lead:
        try:
            said = footer_aggregate(spark, path, schema).first().asDict()
        except (Py4JJavaError, PySparkException):  # the reader fails where a footer lacks a bound: which columns?
            said = df.agg(*_counts(lead)).first().asDict()
            for f in lead:
                if said[f"count {f.name}"] and isinstance(f.dataType, ORDERED):
                    try:
                        said |= df.agg(*_bounds([f])).first().asDict()
                    except (Py4JJavaError, PySparkException):
                        scanned.append(f)
    if scanned:
        said |= _scanned(spark, path, schema, scanned)
    n, rows = said["rows"] or 0, []  # files without a row group add up to null
    for f in [f for f in schema if f in lead or f in scanned]:
        lo, hi, number = said.get(f"min {f.name}"), said.get(f"max {f.name}"), isinstance(f.dataType, NUMBERS)
        own = 1_000_000 if f in scanned else ticks
        numbers = (float(lo) + 0.0, float(hi) + 0.0) if number and lo is not None else (None, None)
        times = (_moment(lo, own), _moment(hi, own)) if not number and lo is not None else (None, None)
        rows.append((f.name, n, n - (said[f"count {f.name}"] or 0), *numbers, *times, f not in scanned))
    return spark.createDataFrame(rows, SCHEMA)


def _moment(v: date | int, ticks: int) -> datetime:
    """A date, or ticks since 1970, as a time."""
    return datetime(1970, 1, 1) + timedelta(microseconds=v * 1_000_000 // ticks) if isinstance(v, int) else datetime(v.year, v.month, v.day)
