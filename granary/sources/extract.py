"""Snapshots of source tables: read once, written whole, and never replaced in part."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from granary.plans.publish import Job, Published, PublishError, current, load, publish
from granary.sources.tables import read_jdbc


def jdbc_readers(spark: SparkSession, url: str, tables: dict[str, str], properties: dict[str, str], timeout_s: int = 600) -> dict[str, Callable[[], DataFrame]]:
    """A read-only reader for each table: name -> table in the database."""
    return {name: lambda table=table: read_jdbc(spark, url, table, properties, timeout_s) for name, table in tables.items()}


def snapshot(spark: SparkSession, target: str, readers: dict[str, Callable[[], DataFrame]], replace: bool = False) -> dict:
    """Read every source and publish all of them, or none; an existing snapshot is kept unless it is to be replaced.

    Rows are counted in the written tables; the manifest holds counts, schemas and fingerprints.
    """
    if current(spark, target) and not replace:
        raise PublishError(f"{target} holds a snapshot")
    return publish(spark, target, {}, [Job(name, lambda _, read=read: read()) for name, read in readers.items()], code="snapshot")


def open_snapshot(spark: SparkSession, target: str, found: Published | None = None) -> dict[str, DataFrame]:
    """The tables, if none was changed since."""
    return load(spark, target, "snapshot", found=found)
