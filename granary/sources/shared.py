"""Tables in the folder that driver and executors share: written once, read as often as needed, removed when the application ends.

A written table cuts the lineage: what stands before it runs once, and a lost executor costs the running tasks only.
"""

from __future__ import annotations

import atexit
import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: Used only where a local session names no shared folder, as in tests.
OWN_DIR = "/tmp/checkpoints"
_written: list[tuple[str, str | None]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only a local session may go without: on a cluster any other is another disk on each node."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (named or OWN_DIR).rstrip("/")


def _new(spark: SparkSession, label: str, table: str | None = None) -> str:
    path = f"{shared_dir(spark)}/granary-{label}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(clear)
    _written.append((path, table))
    return path


def clear(spark: SparkSession | None = None) -> None:
    """Delete all of these tables; frames that still read them can't be computed after this."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path, table = _written.pop()
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        path = jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(conf).delete(path, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """df, computed once into a table of the shared folder."""
    path = _new(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


LAYOUT = "_layout.json"


def write_layout(df: DataFrame, by: Sequence[str], order: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """df as a table in buckets of the columns `by`, one sorted file each; aggregates, windows and joins by these columns
    (and further ones) read it without a shuffle.

    Without a path it goes to the shared folder. What the buckets are is written beside the files for open_layout.
    """
    spark, name = df.sparkSession, f"granary_layout_{uuid.uuid4().hex}"
    path = path or _new(spark, "layout", name)
    # The exchange deals rows as the buckets do, so that a bucket is one task's and one file.
    rows = df.repartition(buckets, *by)
    rows.write.bucketBy(buckets, *by).sortBy(*order).option("path", path).option("compression", "zstd").saveAsTable(name)
    said = {"by": list(by), "order": list(order), "buckets": buckets, "schema": json.loads(df.schema.json())}
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/{LAYOUT}")
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(json.dumps(said).encode()))
    finally:
        out.close()
    return spark.table(name)


def open_layout(spark: SparkSession, path: str) -> DataFrame:
    """A table that write_layout wrote, with its buckets, in a session whose catalog doesn't know it."""
    from pyspark.sql.types import StructType

    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/{LAYOUT}")
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        said = json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()
    name = f"granary_layout_{uuid.uuid4().hex}"
    quoted = lambda names: ", ".join(f"`{n}`" for n in names)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(said["schema"]))
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({quoted(said['by'])}) SORTED BY ({quoted(said['order'])}) INTO {said['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)
