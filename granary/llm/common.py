"""Reading, column picking and durable intermediate tables shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Used only where the session names no shared folder, as in tests.
OWN_CHECKPOINT_DIR = "/tmp/checkpoints"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Paths of intermediate tables, and the names of those that the catalog knows, in the order of their writing.
_staged: list[tuple[str, str | None]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The columns of these names, in this order, and no others.

    Columns are found by position, first by exact name and then regardless of case, so that further
    columns whose names differ only in case do not make a reference ambiguous.
    """
    at = []
    for name in names:
        exact = [i for i, c in enumerate(df.columns) if c == name]
        loose = [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
        if not exact and not loose:
            raise ValueError(f"no column {name!r} among {df.columns}")
        at.append((exact or loose)[0])
    own = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    return own.select(*(F.col(f"_c{i}").alias(name) for i, name in zip(at, names, strict=True)))


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, all else as it is; null stays null.

    lower() is several times faster than translate(), and the same where each character is one byte.
    """
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def fold(c: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo mod; null ids count as the empty text."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % mod


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local session may go without naming one: on a cluster it would be another disk on each node."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (named or OWN_CHECKPOINT_DIR).rstrip("/")


def new_path(spark: SparkSession, label: str, name: str | None = None) -> str:
    """A fresh path in the shared folder, removed when the application ends, or by discard()."""
    path = f"{shared_dir(spark)}/granary-{label}-{uuid.uuid4().hex}"
    if not _staged:
        atexit.register(clear_staged)
    _staged.append((path, name))
    return path


def mark() -> int:
    """How many intermediate tables there are; discard() takes it to know those of later on."""
    return len(_staged)


def discard(spark: SparkSession, since: int, *keep: DataFrame) -> None:
    """Delete the intermediate tables written since a mark, but for those given; nothing unwritten may still read the others."""
    kept = {getattr(df, "_granary_path", None) for df in keep}
    gone = [x for x in _staged[since:] if x[0] not in kept]
    _staged[since:] = [x for x in _staged[since:] if x[0] in kept]
    _delete(spark, gone)


def collect_garbage(spark: SparkSession) -> None:
    """Have the driver forget plans that are done with, so that Spark removes their shuffle files: it does when they are collected, which else may be long after.

    Twice, as what the first round frees may hold more; the files go in the background meanwhile.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def _delete(spark: SparkSession, tables: list[tuple[str, str | None]]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path, name in tables:
        if name:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        path = jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(conf).delete(path, True)


def clear_staged(spark: SparkSession | None = None) -> None:
    """Delete all intermediate tables; results that still read them can't be computed after this."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    try:
        discard(spark, 0)
    except Exception:  # the JVM may be gone at exit
        return


#: Tasks, and so files, of an intermediate table: for each core of the cluster at least, and shuffle partitions that one takes.
TASKS_PER_CORE, PARTITIONS_PER_TASK = 4, 8


def few_files(df: DataFrame) -> DataFrame:
    """df in fewer partitions, without a shuffle; a task takes its partitions one after the other.

    Tables of few rows else leave a file for every shuffle partition, and every file costs the executor calls to the store.
    The number goes with the session's shuffle partitions, which are set for the size of the data.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, partitions // PARTITIONS_PER_TASK))


def release_memory() -> None:
    """Give what a Python worker has freed back to the system: it lives on, beside the executor, through later tasks."""
    pyarrow.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # only glibc has it
        trim(0)


def lengths(texts: pd.Series) -> pd.Series:
    """Characters of each text, 0 for null."""
    return texts.map(lambda t: len(t) if isinstance(t, str) else 0).astype("int64")


class Pool:
    """Gathers rows into frames of about `limit` bytes, whatever the batches that they come in."""

    def __init__(self, limit: int):
        self.limit, self.held, self.room = limit, [], limit

    def add(self, rows: pd.DataFrame, sizes: np.ndarray) -> Iterator[pd.DataFrame]:
        ends, start = np.concatenate(([0], np.cumsum(sizes))), 0
        while start < len(rows):
            stop = int(np.searchsorted(ends, ends[start] + self.room, side="right")) - 1
            if stop <= start and not self.held:
                stop = start + 1  # a row over the limit is a frame of its own
            if stop > start:
                self.held.append(rows.iloc[start:stop])
                self.room -= int(ends[stop] - ends[start])
            if stop < len(rows):
                yield from self.rest()
            start = max(start, stop)

    def rest(self) -> Iterator[pd.DataFrame]:
        if self.held:
            yield pd.concat(self.held, ignore_index=True) if len(self.held) > 1 else self.held[0]
        self.held, self.room = [], self.limit


def pooled(batches: Iterator[pd.DataFrame], size: Callable[[pd.DataFrame], pd.Series], limit: int) -> Iterator[pd.DataFrame]:
    """The rows of all batches in frames of about `limit` bytes."""
    pool = Pool(limit)
    for batch in batches:
        if len(batch):
            yield from pool.add(batch, size(batch).to_numpy())
    yield from pool.rest()


def root_sized(least: int, most: int, size: float, unit: float) -> int:
    """`least` up to a size of `unit`, growing with the square root of the size beyond it, `most` at most.

    Chunks of documents and ranges of hashes that both grow so keep the number of messages between them in proportion to
    the input; at `most` of both, a chunk sends a message to no range that it has nothing for, so one for each distinct key at most.
    """
    return int(min(most, max(least, least * (size / unit) ** 0.5)))


#: Size of ids and texts, as the optimizer estimates it (a fraction of the texts' bytes), from which chunks grow.
UNIT_BYTES = 40 << 20


def input_bytes(df: DataFrame) -> float:
    """The optimizer's estimate of df's size, from its files; no job. It sets the size of chunks only, never a result."""
    return float(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def new_id() -> int:
    """A random positive long: unique also where one task runs a function over several partitions."""
    return uuid.uuid4().int >> 65


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = new_path(df.sparkSession, label)
    few_files(df).write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._granary_path = path
    return out


def stage_by(df: DataFrame, key: str, label: str) -> DataFrame:
    """Like stage, but laid out in buckets of key, so that grouping and joining by key moves only the other side."""
    spark, name = df.sparkSession, f"granary_{label}_{uuid.uuid4().hex}"
    path = new_path(spark, label, name)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    few_files(df).write.bucketBy(n, key).option("path", path).option("compression", "zstd").saveAsTable(name)
    out = spark.table(name)
    out._granary_path = path
    return out


def shielded(df: DataFrame, *names: str) -> DataFrame:
    """All columns of df in their order, the named ones under these names and each other one under a name that clashes with nothing.

    The result of an operator over it gets df's names back by toDF(*df.columns).
    """
    at = {}
    for name in names:
        exact = [i for i, c in enumerate(df.columns) if c == name]
        at[(exact or [i for i, c in enumerate(df.columns) if c.lower() == name.lower()])[0]] = name
    return df.toDF(*(at.get(i, f"_column_{i}") for i in range(len(df.columns))))


def integer_names(df: DataFrame, keys: list[str], name: str, label: str) -> DataFrame:
    """Distinct keys with one integer each, in the order of the sorted keys, as a written table.

    Rows are range-partitioned and sorted; a row's name is its partition's number and its place there,
    so names are unique without one task seeing all rows. Writing them pins the numbering.
    """
    sorted_keys = df.select(*keys).distinct().repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stage(sorted_keys.withColumn(name, F.monotonically_increasing_id()), label)


#: Ids that are sent to every task at most; more go by a shuffle.
BROADCAST_IDS = 1_000_000


def without(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of df whose key is not among ids (distinct, of one column named key). Rows with a null key stay."""
    ids = stage(ids, "ids")
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, "left_anti")
