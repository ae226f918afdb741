"""Whitening of embedding vectors by the principal components of their covariance.

A first pass sums whole numbers, so the mean is exact however rows are dealt out. A second pass centres the rows and
multiplies them batch by batch (GEMM); each task returns one matrix and treeAggregate adds them up in several levels.
What is left on the driver is one symmetric matrix, whose size is that of the vectors and not of the table. The
projection is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import pick, table

COMPONENTS = 32
#: x = floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Entries of a larger size have no x: their sums would leave what is exact.
MOST = float(1 << 52)
#: Partial matrices that one task adds up.
FAN_IN = 32
#: Rows of one multiplication; a task's rows are spread over as many.
BLOCK_ROWS = 4096
_LOW = np.int64((1 << 31) - 1)


@dataclass(frozen=True)
class Whitening:
    """n vectors with the sums `sums` of each dimension; components in columns, over the roots of their eigenvalues.

    explained: each eigenvalue over the trace of the covariance. identity_error: how far the covariance of the
    whitened vectors is from the identity.
    """

    n: int
    sums: tuple[int, ...]
    projection: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n: whole parts are taken off as integers, so nothing is lost to rounding large numbers."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], float) / self.n
        return (x - whole) - rest

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """sum((n * x - sums) ** 2) exactly; None where a long does not hold it."""
        if not len(x):
            return []
        if self.n * int(np.abs(x).max()) + max(map(abs, self.sums)) < 1 << 62:
            d = self.n * x - np.array(self.sums, np.int64)
            if int(np.abs(d).max()) ** 2 * d.shape[1] < 1 << 63:
                return (d * d).sum(axis=1).tolist()
        found = (sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist())
        return [d if d < 1 << 63 else None for d in found]


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, vector (of double) of the rows whose vector is there, has entries, and all of them finite and below MOST."""
    rows = pick(df, id_col, vector_col).toDF("vec_id", "vector").withColumn("vector", F.col("vector").cast("array<double>"))
    odd = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) * SCALE >= MOST))
    return rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & ~odd)


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows of d entries in blocks of BLOCK_ROWS at most, with their x."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            rows = batch.slice(at, BLOCK_ROWS)
            c = pc.list_flatten(rows.column("vector")).to_numpy(zero_copy_only=False).reshape(-1, d)
            yield rows, np.floor(SCALE * c).astype(np.int64) + SHIFT


def _sum_matrices(df: DataFrame, name: str) -> np.ndarray:
    """The sum of the arrays of doubles in one column, added up in levels of FAN_IN at most."""
    arrays = df.select(name).rdd.map(lambda r: np.frombuffer(r[0]))
    depth = max(2, int(np.ceil(np.log(max(2, arrays.getNumPartitions())) / np.log(FAN_IN))))
    return arrays.treeAggregate(None, lambda a, b: b.copy() if a is None else a + b, lambda a, b: b if a is None else a if b is None else a + b, depth)


def _means(rows: DataFrame, of, d: int, width: int) -> np.ndarray:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 1)
        for _, x in _blocks(batches, d):
            y = of(x)
            total += np.append(y.sum(axis=0), len(y))
        yield pa.RecordBatch.from_pydict({"total": [total.tobytes()]})

    total = _sum_matrices(rows.mapInArrow(add, "total binary"), "total")
    return total[:-1] / total[-1]


def _covariance(rows: DataFrame, of, d: int, width: int, mean: np.ndarray, n: int) -> np.ndarray:
    """Covariance of of(x), centred at mean before it is multiplied; divisor n."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((width, width))
        for _, x in _blocks(batches, d):
            y = of(x) - mean
            gram += y.T @ y
        yield pa.RecordBatch.from_pydict({"gram": [gram.tobytes()]})

    return _sum_matrices(rows.mapInArrow(multiply, "gram binary"), "gram").reshape(width, width) / n


def _exact_sums(rows: DataFrame, d: int) -> tuple[int, tuple[int, ...]]:
    """How many rows, and the sum of x in each dimension, as whole numbers of any size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for _, x in _blocks(batches, d):
            n, high, low = n + len(x), high + (x >> 31).sum(axis=0), low + (x & _LOW).sum(axis=0)
        out = {"at": np.arange(d, dtype=np.int32), "n": np.full(d, n), "high": high, "low": low}
        yield pa.RecordBatch.from_pydict(out)

    found = rows.mapInArrow(add, "at int, n long, high long, low long").groupBy("at").agg(*(F.sum(c).alias(c) for c in ("n", "high", "low")))
    by = sorted(found.collect())  # one row for each dimension
    return by[0]["n"], tuple((r["high"] << 31) + r["low"] for r in by)


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitening] | None:
    """The rows that count, of one length, and their whitening; None where there are none.

    The length is that of most rows, the greater one of equally frequent ones.
    """
    by_length = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = by_length.agg(F.max(F.struct("n", "d")).alias("most")).first()["most"]
    if most is None:
        return None
    d = most["d"]
    rows = rows.where(F.size("vector") == d)
    n, sums = _exact_sums(rows, d)
    exact = Whitening(n, sums, np.zeros((d, 0)), np.zeros(0))
    v = _covariance(rows, exact.centred, d, d, np.zeros(d), n)
    e, unit = np.linalg.eigh((v + v.T) / 2)
    e, unit = e[::-1], unit[:, ::-1]
    # What is below the rounding of the largest is no direction that the vectors have.
    k = min(components, int((e > max(e[0], 0) * d * np.finfo(float).eps).sum()))
    whitening = Whitening(n, sums, unit[:, :k] / np.sqrt(e[:k]), e[:k] / np.trace(v))
    if not k:
        return rows, whitening
    whitened = lambda x: whitening.centred(x) @ whitening.projection
    again = _covariance(rows, whitened, d, k, _means(rows, whitened, d, k), n)
    error = float(np.abs(again - np.eye(k)).max())
    return rows, Whitening(n, sums, whitening.projection, whitening.explained, error)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each row and component.

    Dropped are rows whose vector is null, empty, or has null, non-finite or enormous (MOST) entries, and those whose
    vector has another length than most. Rows with a null id, repeated rows and equal vectors count and are returned
    each. Where vectors span fewer directions than `components` there are only as many components; vectors that are all
    equal have none, so no rows. Other columns are ignored; an empty table gives no rows. deviation is null where a
    long does not hold it. Vectors are bounded by what a driver holds of their squared length.
    """
    spark = df.sparkSession
    id_type = pick(df, id_col).schema[0].dataType
    schema = f"vec_id {id_type.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fitted = fit_whitening(usable(df, id_col, vector_col), components)
    if fitted is None:
        return spark.createDataFrame([], schema)
    rows, whitening = fitted
    d, shared = len(whitening.sums), spark.sparkContext.broadcast(whitening)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        k = w.projection.shape[1]
        for some, x in _blocks(batches, d):
            every = pa.array(np.repeat(np.arange(len(x)), k))
            out = {
                "vec_id": some.column("vec_id").take(every),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                "n": pa.array(np.full(len(x) * k, w.n)),
                "deviation": pa.array(w.deviation(x), pa.int64()).take(every),
                "whitened": pa.array((w.centred(x) @ w.projection).ravel()),
                "explained": pa.array(np.tile(w.explained, len(x))),
                "identity_error": pa.array(np.full(len(x) * k, w.identity_error)),
            }
            yield pa.RecordBatch.from_pydict(out)

    return rows.mapInArrow(project, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
