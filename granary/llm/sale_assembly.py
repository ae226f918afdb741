"""When the rows of a sale that arrive day by day are all there: a stateful stream over batches of days.

What arrives of a sale on a day is summed up before anything is shuffled by sale, so a sale has one row a day at most,
however many lines it has. Sales are dealt into hash buckets, and a bucket is one key of applyInPandasWithState: its
state is the table of its open assemblies, as one compressed Arrow stream. Each batch brings one tick row for every
bucket, with the largest day of the batches before it; so a bucket closes what is overdue also where nothing arrives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from granary.llm.common import few_files, new_path, pick, stage, table

BATCHES = 10
#: Days since 1970: the first of the calendar, and how many it has.
FIRST_DAY, DAYS = 19723, 160
#: An assembly closes when so many days have passed since its first.
PATIENCE = 10
#: Lines are said to arrive up to so many days after they were shipped; those never shipped, on one of so many days.
DELAY, UNSHIPPED = 15, 152
#: Rows of all batches that one bucket has, about; buckets for each shuffle partition, at least.
ROWS_PER_BUCKET, LEAST_PER_PARTITION = 25_000, 2

LINE = ("sale_id", "line_no", "item_id", "vendor_id", "quantity", "amount", "discount", "flag", "shipped_at")
SALE = ("sale_id", "client_id", "status", "total", "sold_at", "arrived_at", "priority")
#: No column is ever null, so that all of them reach Python as whole numbers. sold: the row is the sale itself, and has its due.
EVENT = "sale_id long, day long, n_lines long, cents long, sold boolean, due long, batch int"
#: kind: what arrived, or a tick, or the tick after which all close.
TICK = "bucket long, kind int, prior long"
ROW, MORE, LAST = 0, 1, 2
#: The largest day of no batches.
NO_DAY = -(1 << 62)
CLOSING = "sale_id long, first_day long, last_day long, n_lines long, cents long, due long, status string, closing_batch int"


def cents(amount: Column) -> Column:
    """floor(100 * amount + 0.5); null and what is no number that a long holds are 0."""
    sound = F.abs(amount) < F.lit(9e16)
    return F.when(sound & ~F.isnan(amount), F.floor(100 * amount + 0.5).cast("long")).otherwise(F.lit(0).cast("long"))


def day_of(t: Column) -> Column:
    return F.unix_date(t.cast("date")).cast("long")


def _crc(*parts: Column) -> Column:
    return F.crc32(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)).cast("binary"))


def batch_of(day: Column) -> Column:
    at = F.floor((day - FIRST_DAY) * BATCHES / F.lit(float(DAYS)))
    return F.least(F.greatest(at, F.lit(0)), F.lit(BATCHES - 1)).cast("int")


def sale_days(lines: DataFrame) -> DataFrame:
    """sale_id, day, n_lines, cents: what arrives of a sale's distinct lines on a day."""
    lines = pick(lines, *LINE).where("sale_id is not null").distinct()
    h = _crc(F.col("sale_id"), F.col("line_no"))
    day = F.coalesce(day_of(F.col("shipped_at")) + h % DELAY, FIRST_DAY + h % UNSHIPPED)
    own = lines.select(F.col("sale_id").cast("long"), day.alias("day"), cents(F.col("amount")).alias("cents"))
    return own.groupBy("sale_id", "day").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("cents").alias("cents"))


def sales_due(sales: DataFrame, days: DataFrame) -> DataFrame:
    """sale_id, day, due of each distinct sale: the cents its assembly has to reach, by the crc32 of its id."""
    sales = pick(sales, *SALE).where("sale_id is not null").distinct()
    own = sales.select(
        F.col("sale_id").cast("long"), F.coalesce(day_of(F.col("arrived_at")), F.lit(FIRST_DAY)).cast("long").alias("day"), cents(F.col("total")).alias("total")
    )
    sums = days.groupBy("sale_id").agg(F.sum("cents").alias("all"), F.max_by("cents", "day").alias("at_last"))
    every = F.coalesce("all", F.lit(0))
    due = F.when(F.col("kind") == 0, F.col("total")).when(F.col("kind") == 1, every - F.coalesce("at_last", F.lit(0))).otherwise(every)
    own = own.withColumn("kind", _crc(F.col("sale_id")) % 5)
    return own.join(sums, "sale_id", "left").select("sale_id", "day", due.cast("long").alias("due"))


def arrivals(lines: DataFrame, sales: DataFrame) -> DataFrame:
    """The rows of all batches, as a written table by batch: of each sale and day its lines, and its sale."""
    days = stage(sale_days(lines), "days")
    none = F.lit(0).cast("long")
    heads = sales_due(sales, days).withColumns({"n_lines": none, "cents": none, "sold": F.lit(True)})
    rows = days.withColumns({"sold": F.lit(False), "due": none}).unionByName(heads).withColumn("batch", batch_of(F.col("day")))
    path = new_path(lines.sparkSession, "arrivals")
    few_files(rows).write.partitionBy("batch").parquet(path)
    return lines.sparkSession.read.schema(EVENT).parquet(path)


@dataclass
class Assemblies:
    """Open assemblies of a bucket as columns, in the order of sale_id, one of each; sold: whether its sale is there."""

    sale_id: np.ndarray
    first_day: np.ndarray
    last_day: np.ndarray
    n_lines: np.ndarray
    cents: np.ndarray
    due: np.ndarray
    sold: np.ndarray

    @classmethod
    def none(cls, sale_id: np.ndarray) -> Assemblies:
        """Nothing yet of each of these sales; a row without a first day (-1 lines) isn't open."""
        zeros = lambda: np.zeros(len(sale_id), np.int64)
        return cls(sale_id, zeros(), zeros(), zeros() - 1, zeros(), zeros(), np.zeros(len(sale_id), bool))

    @classmethod
    def read(cls, raw: bytes) -> Assemblies:
        with pa.ipc.open_stream(raw) as source:
            t = source.read_all()
        return cls(*(t.column(c).to_numpy() for c in cls.__dataclass_fields__))

    def write(self) -> bytes:
        batch = pa.RecordBatch.from_pydict({c: getattr(self, c) for c in self.__dataclass_fields__})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    def take(self, at: np.ndarray) -> Assemblies:
        return Assemblies(*(getattr(self, c)[at] for c in self.__dataclass_fields__))

    def put(self, at: np.ndarray, rows: Assemblies) -> None:
        for c in self.__dataclass_fields__:
            getattr(self, c)[at] = getattr(rows, c)

    @property
    def complete(self) -> np.ndarray:
        return self.sold & (self.n_lines > 0) & (self.cents == self.due)

    def closed(self, status: str | np.ndarray, batch: int) -> pd.DataFrame:
        out = {c: getattr(self, c) for c in ("sale_id", "first_day", "last_day", "n_lines", "cents")}
        due = pd.Series(self.due).astype("Int64").where(self.sold)
        return pd.DataFrame(out | {"due": due, "status": status, "closing_batch": np.full(len(self.sale_id), batch, np.int32)})

    def verdict(self) -> np.ndarray:
        """The status of those that close without being complete."""
        return np.select([~self.sold, self.n_lines == 0, self.cents < self.due], ["headless", "orphan", "short"], "over").astype(object)


def _daily(rows: pd.DataFrame) -> Assemblies:
    """One row for each sale and day, by sale and then day: segmented sums over the sorted rows. Of several sales' dues, the least."""
    sale_id, day = rows["sale_id"].to_numpy(np.int64), rows["day"].to_numpy(np.int64)
    order = np.lexsort((day, sale_id))
    sale_id, day = sale_id[order], day[order]
    at = np.flatnonzero(np.concatenate(([True], (sale_id[1:] != sale_id[:-1]) | (day[1:] != day[:-1]))))
    n_lines, cents = (np.add.reduceat(rows[c].to_numpy(np.int64)[order], at) for c in ("n_lines", "cents"))
    sold = rows["sold"].to_numpy(bool)[order]
    due = np.minimum.reduceat(np.where(sold, rows["due"].to_numpy(np.int64)[order], np.iinfo(np.int64).max), at)
    sold = np.logical_or.reduceat(sold, at)
    return Assemblies(sale_id[at], day[at], day[at], n_lines, cents, np.where(sold, due, 0), sold)


def fold(opened: Assemblies, arrived: Assemblies, batch: int) -> tuple[Assemblies, list[pd.DataFrame]]:
    """Let the days of each sale join its open assembly in turn; what is left open, and those that became complete.

    The k-th days of all sales are folded at once, so there are as many steps as a sale has days in a batch.
    """
    sales = np.union1d(opened.sale_id, arrived.sale_id)
    all_, closed = Assemblies.none(sales), []
    all_.put(np.searchsorted(sales, opened.sale_id), opened)
    begins = np.flatnonzero(np.concatenate(([True], arrived.sale_id[1:] != arrived.sale_id[:-1]))) if len(arrived.sale_id) else np.zeros(0, int)
    nth = np.arange(len(arrived.sale_id)) - np.repeat(begins, np.diff(np.append(begins, len(arrived.sale_id))))
    for k in range(nth.max(initial=-1) + 1):
        new = arrived.take(nth == k)
        at = np.searchsorted(sales, new.sale_id)
        old = all_.take(at)
        on = old.n_lines >= 0
        new.first_day = np.where(on, old.first_day, new.first_day)
        new.n_lines += np.where(on, old.n_lines, 0)
        new.cents += np.where(on, old.cents, 0)
        new.due = np.where(on & old.sold, old.due, new.due)  # an assembly keeps the first sale's
        new.sold |= on & old.sold
        done = new.complete
        if done.any():
            closed.append(new.take(done).closed("complete", batch))
            new.n_lines[done] = -1
            for c in ("cents", "due", "sold"):
                getattr(new, c)[done] = 0
        all_.put(at, new)
    return all_.take(all_.n_lines >= 0), closed


def assemble(key: tuple[int], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One bucket in one batch: fold what arrived, then close what the tick says is overdue, or all after the last."""
    rows = pd.concat(list(batches), ignore_index=True)
    is_tick = rows["kind"] != ROW
    tick, rows = rows[is_tick].iloc[0], rows[~is_tick]
    batch = int(tick["batch"])
    opened = Assemblies.read(state.get[0]) if state.exists else Assemblies.none(np.zeros(0, np.int64))
    arrived = _daily(rows) if len(rows) else Assemblies.none(np.zeros(0, np.int64))
    opened, closed = fold(opened, arrived, batch)
    late = (opened.first_day + PATIENCE <= int(tick["prior"])) | (tick["kind"] == LAST)
    if late.any():
        gone = opened.take(late)
        closed.append(gone.closed(gone.verdict(), batch))
    left = opened.take(~late)
    if len(left.sale_id):
        state.update((left.write(),))
    elif state.exists:
        state.remove()
    yield from closed


def _ticks(spark: SparkSession, buckets: int, batch: int, prior: int) -> DataFrame:
    none = F.lit(0).cast("long")
    return spark.range(buckets, numPartitions=1 + buckets // 100_000).select(
        *(none.alias(c) for c in ("sale_id", "day", "n_lines", "cents")), F.lit(False).alias("sold"), none.alias("due"), F.lit(batch).alias("batch"),
        F.col("id").alias("bucket"), F.lit(LAST if batch == BATCHES - 1 else MORE).alias("kind"), F.lit(prior).cast("long").alias("prior"),
    )


def sale_assemblies(lines: DataFrame, sales: DataFrame) -> DataFrame:
    """sale_id, first_day, last_day, n_lines, cents, due, status, closing_batch of each closing.

    Rows with a null sale_id are left out, and lines (sales) equal in all their columns are one; further columns are
    ignored. Null, infinite and undefined amounts are 0 cents; a null line_no counts as empty text; a sale that never
    arrived arrives on the first day. Of different sales of one id that come on one day the least due counts, and an
    assembly that holds a sale keeps its due. Empty tables give no rows. Every call feeds a stream of its own, in a new
    folder under spark.checkpoint.dir, started anew for each batch on the same checkpoint.
    """
    spark = lines.sparkSession
    rows = arrivals(lines, sales)
    found = {r["batch"]: (r["n"], r["last"]) for r in rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.max("day").alias("last")).collect()}  # BATCHES rows at most
    buckets = max(LEAST_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")), sum(n for n, _ in found.values()) // ROWS_PER_BUCKET)
    folder = new_path(spark, "assembly")
    source, sink, checkpoint = (f"{folder}/{x}" for x in ("in", "out", "checkpoint"))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("sale_id"), F.lit(buckets)))
    prior = NO_DAY
    for batch in range(BATCHES):
        own = dealt.where(F.col("batch") == batch).withColumns({"kind": F.lit(ROW), "prior": F.lit(NO_DAY).cast("long")})
        own.unionByName(_ticks(spark, buckets, batch, prior)).write.mode("append").parquet(source)
        feed = spark.readStream.schema(f"{EVENT}, {TICK}").parquet(source)
        out = feed.groupBy("bucket").applyInPandasWithState(assemble, CLOSING, "assemblies binary", "append", GroupStateTimeout.NoTimeout)
        query = out.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)
        query.awaitTermination()
        prior = max(prior, found.get(batch, (0, NO_DAY))[1])
    return spark.read.schema(CLOSING).parquet(sink)


def op11_sale_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sale_assemblies(table(spark, sf_dir, "sale_lines"), table(spark, sf_dir, "sales"))
