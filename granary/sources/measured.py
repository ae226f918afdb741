"""Tables measured while they are written: figures of the rows that pass the writer, and keys proven unique by their neighbours.

A contract over a table that was written needs no second pass where it is an aggregate of single rows: an Observation takes it
from the rows on their way. A unique key needs an order only: rows are dealt by ranges of the key and sorted for the file
anyway, so a repeated key lies beside its like, and one exchange and one sort serve the file and the proof.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

ROWS, REPEATED = "rows", "repeated_keys"
_NTH = "_nth_of_key"


def numbered_in_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """df in ranges of the key, sorted by it, with a row's place among those of its key in `_nth_of_key`; nulls are values.

    Ranges of the key hold all rows of a key, so the window has no exchange or sort of its own (tested on the plan).
    Floating-point keys are right too but cost an exchange more, as 0.0 and -0.0 have to meet. A key with very many rows is
    one task's, which spills them; a sound table has none.
    """
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*key))
    return df.repartitionByRange(*key).withColumn(_NTH, place)  # the window sorts by the key, which orders the file too


def write_measured(df: DataFrame, path: str, figures: Mapping[str, Column] | None = None, key: Sequence[str] = ()) -> dict:
    """Write df as Parquet; returns `rows`, the figures, and with a key `repeated_keys`: rows beyond the first of each key.

    figures: aggregates without DISTINCT of df's columns; a sum over no rows is 0. Figures of tasks that ran again after a
    loss count once, as those of a write are taken when a task first succeeds. An empty table has figures of nothing.
    """
    seen, rows = Observation(), df
    aggs = [F.count(F.lit(1)).alias(ROWS), *(c.alias(n) for n, c in (figures or {}).items())]
    if key:
        rows = numbered_in_key(df, key)
        aggs.append(F.count_if(F.col(_NTH) > 1).alias(REPEATED))
    rows.observe(seen, *aggs).drop(_NTH).write.option("compression", "zstd").parquet(path)
    return {n: 0 if v is None else v for n, v in seen.get.items()}
