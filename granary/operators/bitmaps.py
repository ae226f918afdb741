"""Distinct counts that add up: bitmaps of keys at a fine grain, of which any coarser group is an OR.

A table of presence has, for each group and bucket of 32,768 keys, the bitmap of the keys that the group has there, beside
sums. It is as additive as a table of sums: group it by fewer columns, OR the bitmaps, and count their bits at the end. Keys
are whole numbers close together, such as surrogate keys (operators/keys.py). A domain of few values (weeks) needs no
bucket: its bitmap stands in the same row, or, where there are very many groups, in words of 64 bits, which a hash
aggregate can hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one of Spark's bitmaps.
BITS = 32_768
#: Where weeks are counted from: BITS weeks reach to the year 2328.
FIRST_WEEK = "1700-01-04"
BUCKET = "_bucket"


def week_ordinal(week: Column) -> Column:
    """A number from 1 to BITS for each week; null for null, and an error for weeks beyond."""
    n = F.floor(F.datediff(week, F.lit(FIRST_WEEK).cast("date")) / 7) + 1
    return F.when(n.between(1, BITS), n).when(n.isNotNull(), F.raise_error(F.lit("week out of range")).cast("long"))


def _bits(c: Column) -> Column:
    return F.bitmap_construct_agg(F.bitmap_bit_position(c))


def presence(
    rows: DataFrame, grain: Sequence[str], key: str, narrow: dict[str, Column] | None = None, where: dict[str, Column] | None = None, sums: dict[str, Column] | None = None,
    least: dict[str, Column] | None = None,
) -> DataFrame:
    """One row for each group of the grain and bucket of keys: bitmaps and sums of the rows there.

    `keys` is the bitmap of key; narrow: bitmaps of ordinals from 1 to BITS; where: bitmaps of the keys of rows that hold a
    condition; sums and least: aggregates of columns. Null keys and ordinals set no bit, but their rows are summed up.
    """
    n = F.col(key).cast("long")
    aggs = [_bits(n).alias("keys"), *(_bits(c).alias(name) for name, c in (narrow or {}).items()), *(_bits(F.when(c, n)).alias(name) for name, c in (where or {}).items())]
    aggs += [F.sum(c).alias(name) for name, c in (sums or {}).items()] + [F.min(c).alias(name) for name, c in (least or {}).items()]
    return rows.groupBy(*grain, F.bitmap_bucket_number(n).alias(BUCKET)).agg(*aggs)


def merged(table: DataFrame, by: Sequence[str], bits: Sequence[str] = ("keys",), sums: Sequence[str] = (), least: Sequence[str] = ()) -> DataFrame:
    """A table of presence of the coarser groups `by`."""
    return table.groupBy(*by, BUCKET).agg(*(F.bitmap_or_agg(c).alias(c) for c in bits), *(F.sum(c).alias(c) for c in sums), *(F.min(c).alias(c) for c in least))


def counted(table: DataFrame, by: Sequence[str], wide: Sequence[str] = ("keys",), narrow: Sequence[str] = (), sums: Sequence[str] = (), least: Sequence[str] = ()) -> DataFrame:
    """by, and for each column what the group has: keys or ordinals counted, sums and least values taken on."""
    own = merged(table, by, [*wide, *narrow], sums, least)
    return own.groupBy(*by).agg(
        *(F.sum(F.bitmap_count(c)).alias(c) for c in wide), *(F.bitmap_count(F.bitmap_or_agg(c)).alias(c) for c in narrow), *(F.sum(c).alias(c) for c in sums), *(F.min(c).alias(c) for c in least)
    )


def counted_sets(table: DataFrame, sets: Sequence[Sequence[str]], **columns: Sequence[str]) -> DataFrame:
    """counted() for several groupings, missing columns null, one below the other. Each reads the table, which is written or cheap.

    rollup() and cube() give the usual lists of groupings.
    """
    every = list(dict.fromkeys(c for s in sets for c in s))
    kinds = dict(table.dtypes)
    out = None
    for s in sets:
        own = counted(table, s, **columns)
        own = own.withColumns({c: F.lit(None).cast(kinds[c]) for c in every if c not in s})
        out = own if out is None else out.unionByName(own)
    return out


def rollup(*by: str) -> list[list[str]]:
    return [list(by[:n]) for n in range(len(by), -1, -1)]


def cube(*by: str) -> list[list[str]]:
    return [[c for i, c in enumerate(by) if not m >> i & 1] for m in range(1 << len(by))]


WORD, MASK = "_word", "_mask"


def ordinal_masks(rows: DataFrame, by: Sequence[str], ordinal: Column, least: dict[str, Column] | None = None) -> DataFrame:
    """For each group and word of 64 ordinals: which of these the group has, as the bits of one number, in a hash aggregate.

    Null ordinals set no bit; their group stays. least: least values of columns.
    """
    bit = F.expr("shiftleft(1L, cast(_n & 63 as int))")
    rows = rows.select(*by, ordinal.cast("long").alias("_n"), *(c.alias(name) for name, c in (least or {}).items()))
    return rows.groupBy(*by, F.shiftright("_n", 6).alias(WORD)).agg(F.bit_or(bit).alias(MASK), *(F.min(name).alias(name) for name in least or {}))


def merged_masks(masks: DataFrame, by: Sequence[str]) -> DataFrame:
    return masks.groupBy(*by, WORD).agg(F.bit_or(MASK).alias(MASK))


def counted_masks(masks: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """How many ordinals each group of masks, already one row for each word, has."""
    return masks.groupBy(*by).agg(F.coalesce(F.sum(F.bit_count(MASK)), F.lit(0)).alias(name))
