"""Where two tables differ: a tree of hashes over ranges of a key, so that unequal roots lead to the rows.

A leaf is a range of 2^shift neighbouring whole numbers of a key; it holds the rows there, and the sum and exclusive or of their
hashes. A node holds the same of 2^BITS nodes below it, and one more level covers all. Ranges are aligned, so two sides that never
met have the same nodes, and a tree is additive: what is added to a table is added to its tree. Trees are small beside
their tables and are kept with them; to compare two sets only trees are read, then only rows in leaves that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Each node has at most 2^BITS children; LEVELS levels are above the leaves, so with BITS * LEVELS >= 64 the top is one node a sign.
BITS, LEVELS = 8, 8
FIGURES = ("rows", "hash_sum", "hash_xor")
#: Ranges that a scan is asked for one by one; beyond them, rows are met with the list of leaves by a join.
MOST_RANGES = 200


def row_hash(columns: Sequence[str]) -> Column:
    """Of all columns by name, whatever their order, with the pattern of nulls: the hash alone skips a null."""
    named = sorted(columns)
    return F.xxhash64(*(F.col(c) for c in named), F.concat(*(F.col(c).isNull().cast("int").cast("string") for c in named)))


def leaves(df: DataFrame, key: str, shift: int = 12) -> DataFrame:
    """node, rows, hash_sum and hash_xor of each range of 2^shift keys that has rows; a null key has the node null."""
    h = df.select(F.shiftright(F.col(key).cast("long"), shift).alias("node"), row_hash(df.columns).cast("decimal(38,0)").alias("h"))
    return h.groupBy("node").agg(F.count("*").alias("rows"), F.sum("h").alias("hash_sum"), F.bit_xor(F.col("h").cast("long")).alias("hash_xor"))


def tree(of: DataFrame) -> DataFrame:
    """All levels of leaves() in one table: level 0 are the leaves, level LEVELS the top. Each level is made of the one below."""
    out = now = of.withColumn("level", F.lit(0))
    for level in range(1, LEVELS + 1):
        up = now.groupBy(F.shiftright("node", BITS).alias("node")).agg(F.sum("rows").alias("rows"), F.sum("hash_sum").alias("hash_sum"), F.bit_xor("hash_xor").alias("hash_xor"))
        now = up.withColumn("level", F.lit(level))
        out = out.unionByName(now)
    return out.select("level", "node", *FIGURES)


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """level and node of all nodes of two trees that differ, those of one side alone included. Equal trees give no row.

    Figures of the sides are summed up with opposite signs in one aggregate, so there is no join, and equal tops need no more than their own rows
    (ask for level = LEVELS first).
    """
    signed = a.withColumn("side", F.lit(1)).unionByName(b.withColumn("side", F.lit(-1)))
    both = signed.groupBy("level", "node").agg(F.sum(F.col("rows") * F.col("side")).alias("n"), F.sum(F.col("hash_sum") * F.col("side")).alias("s"), F.bit_xor("hash_xor").alias("x"))
    return both.where("n <> 0 or s <> 0 or x <> 0").select("level", "node")


def equal(a: DataFrame, b: DataFrame) -> bool:
    """By the tops of the trees, two or three rows each (of either sign, and null)."""
    return differing(a.where(F.col("level") == LEVELS), b.where(F.col("level") == LEVELS)).isEmpty()


def within(df: DataFrame, key: str, nodes: DataFrame, shift: int) -> DataFrame:
    """Rows whose key lies in one of the leaves.

    Up to MOST_RANGES leaves become ranges that the scan is asked for, so that files and row groups sorted by the key are
    left out by their bounds; more of them are met by a join, with the same rows.
    """
    few = [r[0] for r in nodes.select("node").limit(MOST_RANGES + 1).collect()]
    if len(few) > MOST_RANGES:
        return df.join(nodes.select("node"), F.shiftright(F.col(key).cast("long"), shift).eqNullSafe(F.col("node")), "left_semi")
    held = F.lit(False)
    for node in few:
        held = held | (F.col(key).isNull() if node is None else F.col(key).between(F.lit(node << shift), F.lit((node + 1 << shift) - 1)))
    return df.where(held)


def changed_rows(a: DataFrame, b: DataFrame, key: str, shift: int = 12, trees: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """key, change, a_rows, b_rows: `added` and `removed` keys, and keys whose rows `changed`, from a to b.

    trees: of both sides as kept beside them; else they are made here. A key may stand on several rows, as often counts too;
    null is a key of its own. Columns are those of a; b must have them. Sides whose trees are equal give no row.
    """
    b = b.select(a.columns)
    left, right = (t.where("level = 0") for t in trees) if trees else (leaves(t, key, shift).withColumn("level", F.lit(0)) for t in (a, b))
    nodes = differing(left, right)
    side = lambda df, sign: within(df, key, nodes, shift).select(F.col(key), row_hash(a.columns).cast("decimal(38,0)").alias("h"), F.lit(sign).alias("side"))
    rows = side(a, 1).unionByName(side(b, -1))
    per = rows.groupBy(key).agg(
        F.count_if(F.col("side") == 1).alias("a_rows"), F.count_if(F.col("side") == -1).alias("b_rows"), F.sum(F.col("h") * F.col("side")).alias("s"), F.bit_xor(F.col("h").cast("long")).alias("x"),
    )
    change = F.when(F.col("a_rows") == 0, "added").when(F.col("b_rows") == 0, "removed").otherwise("changed")
    return per.where("a_rows <> b_rows or s <> 0 or x <> 0").select(key, change.alias("change"), "a_rows", "b_rows")
