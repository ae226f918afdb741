"""Exact deduplication by deterministic block naming, in DataFrame operations only.

A text is cut into blocks of fixed size. Distinct blocks are sorted into integer names; adjacent names
are paired, distinct pairs are sorted into names again, and so on until each document has one name.
Two documents have the same name exactly when their normalised texts are equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from granary.llm.common import LOWER, UPPER, ascii_lower, integer_names, pick, stage, table

BLOCK_BYTES = 8192


def _digest(block: Column) -> list[Column]:
    """128 bits in two longs. Only a way to move less: blocks that share it are told apart by their bytes."""
    return [F.xxhash64(block), F.xxhash64(F.lit(0x9E3779B9), block)]


def _blocks(df: DataFrame, block_bytes: int, digest: Callable[[Column], list[Column]]) -> DataFrame:
    size = f"greatest(1, cast(ceil(octet_length(_bytes) / {block_bytes}) as int))"
    cut = F.expr(f"transform(sequence(0, {size} - 1), i -> substring(_bytes, i * {block_bytes} + 1, {block_bytes}))")
    rows = df.withColumn("_bytes", ascii_lower(F.coalesce(F.col("text"), F.lit(""))).cast("binary"))
    rows = rows.select("*", F.expr(size).alias("n_blocks")).select(*[c for c in df.columns if c != "text"], "n_blocks", F.sha2("_bytes", 256).alias("sha"), F.posexplode(cut).alias("at", "block"))
    for i, h in enumerate(digest(F.col("block")), 1):
        rows = rows.withColumn(f"h{i}", h)
    return rows


def name_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, digest: Callable[[Column], list[Column]] = _digest) -> DataFrame:
    """One row per input row: row_id, doc_id, sha, n_blocks, name. (n_blocks, name) is equal for equal texts only."""
    docs = pick(df, id_col, text_col).toDF("doc_id", "text")
    blocks = _blocks(docs, block_bytes, digest)
    # The one shuffle of texts: distinct blocks, combined before they move. It proves which digests stand for one block.
    distinct = blocks.select("h1", "h2", "block").distinct()
    variants = stage(distinct.groupBy("h1", "h2").agg(F.count("*").alias("n")), "variants")
    shared = variants.where("n > 1").select("h1", "h2")
    numbered = docs.withColumn("row_id", F.monotonically_increasing_id())
    cells = _blocks(numbered, block_bytes, digest)
    if shared.isEmpty():
        cells = cells.withColumn("v", F.lit(0))
    else:
        apart = distinct.join(shared, ["h1", "h2"], "left_semi")
        apart = stage(apart.withColumn("v", F.row_number().over(W.partitionBy("h1", "h2").orderBy("block"))), "collisions")
        cells = cells.join(apart, ["h1", "h2", "block"], "left").withColumn("v", F.coalesce("v", F.lit(0)))
    cells = stage(cells.select("row_id", "doc_id", "sha", "n_blocks", "at", "h1", "h2", "v"), "cells")
    keys = ["h1", "h2", "v"]
    names = integer_names(cells, keys, "name", "names0")
    level = stage(cells.join(names, keys).select("row_id", "doc_id", "sha", "n_blocks", "at", "name"), "level0")
    done, width = level.where("n_blocks = 1").drop("at"), 1
    most = level.agg(F.max("n_blocks")).first()[0] or 1
    rows = level.where("n_blocks > 1")
    while width < most:  # as often as the longest text's blocks can be halved
        even = F.col("at") % 2 == 0
        pairs = rows.groupBy("row_id", "doc_id", "sha", "n_blocks", F.shiftright("at", 1).alias("at")).agg(
            F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b")
        )
        pairs, width = stage(pairs, "pairs"), width * 2
        names = integer_names(pairs, ["a", "b"], "name", "names")
        level = stage(pairs.join(names, ["a", "b"]).select("row_id", "doc_id", "sha", "n_blocks", "at", "name"), "level")
        done = done.unionByName(level.where(f"n_blocks <= {width}").drop("at"))
        rows = level.where(f"n_blocks > {width}")
    return done


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each input row.

    Texts are equal when identical after lower-casing A-Z; null counts as the empty text, and empty texts
    are equal to each other. Of equal texts the row with the largest doc_id is kept (a null id is below all
    others; of rows repeated with that id, one is kept). Any length of text. Other columns are ignored.
    An empty table gives an empty result.
    """
    named = name_documents(df, id_col, text_col, **how)
    identity = ["n_blocks", "name"]
    best = named.groupBy(*identity).agg(F.max(F.struct("doc_id", "row_id")).alias("best"), F.count("*").alias("group_size"))
    # Written first, so that the join's exchange of a hot identity is the join's own and can be split.
    joined = named.join(stage(best, "best"), identity)
    return joined.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row_id") == F.col("best.row_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP7_SQL = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
