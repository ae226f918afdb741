"""A corpus pipeline of five stages, each of which works on all that the one before it kept.

All stages judge rows, not ids: rows without an id, or with one that other rows have too, are judged like all others. Null
texts are empty. Columns beside doc_id and text may have any names and values and are kept as they are; an empty table
stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import BROADCAST_IDS, ascii_lower, discard, mark, shielded, stage, table, without
from granary.llm.decontaminate import contaminated
from granary.llm.exact_dedup import exact_dedup
from granary.llm.jaccard_join import jaccard_components
from granary.llm.packing import pack
from granary.llm.quality import fit_quality, keep_quality

SHINGLE_WORDS, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rule ensemble, fitted on the labelled ones among them, does not reject.

    Null, empty and blank texts have the score that the rules give to texts without words. Repeated rows are judged alike.
    """
    return keep_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that with the largest id; null ids are below all others.

    Of rows equal in id and text one stays, the least by its columns. Null and empty texts are one group.
    """
    rows = shielded(docs, "doc_id", "text")
    key = lambda sha: F.concat_ws(":", F.col("doc_id").cast("string"), sha)
    found = stage(exact_dedup(rows.select("doc_id", "text")).withColumn("_key", key(F.col("text_sha256"))), "exact")
    keyed = rows.withColumn("_key", key(F.sha2(ascii_lower(F.coalesce("text", F.lit(""))).cast("binary"), 256)))
    kept = without(keyed, found.where("not (doc_id <=> keep_id)").select("_key").distinct(), "_key")
    again = stage(found.where("doc_id <=> keep_id and not kept").select("_key").distinct(), "again")
    if again.isEmpty():
        return kept.drop("_key").toDF(*docs.columns)
    once = kept.join(again, "_key", "left_semi").groupBy("_key").agg(F.min_by(F.struct(*rows.columns), F.coalesce("text", F.lit(""))).alias("row"))
    out = kept.join(again, "_key", "left_anti").drop("_key").unionByName(once.select("row.*"))
    return out.toDF(*docs.columns)


def _hash() -> Column:
    return F.xxhash64(F.isnull("doc_id"), "doc_id", F.isnull("text"), "text").bitwiseAND((1 << 63) - 1)


def _numbered(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows with a number for each distinct pair of id and text as _row, and a written table of _row and doc_id.

    Numbers are hashes, so that every scan gives the same. Pairs of which several have one hash, told by SHA-256, are
    few (some 50 of 3 * 10**10) and have written numbers below 0 instead, so any number of rows has its own.
    """
    hashed = rows.withColumn("_row", _hash()).withColumn("_sha", F.sha2(F.col("text").cast("binary"), 256))
    names = stage(hashed.select("_row", "doc_id", "_sha").distinct(), "rows")
    shared = names.groupBy("_row").count().where("count > 1").select("_row")
    if shared.isEmpty():
        return hashed.drop("_sha"), names.drop("_sha")
    own = stage(names.join(shared, "_row", "left_semi").withColumn("_own", -1 - F.monotonically_increasing_id()), "shared")
    other = own.toDF("_hash", "_id", "_text", "_own")
    if own.count() <= BROADCAST_IDS:
        other = F.broadcast(other)
    same = (F.col("_row") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_sha").eqNullSafe(F.col("_text"))

    def renamed(df: DataFrame) -> DataFrame:
        return df.join(other, same, "left").withColumn("_row", F.coalesce("_own", "_row")).drop("_sha", "_hash", "_id", "_text", "_own")

    return renamed(hashed), stage(renamed(names), "rows")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by near copies, that with the least id; null ids come last.

    Rows equal in id and text are one and stay or go together. Texts without words are linked with nothing.
    """
    rows, names = _numbered(shielded(docs, "doc_id", "text"))
    found = jaccard_components(rows.select("_row", "text"), id_col="_row", words=SHINGLE_WORDS, percent=PERCENT)
    found = found.where("n_links > 0").select(F.col("doc_id").alias("_row"), "component_id").distinct()
    found = stage(found.join(names, "_row"), "near")
    best = stage(found.groupBy("component_id").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "_row")).alias("best")), "best")
    kept = without(rows, found.join(best, "component_id").where("_row != best._row").select("_row"), "_row")
    return kept.drop("_row").toDF(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage that aligns with a test item. Null texts hold none; repeated rows go or stay together."""
    rows, _ = _numbered(shielded(docs, "doc_id", "text"))
    texts = rows.select(F.col("_row").alias("doc_id"), "text")
    found = contaminated(texts, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_row")).distinct()
    return without(rows, found, "_row").drop("_row").toDF(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands among the training sequences. Every row is packed, repeated ones too."""
    import public_tokenizers  # its path is all that is asked of it

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("decontaminate", decontaminate), ("pack", packed)]

#: No stage but the second can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the intermediate tables of a stage are deleted when the next one has its input written."""
    docs = table(spark, sf_dir, "documents")
    since = mark()
    for i, (name, stage_of) in enumerate(STAGES):
        docs = stage_of(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name)
            discard(spark, since, docs)
    return docs
