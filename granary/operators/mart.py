"""Dimensions and the nutrition-like fact of a star schema, as functions over table specifications."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.columns import finite, flag, n_values, only_value
from granary.operators.contracts import join_checked
from granary.operators.keys import surrogate_keys, with_unknown
from granary.operators.versions import latest_flag

DECISION = ("category_code", "category_status")


def used_members(members: DataFrame, facts: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Members that some fact refers to."""
    keys = None
    for fact in facts:
        own = fact.select(*key)
        keys = own if keys is None else keys.unionByName(own)
    return members.join(keys.distinct(), list(key), "left_semi")


def recover(missing: DataFrame, described: DataFrame, key: Sequence[str], context: str, attributes: Sequence[str]) -> DataFrame:
    """Members without a description in their own context, described by others' where exactly one context has the key;
    each attribute only where its rows agree.

    Rows that say the same are one first, in a hash aggregate: what follows holds texts and sets, and sorts what it gets.
    They are counted, and the count asked for, as the optimizer takes out a step before sets and least values that only drops repeats.
    """
    said = described.groupBy(*dict.fromkeys([*key, context, *attributes])).agg(F.count("*").alias("_rows"))
    per = said.groupBy(*key).agg(n_values(F.col(context)).alias("_n"), F.sum("_rows").alias("_rows"), *(only_value(F.col(a)).alias(a) for a in attributes))
    return missing.select(*key, context).distinct().join(per.where("_n = 1 and _rows > 0").drop("_n", "_rows"), list(key))


def infer(missing: DataFrame, key: Sequence[str], name: str, text: str) -> DataFrame:
    """A member for each identity that nothing describes, named after it."""
    return missing.select(*key).distinct().withColumn(name, F.format_string(text, *(F.col(k).cast("string") for k in key)))


def entity_dimension(key_name: str, identity: Sequence[str], parts: Sequence[tuple[DataFrame, str]], attributes: Sequence[str], unknown: dict) -> DataFrame:
    """Members of all parts, the first part that has an identity winning, numbered over their sorted identity, and Unknown.

    parts: rows of identity and attributes (missing ones null), and the label of where they come from. Parts are few and
    each has an identity once; a member that an earlier part has is left out of a later one.
    """
    rows = None
    for part, source in parts:
        own = part.select(*identity, *((F.col(a) if a in part.columns else F.lit(None).cast("string")).alias(a) for a in attributes), F.lit(source).alias("descriptive_source"))
        rows = own if rows is None else rows.unionByName(own.join(rows.select(*identity), list(identity), "left_anti"))
    rows = rows.withColumn("is_inferred", F.col("descriptive_source") == "inferred")
    dim = join_checked(surrogate_keys(rows, identity, key_name), rows, identity, "1:1", "inner").select(key_name, *identity, *attributes, "descriptive_source", "is_inferred")
    return with_unknown(dim, key_name, {**unknown, "descriptive_source": "unknown", "is_inferred": False})


def attach_decision(dim: DataFrame, decisions: DataFrame, identity: Sequence[str], key_name: str) -> DataFrame:
    """Each member with its decision (code, status); the Unknown member and inferred ones have outcomes of their own."""
    rows = join_checked(dim, decisions.select(*identity, F.col("code").alias("_code"), F.col("status").alias("_status")), identity, "m:1")
    status = F.when(F.col(key_name) == -1, "unknown_product").when(F.col("is_inferred"), "missing_evidence").otherwise(F.coalesce("_status", F.lit("missing_evidence")))
    code = F.when((F.col(key_name) == -1) | F.col("is_inferred"), "unclassified").otherwise(F.coalesce("_code", F.lit("unclassified")))
    return rows.select(*dim.columns, code.alias(DECISION[0]), status.alias(DECISION[1]))


def entry_fact(rows: DataFrame, dims: dict[str, tuple[DataFrame, Sequence[str]]], grain: Sequence[str], date: str, portion: str, portion_unit: str, value: str) -> DataFrame:
    """Label entries with their dimensions' keys, basis, usability and whether they are of the product's latest date.

    dims: key column -> (dimension, natural key, as columns of both). Rows without a member of a dimension drop out.
    """
    for key, (dim, natural) in dims.items():
        rows = rows.join(dim.select(key, *natural), list(natural))
    g100 = (F.col(portion) == 100) & (F.col(portion_unit) == "g")
    ml100 = (F.col(portion) == 100) & (F.col(portion_unit) == "ml")
    rows = rows.withColumns({"basis": F.when(g100, "per_100g").when(ml100, "per_100ml").otherwise("other"), "is_value_usable": flag(finite(F.col(value)) & (F.col(value) >= 0))})
    return latest_flag(rows, grain, date)


def location_dimension(locations: DataFrame, prices: DataFrame, identity: Sequence[str], key_name: str) -> DataFrame:
    """Locations that have a price, numbered."""
    used = used_members(locations, [prices], identity)
    return join_checked(surrogate_keys(used, identity, key_name), used, identity, "1:1", "inner")


def category_dimension(memberships: DataFrame, identity: Sequence[str], key_name: str, member: str) -> tuple[DataFrame, DataFrame]:
    """Numbered distinct categories, and the bridge (member, category key); other columns of a category are the least of its rows."""
    dim = surrogate_keys(memberships, identity, key_name)
    rest = [c for c in memberships.columns if c not in identity and c != member]
    if rest:
        least = memberships.groupBy(*identity).agg(F.min(F.struct(*rest)).alias("_r")).select(*identity, "_r.*")
        dim = join_checked(dim, least, identity, "1:1", "inner")
    bridge = memberships.select(member, *identity).join(dim.select(key_name, *identity), list(identity)).select(member, key_name).distinct()
    return dim, bridge
