"""One category for each product from its paths and name, by rules that are data; every decision says what it rests on."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.columns import flag, label_key
from granary.operators.paths import STRUCTURAL

TEXTS = "array<string>"
#: A decision of its own among the rule ids.
BY_NAME, REVIEWED = "name_breaks_path_conflict", "reviewed_source_contradiction"
STATUSES = ("classified", "conflicting_evidence", "missing_evidence", "no_supported_match", "excluded_evidence", "review_required")


@dataclass(frozen=True)
class Withheld:
    """Paths with one of the labels are left out, but for those of a shop that begin with `lead` and hold `label`: they have `code` by `rule`."""

    labels: Sequence[str]
    shop: str | None = None
    lead: Sequence[str] = ()
    label: str = ""
    code: str = ""
    rule: str = ""


@dataclass(frozen=True)
class PathRules:
    """Rules within one path, in the order in which they are asked. Labels are compared by their keys, see columns.label_key.

    language: paths in any other give nothing. promotion: an expression; paths with such a label are left out, like those
    with an ambiguous one. precedence: (winner, allowed, rule): the winner among several codes all of which are allowed.
    boundaries: (labels, allowed, winner, rule): the winner where the path has one of the labels and no code beside the allowed.
    """

    language: str | None = None
    promotion: str | None = None
    ambiguous: Sequence[str] = ()
    withheld: Sequence[Withheld] = ()
    precedence: Sequence[tuple[str, Sequence[str], str]] = ()
    boundaries: Sequence[tuple[Sequence[str], Sequence[str], str, str]] = ()
    prefix: str = "label_"


def texts(values: Sequence[str] = ()) -> Column:
    return F.array(*map(F.lit, values)).cast(TEXTS)


def precedence(codes: Column, rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The winner of the first rule (winner, allowed) that holds among several codes all of which it allows; else the codes."""
    out = None
    for winner, allowed in rules:
        holds = wins(codes, winner, allowed)
        out = F.when(holds, texts([winner])) if out is None else out.when(holds, texts([winner]))
    return codes if out is None else out.otherwise(codes)


def wins(codes: Column, winner: str, allowed: Sequence[str]) -> Column:
    return (F.size(codes) > 1) & F.array_contains(codes, winner) & within(codes, allowed)


def within(codes: Column, allowed: Sequence[str]) -> Column:
    return F.size(F.array_except(codes, texts(allowed))) == 0


def labelled(paths: DataFrame, key: Sequence[str], anchors: DataFrame, prefix: str) -> DataFrame:
    """key, keys, codes, rules: the keys of each path's labels in order, the codes of those that are anchors, and a rule id for each of these.

    Distinct labels are keyed and matched once; paths get them back by a join on the label.
    """
    rows = paths.select(*key, F.posexplode("category_path_normalized").alias("_at", "label"))
    known = rows.select("label").distinct().withColumn("key", label_key("label"))
    known = known.join(anchors.select(label_key("label").alias("key"), "code").distinct(), "key", "left")
    per = rows.join(known, "label").groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_at", "key", "code"))).alias("l"))
    hit = F.filter("l", lambda x: x["code"].isNotNull())
    rule = lambda x: F.concat(F.lit(prefix), F.substring(F.sha2(x["key"].cast("binary"), 256), 1, 12))
    sorted_set = lambda f: F.array_sort(F.array_distinct(F.transform(hit, f)))
    return per.select(*key, F.transform("l", lambda x: x["key"]).alias("keys"), sorted_set(lambda x: x["code"]).alias("codes"), sorted_set(rule).alias("rules"))


def classify_paths(paths: DataFrame, key: Sequence[str], anchors: DataFrame, rules: PathRules) -> DataFrame:
    """paths with codes, rules and reason: unsupported_language, excluded, matched or no_match. key tells paths apart.

    Where the rules ask for a language or shop, paths has these columns. Paths with a structural flag have reason `structural`.
    """
    own = lambda c: F.col(c) if c in paths.columns else F.lit(None).cast("string")
    found = labelled(paths, key, anchors, rules.prefix)
    rows = paths.join(found, list(key))
    keys, codes, ids = F.col("keys"), F.col("codes"), F.col("rules")
    out = lambda c, r, why: F.struct(c.alias("codes"), F.array_sort(F.array_distinct(r)).alias("rules"), F.lit(why).alias("reason"))
    has = lambda labels: F.arrays_overlap(keys, texts([key_of(x) for x in labels]))
    nothing = lambda why: out(texts(), texts(), why)
    structural = F.lit(False)
    for c in STRUCTURAL:
        structural = structural | F.col(c)
    case = F.when(structural, nothing("structural"))
    if rules.language:
        case = case.when(~own("language").eqNullSafe(F.lit(rules.language)), nothing("unsupported_language"))
    if rules.promotion:
        case = case.when(F.exists(keys, lambda x: x.rlike(rules.promotion)), nothing("excluded"))
    if rules.ambiguous:
        case = case.when(has(rules.ambiguous), nothing("excluded"))
    for w in rules.withheld:
        if w.shop:
            lead = [key_of(x) for x in w.lead]
            case = case.when(has(w.labels) & own("shop").eqNullSafe(F.lit(w.shop)) & (F.slice(keys, 1, len(lead)) == texts(lead)) & F.array_contains(keys, key_of(w.label)), out(texts([w.code]), texts([w.rule]), "matched"))
        case = case.when(has(w.labels), nothing("excluded"))
    for winner, allowed, rule in rules.precedence:
        case = case.when(wins(codes, winner, allowed), out(texts([winner]), F.concat(ids, texts([rule])), "matched"))
    for names, allowed, winner, rule in rules.boundaries:
        case = case.when(has(names) & within(codes, allowed), out(texts([winner]), F.concat(ids, texts([rule])), "matched"))
    case = case.when(F.size(codes) > 0, out(codes, ids, "matched")).otherwise(nothing("no_match"))
    return rows.withColumn("_c", case).drop("keys", "codes", "rules").select("*", "_c.*").drop("_c")


def key_of(label: str) -> str:
    """columns.label_key of one text of the rules."""
    return " ".join(unicodedata.normalize("NFC", label).split()).casefold()


def path_votes(paths: DataFrame, identity: Sequence[str], anchors: DataFrame, promotion: str | None = None, rules: PathRules | None = None) -> DataFrame:
    """Per identity: the codes that its paths give, the rules they were given by, the sources and paths (source:position) they
    stand in, and how many paths there were and were left out (a structural flag, a promotion, an ambiguous or withheld label).

    anchors: label, code. Paths without a column source_dataset are of one source without a name.
    """
    rules = rules or PathRules(promotion=promotion)
    if "source_dataset" not in paths.columns:
        paths = paths.withColumn("source_dataset", F.lit(""))
    rows = classify_paths(paths, [*identity, "source_dataset", "category_path_position"], anchors, rules)
    some = F.size("codes") > 0
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    return rows.groupBy(*identity).agg(
        union("codes").alias("candidates"), union("rules").alias("matched_rule_ids"), F.array_sort(F.collect_set(F.when(some, F.col("source_dataset")))).alias("evidence_source_datasets"),
        F.array_sort(F.collect_set(F.when(some, F.concat_ws(":", "source_dataset", "category_path_position")))).alias("evidence_path_references"),
        F.count("*").alias("source_path_count"), F.count_if(F.col("reason").isin("structural", "excluded")).alias("excluded_path_count"),
    )


EVIDENCE = ("matched_rule_ids", "evidence_source_datasets", "evidence_path_references")


def decide(votes: DataFrame, identity: Sequence[str], names: DataFrame) -> DataFrame:
    """One code per identity, or an abstention with its reason, and the evidence.

    One candidate decides. Else a single code of the name does, if there is no candidate or it is among them; a name never
    overrides agreeing paths. names: identity, name_codes, and name_rules if there are any. votes and names may lack an
    identity of the other, and votes the evidence.
    """
    for c in EVIDENCE:
        votes = votes if c in votes.columns else votes.withColumn(c, texts())
    names = names if "name_rules" in names.columns else names.withColumn("name_rules", texts())
    rows = votes.join(names, list(identity), "full_outer")
    rows = rows.withColumns({c: F.coalesce(c, texts()) for c in ("candidates", "name_codes", "name_rules", *EVIDENCE)} | {c: F.coalesce(c, F.lit(0)) for c in ("source_path_count", "excluded_path_count")})
    found, name = F.col("candidates"), F.col("name_codes")
    by_path = F.size(found) == 1
    by_name = ~by_path & (F.size(name) == 1) & ((F.size(found) == 0) | (F.size(F.array_except(name, found)) == 0))
    settles = by_name & (F.size(found) > 0)
    status = (
        F.when(by_path | by_name, "classified").when(F.size(found) > 0, "conflicting_evidence").when(F.col("source_path_count") == 0, "missing_evidence")
        .when(F.col("excluded_path_count") == F.col("source_path_count"), "excluded_evidence").otherwise("no_supported_match")
    )
    code = F.when(by_path, F.get(found, F.lit(0))).when(by_name, F.get(name, F.lit(0))).otherwise("unclassified")
    basis = F.when(by_path, "paths").when(settles, BY_NAME).when(by_name, "name")
    ids = F.when(by_name, F.array_sort(F.concat("matched_rule_ids", "name_rules", F.when(settles, texts([BY_NAME])).otherwise(texts())))).otherwise(F.col("matched_rule_ids"))
    sources = F.when(by_name, F.array_sort(F.concat("evidence_source_datasets", texts(["product_name"])))).otherwise(F.col("evidence_source_datasets"))
    return rows.select(
        *identity, code.alias("code"), status.alias("status"), basis.alias("basis"), F.when(by_name & (F.size(found) == 0), name).otherwise(found).alias("candidates"), "name_codes",
        ids.alias("matched_rule_ids"), sources.alias("evidence_source_datasets"), "evidence_path_references", "source_path_count", "excluded_path_count",
    )


def withhold(decisions: DataFrame, identity: Sequence[str], paths: DataFrame, exclusions: DataFrame, payload: str = "source_categories_sha256") -> DataFrame:
    """Decisions with reviewed products held back (unclassified, review_required) while their paths' payloads are the reviewed ones.

    exclusions: identity, hashes (array). Payloads that have changed fail, as they ask for another review.
    """
    now = paths.groupBy(*identity).agg(F.array_sort(F.collect_set(payload)).alias("_now"))
    held = exclusions.select(*identity, F.array_sort(F.array_distinct("hashes")).alias("_reviewed")).join(now, list(identity), "left")
    changed = F.concat(F.lit("reviewed evidence has changed: "), F.concat_ws(" ", *(F.col(c).cast("string") for c in identity)))
    held = held.withColumn("_held", F.when(F.coalesce("_now", texts()) == F.col("_reviewed"), True).otherwise(F.raise_error(changed).cast("boolean")))
    rows = decisions.join(held.select(*identity, "_held"), list(identity), "left")
    off = flag(F.col("_held"))
    return rows.withColumns({
        "code": F.when(off, "unclassified").otherwise(F.col("code")), "status": F.when(off, "review_required").otherwise(F.col("status")),
        "matched_rule_ids": F.when(off, F.concat("matched_rule_ids", texts([REVIEWED]))).otherwise(F.col("matched_rule_ids")),
    }).drop("_held")
