"""Category paths, evidence decisions over them, and words mined from names."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.columns import flag, strip, tokens

PATHS = "array<array<string>>"


# What a path still needs a review for, by the first structural flag that holds.
NAVIGATION, REPEATED, DUPLICATE, ANCESTOR = "navigation_review_required", "repeated_label_review_required", "duplicate_path_occurrence", "ancestor_path"
BRANCHES, UNMAPPED = "multiple_branches_review_required", "unmapped"
STRUCTURAL = ("dq_duplicate_category_path", "is_prefix_of_another_path", "dq_navigation_contamination", "dq_repeated_category_label")


_TEXT = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_PATH = rf"\[\s*+{_TEXT}\s*+(?:,\s*+{_TEXT}\s*+)*+\]"
#: JSON arrays of arrays of texts and nothing else; possessive, so that long texts need no stack.
NESTED = rf"(?s)\A\s*+\[\s*+{_PATH}\s*+(?:,\s*+{_PATH}\s*+)*+\]\s*+\z"


def parse_paths(payload: Column) -> Column:
    """Paths of labels from JSON text: a non-empty array of non-empty arrays of texts that are not blank. Anything else fails, null stays null.

    The parser alone would turn numbers and objects into text and stop at the end of a first value, so the shape is asked for too.
    """
    paths = F.from_json(payload, PATHS)
    typed = payload.rlike(NESTED)
    wrong = F.exists(paths, lambda p: p.isNull() | (F.size(p) == 0) | F.exists(p, lambda x: x.isNull() | (strip(x) == "")))
    sound = flag(typed) & flag(F.size(paths) > 0) & flag(~wrong)
    return F.when(payload.isNull(), F.lit(None).cast(PATHS)).when(sound, paths).otherwise(F.raise_error(F.concat(F.lit("malformed paths: "), payload)).cast(PATHS))


def _is_prefix(a: Column, b: Column) -> Column:
    return (F.size(a) < F.size(b)) & (F.slice(b, F.lit(1), F.size(a)) == a)


def _bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of c, which is computed once however often f has it."""
    return F.element_at(F.transform(F.array(c), f), 1)


def _runs(paths: Column) -> Column:
    """The distinct paths of an array in order, each with its places from 0 and labels as given, and whether it begins another.

    In order, all that a path begins stands right behind it, so only neighbours are compared: one sort, whatever the owner has.
    """
    given = F.transform(paths, lambda p, i: F.struct(F.transform(p, strip).alias("path"), i.alias("at"), p.alias("given")))

    def path(s: Column, i: Column) -> Column:
        return F.get(s, i)["path"]

    def starts(s: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | ~path(s, i).eqNullSafe(path(s, i - 1)))

    def run(s: Column, begins: Column, begin: Column, nth: Column) -> Column:
        end = F.coalesce(F.get(begins, nth + 1), F.size(s))
        places = F.transform(F.slice(s, begin + 1, end - begin), lambda e: F.struct(e["at"].alias("at"), e["given"].alias("given")))
        return F.struct(path(s, begin).alias("path"), flag(_is_prefix(path(s, begin), path(s, end))).alias("is_prefix"), places.alias("places"))

    def all_runs(s: Column) -> Column:
        found = _bound(starts(s), lambda begins: F.transform(begins, lambda begin, nth: run(s, begins, begin, nth)))
        return F.when(F.size(s) > 0, found)

    return _bound(F.sort_array(given), all_runs)


def category_paths(df: DataFrame, identity: Sequence[str], paths: str, navigation: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """A row per path: position from 1, labels as given and normalised, depth, and the structural flags.

    A path is a duplicate where it stands several times among its owner's, a prefix where it begins another, repeated
    where a label stands twice in it. Maximal paths begin no other. navigation: a leading part of no meaning, for rows
    that hold `where`. The status is by the first flag of navigation, repeated label, duplicate and prefix. Each row of
    df is an owner, those with one identity too; null and empty arrays have no rows.
    """
    rows = df.select(*identity, flag(F.lit(True) if where is None else where).alias("_nav"), _runs(F.col(paths)).alias("_runs"))
    rows = rows.withColumn("maximal_path_count", F.size(F.filter("_runs", lambda r: ~r["is_prefix"])))
    rows = rows.select(*identity, "_nav", "maximal_path_count", F.explode("_runs").alias("_run"))
    rows = rows.select(
        *identity, "_nav", "maximal_path_count", F.col("_run.path").alias("category_path_normalized"), F.col("_run.is_prefix").alias("is_prefix_of_another_path"),
        (F.size("_run.places") > 1).alias("dq_duplicate_category_path"), F.col("_run.places").alias("_places"),
    ).select("*", F.explode("_places").alias("_place")).drop("_places")
    path = F.col("category_path_normalized")
    nav = F.lit(False) if not navigation else F.col("_nav") & (F.slice(path, F.lit(1), F.lit(len(navigation))) == F.array(*map(F.lit, navigation)))
    rows = rows.withColumns({
        "category_path_position": F.col("_place.at") + 1,
        "category_path": F.col("_place.given"),
        "category_path_depth": F.size(path),
        "dq_repeated_category_label": F.size(F.array_distinct(path)) < F.size(path),
        "dq_navigation_contamination": flag(nav),
    })
    status = (
        F.when(F.col("dq_navigation_contamination"), NAVIGATION).when(F.col("dq_repeated_category_label"), REPEATED)
        .when(F.col("dq_duplicate_category_path"), DUPLICATE).when(F.col("is_prefix_of_another_path"), ANCESTOR)
        .when(F.col("maximal_path_count") > 1, BRANCHES).otherwise(UNMAPPED)
    )
    return rows.withColumn("path_review_status", status).drop("_nav", "_place")


def usable_paths(paths: DataFrame) -> DataFrame:
    """Paths without a structural exclusion."""
    return paths.where(" and ".join(f"not {c}" for c in STRUCTURAL))


def categories(paths: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Distinct paths of each identity with their text, leaf and depth."""
    path = F.col("category_path_normalized")
    return usable_paths(paths).select(*identity, path.alias("category_path"), F.array_join(path, " > ").alias("category_path_text"), F.element_at(path, -1).alias("category_leaf"), "category_path_depth").distinct()


def mine_tokens(df: DataFrame, text: str, code: str, support: int = 20, purity: float = 0.98, least: int = 4, stop: Sequence[str] = ()) -> DataFrame:
    """Words that stand in at least `support` rows and go with one code in at least `purity` of them; a row counts a word once.

    Ties of the leading code go to the least. Two aggregations: by (word, code), then by word.
    """
    words = df.select(F.explode(tokens(F.col(text), least)).alias("token"), F.col(code).alias("code"))
    per_code = words.groupBy("token", "code").agg(F.count("*").alias("n"))
    best = per_code.groupBy("token").agg(F.sum("n").alias("support"), F.min(F.struct((-F.col("n")).alias("n"), "code")).alias("best"))
    rows = best.select("token", F.col("best.code").alias("code"), "support", (-F.col("best.n")).alias("top"))
    rows = rows.where((F.col("support") >= support) & (F.col("top") >= purity * F.col("support")))
    return rows.where(~F.col("token").isin(*stop)) if stop else rows


def name_codes(df: DataFrame, identity: Sequence[str], text: str, vocabulary: DataFrame, least: int = 4, where: Column | None = None) -> DataFrame:
    """identity, name_codes, name_rules: the codes of the vocabulary's words (token, code) that stand in the text, and `name:` and the word for each.

    Only rows that hold `where` are read, as a vocabulary is of one language.
    """
    rows = df if where is None else df.where(where)
    words = rows.select(*identity, F.explode(tokens(F.col(text), least)).alias("token")).join(vocabulary.select("token", "code"), "token")
    return words.groupBy(*identity).agg(F.array_sort(F.collect_set("code")).alias("name_codes"), F.array_sort(F.collect_set(F.concat(F.lit("name:"), "token"))).alias("name_rules"))


def leave_one_out(df: DataFrame, key: str, text: str, code: str, group: str, support: int = 20, purity: float = 0.98, least: int = 4) -> DataFrame:
    """Per group: rows, those that words mined from all other groups decide, and those of these that agree with their own code.

    Words are counted once over all groups; what a group has itself is taken off for its own vocabulary, so there is one
    pass whatever the number of groups. Ties of the leading code go to the least.
    """
    rows = df.where(F.col(group).isNotNull()).select(key, F.col(code).alias("code"), F.col(group).alias("group"), F.explode_outer(tokens(F.col(text), least)).alias("token"))
    words = rows.where("token is not null")
    own = words.groupBy("group", "token", "code").agg(F.count("*").alias("own"))
    every = own.groupBy("token", "code").agg(F.sum("own").alias("n"))
    asked = own.select("group", "token").distinct().join(every, "token").join(own, ["group", "token", "code"], "left")
    asked = asked.withColumn("n", F.col("n") - F.coalesce("own", F.lit(0))).where("n > 0")
    best = asked.groupBy("group", "token").agg(F.sum("n").alias("support"), F.min(F.struct((-F.col("n")).alias("n"), "code")).alias("best"))
    mined = best.where((F.col("support") >= support) & (-F.col("best.n") >= purity * F.col("support"))).select("group", "token", F.col("best.code").alias("_code"))
    named = words.join(mined, ["group", "token"]).groupBy(key, "group", "code").agg(F.min("_code").alias("a"), F.max("_code").alias("b"))
    decided = named.groupBy("group").agg(F.count_if(F.col("a") == F.col("b")).alias("decided"), F.count_if((F.col("a") == F.col("b")) & (F.col("a") == F.col("code"))).alias("agreed"))
    total = df.where(F.col(group).isNotNull()).groupBy(F.col(group).alias("group")).agg(F.count("*").alias("documents"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return total.join(decided, "group", "left").select(F.col("group").alias(group), "documents", zero("decided"), zero("agreed"))
