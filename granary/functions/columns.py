"""Column expressions: text cleaning, code decoding, geography, dates and three-valued logic."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence
from functools import cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole texts, in lower case, that stand for a missing value; and those of single columns.
NULL_TOKENS = ("", "null", "none", "n/a", "#n/a")
COLUMN_TOKENS = {
    "name": ("not provided",),
    "brand": ("not provided", "no brand", "unknown", "*", ".", "geen"),
    "description": ("x", "*", "0", "-", "."),
}
# Four-digit postcodes of the regions, and the box that coordinates should lie in.
REGIONS = (("Brussels", 1000, 1299), ("Wallonia", 1300, 1499), ("Flanders", 1500, 3999), ("Wallonia", 4000, 7999), ("Flanders", 8000, 9999))
LATITUDES, LONGITUDES = (49.4, 53.6), (2.5, 7.3)
# The types of a location.
NATIONAL, STORE = "National price (online)", "Store"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def normalize_text(c: Column, tokens: Sequence[str] = ()) -> Column:
    """Stripped; null where the whole text, in any case, is a missing-value token."""
    text = strip(c)
    return F.when(~F.lower(text).isin(*NULL_TOKENS, *tokens), text)


def decode_code(c: Column, encoded: Sequence[str], canonical: Sequence[str]) -> Column:
    """Reviewed encoded codes reversed, canonical ones as they are, null for missing; anything else fails. Idempotent."""
    if both := set(encoded) & set(canonical):
        raise ValueError(f"codes both encoded and canonical: {sorted(both)}")
    text = normalize_text(c)
    known = F.when(text.isNull(), text).when(text.isin(*encoded), F.reverse(text)).when(text.isin(*canonical), text)
    return known.otherwise(F.raise_error(F.concat(F.lit("unknown code: "), text)))


def lookup(c: Column, values: Mapping, what: str = "value") -> Column:
    """The mapped value; null stays null and an unmapped one fails."""
    cases = reduce(lambda acc, kv: acc.when(c == kv[0], F.lit(kv[1])), values.items(), F.when(c.isNull(), F.lit(None)))
    return cases.otherwise(F.raise_error(F.concat(F.lit(f"unknown {what}: "), c.cast("string"))))


@F.pandas_udf(T.StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Composed Unicode; Spark has no built-in for it. Apply to distinct values and join back where they repeat."""
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


@F.pandas_udf(T.StringType())
def label_key(texts: pd.Series) -> pd.Series:
    """What labels are compared by: composed, stripped, white space as one blank, case folded. Apply it to distinct labels and join back."""
    return texts.map(lambda t: " ".join(unicodedata.normalize("NFC", t).split()).casefold(), na_action="ignore")


@cache
def _unsettled() -> str:
    """A regular expression for one character that composing may change, move or join to the one before it; all others end what a change can reach."""
    pairs = (unicodedata.decomposition(chr(n)).split() for n in range(0xC0, 0x30000))
    seconds = {int(p[1], 16) for p in pairs if len(p) == 2 and p[0][0] != "<"} | {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}
    each = (n for n in range(0x300, 0x110000) if not 0xD800 <= n < 0xE000)
    found = [n for n in each if n in seconds or unicodedata.combining(chr(n)) or not unicodedata.is_normalized("NFC", chr(n))]
    starts = [n for n, before in zip(found, [-1, *found], strict=False) if n != before + 1]
    ends = [n for n, after in zip(found, [*found[1:], -1], strict=True) if n != after - 1]
    return r"[[^\x00-\x{2FF}]&&[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in zip(starts, ends, strict=True)) + "]]"


def composed(df: DataFrame, column: str) -> DataFrame:
    """df with a column's texts composed (NFC). Only the places of a text that composing may change go to Python, each with the character before it.

    What stands between them is composed as it is, and most texts have no such place.
    """
    other = flag(F.col(column).rlike(_unsettled()))
    place = F.lit(rf"[^\n]?{_unsettled()}+")
    rows = df.where(other).withColumn("_places", nfc(F.array_join(F.regexp_extract_all(column, place, F.lit(0)), "\n")))
    both = F.zip_with(F.split(column, place), F.split("_places", "\n"), lambda between, at: F.concat(between, F.coalesce(at, F.lit(""))))
    return df.where(~other).unionByName(rows.withColumn(column, F.array_join(both, "")).select(*df.columns))


def tokens(c: Column, least: int = 4) -> Column:
    """Distinct words of at least `least` Latin letters, in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(f"[a-zà-ÿ]{{{least},}}"), F.lit(0)))


def flag(c: Column) -> Column:
    """Two-valued: unknown counts as false."""
    return F.coalesce(c, F.lit(False))


def finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) < float("inf"))


def must_be_finite(c: Column, name: str) -> Column:
    """The value, or null; NaN and infinities fail."""
    return F.when(c.isNull() | finite(c), c).otherwise(F.raise_error(F.lit(f"{name}: a value that is not finite")).cast("double"))


def only_value(c: Column) -> Column:
    """Aggregate: the value that all non-null rows of the group agree on, else null."""
    return F.when(F.min(c).eqNullSafe(F.max(c)), F.min(c))


def n_values(c: Column) -> Column:
    """Aggregate: distinct non-null values, for groups of few rows; needs no second shuffle where several are counted."""
    return F.size(F.collect_set(c)).cast("long")


def region(postcode: Column) -> Column:
    """By four-digit postcode; any other shape gives null."""
    number = F.regexp_extract(strip(postcode), "^([0-9]{4})$", 1).try_cast("int")
    return reduce(lambda acc, r: acc.when(number.between(r[1], r[2]), r[0]), REGIONS[1:], F.when(number.between(*REGIONS[0][1:]), REGIONS[0][0]))


def location_type(name: Column, national: str = NATIONAL, store: str = STORE) -> Column:
    return F.when(F.lower(strip(name)) == "default", national).otherwise(store)


def outside_box(latitude: Column, longitude: Column) -> Column:
    """False where a coordinate is missing."""
    return flag(~latitude.between(*LATITUDES) | ~longitude.between(*LONGITUDES))


def iso_week_label(d: Column) -> Column:
    return F.format_string("%04d-W%02d", F.extract(F.lit("yearofweek"), d), F.weekofyear(d))


def week_of(c: Column) -> Column:
    """The Monday of the week."""
    return F.trunc(c.cast("date"), "week")
