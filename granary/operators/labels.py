"""JSON labels: their checks, unpivot to one row per entry, unit standards and cross-checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.columns import finite, flag
from granary.operators.contracts import ContractError

#: (name, unit) -> (standard unit, factor, status)
MAPPING = T.StructType([T.StructField(c, t) for c, t in (("entry", T.StringType()), ("unit", T.StringType()), ("standard_unit", T.StringType()), ("factor", T.DoubleType()), ("status", T.StringType()))])
#: A stated energy may differ from that computed by this share, or by this much.
ENERGY_SHARE, ENERGY_LEAST, KJ_PER_KCAL = 0.02, 1.0, 4.184


def check_mapping(rows: Sequence[tuple]) -> Sequence[tuple]:
    """Keys are unique, an entry has one standard unit, and a factor goes with a compatible unit only."""
    if len({r[:2] for r in rows}) != len(rows):
        raise ContractError("mapping keys are repeated")
    standard: dict[str, str] = {}
    for entry, _, unit, factor, status in rows:
        if standard.setdefault(entry, unit) != unit:
            raise ContractError(f"{entry} has several standard units")
        if (status == "incompatible_unit") != (factor is None) or status not in ("identity", "converted", "incompatible_unit") or (status == "identity" and factor != 1):
            raise ContractError(f"{entry}: factor {factor} does not go with status {status}")
    return rows


def entries(payload: Column, path: str) -> Column:
    """The object at the path as name -> (value, unit), both as text; null for anything else."""
    return F.from_json(F.get_json_object(payload, path), "map<string,struct<value:string,unit:string>>")


def unpivot(df: DataFrame, payload: str, path: str, keep_empty: bool = False) -> DataFrame:
    """A row per entry: entry, raw_value, raw_unit. Labels without entries are kept only if asked for."""
    explode = F.explode_outer if keep_empty else F.explode
    rows = df.select("*", explode(entries(F.col(payload), path)).alias("entry", "_e"))
    return rows.withColumns({"raw_value": F.col("_e.value"), "raw_unit": F.col("_e.unit")}).drop("_e")


def completeness(df: DataFrame, payload: str, path: str) -> DataFrame:
    """df with the numbers of entries, of numeric ones and of units."""
    values = F.coalesce(F.map_values(entries(F.col(payload), path)), F.array().cast("array<struct<value:string,unit:string>>"))
    number = lambda e: finite(e["value"].try_cast("double"))
    return df.withColumns({
        "entry_count": F.size(values),
        "numeric_entry_count": F.size(F.filter(values, lambda e: F.coalesce(number(e), F.lit(False)))),
        "populated_unit_count": F.size(F.filter(values, lambda e: F.coalesce(F.nullif(F.trim(e["unit"]), F.lit("")).isNotNull(), F.lit(False)))),
    })


def standardize(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Values in standard units; null, with the row kept, where a unit can't be converted or the value is no finite number."""
    joined = rows.join(F.broadcast(mapping), (rows["entry"] == mapping["entry"]) & (rows["raw_unit"] == mapping["unit"]), "left").drop(mapping["entry"]).drop("unit")
    raw = F.col("raw_value").try_cast("double")
    number = F.when(finite(raw), raw)
    return joined.withColumns({
        "value": F.when(F.col("status") != "incompatible_unit", number * F.col("factor")),
        "dq_missing_value": F.col("raw_value").isNull(),
        "dq_non_numeric_value": flag(F.col("raw_value").isNotNull() & number.isNull()),
        "dq_incompatible_unit": flag(F.col("status") == "incompatible_unit"),
        "dq_unknown_unit": F.col("status").isNull(),
        "dq_negative_value": flag(number < 0),
    })


def energy_mismatch(kj: Column, kcal: Column) -> Column:
    """Whether two statements of one energy differ by more than the tolerance; null where one is missing or negative."""
    computed = kcal * KJ_PER_KCAL
    return F.when((kj >= 0) & (kcal >= 0), F.abs(kj - computed) > F.greatest(F.lit(ENERGY_LEAST), computed * ENERGY_SHARE))


def payload_problems(payload: Column, path: str) -> Column:
    """What is wrong with a label: no JSON, no object of entries at the path, or none in it; null for a sound one."""
    inner = F.get_json_object(payload, path)
    keys = F.json_object_keys(inner)
    return F.when(F.try_parse_json(payload).isNull(), "invalid_json").when(keys.isNull(), "no_entries_object").when(F.size(keys) == 0, "empty_entries")


def label_problems(payload: Column, path: str, portion: str, units: Sequence[tuple]) -> Column:
    """payload_problems, else a portion that is not positive and finite with a unit, an entry whose unit is not in the mapping,
    or a value that is no finite number; null for a sound label. units: rows of MAPPING."""
    size = F.get_json_object(payload, f"{portion}.value").try_cast("double")
    unit = F.nullif(F.trim(F.get_json_object(payload, f"{portion}.unit")), F.lit(""))
    known = F.array(*(F.lit(f"{r[0]}\u0000{r[1]}") for r in units)).cast("array<string>")
    every = F.map_entries(entries(payload, path))
    unmapped = F.filter(every, lambda e: ~flag(F.array_contains(known, F.concat(e["key"], F.lit("\u0000"), e["value"]["unit"]))))
    number = lambda e: e["value"]["value"].try_cast("double")
    odd = F.exists(every, lambda e: ~flag(finite(number(e))))
    first = F.get(unmapped, F.lit(0))
    return (
        F.when(payload_problems(payload, path).isNotNull(), payload_problems(payload, path)).when(~flag(finite(size) & (size > 0)) | unit.isNull(), "no positive portion with a unit")
        .when(F.size(unmapped) > 0, F.concat_ws(" ", F.lit("unmapped entry:"), first["key"], first["value"]["unit"])).when(odd, "a value that is no finite number")
    )
