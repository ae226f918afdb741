"""Content fingerprints and regression baselines."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_aware(*columns: Column) -> Column:
    """A row's hash in which a null counts where it stands: the hash alone skips nulls, so that (1, null) and (null, 1) would be alike."""
    return F.xxhash64(*columns, F.concat(F.lit(""), *(c.isNull().cast("int").cast("string") for c in columns)))


def fingerprint(df: DataFrame, row_hash: Callable[..., Column] = null_aware) -> DataFrame:
    """Rows, the sum and the exclusive or of row hashes: equal for equal contents in any order and layout. row_hash: of the columns by name."""
    h = row_hash(*(F.col(c) for c in sorted(df.columns)))
    return df.select(h.alias("h")).agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum"), F.coalesce(F.bit_xor("h"), F.lit(0)).alias("hash_xor"))


def measure(tables: dict[str, DataFrame], metrics: dict[str, object], invariants: dict[str, Callable[[], int]]) -> dict:
    """What a baseline holds; metrics are values, or how to take them. An error in a metric or invariant is kept as text, so that one does not hide the others."""

    def said(f: Callable[[], object]) -> object:
        try:
            return f()
        except Exception as e:
            return f"error: {type(e).__name__}: {str(e)[:200]}"

    return {
        "tables": {n: {"columns": [[f.name, f.dataType.simpleString()] for f in df.schema], **fingerprint(df).first().asDict()} for n, df in tables.items()},
        "metrics": {n: said(f) if callable(f) else f for n, f in metrics.items()},
        "invariants": {n: said(f) for n, f in invariants.items()},
    }


def compare(now: dict, baseline: dict) -> list[str]:
    """Differences, and every invariant that is not 0."""
    out = [f"invariant {k} is {v}" for k, v in now["invariants"].items() if v != 0]
    for part in ("tables", "metrics"):
        for k in sorted({*now[part], *baseline[part]}):
            a, b = baseline[part].get(k), now[part].get(k)
            if a != b:
                out.append(f"{part} {k}: {json.dumps(a, default=str)} -> {json.dumps(b, default=str)}")
    return out


def update_baseline(now: dict, path: str | Path) -> None:
    """Refuses measurements with a broken invariant or a metric in error."""
    broken = [k for k, v in now["invariants"].items() if v != 0] + [k for k, v in now["metrics"].items() if str(v).startswith("error: ")]
    if broken:
        raise ValueError(f"not a baseline: {broken}")
    Path(path).write_text(json.dumps(now, indent=1, sort_keys=True, default=str))
