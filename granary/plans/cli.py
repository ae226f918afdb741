"""Command line: a snapshot of the sources, the clean tables, the star schema, and the figures that they are held to.

    python -m granary.plans.cli raw    --raw DIR [--rebuild --sources FILE]
    python -m granary.plans.cli silver --raw DIR --silver DIR --spec FILE
    python -m granary.plans.cli gold   --silver DIR --gold DIR --spec FILE
    python -m granary.plans.cli parity --silver DIR --gold DIR --baseline FILE [--update-baseline]
    python -m granary.plans.cli all    --raw DIR --silver DIR --gold DIR --spec FILE --baseline FILE [--rebuild --sources FILE]

A Spec (see plans.retail) is a JSON file; sources are url, tables (name -> table) and properties of a database. Each step
fails with a message and exit code 1; `all` runs each in a process of its own and stops at the first that fails.
"""

from __future__ import annotations

import argparse
import json
import subprocess
import sys
from pathlib import Path

from pyspark.sql import SparkSession

import granary
from granary.plans import parity as P
from granary.plans import retail as R
from granary.plans.fingerprint import compare, measure, update_baseline
from granary.plans.publish import code_fingerprint, current, load, publish
from granary.session import local_session
from granary.sources.extract import jdbc_readers, open_snapshot, snapshot


def code() -> str:
    root = Path(granary.__file__).parent
    return code_fingerprint(root / "operators", root / "functions", root / "plans", root / "sources")


def raw(spark: SparkSession, args: argparse.Namespace) -> None:
    """Check the snapshot of the sources, or take a new one."""
    if args.rebuild:
        said = json.loads(Path(args.sources).read_text())
        snapshot(spark, args.raw, jdbc_readers(spark, said["url"], said["tables"], said.get("properties", {})), replace=True)
    print(json.dumps({n: df.count() for n, df in open_snapshot(spark, args.raw).items()}))


def silver(spark: SparkSession, args: argparse.Namespace) -> None:
    found = current(spark, args.raw)
    open_snapshot(spark, args.raw, found)
    spec = R.Spec.read(args.spec)
    paths = found.paths()
    manifest = publish(spark, args.silver, {n: paths[n] for n in R.RAW}, R.silver_jobs(spec), code, R.check_silver(spec))
    print(json.dumps({n: t["metrics"] for n, t in manifest["tables"].items()} | {"cross_table": manifest["metrics"]}, default=str))


def gold(spark: SparkSession, args: argparse.Namespace) -> None:
    found = current(spark, args.silver)
    load(spark, args.silver, code(), found=found)
    spec = R.Spec.read(args.spec)
    paths = found.paths()
    manifest = publish(spark, args.gold, {n: paths[n] for n in R.SILVER}, R.gold_jobs(spec), code, lambda t: R.check_gold(t, spec.market, (spec.national, spec.store)))
    print(json.dumps({n: t["rows"] for n, t in manifest["tables"].items()}))


def parity(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = load(spark, args.silver, code()) | load(spark, args.gold, code())
    now = measure(tables, P.metrics(tables), {n: lambda f=f: f(tables) for n, f in P.INVARIANTS.items()})
    if args.update_baseline:
        update_baseline(now, args.baseline)
    elif found := compare(now, json.loads(Path(args.baseline).read_text())):
        raise SystemExit("\n".join(found))


STEPS = {"raw": raw, "silver": silver, "gold": gold, "parity": parity}
NEEDS = {"raw": ("raw",), "silver": ("raw", "silver", "spec"), "gold": ("silver", "gold", "spec"), "parity": ("silver", "gold", "baseline"), "all": ("raw", "silver", "gold", "spec", "baseline")}


def run_all(args: argparse.Namespace) -> int:
    for step in STEPS:
        given = [x for n in NEEDS[step] for x in (f"--{n}", getattr(args, n))]
        given += ["--rebuild", "--sources", args.sources] if step == "raw" and args.rebuild else []
        given += ["--update-baseline"] if step == "parity" and args.update_baseline else []
        if code := subprocess.run([sys.executable, "-m", "granary.plans.cli", step, *given], check=False).returncode:
            print(f"{step} failed, the steps after it were not run", file=sys.stderr)
            return code
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="granary")
    parser.add_argument("step", choices=[*STEPS, "all"])
    for name in ("raw", "silver", "gold", "spec", "baseline", "sources"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--update-baseline", action="store_true")
    parser.add_argument("--rebuild", action="store_true")
    args = parser.parse_args(argv)
    if missing := [f"--{n}" for n in (*NEEDS[args.step], *(("sources",) if args.rebuild else ())) if not getattr(args, n)]:
        parser.error(f"{args.step} needs {' '.join(missing)}")
    if args.step == "all":
        return run_all(args)
    spark = SparkSession.getActiveSession() or local_session()
    try:
        STEPS[args.step](spark, args)
    except (Exception, SystemExit) as e:
        print(f"{args.step} failed: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
