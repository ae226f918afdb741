"""The session that local runs, the bench and the tests use; on a cluster the session is given."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cpus: int = 4, memory: str = "8g", partitions: int | None = None, name: str = "granary") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    conf = {
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": str(partitions or cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, where they can't import it themselves."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)
