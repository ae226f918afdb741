"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up, then three times into the noop sink; the median counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from granary.catalog import QUERIES  # noqa: E402
from granary.session import local_session  # noqa: E402

HEADLINE = (
    "promo_by_location", "weekly_price_fact", "price_versions_profile", "yoy_ratio", "store_vs_national", "wow_ratio_histogram", "measure_overview", "assortment_churn", "listing_bands",
    "calendar_dim", "tuple_distinct_ladder", "row_explosion", "canonical_version", "latest_observation", "label_unpivot_units", "category_benchmark", "threshold_flags", "token_mining", "dim_customer", "fk_audit",
)


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), int(os.environ.get("BENCH_CPUS", "4"))
    spark = local_session(cpus)
    took = {}
    for name in HEADLINE:
        times = []
        for _ in range(4):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        took[name] = round(median(times[1:]), 3)
    print(json.dumps({"metric": "sum of median query times", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf_dir.rsplit("sf", 1)[-1], "cpus": cpus}))


if __name__ == "__main__":
    main()
