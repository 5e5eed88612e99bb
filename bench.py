"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs once unmeasured and ``BENCH_RUNS`` times measured; the best time
counts. Every run builds its plan anew and computes every output row and column.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from deskmart.queries import QUERIES  # noqa: E402
from deskmart.session import builder  # noqa: E402

HEADLINE = (
    "adhoc_history_sorted sku_group_occupancy location_occupancy current_occupancy forward_occupancy "
    "discount_at_sale max_discount_month fx_rate_frozen free_months renewal_join relocation_flag latest_promo "
    "running_max note_tags promo_applied email_list deal_size_band row_number_global inventory_mart sales_mart"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        builder("deskmart-bench")
        .master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="deskmart-bench-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        best = None
        for run in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if run and (best is None or took < best):
                best = took
        times[name] = round(best, 3)
        print(f"{name}: {best:.2f}", file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(times.values()), 3)
    result = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
