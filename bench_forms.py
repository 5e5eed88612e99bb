"""Plain and rewritten forms of the same result, timed side by side (best of two warm runs).

``python bench_forms.py [sf_dir]``. Both forms must return the same number of rows.
"""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from deskmart.operators import ordering, population, promos, rates  # noqa: E402
from deskmart.session import builder  # noqa: E402
from deskmart.sources.adapter import LazyRoles  # noqa: E402

SALE = ["sales_reporting_month", "deal_uuid", "primary_reservation_uuid"]


def plain_row_number(r):
    return r.deals.select(*SALE).withColumn("n", F.row_number().over(Window.orderBy(*SALE)))


def range_row_number(r):
    return ordering.number_rows(r.deals.select(*SALE), [F.asc_nulls_last(c) for c in SALE], "n")


def plain_frozen_rate(r):
    a, br = r.spaces.alias("a"), r.rates.alias("br")
    same_month = F.when(F.year("a.report_month") <= 2022, F.col("a.report_month") == F.col("br.report_month")).when(
        F.year("a.report_month") > 2022, F.col("br.report_month") == F.lit(rates.FROZEN_MONTH)
    )
    joined = a.join(br, (F.col("a.local_currency") == F.col("br.source_currency")) & same_month, "left")
    return joined.select("a.reservable_uuid", "a.report_month", "br.budget_rate")


def keyed_frozen_rate(r):
    return rates.with_frozen_rate(r.spaces, r.rates).select("reservable_uuid", "report_month", "budget_rate")


def plain_latest_promo(r):
    live = promos.live_terms(population.active_spaces(r.spaces, r.accounts))
    term = Window.partitionBy("reservation_uuid", "term_id")
    created = "commitment_term_created_utc"
    rows = live.select(
        *promos._ROW,
        F.max("applied_discount").over(term.orderBy(F.asc_nulls_last(created))).alias("applied_discount"),
        F.rank().over(term.orderBy(F.desc_nulls_last(created))).alias("rank"),
    )
    return rows.filter(F.col(created).isNotNull() & (F.col("rank") == 1)).distinct()


def aggregated_latest_promo(r):
    return promos.latest_promo(population.active_spaces(r.spaces, r.accounts))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        builder("deskmart-forms")
        .master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="deskmart-forms-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    pairs = [
        ("row number", plain_row_number, range_row_number),
        ("frozen rate", plain_frozen_rate, keyed_frozen_rate),
        ("latest promo", plain_latest_promo, aggregated_latest_promo),
    ]
    for name, plain, ours in pairs:
        best = []
        for form in (plain, ours):
            took = []
            for _ in range(3):
                start = time.perf_counter()
                form(LazyRoles(spark, sf_dir)).write.format("noop").mode("overwrite").save()
                took.append(time.perf_counter() - start)
            best.append(min(took[1:]))
        rows = [form(LazyRoles(spark, sf_dir)).count() for form in (plain, ours)]
        if rows[0] != rows[1]:
            raise SystemExit(f"{name}: row counts differ: {rows}")
        print(f"{name}: plain {best[0]:.2f} s, rewritten {best[1]:.2f} s, {rows[0]} rows", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
