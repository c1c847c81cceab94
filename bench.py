"""Time the layout queries and the main operators; prints one JSON line.

once to warm up and then three times into the noop sink; its median counts.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quaymill import trips as taxi  # noqa: E402
from quaymill.operators.quality import passed  # noqa: E402
from quaymill.plans import bronze, gold, layout, silver  # noqa: E402
from quaymill.session import open_session  # noqa: E402
from quaymill.sources.lake import Lake  # noqa: E402
from quaymill.sources.workspace import work_path  # noqa: E402
from workload import derived  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def once(action: Callable[[], object]) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def median(query: Callable[[], DataFrame]) -> float:
    def run() -> None:
        query().write.format("noop").mode("overwrite").save()

    run()
    return statistics.median(once(run) for _ in range(RUNS))


def build(spark: SparkSession, lake: Lake) -> dict[str, float]:
    """The whole flow once, from the driver's tables."""
    zones = work_path(spark, "bench-zones")
    derived.zones(spark, SF_DIR).select(*taxi.ZONE_COLUMNS).write.option("header", True).csv(zones)
    bronze.ingest_zones(lake, zones)
    rows = derived.trips(spark, SF_DIR).hint("rebalance", taxi.BATCH)
    return {
        "ingest_bronze": once(lambda: bronze.ingest_months(lake, rows, "parquet", "lineitem")),
        "build_silver": once(lambda: silver.build_silver(lake)),
        "build_gold": once(lambda: gold.build_gold(lake)),
        "update_gold": once(lambda: gold.build_gold(lake, ["1996-03"])),
    }


def main() -> None:
    spark = open_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    lake = Lake(spark, work_path(spark, "bench"))
    seconds = build(spark, lake)

    trips = lake.read(bronze.TRIPS, partition_by=taxi.BATCH)
    facts = lake.read(silver.TRIPS, partition_by=taxi.BATCH)
    zones = lake.read(bronze.ZONES)
    hours = lake.read(gold.ZONE_HOUR, partition_by=taxi.BATCH)
    copies = layout.build_copies(spark, lake.path(silver.TRIPS), lake.path("copies"))
    small = spark.read.parquet(copies.small_files)
    clustered = spark.read.parquet(copies.clustered)
    lookup = taxi.zone_lookup(zones)
    marts = taxi.TripMarts()
    measures = taxi.trip_measures(facts)
    first, last = dt.date(1995, 3, 1), dt.date(1995, 3, 7)
    classified = taxi.classify_trips(trips, lookup)

    queries: dict[str, Callable[[], DataFrame]] = {
        "q1_small_files": lambda: layout.month_by_zone_hour(small, "1995-03"),
        "q1_clustered": lambda: layout.month_by_zone_hour(clustered, "1995-03"),
        "q2_small_files": lambda: layout.zone_days_total(small, 7, first, last),
        "q2_clustered": lambda: layout.zone_days_total(clustered, 7, first, last),
        "q3_merge": lambda: layout.borough_totals(clustered, zones, broadcast=False),
        "q3_broadcast": lambda: layout.borough_totals(clustered, zones, broadcast=True),
        "classify": lambda: classified,
        "reject_reasons": lambda: classified.groupBy("reject_reason").agg(F.count("*").alias("n")),
        "dedup_enrich": lambda: taxi.to_silver(taxi.drop_duplicate_trips(passed(classified)), lookup),
        "revenue_by_zone_hour": lambda: marts.revenue_by_zone_hour(measures),
        "daily_summary": lambda: marts.daily_summary(measures),
        "payment_borough": lambda: marts.payment_borough(measures),
        "top_zone_hours": lambda: taxi.top_zone_hours(hours),
        "month_counts": lambda: bronze.month_counts(trips),
    }
    for name, query in queries.items():
        seconds[name] = median(query)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "rows": {"bronze": trips.count(), "silver": facts.count()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
