"""One query per operator over the driver's tables; each reads the tables whole."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from quaymill import trips as taxi
from quaymill.functions.measures import Exact
from quaymill.operators.dedup import keep_first, keep_first_per_batch
from quaymill.operators.dimensions import flag_known
from quaymill.operators.layout import refile
from quaymill.operators.quality import REASON, passed, reason_histogram, rejected
from quaymill.operators.sample import first_rows
from quaymill.operators.schema import fit_schema
from quaymill.plans import bronze as bronze_plan, gold as gold_plan, layout, silver as silver_plan
from quaymill.plans.sources import export_json_sample
from quaymill.sources.files import read_json_lines, read_text_csv, write_json_lines
from quaymill.sources.lake import Lake
from quaymill.sources.workspace import Scratch, work_path
from workload import derived

EXACT = Exact()
MARTS = taxi.TripMarts(EXACT)
MONTH = taxi.BATCH
BENCH_MONTH, BENCH_ZONE = "1995-03", 7


# --- inputs ---------------------------------------------------------------------------------


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.zone_lookup(derived.zones(spark, sf_dir))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.classify_trips(derived.bronze(spark, sf_dir), _lookup(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = _lookup(spark, sf_dir)
    return taxi.to_silver(_unique_trips(spark, sf_dir, lookup), lookup)


def _unique_trips(spark: SparkSession, sf_dir: str, lookup: DataFrame) -> DataFrame:
    valid = passed(taxi.classify_trips(derived.bronze(spark, sf_dir), lookup))
    return taxi.drop_duplicate_trips(valid)


def _silver_by_month(spark: SparkSession, sf_dir: str, month: Column | None = None) -> DataFrame:
    """Silver rebalanced by month for a partitioned write, before the zones' names make its rows wide.

    ``month`` is another month for each trip.
    """
    lookup = _lookup(spark, sf_dir)
    unique = _unique_trips(spark, sf_dir, lookup)
    if month is not None:
        unique = unique.withColumn(MONTH, month)
    return taxi.to_silver(unique.hint("rebalance", MONTH), lookup)


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.trip_measures(_silver(spark, sf_dir), EXACT)


def _lake(spark: SparkSession, label: str) -> Lake:
    return Lake(spark, work_path(spark, label))


def _kept(frame: DataFrame) -> DataFrame:
    """Written once, for frames that are read several times: a scan instead of all their joins."""
    return Scratch(frame.sparkSession, "kept").keep(frame, "rows")


def _monthly_totals(silver: DataFrame) -> DataFrame:
    total = F.sum(F.round(F.col("total_amount") * 100).cast("bigint")) / F.lit(100.0)
    return silver.groupBy(MONTH).agg(
        F.count("*").alias("trips"), total.alias("total_amount")
    )


# --- quality --------------------------------------------------------------------------------


def reject_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = F.coalesce(REASON, F.lit("valid")).alias(REASON)
    return _classified(spark, sf_dir).groupBy(reason).agg(F.count("*").alias("rows"))


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected(_classified(spark, sf_dir)).drop("quarantined_ts")


def quarantine_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reason_histogram(rejected(_classified(spark, sf_dir)))


def month_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze, lookup = derived.bronze(spark, sf_dir), _lookup(spark, sf_dir)
    classified = _kept(taxi.classify_trips(bronze, lookup))
    unique = keep_first_per_batch(
        classified, taxi.TRIP_KEY, MONTH, exclude=F.col(REASON).isNotNull()
    )
    silver = taxi.to_silver(unique.rows, lookup)
    return silver_plan.reconcile(classified, silver, unique.aside, unique.removed)


# --- dedup and enrichment -------------------------------------------------------------------


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).drop("silver_ts")


def repeated_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = passed(_classified(spark, sf_dir))
    kept = keep_first(valid, taxi.TRIP_KEY, copies="copies")
    return kept.where(F.col("copies") > 1).select(*taxi.TRIP_KEY, "copies")


def zone_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.zone_dimension(derived.zones(spark, sf_dir))


def known_zone_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = _lookup(spark, sf_dir)
    columns = {"PULocationID": "pickup_known", "DOLocationID": "dropoff_known"}
    flagged = flag_known(derived.bronze(spark, sf_dir), lookup, "location_id", columns)
    flags = [F.col(name).isNotNull().alias(name) for name in columns.values()]
    return flagged.groupBy(*flags).agg(F.count("*").alias("rows"))


def zone_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["pickup_zone", "pickup_borough", "dropoff_zone", "dropoff_borough"]
    return _silver(spark, sf_dir).groupBy(*names).agg(F.count("*").alias("trips"))


# --- marts ----------------------------------------------------------------------------------


def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MARTS.daily_summary(_measures(spark, sf_dir)).drop("gold_ts")


def revenue_by_zone_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MARTS.revenue_by_zone_hour(_measures(spark, sf_dir)).drop("gold_ts")


def payment_borough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MARTS.payment_borough(_measures(spark, sf_dir))


def top_zone_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.top_zone_hours(MARTS.revenue_by_zone_hour(_measures(spark, sf_dir)))


def month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_plan.month_counts(derived.bronze(spark, sf_dir))


def month_counts_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_plan.month_counts_with_total(derived.bronze(spark, sf_dir))


def months_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_plan.months_present(derived.bronze(spark, sf_dir))


def daily_trips_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _silver(spark, sf_dir)
    daily = MARTS.daily_summary(taxi.trip_measures(silver, EXACT))
    return gold_plan.compare_counts(silver, daily)


# --- layout ---------------------------------------------------------------------------------


def bench_q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.month_by_zone_hour(_silver(spark, sf_dir), BENCH_MONTH, EXACT)


def bench_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = dt.date(1995, 3, 1), dt.date(1995, 3, 7)
    return layout.zone_days_total(_silver(spark, sf_dir), BENCH_ZONE, first, last, EXACT)


def bench_q3_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = derived.zones(spark, sf_dir)
    return layout.borough_totals(_silver(spark, sf_dir), zones, broadcast=True, arithmetic=EXACT)


def bench_q3_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = derived.zones(spark, sf_dir)
    return layout.borough_totals(_silver(spark, sf_dir), zones, broadcast=False, arithmetic=EXACT)


def _copies(spark: SparkSession, sf_dir: str) -> layout.Copies:
    lake = _lake(spark, "layout")
    lake.overwrite("silver", silver_trips(spark, sf_dir))
    return layout.build_copies(spark, lake.path("silver"), lake.root, small_files=32)


def clustered_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_copies(spark, sf_dir).clustered)


def layout_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each copy, whether it has bytes, and the files of the one that has a fixed number."""
    copies = _copies(spark, sf_dir)
    stats = layout.copy_stats(spark, copies)
    paths = {"small_files": copies.small_files, "clustered": copies.clustered}
    rows = None
    for name, path in paths.items():
        one = spark.read.parquet(path).agg(F.lit(name).alias("copy"), F.count("*").alias("rows"))
        rows = one if rows is None else rows.unionByName(one)
    fixed = F.when(F.col("copy") == "small_files", F.col("files")).alias("files")
    return stats.join(rows, "copy").select("copy", "rows", fixed, (F.col("size_bytes") > 0).alias("has_bytes"))


def refiled_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "refiled")
    refile(silver_trips(spark, sf_dir), path, 32)
    return _monthly_totals(spark.read.parquet(path))


# --- schema and formats ---------------------------------------------------------------------


def align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fee column spelled four ways, and passenger counts as doubles."""
    rows = derived.bronze(spark, sf_dir).withColumn(
        "passenger_count", F.col("passenger_count").cast("double")
    )
    others = [name for name in rows.columns if name != "Airport_fee"]
    fee = F.col("Airport_fee")
    spelled = {
        "lower": [fee.alias("airport_fee")],
        "upper": [fee],
        "both": [
            F.when(F.col("payment_type") == 2, fee).alias("Airport_fee"),
            fee.alias("airport_fee"),
        ],
        "neither": [],
    }
    union = None
    for group, (spelling, fees) in enumerate(spelled.items()):
        part = rows.where(F.col("payment_type") % 4 == group).select(*others, *fees)
        aligned = taxi.align(part).withColumn("spelling", F.lit(spelling))
        union = aligned if union is None else union.unionByName(aligned)
    return union.groupBy("spelling", "RatecodeID", "passenger_count").agg(
        F.count("*").alias("rows"), F.sum("Airport_fee").alias("fees")
    )


def project_to_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = StructType.fromDDL(
        "VendorID int, trip_type string, trip_distance double, PULocationID bigint, batch_id string"
    )
    return fit_schema(derived.bronze(spark, sf_dir), schema, skip=("batch_id",))


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "json")
    rows = derived.trips(spark, sf_dir).drop(MONTH)
    write_json_lines(taxi.text_times(rows), path)
    return taxi.parse_times(read_json_lines(spark, path, taxi.json_schema()))


def csv_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "zones")
    derived.zones(spark, sf_dir).select(*taxi.ZONE_COLUMNS).write.option("header", True).csv(path)
    return read_text_csv(spark, path, taxi.ZONE_COLUMNS)


def pickup_month_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived.trips(spark, sf_dir).drop(MONTH)
    return bronze_plan.month_sample(rows, "1996-05", 100, rows.columns)


def exported_month_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sample by way of a JSON export; the second export must leave the first alone."""
    path = work_path(spark, "export")
    rows = derived.trips(spark, sf_dir).drop(MONTH)
    export_json_sample(rows, path, "1996-05", 100, rows.columns)
    export_json_sample(rows, path, "1996-06", 100, rows.columns)
    return taxi.parse_times(read_json_lines(spark, path, taxi.json_schema()))


def first_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More first rows than one task should sort."""
    rows = _kept(derived.trips(spark, sf_dir))
    return first_rows(rows, 20_000, rows.columns)


# --- table writes ---------------------------------------------------------------------------


def append_new_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the months up to 1998-06, then offer every month: only the rest may be added."""
    lake, rows = _lake(spark, "append"), _kept(derived.bronze(spark, sf_dir))
    lake.append_new("trips", rows.where(F.col(MONTH) <= "1998-06"), MONTH)
    lake.append_new("trips", rows, MONTH)
    return bronze_plan.month_counts(lake.read("trips", partition_by=MONTH))


def replace_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace two months: one by part of its rows, one by none."""
    lake, silver = _lake(spark, "replace"), _silver_by_month(spark, sf_dir).drop("silver_ts")
    lake.append("trips", silver, MONTH)
    table = lake.read("trips", partition_by=MONTH)
    kept = table.where((F.col(MONTH) == BENCH_MONTH) & (F.col("payment_type") != 1))
    lake.replace_batches("trips", kept, MONTH, [BENCH_MONTH, "1996-02"])
    return _monthly_totals(lake.read("trips", partition_by=MONTH))


def backfill_source_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months landed before the column existed, then months that leave some of it null."""
    lake, rows = _lake(spark, "backfill"), derived.bronze(spark, sf_dir)
    old, new = F.col(MONTH) < "1998-01", F.col(MONTH) >= "1998-01"
    lake.append_new("trips", rows.where(old).drop("source_system"), MONTH)
    later = rows.where(new).withColumn(
        "source_system", F.when(F.col("payment_type") != 0, F.lit("json"))
    )
    lake.append_new("trips", later, MONTH)
    lake.fill_nulls("trips", "source_system", "parquet", MONTH)
    table = lake.read("trips", partition_by=MONTH)
    return table.groupBy(MONTH, "source_system").agg(F.count("*").alias("rows"))


def _upserted_daily(spark: SparkSession, sf_dir: str) -> Lake:
    lake, daily = _lake(spark, "upsert"), _kept(MARTS.daily_summary(_measures(spark, sf_dir)))
    for chosen in (F.col(MONTH) <= "1998-06", F.col(MONTH) >= "1998-01"):
        lake.upsert("daily", daily.where(chosen), ["pickup_date"])
    return lake


def upsert_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted_daily(spark, sf_dir).read("daily").drop("gold_ts")


def upsert_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = _upserted_daily(spark, sf_dir).history("daily")
    return history.select("version", "operation", "rows_inserted", "rows_updated")


def latest_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last write of four tables, each of another kind, with its row counts."""
    lake, silver = _lake(spark, "writes"), _kept(silver_trips(spark, sf_dir))
    early, bench = silver.where(F.col(MONTH) <= "1994-06"), silver.where(F.col(MONTH) == BENCH_MONTH)
    lake.append("appended", early.hint("rebalance", MONTH), MONTH)
    lake.append("appended", bench, MONTH)
    lake.append_new("renewed", early, MONTH)
    lake.append_new("renewed", silver.where(F.col(MONTH) <= "1995-06"), MONTH)
    lake.replace_batches("replaced", silver, MONTH, [BENCH_MONTH, "1996-02"])
    lake.overwrite("rewritten", early)
    lake.overwrite("rewritten", bench)
    union = None
    for table in ("appended", "renewed", "replaced", "rewritten"):
        last = lake.latest_write(table).drop("written_at")
        union = last if union is None else union.unionByName(last)
    return union


def upsert_moved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each zone's latest month; the second run moves zones to another partition."""
    lake, per_month = _lake(spark, "moved"), _silver(spark, sf_dir).groupBy("pu_location_id", MONTH)
    counts = _kept(per_month.agg(F.count("*").alias("trips")))
    for chosen in (F.col(MONTH) <= "1998-06", F.lit(True)):
        latest = counts.where(chosen).groupBy("pu_location_id")
        zones = latest.agg(F.max(MONTH).alias(MONTH), F.sum("trips").alias("trips"))
        lake.upsert("zones", zones, ["pu_location_id"], partition_by=MONTH)
    return lake.read("zones", partition_by=MONTH)


# --- whole flow -----------------------------------------------------------------------------


def _refined(spark: SparkSession, sf_dir: str) -> Lake:
    """History from one table, two months as Parquet files, the last as JSON lines; then silver."""
    lake = _lake(spark, "flow")
    raw = Lake(spark, work_path(spark, "raw"))
    raw.append("trips", derived.trips(spark, sf_dir).hint("rebalance", MONTH), MONTH)
    *_, first, second, last = raw.batches("trips", MONTH)
    rows = raw.read("trips", partition_by=MONTH)
    last_rows = rows.where(F.col(MONTH) == last).drop(MONTH)
    write_json_lines(taxi.text_times(last_rows), raw.path("json"))
    zones = derived.zones(spark, sf_dir).select(*taxi.ZONE_COLUMNS)
    zones.write.option("header", True).csv(raw.path("zones"))

    bronze_plan.ingest_zones(lake, raw.path("zones"))
    earlier = rows.where(F.col(MONTH) < first)
    bronze_plan.ingest_months(lake, earlier, "parquet", "trips", rebalance=False)
    files = {month: f"{raw.path('trips')}/{MONTH}={month}" for month in (first, second)}
    bronze_plan.ingest_files(lake, files)
    bronze_plan.ingest_json(lake, raw.path("json"), last)
    silver_plan.build_silver(lake)
    return lake


def pipeline_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refined(spark, sf_dir).read(silver_plan.LEDGER)


def pipeline_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three gold tables after the whole flow, stacked; columns a mart lacks are null."""
    lake = _refined(spark, sf_dir)
    gold_plan.build_gold(lake, arithmetic=EXACT)
    tables = {
        "daily": lake.read(gold_plan.DAILY),
        "zone_hour": lake.read(gold_plan.ZONE_HOUR, partition_by=MONTH).drop("pickup_zone"),
        "payment": lake.read(gold_plan.PAYMENT),
    }
    union = None
    for name, mart in tables.items():
        mart = mart.drop("gold_ts").withColumn("mart", F.lit(name))
        union = mart if union is None else union.unionByName(mart, allowMissingColumns=True)
    return union


def marts_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold from silver whose rows partly lost their month, brought in three lots that share days.

    The rows without a month come second, a month that was already built comes again with the last lot.
    """
    lake = _lake(spark, "lots")
    lost = F.when(F.col("PULocationID") % 7 != 3, F.col(MONTH))
    silver = _silver_by_month(spark, sf_dir, lost)
    lake.append_new(silver_plan.TRIPS, silver, MONTH, rebalance=False)
    months = [month for month in lake.batches(silver_plan.TRIPS, MONTH) if month is not None]
    half = len(months) // 2
    for lot in (months[:half], [None], months[half - 1 :]):
        gold_plan.build_gold(lake, lot, EXACT)
    daily = lake.read(gold_plan.DAILY).withColumn("mart", F.lit("daily"))
    hours = lake.read(gold_plan.ZONE_HOUR, partition_by=MONTH).withColumn("mart", F.lit("zone_hour"))
    return daily.unionByName(hours, allowMissingColumns=True).drop("gold_ts")


def pipeline_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _refined(spark, sf_dir)
    gold_plan.build_gold(lake)
    return gold_plan.mart_rows(lake)


QUERIES = [
    reject_reason_counts,
    quarantine_rows,
    quarantine_histogram,
    month_reconciliation,
    silver_trips,
    repeated_trips,
    zone_dimension,
    known_zone_flags,
    zone_pair_counts,
    daily_summary,
    revenue_by_zone_hour,
    payment_borough,
    top_zone_hours,
    month_counts,
    month_counts_total,
    months_present,
    daily_trips_check,
    bench_q1,
    bench_q2,
    bench_q3_broadcast,
    bench_q3_merge,
    clustered_copy,
    layout_stats,
    refiled_copy,
    align_schema,
    project_to_schema,
    json_roundtrip,
    csv_zones,
    pickup_month_sample,
    exported_month_sample,
    first_trips,
    append_new_months,
    replace_month,
    backfill_source_system,
    upsert_daily,
    upsert_metrics,
    latest_writes,
    upsert_moved_keys,
    pipeline_ledger,
    pipeline_marts,
    marts_by_month,
    pipeline_table_rows,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}
