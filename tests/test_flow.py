"""Bronze to gold on small tables, reruns and the guards that stop a bad build."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quaymill import trips as taxi
from quaymill.functions.measures import Exact, Floating
from quaymill.plans import bronze as bronze_plan, gold as gold_plan, silver as silver_plan
from quaymill.plans.gold import CountMismatch, build_gold
from quaymill.plans.silver import RowsLost, build_silver
from quaymill.plans.sources import export_json_sample
from quaymill.sources.files import read_json_lines, write_json_lines
from quaymill.sources.lake import Lake

MONTHS = ["2024-01", "2024-02", "2024-03"]
SILVER_COLUMNS = """
    vendor_id pickup_ts dropoff_ts passenger_count trip_distance rate_code_id store_and_fwd_flag
    pu_location_id do_location_id payment_type fare_amount extra mta_tax tip_amount tolls_amount
    improvement_surcharge total_amount congestion_surcharge airport_fee trip_duration_min
    pickup_date pickup_hour pickup_zone pickup_borough dropoff_zone dropoff_borough source_month
    batch_id source_system silver_ts
""".split()


def month_rows(spark, month, rows=200):
    """Half an hour apart; every seventh is invalid, ten rows are there twice."""
    start = F.lit(f"{month}-01").cast("timestamp_ntz")
    n = F.col("id").cast("int")
    fare = (F.col("id") % 37 * 50 + 325) / 100.0
    frame = spark.range(rows).select(
        F.lit(1).alias("VendorID"),
        F.timestamp_add("MINUTE", n * 30, start).alias("tpep_pickup_datetime"),
        F.timestamp_add("MINUTE", n * 30 + 12, start).alias("tpep_dropoff_datetime"),
        (F.col("id") % 5).cast("double").alias("passenger_count"),
        F.when(F.col("id") % 7 == 0, 0.0).otherwise(F.col("id") % 9 + 0.5).alias("trip_distance"),
        F.lit(1).alias("RatecodeID"),
        F.lit("N").alias("store_and_fwd_flag"),
        (F.col("id") % 3 + 1).alias("PULocationID"),
        (F.col("id") % 2 + 1).alias("DOLocationID"),
        (F.col("id") % 4).alias("payment_type"),
        fare.alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (F.col("id") % 4 / 2).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        (fare + 2).alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.lit(0.0).alias("Airport_fee"),
    )
    return frame.unionByName(frame.limit(10))


@pytest.fixture
def raw(spark, tmp_path):
    paths = {}
    for month in MONTHS[:2]:
        paths[month] = str(tmp_path / f"trips_{month}.parquet")
        month_rows(spark, month).coalesce(1).write.parquet(paths[month])
    (tmp_path / "zones.csv").write_text(
        "LocationID,Borough,Zone,service_zone\n1,East,A,x\n2,East,B,x\n3,West,C,x\nN/A,,,\n"
    )
    write_json_lines(taxi.text_times(taxi.align(month_rows(spark, MONTHS[2]))), str(tmp_path / "json"))
    return {"paths": paths, "zones": str(tmp_path / "zones.csv"), "json": str(tmp_path / "json")}


def land(lake: Lake, raw) -> list[str]:
    bronze_plan.ingest_zones(lake, raw["zones"])
    landed = bronze_plan.ingest_files(lake, raw["paths"])
    bronze_plan.ingest_json(lake, raw["json"], MONTHS[2], "json/trips")
    return landed


def bronze_of(lake):
    return lake.read(bronze_plan.TRIPS, partition_by=taxi.BATCH)


def test_bronze_lands_each_month_once(lake, raw):
    assert land(lake, raw) == MONTHS[:2]
    assert land(lake, raw) == []
    assert not bronze_plan.ingest_json(lake, raw["json"], MONTHS[2])
    bronze = bronze_of(lake)
    counts = bronze_plan.month_counts_with_total(bronze).select("source_month", "rows").collect()
    assert [tuple(row) for row in counts] == [*((m, 210) for m in MONTHS), (None, 630)]
    assert [r[0] for r in bronze_plan.months_present(bronze).collect()] == MONTHS
    systems = bronze.select("source_system", "source_month").distinct().collect()
    assert sorted(map(tuple, systems)) == [
        ("json", MONTHS[2]),
        ("parquet", MONTHS[0]),
        ("parquet", MONTHS[1]),
    ]
    assert bronze.select("batch_id").distinct().count() == 2
    assert set(bronze.columns) == set(taxi.bronze_schema().fieldNames())
    assert {f.name: f.dataType for f in bronze.schema} == {
        f.name: f.dataType for f in taxi.bronze_schema()
    }


def test_bronze_fills_the_missing_source_system(spark, lake):
    old = month_rows(spark, MONTHS[0]).withColumn("source_month", F.lit(MONTHS[0]))
    lake.append(bronze_plan.TRIPS, taxi.align(old), taxi.BATCH)
    assert bronze_plan.backfill_source_system(lake)
    assert bronze_of(lake).select("source_system").distinct().first()[0] == "parquet"
    assert not bronze_plan.backfill_source_system(lake)
    assert not bronze_plan.backfill_source_system(Lake(spark, lake.root + "-none"))


def test_silver_accounts_for_every_row_and_reruns_agree(spark, lake, raw):
    land(lake, raw)
    ledger = build_silver(lake).orderBy("source_month").collect()
    # 200 rows with 29 multiples of seven; among the ten copies two are such.
    assert [tuple(row) for row in ledger] == [(m, 210, 171, 31, 8) for m in MONTHS]

    silver = lake.read(silver_plan.TRIPS, partition_by=taxi.BATCH)
    in_order = silver.select(*SILVER_COLUMNS).columns
    assert sorted(silver.columns) == sorted(in_order) and len(in_order) == 30
    before = silver.drop("silver_ts").orderBy(*[c for c in silver.columns if c != "silver_ts"]).collect()
    build_silver(lake, [MONTHS[1]])
    build_silver(lake)
    again = lake.read(silver_plan.TRIPS, partition_by=taxi.BATCH)
    assert before == again.drop("silver_ts").orderBy(*[c for c in silver.columns if c != "silver_ts"]).collect()
    row = again.where("pickup_ts = timestamp_ntz'2024-01-01 00:30:00'").first()
    assert (row.trip_duration_min, row.pickup_date, row.pickup_hour) == (12.0, dt.date(2024, 1, 1), 0)
    assert (row.pickup_zone, row.pickup_borough, row.dropoff_zone) == ("B", "East", "B")

    quarantine = lake.read(silver_plan.QUARANTINE, partition_by=taxi.BATCH)
    assert quarantine.groupBy("reject_reason").count().collect() == [("invalid_distance", 93)]
    assert set(quarantine.columns) == {*bronze_of(lake).columns, "reject_reason", "quarantined_ts"}


def test_silver_month_that_loses_all_its_rows_is_emptied(spark, lake, raw):
    land(lake, raw)
    build_silver(lake)
    bad = bronze_of(lake).where(F.col("source_month") == MONTHS[0]).withColumn(
        "trip_distance", F.lit(None).cast("double")
    )
    lake.replace_batches(bronze_plan.TRIPS, bad, taxi.BATCH, [MONTHS[0]])
    ledger = build_silver(lake, [MONTHS[0]]).collect()
    assert [tuple(row) for row in ledger] == [(MONTHS[0], 210, 0, 210, 0)]
    assert lake.batches(silver_plan.TRIPS, taxi.BATCH) == MONTHS[1:]


def test_silver_refuses_to_lose_rows(monkeypatch, lake, raw):
    land(lake, raw)
    build_silver(lake)
    version = lake.latest_write(silver_plan.TRIPS).first().version
    real = taxi.to_silver
    monkeypatch.setattr(taxi, "to_silver", lambda rows, zones: real(rows, zones).where("pickup_hour > 0"))
    with pytest.raises(RowsLost, match="2024-01"):
        build_silver(lake)
    assert lake.latest_write(silver_plan.TRIPS).first().version == version
    assert lake.read(silver_plan.TRIPS).where("pickup_hour = 0").count() > 0
    assert os.listdir(f"{lake.root}/_staging") == []


def test_fan_out_in_the_zone_join_is_caught(monkeypatch, lake, raw):
    land(lake, raw)
    real = taxi.zone_dimension
    monkeypatch.setattr(taxi, "zone_dimension", lambda zones: real(zones).union(real(zones)))
    with pytest.raises(RowsLost):
        build_silver(lake)
    assert not lake.exists(silver_plan.TRIPS)


def test_silver_without_bronze_is_empty(lake):
    assert build_silver(lake).isEmpty()
    with pytest.raises(ValueError, match="2024-01"):
        build_silver(lake, ["2024-01"])


def plain_daily(silver):
    tip = F.sum("tip_amount") / F.sum("fare_amount")
    return silver.groupBy("pickup_date").agg(
        F.count("*").alias("trips"),
        F.sum("total_amount").alias("total_revenue"),
        F.round(F.avg("fare_amount"), 2).alias("avg_fare"),
        F.round(F.avg("trip_distance"), 2).alias("avg_distance"),
        F.round(tip, 4).alias("tip_pct"),
    )


@pytest.mark.parametrize("arithmetic", [Floating(), Exact()])
def test_gold_is_the_plain_aggregate(lake, raw, arithmetic):
    land(lake, raw)
    build_silver(lake)
    written = build_gold(lake, arithmetic=arithmetic)
    silver = lake.read(silver_plan.TRIPS, partition_by=taxi.BATCH)
    daily = lake.read(gold_plan.DAILY)
    names = plain_daily(silver).columns
    got = daily.select(*names).orderBy("pickup_date").collect()
    want = plain_daily(silver).orderBy("pickup_date").collect()
    assert [r.pickup_date for r in got] == [r.pickup_date for r in want]
    for left, right in zip(got, want):
        assert tuple(left)[1:] == pytest.approx(tuple(right)[1:], rel=1e-12)
    assert tuple(written[gold_plan.DAILY]) == (len(want), 0)

    again = build_gold(lake, arithmetic=arithmetic)
    assert all(counts.rows_inserted == 0 for counts in again.values())
    assert again[gold_plan.DAILY].rows_updated == len(want)
    hours = lake.read(gold_plan.ZONE_HOUR, partition_by=taxi.BATCH)
    assert hours.columns[-2:] == ["gold_ts", "source_month"]
    assert hours.agg(F.sum("trips")).first()[0] == silver.count()
    assert "gold_ts" not in lake.read(gold_plan.PAYMENT).columns
    rows = {r.table_name: r.rows for r in gold_plan.mart_rows(lake).collect()}
    assert rows[gold_plan.DAILY] == len(want)


def test_gold_for_some_months_and_for_unknown_ones(lake, raw):
    land(lake, raw)
    build_silver(lake)
    build_gold(lake, [MONTHS[1]])
    assert [r[0] for r in lake.read(gold_plan.DAILY).select("source_month").distinct().collect()] == [MONTHS[1]]
    with pytest.raises(ValueError, match="2030-01"):
        build_gold(lake, [MONTHS[0], "2030-01"])


def test_gold_notices_days_that_left_silver(lake, raw):
    land(lake, raw)
    build_silver(lake)
    build_gold(lake)
    fewer = lake.read(silver_plan.TRIPS, partition_by=taxi.BATCH).where("pickup_date > '2024-01-02'")
    lake.replace_batches(silver_plan.TRIPS, fewer, taxi.BATCH, [MONTHS[0]])
    with pytest.raises(CountMismatch):
        build_gold(lake)


def test_months_that_share_days_add_up_in_any_order(spark, tmp_path, lake, raw):
    land(lake, raw)
    build_silver(lake)
    lost = F.when(F.col("pickup_hour") % 3 > 0, F.col(taxi.BATCH))
    silver = lake.read(silver_plan.TRIPS, partition_by=taxi.BATCH).withColumn(taxi.BATCH, lost)
    months = [row[0] for row in silver.select(taxi.BATCH).distinct().collect()]
    assert None in months
    known = sorted(month for month in months if month)
    want = plain_daily(silver).orderBy("pickup_date")
    for number, lots in enumerate(([[None], known], [known[:1], known[1:] + [None]], [None])):
        one = Lake(spark, str(tmp_path / f"lots{number}"))
        one.append_new(silver_plan.TRIPS, silver, taxi.BATCH)
        for lot in lots:
            build_gold(one, lot, Exact())
        got = one.read(gold_plan.DAILY).select(*want.columns).orderBy("pickup_date").collect()
        assert [tuple(row)[1:] for row in got] == [pytest.approx(tuple(row)[1:]) for row in want.collect()]
        hours = one.read(gold_plan.ZONE_HOUR, partition_by=taxi.BATCH)
        assert hours.count() == silver.select(*gold_plan.ZONE_HOUR_KEYS).distinct().count()
        assert hours.agg(F.sum("trips")).first()[0] == silver.count()
    # A day that silver no longer has under a renewed month is noticed.
    first = silver.agg(F.min("pickup_date")).first()[0]
    one.replace_batches(silver_plan.TRIPS, silver.where(F.col("pickup_date") > F.lit(first)), taxi.BATCH, known[:1])
    with pytest.raises(CountMismatch):
        build_gold(one, known[:1], Exact())


def test_gold_without_silver_does_nothing(lake):
    assert build_gold(lake) == {}


def test_ratio_is_null_when_the_fares_cancel(spark):
    rows = [(dt.date(2024, 1, 1), 5.0, 1.0), (dt.date(2024, 1, 1), -5.0, 1.0)]
    silver = spark.createDataFrame(rows, "pickup_date date, fare_amount double, tip_amount double")
    silver = silver.withColumns(
        {
            "total_amount": F.lit(1.0),
            "trip_distance": F.lit(None).cast("double"),
            "trip_duration_min": F.lit(1.0),
            "source_month": F.lit("2024-01"),
            "pickup_hour": F.lit(0),
            "pu_location_id": F.lit(1),
            "pickup_zone": F.lit("z"),
            "pickup_borough": F.lit("b"),
            "payment_type": F.lit(1),
        }
    )
    for arithmetic in (Floating(), Exact()):
        daily = taxi.TripMarts(arithmetic).daily_summary(taxi.trip_measures(silver, arithmetic))
        row = daily.first()
        assert (row.tip_pct, row.avg_distance, row.avg_fare, row.trips) == (None, None, 0.0, 2)


def test_sample_is_exported_once(spark, tmp_path):
    path = str(tmp_path / "feed")
    rows = taxi.align(month_rows(spark, MONTHS[0], 100))
    order = ["tpep_pickup_datetime"]
    assert not export_json_sample(rows, str(tmp_path), MONTHS[0], 5, order)
    assert export_json_sample(rows, path, MONTHS[0], 5, order, files=1)
    assert not export_json_sample(rows, path, MONTHS[0], 50, order)
    back = taxi.parse_times(read_json_lines(spark, path, taxi.json_schema()))
    assert sorted(r[0] for r in back.select("tpep_pickup_datetime").collect()) == sorted(
        r[0] for r in rows.orderBy(*order).select(*order).limit(5).collect()
    )


def test_top_rows_break_ties_by_key(spark):
    rows = [(dt.date(2024, 1, d), h, 1, "z", "b", 1, 10.0) for d in (2, 1) for h in (1, 0)]
    revenue = spark.createDataFrame(
        rows,
        "pickup_date date, pickup_hour int, pu_location_id int, pickup_zone string, "
        "pickup_borough string, trips int, total_revenue double",
    )
    top = taxi.top_zone_hours(revenue, 3).collect()
    assert [(r.pickup_date.day, r.pickup_hour) for r in top] == [(1, 0), (1, 1), (2, 0)]
