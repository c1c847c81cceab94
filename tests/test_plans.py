"""What the physical plans must show: pruning, pushdown, join choice and what is shuffled."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import re

import pytest
from pyspark.sql import functions as F

from quaymill import trips as taxi
from quaymill.operators.dimensions import broadcast_if_small
from quaymill.plans import layout
from quaymill.sources.lake import Lake


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def details_of(frame) -> str:
    """The formatted plan, whose scan details are not cut short."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()


def scanned(details: str) -> set[str]:
    """Columns read from files, over all scans."""
    return {
        field.split(":")[0]
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", details)
        for field in schema.split(",")
    }


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("plans")))
    bronze = spark.createDataFrame([], taxi.bronze_schema())
    one = spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in bronze.schema if f.name != taxi.BATCH],
        F.lit("2024-01").alias(taxi.BATCH),
    )
    zones = spark.createDataFrame(
        [("1", "East", "A", "x")], "LocationID string, Borough string, Zone string, service_zone string"
    )
    lake.append("silver", taxi.to_silver(one, taxi.zone_lookup(zones)), taxi.BATCH)
    return lake.read("silver", partition_by=taxi.BATCH)


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame([("1", "East", "A")], "LocationID string, Borough string, Zone string")


def test_month_query_prunes_partitions_and_columns(silver):
    plan = details_of(layout.month_by_zone_hour(silver, "2024-01"))
    assert re.search(r"PartitionFilters: \[[^\]]*source_month#\d+ = 2024-01", plan)
    assert scanned(plan) == {"pu_location_id", "pickup_hour", "total_amount"}


def test_zone_days_query_pushes_its_filters(silver):
    days = dt.date(2024, 1, 1), dt.date(2024, 1, 7)
    plan = details_of(layout.zone_days_total(silver, 132, *days))
    assert "EqualTo(pu_location_id,132)" in plan
    assert "GreaterThanOrEqual(pickup_date,2024-01-01)" in plan
    assert "LessThanOrEqual(pickup_date,2024-01-07)" in plan


def test_borough_query_broadcasts_or_sums_before_its_merge_join(silver, zones):
    assert "BroadcastHashJoin" in plan_of(layout.borough_totals(silver, zones, broadcast=True))
    merged = plan_of(layout.borough_totals(silver, zones, broadcast=False))
    assert "SortMergeJoin" in merged and "BroadcastHashJoin" not in merged
    below_join = merged[merged.index("SortMergeJoin"):]
    assert below_join.index("partial_sum") < below_join.index("FileScan")


def test_gold_grain_is_one_scan_of_the_needed_columns_in_the_chosen_months(silver):
    grain = taxi.trip_grain(silver.where(F.col(taxi.BATCH).isin(["2024-01", "2024-02"])))
    plan, details = plan_of(grain), details_of(grain)
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "source_month#" in re.search(r"PartitionFilters: \[(.*?)\]", details).group(1)
    measured = {m.column for m in taxi.MEASURES}
    assert scanned(details) == measured | (set(taxi.GRAIN) - {taxi.BATCH})


def test_each_mart_is_one_shuffle(silver):
    measures = taxi.trip_measures(silver)
    marts = taxi.TripMarts()
    for mart in (marts.revenue_by_zone_hour, marts.daily_summary, marts.payment_borough):
        assert plan_of(mart(measures)).count("Exchange") == 1


def test_lookup_past_its_bound_is_not_broadcast_by_hint(spark):
    lookup = spark.range(10)
    hinted = broadcast_if_small(lookup, 10)._jdf.queryExecution().optimizedPlan().toString()
    plain = broadcast_if_small(lookup, 9)._jdf.queryExecution().optimizedPlan().toString()
    assert "ResolvedHint" in broadcast_if_small(lookup, 10)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_if_small(lookup, 9)._jdf.queryExecution().analyzed().toString()
    assert hinted == plain


def test_classification_joins_without_a_shuffle_of_the_trips(spark, tmp_path, zones):
    path = str(tmp_path / "bronze")
    spark.createDataFrame([], taxi.bronze_schema()).write.parquet(path)
    plan = plan_of(taxi.classify_trips(spark.read.parquet(path), taxi.zone_lookup(zones)))
    assert plan.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning(PULocationID" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
