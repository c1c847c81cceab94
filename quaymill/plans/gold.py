"""Keep the gold marts current from one pass over the chosen silver months."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, functions as F

from quaymill import trips
from quaymill.functions.measures import ROWS, Arithmetic, Floating
from quaymill.operators.dimensions import broadcast_if_small
from quaymill.plans.silver import TRIPS as SILVER_TRIPS
from quaymill.sources.lake import Lake, key_bounds
from quaymill.sources.workspace import Scratch

ZONE_HOUR = "gold/revenue_by_zone_hour"
DAILY = "gold/daily_summary"
PAYMENT = "gold/payment_borough"
ZONE_HOUR_KEYS = ["pickup_date", "pickup_hour", "pu_location_id"]
DAILY_KEYS = ["pickup_date"]
PAYMENT_KEYS = ["source_month", "pickup_borough", "payment_type"]


class CountMismatch(RuntimeError):
    """The daily mart does not add up to the silver rows."""


def compare_counts(silver: DataFrame, daily: DataFrame) -> DataFrame:
    """One row: silver rows against the trips of the daily mart, zero when there are none."""
    zero = F.lit(0).cast("bigint")
    left = silver.agg(F.count("*").alias("silver_rows"), zero.alias("gold_trips"))
    right = daily.agg(zero.alias("silver_rows"), F.sum("trips").alias("gold_trips"))
    sums = [F.coalesce(F.sum(c), zero).alias(c) for c in ("silver_rows", "gold_trips")]
    return left.unionByName(right).agg(*sums)


def states_table(arithmetic: Arithmetic) -> str:
    """Partial sums of one arithmetic; those of another have other types."""
    return f"gold/trip_states_{type(arithmetic).__name__.lower()}"


def one_month_per_day(states: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows of a day that several months share count for its latest month, so that they add up to one day."""
    latest = states.groupBy(F.col("pickup_date").alias("_day")).agg(F.max(trips.BATCH).alias("_month"))
    # Written and counted, the days are few: the sums stay where they are and take no shuffle.
    latest = broadcast_if_small(scratch.keep(latest, "latest"))
    joined = states.join(latest, F.col("pickup_date").eqNullSafe(F.col("_day")), "left")
    columns = [F.col("_month").alias(c) if c == trips.BATCH else F.col(c) for c in states.columns]
    return joined.select(*columns)


def build_gold(
    lake: Lake, months: Iterable[str] | None = None, arithmetic: Arithmetic = Floating()
) -> dict[str, Row]:
    """Upsert the three marts for the given months, or all of silver; returns rows written.

    Silver is read for these months only. Its sums at the coarsest common grain are kept per month, and a
    day that other months share is summed again from their kept sums, so months can come one by one, in any
    order. Such a day stands under its latest month; rows without a month have the earliest.
    """
    present = lake.batches(SILVER_TRIPS, trips.BATCH)
    if not present and months is None:
        return {}
    if months is not None:
        months = set(months)
        unknown = months - set(present)
        if unknown:
            raise ValueError(f"silver has no rows for {sorted(map(str, unknown))}")
    silver = lake.read(SILVER_TRIPS, partition_by=trips.BATCH)
    if months is not None:
        silver = silver.where(_in_months(months))

    kept = states_table(arithmetic)
    chosen = set(lake.batches(kept, trips.BATCH)) | set(present) if months is None else months
    lake.replace_batches(kept, trips.trip_grain(silver, arithmetic), trips.BATCH, chosen)

    marts = trips.TripMarts(arithmetic)
    with Scratch(lake.spark, "gold") as scratch:
        states = lake.read(kept, partition_by=trips.BATCH)
        renewed = states if months is None else states.where(_in_months(months))
        elsewhere, shared = 0, states
        if months is not None:
            days = scratch.keep(renewed.select(F.col("pickup_date").alias("_day")).distinct(), "days")
            near = states.where(key_bounds(days.select(F.col("_day").alias("pickup_date")), ["pickup_date"]))
            shared = near.join(days, F.col("pickup_date").eqNullSafe(F.col("_day")), "left_semi")
            other = shared.where(~F.coalesce(_in_months(months), F.lit(False)))
            elsewhere = other.agg(F.coalesce(F.sum(ROWS), F.lit(0))).first()[0]
        settled = one_month_per_day(shared, scratch)
        hours = marts.revenue_by_zone_hour(settled)
        written = {
            ZONE_HOUR: lake.upsert(ZONE_HOUR, hours, ZONE_HOUR_KEYS, partition_by=trips.BATCH),
            DAILY: lake.upsert(DAILY, marts.daily_summary(settled), DAILY_KEYS),
            PAYMENT: lake.upsert(PAYMENT, marts.payment_borough(renewed), PAYMENT_KEYS),
        }

        daily = lake.read(DAILY)
        if months is not None:
            # The renewed days, and whatever else stands under these months.
            renewed_day = daily.join(days, F.col("pickup_date").eqNullSafe(F.col("_day")), "left")
            daily = renewed_day.where(F.col("_day").isNotNull() | F.coalesce(_in_months(months), F.lit(False)))
        counts = compare_counts(silver, daily).first()
    if counts["silver_rows"] + elsewhere != counts["gold_trips"]:
        raise CountMismatch(f"daily trips do not match silver: {counts.asDict()}, {elsewhere} of other months")
    return written


def _in_months(months: set[str | None]) -> Column:
    """Rows of the given months; None stands for rows without a month."""
    month = F.col(trips.BATCH)
    known = month.isin(sorted(value for value in months if value is not None))
    return known | month.isNull() if None in months else known


def mart_rows(lake: Lake) -> DataFrame:
    """Rows of each gold table."""
    counts = None
    for table in (ZONE_HOUR, DAILY, PAYMENT):
        one = lake.read(table).agg(F.count("*").alias("rows"))
        one = one.select(F.lit(table).alias("table_name"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts
