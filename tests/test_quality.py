"""Each rule at its boundary, the order of the rules, and the two timestamp kinds."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quaymill import trips as taxi
from quaymill.operators.quality import Range, any_outside, passed, reason_histogram, rejected

SCHEMA = (
    "trip string, pickup string, dropoff string, source_month string, trip_distance double, "
    "fare_amount double, total_amount double, passenger_count int, PULocationID int, "
    "DOLocationID int"
)
GOOD = {
    "pickup": "2022-11-30 23:41:07",
    "dropoff": "2022-12-01 00:03:52",
    "source_month": "2022-11",
    "trip_distance": 7.31,
    "fare_amount": 23.6,
    "total_amount": 31.15,
    "passenger_count": 3,
    "PULocationID": 48,
    "DOLocationID": 230,
}

CASES = [
    ("valid", {}, None),
    ("pickup missing", {"pickup": None}, "null_pickup_or_dropoff"),
    ("dropoff missing", {"dropoff": None}, "null_pickup_or_dropoff"),
    ("dropoff before pickup", {"dropoff": "2022-11-30 23:41:06"}, "dropoff_not_after_pickup"),
    ("dropoff equals pickup", {"dropoff": "2022-11-30 23:41:07"}, "dropoff_not_after_pickup"),
    (
        "other month",
        {"pickup": "2022-12-01 00:00:00"},
        "pickup_outside_source_month",
    ),
    ("no month", {"source_month": None}, None),
    ("exactly a day", {"dropoff": "2022-12-01 23:41:07"}, None),
    ("a day and a fraction", {"dropoff": "2022-12-01 23:41:07.9"}, None),
    ("a day and a second", {"dropoff": "2022-12-01 23:41:08"}, "duration_over_24h"),
    ("no distance", {"trip_distance": None}, "invalid_distance"),
    ("zero distance", {"trip_distance": 0.0}, "invalid_distance"),
    ("distance at the limit", {"trip_distance": 200.0}, None),
    ("distance past the limit", {"trip_distance": 200.01}, "invalid_distance"),
    ("distance not a number", {"trip_distance": float("nan")}, "invalid_distance"),
    ("negative fare", {"fare_amount": -0.3}, "negative_fare_or_total"),
    ("negative total", {"total_amount": -0.01}, "negative_fare_or_total"),
    ("zero fare", {"fare_amount": 0.0}, None),
    ("fare missing", {"fare_amount": None}, None),
    ("both missing", {"fare_amount": None, "total_amount": None}, None),
    (
        "fare missing, total negative",
        {"fare_amount": None, "total_amount": -2.0},
        "negative_fare_or_total",
    ),
    ("passengers missing", {"passenger_count": None}, None),
    ("no passengers", {"passenger_count": 0}, None),
    ("nine passengers", {"passenger_count": 9}, None),
    ("ten passengers", {"passenger_count": 10}, "invalid_passenger_count"),
    ("minus one passenger", {"passenger_count": -1}, "invalid_passenger_count"),
    ("unknown pickup", {"PULocationID": 49}, "unknown_pickup_zone"),
    ("pickup zone missing", {"PULocationID": None}, "unknown_pickup_zone"),
    ("unknown dropoff", {"DOLocationID": 23}, "unknown_dropoff_zone"),
    (
        "first rule wins",
        {"dropoff": None, "passenger_count": 77, "DOLocationID": None},
        "null_pickup_or_dropoff",
    ),
    ("later rules in order", {"passenger_count": 12, "PULocationID": 49}, "invalid_passenger_count"),
]


def trip_frame(spark, cases, kind):
    rows = [tuple({"trip": name, **GOOD, **change}.values()) for name, change, _ in cases]
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.select(
        "*",
        F.col("pickup").cast(kind).alias("tpep_pickup_datetime"),
        F.col("dropoff").cast(kind).alias("tpep_dropoff_datetime"),
    ).drop("pickup", "dropoff")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_each_rule_and_its_boundary(spark, kind):
    trips = trip_frame(spark, CASES, kind)
    classified = taxi.classify_trips(trips, taxi.known_ids(spark, [48, 230]))
    got = {row.trip: row.reject_reason for row in classified.collect()}
    assert got == {name: reason for name, _, reason in CASES}
    assert classified.columns == [*trips.columns, "reject_reason"]


def test_ranges_take_columns_and_tell_missing_from_outside(spark):
    rows = [(1.0, 0.0, 2.0), (None, 0.0, 2.0), (2.0, 2.0, None), (float("nan"), None, 9.0), (3.0, 1.0, 2.0)]
    frame = spark.createDataFrame(rows, "v double, low double, high double")
    ranges = [Range(above="low", most="high"), Range(above="low", required=True), Range(least="low"), Range(required=True)]
    got = frame.select(*[any_outside([F.col("v")], limit).alias(f"r{n}") for n, limit in enumerate(ranges)]).collect()
    assert [tuple(row) for row in got] == [
        (False, False, False, False),
        (False, True, False, True),
        (True, True, False, False),
        (True, False, False, False),
        (True, False, False, False),
    ]


def test_split_keeps_every_row_once(spark):
    trips = trip_frame(spark, CASES, "timestamp_ntz")
    classified = taxi.classify_trips(trips, taxi.known_ids(spark, [48, 230]))
    good, bad = passed(classified), rejected(classified)
    assert good.count() + bad.count() == len(CASES)
    assert "reject_reason" not in good.columns
    assert bad.where(F.col("quarantined_ts").isNull() | F.col("reject_reason").isNull()).isEmpty()


def test_histogram_orders_by_count_then_reason(spark):
    reasons = ["b", "a", "c", "c"]
    frame = spark.createDataFrame([(r,) for r in reasons], "reject_reason string")
    rows = [tuple(row) for row in reason_histogram(frame).collect()]
    assert rows == [("c", 2), ("a", 1), ("b", 1)]


def test_zone_table_may_repeat_and_lack_ids(spark):
    zones = spark.createDataFrame(
        [("48", "Q", "Airport"), ("48", "Q", "Airport"), (None, "x", "y"), ("N/A", "x", "y")],
        "LocationID string, Borough string, Zone string",
    )
    dimension = taxi.zone_dimension(zones)
    assert [tuple(row) for row in dimension.collect()] == [(48, "Airport", "Q")]
    trips = trip_frame(spark, [("t", {"DOLocationID": 48}, None)], "timestamp_ntz")
    classified = taxi.classify_trips(trips, taxi.zone_lookup(zones))
    assert [row.reject_reason for row in classified.collect()] == [None]
