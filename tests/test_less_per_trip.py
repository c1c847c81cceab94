"""Fewer evaluations, narrower shuffles and fewer writes on the way to silver and gold."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaymill import trips as taxi
from quaymill.operators.quality import Range, any_outside, passed
from quaymill.plans import gold, silver
from quaymill.sources.lake import Lake
from quaymill.sources.workspace import Scratch
from test_round_three import counted, own_trips  # noqa: F401
from workload import derived, queries


def optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_a_filter_on_valid_trips_computes_month_and_seconds_once(spark):
    rows = own_trips(spark).repartition(2)
    plan = optimized(passed(taxi.classify_trips(rows, taxi.known_ids(spark, [0, 1, 2]))))
    assert plan.count("date_format(") == 1 and plan.count("timestampdiff(") == 1


def test_equal_ends_reject_what_two_comparisons_rejected(spark):
    values = [None, -0.0, 0.0, 1.0, 2.0, float("inf"), float("nan")]
    frame = spark.createDataFrame([(v, e) for v in values for e in values], "v double, e double")
    v, e = F.col("v"), F.col("e")
    for required in (False, True):
        was = F.when(v.isNull(), F.lit(required)).otherwise(F.coalesce((v < e) | (v > e), F.lit(False)))
        now = any_outside([v], Range(least="e", most="e", required=required))
        assert frame.where(~was.eqNullSafe(now)).count() == 0


def months_written(monkeypatch, method):
    """The frames that the tables get from this method, in order."""
    frames, real = [], getattr(Lake, method)
    monkeypatch.setattr(Lake, method, lambda self, table, frame, *rest, **more: frames.append(frame) or real(self, table, frame, *rest, **more))
    return frames


def test_replaced_months_are_rebalanced_before_the_zones_names(spark, counted, monkeypatch):  # noqa: F811
    frames = months_written(monkeypatch, "append")
    got = {row["source_month"]: row["trips"] for row in queries.replace_month(spark, "unused").collect()}
    plan = optimized(frames[0])
    assert plan.index("Join LeftOuter") < plan.index("RebalancePartitions") and plan.count("RebalancePartitions") == 1
    rows = queries.silver_trips(spark, "unused").where("source_month != '1996-02' AND (source_month != '1995-03' OR payment_type != 1)")
    assert got == {row["source_month"]: row["count"] for row in rows.groupBy("source_month").count().collect()}


def test_lost_months_are_rebalanced_before_the_zones_names(spark, monkeypatch):
    zone = F.col("PULocationID")
    rows = own_trips(spark).withColumn("PULocationID", F.when(zone == 2, 3).otherwise(zone))
    zones = spark.createDataFrame([(str(n), "B", f"Z{n}", "s") for n in range(4)], taxi.ZONE_COLUMNS)
    monkeypatch.setattr(derived, "trips", lambda *_: rows)
    monkeypatch.setattr(derived, "zones", lambda *_: zones)
    staged = months_written(monkeypatch, "stage")
    got = queries.marts_by_month(spark, "unused").where("mart = 'daily'").collect()
    landed = optimized(staged[0])
    assert landed.index("Join LeftOuter") < landed.index("RebalancePartitions") and landed.count("RebalancePartitions") == 1
    days = queries.silver_trips(spark, "unused").groupBy("pickup_date").count().collect()
    assert {row["pickup_date"]: row["trips"] for row in got} == {row["pickup_date"]: row["count"] for row in days}


def test_days_that_months_share_are_settled_without_a_shuffle_or_a_copy_of_the_sums(spark, lake, monkeypatch):
    states = spark.createDataFrame(
        [("2024-01", 1, 5), ("2024-02", 1, 7), (None, 1, 2), (None, 2, 3), ("2024-01", None, 4)],
        "source_month string, pickup_date int, n_rows int",
    )
    with Scratch(spark, "days") as scratch:
        settled = gold.one_month_per_day(states, scratch)
        assert "rightHint=(strategy=broadcast)" in optimized(settled)
        got = sorted(map(tuple, settled.collect()), key=str)
    assert got == sorted(
        [("2024-02", 1, 5), ("2024-02", 1, 7), ("2024-02", 1, 2), (None, 2, 3), ("2024-01", None, 4)], key=str
    )

    names = []
    keep = Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, frame, name: names.append(name) or keep(self, frame, name))
    rows = own_trips(spark).withColumns({"batch_id": F.lit("b"), "source_system": F.lit("s")})
    zones = spark.createDataFrame([(n, f"Z{n}", "B") for n in range(3)], "location_id int, zone_name string, borough string")
    lake.append_new(silver.TRIPS, taxi.to_silver(rows, zones), taxi.BATCH)
    gold.build_gold(lake, ["1994-06", "1995-03"])
    assert "latest" in names and "settled" not in names
