"""Costly steps run once, wide rows are shuffled once, and no task sorts more rows than it should."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quaymill import trips as taxi
from quaymill.operators import layout
from quaymill.operators.dedup import keep_first, keep_first_per_batch
from quaymill.plans import bronze as bronze_plan
from quaymill.sources.files import read_json_lines, write_json_lines
from quaymill.sources.lake import Lake
from quaymill.sources.workspace import Scratch
from workload import derived, queries

ROWS = 120


def own_trips(spark):
    days = ["1993-05-03", "1994-06-07", "1995-03-01", "1995-04-02", "1996-02-05", "1998-02-01", "1998-07-09"]
    rows = []
    for n in range(ROWS):
        start = dt.datetime.fromisoformat(days[n % 7]) + dt.timedelta(minutes=n // 2)
        end = start + dt.timedelta(minutes=5)
        rows.append((1, start, end, 1, 2.5, 1, "N", n % 3, 1, n % 5, 9.5, *[0.5] * 8, days[n % 7][:7]))
    return spark.createDataFrame(rows, f"{taxi.SOURCE_FIELDS}, source_month string")


@pytest.fixture
def counted(spark, monkeypatch):
    """The query's inputs, and how many trips were computed from them."""
    seen = spark.sparkContext.accumulator(0)

    def batches(chunks):
        for chunk in chunks:
            seen.add(chunk.num_rows)
            yield chunk

    # Written, so that only the marked step counts its rows.
    rows = Scratch(spark, "own").keep(own_trips(spark), "trips")
    zones = spark.createDataFrame([(str(n), "B", f"Z{n}", "s") for n in range(3)], taxi.ZONE_COLUMNS)
    monkeypatch.setattr(derived, "trips", lambda *_: rows.mapInArrow(batches, rows.schema))
    monkeypatch.setattr(derived, "zones", lambda *_: zones)
    return seen


@pytest.mark.parametrize(
    "name",
    ["latest_writes", "first_trips", "month_reconciliation", "exported_month_sample",
     "pickup_month_sample", "upsert_daily", "upsert_metrics", "upsert_moved_keys"],
)
def test_trips_are_computed_once(spark, counted, name):
    queries.queries()[name](spark, "unused").collect()
    assert counted.value == ROWS


def test_a_month_is_written_once_before_its_first_rows_are_sought(spark, counted):
    rows = derived.trips(spark, "unused")
    got = bronze_plan.month_sample(rows, "1995-03", 5, rows.columns).collect()
    want = own_trips(spark).where("source_month = '1995-03'").orderBy(*rows.columns).limit(5).collect()
    assert sorted(got) == sorted(want) and counted.value == ROWS


def test_line_items_are_shuffled_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = derived.trips(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") == 4


def test_json_export_is_compressed(spark, tmp_path):
    path, rows = str(tmp_path / "out"), own_trips(spark).drop("source_month")
    write_json_lines(taxi.text_times(rows), path)
    data = [file for file in Path(path).iterdir() if file.name.startswith("part-")]
    assert data and all(file.name.endswith(".json.gz") for file in data)
    back = taxi.parse_times(read_json_lines(spark, path, taxi.json_schema()))
    assert sorted(back.collect()) == sorted(rows.collect())


@pytest.mark.parametrize("limit", [64, 7, 1])
def test_many_repeated_keys_do_not_send_every_row_the_shuffled_way(spark, limit):
    """40 repeated keys among 2,000: exact, by a bit map, and (one word) all rows."""
    frame = spark.range(2_040).selectExpr("id % 2000 AS k", "if(id % 11 = 0, null, 'b') AS batch", "id AS v")
    with Scratch(spark, "bits") as scratch:
        result = keep_first_per_batch(
            frame, ["k"], "batch", exclude=F.col("v") % 10 == 3, suspect_limit=limit, scratch=scratch
        )
        want = keep_first(frame.where("v % 10 != 3"), ["batch", "k"]).select(*frame.columns)
        assert sorted(map(str, result.rows.collect())) == sorted(map(str, want.collect()))
        assert result.aside.count() == frame.where("v % 10 = 3").count()
        resolved = spark.read.parquet(f"{scratch.path}/resolved-keys").count()
        assert resolved < 900 if limit > 1 else resolved == want.count()


def test_points_in_an_array_are_reached_as_before(spark):
    frame = spark.createDataFrame([([2, 4, 9], v) for v in (None, 1, 2, 5, 9, 10)] + [([], 3)], "p array<int>, v int")
    got = [row[0] for row in frame.select(layout.points_reached(F.col("p"), F.col("v"), 7)).collect()]
    assert got == [0, 0, 1, 2, 3, 3, 0]


def test_compaction_bounds_the_rows_a_task_sorts(spark, tmp_path, monkeypatch):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(1_000).selectExpr("'m' AS batch", "id AS k", "id % 7 AS v").write.parquet(source)
    monkeypatch.setattr(layout, "TASK_ROWS", 250)
    layout.compact_clustered(spark, source, path, "batch", ["k", "v"])
    assert spark.read.parquet(path).count() == 1_000
    assert len(list(Path(path, "batch=m").glob("*.parquet"))) == 4


def test_months_that_lie_by_month_land_without_a_shuffle(spark, lake, tmp_path, monkeypatch):
    raw = Lake(spark, str(tmp_path / "raw"))
    raw.append("trips", own_trips(spark), taxi.BATCH)
    staged = []
    stage = Lake.stage
    monkeypatch.setattr(Lake, "stage", lambda self, table, frame, *rest: staged.append(frame) or stage(self, table, frame, *rest))
    bronze_plan.ingest_months(lake, raw.read("trips", partition_by=taxi.BATCH), "parquet", "trips", rebalance=False)
    assert "Rebalance" not in staged[0]._jdf.queryExecution().optimizedPlan().toString()
    assert lake.read(bronze_plan.TRIPS, partition_by=taxi.BATCH).count() == ROWS


def test_filled_batches_are_rebalanced_before_they_are_sorted(spark, lake, monkeypatch):
    lake.append("trips", own_trips(spark).withColumn("system", F.lit(None).cast("string")), taxi.BATCH)
    staged = []
    stage = Lake.stage
    monkeypatch.setattr(Lake, "stage", lambda self, table, frame, *rest: staged.append(frame) or stage(self, table, frame, *rest))
    assert lake.fill_nulls("trips", "system", "parquet", taxi.BATCH)
    assert "Rebalance" in staged[0]._jdf.queryExecution().optimizedPlan().toString()
    assert lake.read("trips", partition_by=taxi.BATCH).where("system = 'parquet'").count() == ROWS
