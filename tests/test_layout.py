"""Copies hold the same rows; clustering narrows what a lookup must read, skew or not."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quaymill.operators.layout import (
    compact_clustered,
    file_ranges,
    grouped_split_points,
    interleave,
    points_reached,
    range_number,
    refile,
    split_points,
)

COLUMNS = ["zone", "day"]


@pytest.fixture
def table(spark, tmp_path):
    """One zone holds a third of the rows, and a quarter of the rows are copies of one row."""
    path = str(tmp_path / "table")
    rows = spark.range(60_000).select(
        F.lit("2024-01").alias("month"),
        F.when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") * 31 % 260).cast("int")).alias("zone"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") * 17 % 31).cast("int")).alias("day"),
        (F.col("id") % 1000).alias("v"),
    )
    same = spark.range(20_000).select(
        F.lit("2024-01").alias("month"),
        F.lit(31).alias("zone"),
        F.lit("2024-01-18").cast("date").alias("day"),
        F.lit(1).cast("bigint").alias("v"),
    )
    rows.unionByName(same).repartition(16).write.parquet(path)
    return path


def overlapping(spark, path):
    """Files whose ranges admit zone 100 on one day."""
    day = F.lit("2024-01-09").cast("date")
    inside = F.lit(100).between(F.col("min_zone"), F.col("max_zone"))
    inside &= day.between(F.col("min_day"), F.col("max_day"))
    return file_ranges(spark, path, COLUMNS).where(inside).count()


def test_clustering_skips_files_and_splits_hot_values(spark, table, tmp_path):
    small, packed = str(tmp_path / "small"), str(tmp_path / "packed")
    refile(spark.read.parquet(table), small, 20)
    compact_clustered(spark, table, packed, "month", COLUMNS, files=16)
    names = ["month", "zone", "day", "v"]
    totals = [
        spark.read.parquet(path).groupBy(*names).count().orderBy(*names, "count").collect()
        for path in (table, small, packed)
    ]
    assert totals[0] == totals[1] == totals[2]
    assert overlapping(spark, small) == 20
    assert overlapping(spark, packed) <= 4
    sizes = spark.read.parquet(packed).groupBy("_metadata.file_path").count()
    largest = sizes.agg(F.max("count")).first()[0]
    assert largest < 2.5 * 80_000 / 16


def test_rows_lie_in_curve_order_within_a_file(spark, table, tmp_path):
    packed = str(tmp_path / "packed")
    compact_clustered(spark, table, packed, "month", COLUMNS, files=4)
    rows = spark.read.parquet(packed).select("_metadata.file_path", "_metadata.row_index", "*")
    points = split_points(spark.read.parquet(table), COLUMNS, 5)
    curve = interleave([range_number(F.col(c), points[c]) for c in COLUMNS], 5)
    placed = rows.withColumn("curve", curve).orderBy("file_path", "row_index").collect()
    for left, right in zip(placed, placed[1:]):
        assert left.file_path != right.file_path or left.curve <= right.curve


def test_default_file_count_follows_the_bytes(spark, table, tmp_path):
    packed = str(tmp_path / "packed")
    compact_clustered(spark, table, packed, "month", COLUMNS)
    assert spark.read.parquet(packed).select("_metadata.file_path").distinct().count() == 1


def test_range_numbers_and_bits(spark):
    frame = spark.createDataFrame([(None,), (1,), (5,), (6,), (99,)], "x int")
    numbers = [row[0] for row in frame.select(range_number(F.col("x"), [5, 9, 20])).collect()]
    assert numbers == [0, 0, 1, 1, 3]
    pair = spark.range(1).select(
        interleave([F.lit(0b101).cast("bigint"), F.lit(0b011).cast("bigint")], 3)
    )
    assert pair.first()[0] == 0b011011


def test_split_points_ignore_nulls_and_repeats(spark):
    frame = spark.createDataFrame([(None,), (1,), (1,), (1,), (8,)], "x int")
    assert split_points(frame, ["x"], 2) == {"x": [1]}
    assert split_points(frame.where("x > 100"), ["x"], 2) == {"x": []}


def test_each_month_is_cut_at_its_own_quantiles(spark, tmp_path):
    source, packed = str(tmp_path / "source"), str(tmp_path / "packed")
    spark.range(96_000).select(
        F.when(F.col("id") % 12 > 0, F.format_string("m%02d", F.col("id") % 12)).alias("month"),
        # Zones of one month lie far from those of every other.
        (F.col("id") % 12 * 1000 + F.col("id") * 37 % 211).cast("int").alias("zone"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") * 17 % 31).cast("int")).alias("day"),
    ).repartition(8).write.parquet(source)
    compact_clustered(spark, source, packed, "month", COLUMNS, files=96)
    names = ["month", "zone", "day"]
    rows = [spark.read.parquet(path).select(*names).groupBy(*names).count().orderBy(*names).collect() for path in (source, packed)]
    assert rows[0] == rows[1]
    for month in (3, 8):
        files = file_ranges(spark, f"{packed}/month=m{month:02d}", COLUMNS).collect()
        zone, week = month * 1000 + 100, ("2024-01-08", "2024-01-14")
        met = [f for f in files if f.min_zone <= zone <= f.max_zone and str(f.min_day) <= week[1] and str(f.max_day) >= week[0]]
        assert len(files) >= 7 and len(met) <= 4


def test_grouped_points_equal_those_of_each_group(spark):
    rows = [("a", 1), ("a", 4), ("a", 9), ("b", 70), ("b", 90), (None, 5), ("c", None)]
    frame = spark.createDataFrame(rows, "g string, x int")
    found = {r.group_value: r.points_x for r in grouped_split_points(frame, "g", ["x"], 2).collect()}
    for group in ("a", "b", "c"):
        assert found[group] == split_points(frame.where(F.col("g") == group), ["x"], 2)["x"]
    assert found[None] == [5]
    numbers = frame.select(points_reached(F.array(F.lit(4), F.lit(9)), F.col("x"))).collect()
    assert [r[0] for r in numbers] == [0, 1, 2, 2, 2, 1, 0]
