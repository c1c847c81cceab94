"""Table layout: small-file copies, and compaction clustered on several columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quaymill.operators.dimensions import broadcast_if_small
from quaymill.sources.files import storage_stats

TARGET_FILE_BYTES = 256 * 1024 * 1024
# A task sorts its rows, which take several times their size in a file: more rows would spill.
TASK_ROWS = 2_000_000


def split_points(frame: DataFrame, columns: list[str], bits: int) -> dict[str, list]:
    """Per column, up to ``2**bits - 1`` values that cut it into ranges of about equal rows.

    One aggregate over all columns; what reaches the driver depends on ``bits`` alone.
    """
    parts = 2**bits
    shares = [i / parts for i in range(1, parts)]
    found = frame.agg(*[F.percentile_approx(c, shares).alias(c) for c in columns]).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def range_number(column: Column, points: list) -> Column:
    """How many of the sorted ``points`` are <= the value, by nested halving; nulls get 0."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column >= F.lit(points[middle]), search(middle + 1, high)).otherwise(
            search(low, middle)
        )

    return search(0, len(points)).cast("bigint")


def grouped_split_points(frame: DataFrame, group: str, columns: list[str], bits: int) -> DataFrame:
    """``split_points`` for every value of ``group``: one row each, an array ``points_<column>`` per column.

    Partial sketches are merged per group, so a group that holds most rows is no burden to one task.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    found = [F.percentile_approx(c, shares).alias(f"points_{c}") for c in columns]
    cut = frame.groupBy(F.col(group).alias("group_value")).agg(*found)
    empty = {c: F.array().cast(cut.schema[f"points_{c}"].dataType) for c in columns}
    points = [F.coalesce(F.array_distinct(f"points_{c}"), empty[c]).alias(f"points_{c}") for c in columns]
    return cut.select("group_value", *points)


def points_reached(points: Column, value: Column, most: int = 31) -> Column:
    """``range_number`` where up to ``most`` sorted points stand in an array column.

    Nested halving over single elements compiles; a lambda over the array would be interpreted per row.
    """

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        # Beyond the end of the array the element is null: never reached.
        return F.when(value >= F.get(points, F.lit(middle)), search(middle + 1, high)).otherwise(
            search(low, middle)
        )

    return search(0, most).cast("bigint")


def interleave(numbers: list[Column], bits: int) -> Column:
    """Morton order: bit i of number k becomes bit ``i * len(numbers) + k``."""
    code = F.lit(0).cast("bigint")
    for bit in range(bits):
        for k, number in enumerate(numbers):
            single = F.shiftright(number, bit).bitwiseAND(F.lit(1).cast("bigint"))
            code = code.bitwiseOR(F.shiftleft(single, bit * len(numbers) + k))
    return code


def zorder_code(frame: DataFrame, columns: list[str], bits: int = 5) -> Column:
    """Place of each row on a curve that keeps rows close in every column together."""
    points = split_points(frame, columns, bits)
    return interleave([range_number(F.col(c), points[c]) for c in columns], bits)


def refile(frame: DataFrame, path: str, files: int) -> None:
    """Copy into a fixed number of equal files in no order."""
    frame.repartition(files).write.mode("overwrite").parquet(path)


def compact_clustered(
    spark: SparkSession,
    source: str,
    path: str,
    partition_by: str,
    columns: list[str],
    files: int | None = None,
    bits: int = 5,
) -> None:
    """Copy a Parquet table into few large files per partition, clustered on ``columns``.

    Each partition is cut at its own quantiles, so its files narrow a lookup however its values differ from
    the other partitions'. The range split goes on by the row's place in its source file, so neither a hot
    value nor a group of equal rows can outgrow one task; that place is the same on every retry.
    """
    table = spark.read.parquet(source)
    if files is None:
        size = storage_stats(spark, source).first()["size_bytes"]
        # The count comes from the footers.
        files = max(1, math.ceil(size / TARGET_FILE_BYTES), math.ceil(table.count() / TASK_ROWS))
    curve, place = "_curve", "_place"
    # One row per partition directory.
    points = broadcast_if_small(grouped_split_points(table, partition_by, columns, bits))
    rows = table.select("*", F.col("_metadata.row_index").alias(place))
    cut = rows.join(points, F.col(partition_by).eqNullSafe(F.col("group_value")), "left")
    numbers = [points_reached(F.col(f"points_{c}"), F.col(c), 2**bits - 1) for c in columns]
    placed = cut.select(*table.columns, interleave(numbers, bits).alias(curve), place)
    spread = placed.repartitionByRange(files, partition_by, curve, place)
    ordered = spread.sortWithinPartitions(partition_by, curve, *columns)
    kept = ordered.drop(curve, place)
    kept.write.mode("overwrite").partitionBy(partition_by).parquet(path)


def file_ranges(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Smallest and largest value of each column per data file: what data skipping can use."""
    table = spark.read.parquet(path).withColumn("path", F.col("_metadata.file_path"))
    bounds = []
    for c in columns:
        bounds += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return table.groupBy("path").agg(*bounds)
