"""Two copies of silver, many small files against few clustered ones, and the queries to compare."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from quaymill import trips
from quaymill.functions.measures import Arithmetic, Figures, Floating, additive, summed
from quaymill.operators.dimensions import broadcast_if_small
from quaymill.operators.layout import compact_clustered, refile
from quaymill.sources.files import storage_stats

SMALL_FILES = 200
CLUSTER_BY = ["pu_location_id", "pickup_date"]


@dataclass(frozen=True)
class Copies:
    small_files: str
    clustered: str


def build_copies(
    spark: SparkSession, silver_path: str, root: str, small_files: int = SMALL_FILES
) -> Copies:
    copies = Copies(f"{root}/small_files", f"{root}/clustered")
    refile(spark.read.parquet(silver_path), copies.small_files, small_files)
    compact_clustered(spark, silver_path, copies.clustered, trips.BATCH, CLUSTER_BY)
    return copies


def copy_stats(spark: SparkSession, copies: Copies) -> DataFrame:
    """Files and bytes of each copy."""
    small = storage_stats(spark, copies.small_files).withColumn("copy", F.lit("small_files"))
    clustered = storage_stats(spark, copies.clustered).withColumn("copy", F.lit("clustered"))
    return small.unionByName(clustered).select("copy", "files", "size_bytes")


def _measures(silver: DataFrame, keys: list[str], arithmetic: Arithmetic) -> DataFrame:
    return additive(silver, keys, [trips.TOTAL], arithmetic)


def month_by_zone_hour(
    silver: DataFrame, month: str, arithmetic: Arithmetic = Floating()
) -> DataFrame:
    keys = ["pu_location_id", "pickup_hour"]
    figures = Figures(arithmetic)
    chosen = silver.where(F.col(trips.BATCH) == month)
    return (
        _measures(chosen, keys, arithmetic)
        .groupBy(*keys)
        .agg(figures.total(trips.TOTAL).alias("revenue"), figures.rows().alias("trips"))
    )


def zone_days_total(
    silver: DataFrame,
    zone: int,
    first: dt.date,
    last: dt.date,
    arithmetic: Arithmetic = Floating(),
) -> DataFrame:
    """One zone's revenue over an inclusive range of days."""
    days = F.col("pickup_date").between(F.lit(first), F.lit(last))
    chosen = silver.where((F.col("pu_location_id") == zone) & days)
    total = Figures(arithmetic).total(trips.TOTAL)
    return _measures(chosen, [], arithmetic).agg(total.alias("total_amount"))


def borough_totals(
    silver: DataFrame, zones: DataFrame, broadcast: bool, arithmetic: Arithmetic = Floating()
) -> DataFrame:
    """Revenue per pickup borough, by broadcast or by sort-merge join.

    The broadcast join streams the trips. The merge join first sums them per zone, so that a hot
    zone reaches the shuffle as one row per task and not as all of its trips.
    """
    key = "pu_location_id"
    boroughs = zones.select(F.col("LocationID").try_cast("int").alias(key), F.col("Borough").alias("borough"))
    rows = _measures(silver, [key], arithmetic)
    if broadcast:
        matched = rows.join(broadcast_if_small(boroughs), key)
    else:
        matched = rows.groupBy(key).agg(*summed([trips.TOTAL])).join(boroughs.hint("merge"), key)
    total = Figures(arithmetic).total(trips.TOTAL)
    return matched.groupBy("borough").agg(total.alias("total_amount"))
