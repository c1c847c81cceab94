"""Land source rows in bronze, unchanged but for types and audit columns, each batch once."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from quaymill import trips
from quaymill.functions.columns import in_month
from quaymill.operators.sample import first_rows
from quaymill.operators.schema import columns_first, fit_schema, stamp
from quaymill.sources.files import read_batches, read_json_lines, read_text_csv
from quaymill.sources.jdbc import JdbcSource, Slices, read_jdbc
from quaymill.sources.lake import Lake
from quaymill.sources.workspace import Scratch

TRIPS = "bronze/trips"
ZONES = "bronze/zones"


def _new_batch_id() -> str:
    return str(uuid.uuid4())


def _land(
    lake: Lake, rows: DataFrame, source_system: str, rebalance: bool = True, **audit: str
) -> None:
    """Land new months; rows of the time before source_system existed are marked first."""
    backfill_source_system(lake)
    stamped = stamp(
        rows, {"batch_id": _new_batch_id(), "source_system": source_system, **audit}
    )
    lake.append_new(TRIPS, stamped, trips.BATCH, rebalance)


def _fit_to_bronze(lake: Lake, rows: DataFrame) -> DataFrame:
    """Once bronze exists its columns decide; before that the rows pass as they are."""
    aligned = trips.zoneless_times(trips.align(rows))
    if not lake.batches(TRIPS, trips.BATCH):
        return aligned
    schema = lake.read(TRIPS, partition_by=trips.BATCH).schema
    absent = tuple(name for name in trips.AUDIT_COLUMNS if name not in rows.columns)
    return fit_schema(aligned, schema, skip=absent)


def backfill_source_system(lake: Lake) -> bool:
    """Rows landed before the column existed all came from Parquet files."""
    if not lake.batches(TRIPS, trips.BATCH):
        return False
    return lake.fill_nulls(TRIPS, "source_system", "parquet", trips.BATCH)


def ingest_files(lake: Lake, paths: Mapping[str, str]) -> list[str]:
    """Land Parquet files, ``{month: path}``, for the months bronze lacks; returns those months."""
    present = set(lake.batches(TRIPS, trips.BATCH))
    missing = {month: path for month, path in paths.items() if month not in present}
    if missing:
        rows = read_batches(lake.spark, missing, trips.BATCH, trips.align)
        _land(lake, rows, "parquet", rebalance=False)
    return sorted(missing)


def ingest_months(
    lake: Lake, rows: DataFrame, source_system: str, source_file: str, rebalance: bool = True
) -> None:
    """Land rows that carry their month, for every month that bronze lacks, in one job.

    A source that lies in files by month needs no shuffle: pass ``rebalance=False``.
    """
    _land(lake, _fit_to_bronze(lake, rows), source_system, rebalance, source_file=source_file)


def ingest_month(
    lake: Lake, rows: DataFrame, month: str, source_system: str, source_file: str
) -> bool:
    """Land one month from any other source unless bronze already has it."""
    if month in lake.batches(TRIPS, trips.BATCH):
        return False
    _land(
        lake,
        _fit_to_bronze(lake, rows),
        source_system,
        source_file=source_file,
        **{trips.BATCH: month},
    )
    return True


def ingest_json(lake: Lake, path: str, month: str, source_file: str | None = None) -> bool:
    rows = trips.parse_times(read_json_lines(lake.spark, path, trips.json_schema()))
    return ingest_month(lake, rows, month, "json", source_file or path)


def ingest_jdbc(
    lake: Lake,
    source: JdbcSource,
    table: str,
    month: str,
    slices: Slices | None = None,
    system: str = "postgres",
) -> bool:
    rows = read_jdbc(lake.spark, source, table, slices)
    return ingest_month(lake, rows, month, system, f"{system}:{table}")


def ingest_zones(lake: Lake, path: str) -> None:
    zones = read_text_csv(lake.spark, path, trips.ZONE_COLUMNS)
    lake.overwrite(ZONES, stamp(zones, {"source_file": F.col("_metadata.file_name")}))


def month_counts(bronze: DataFrame) -> DataFrame:
    counts = bronze.groupBy(trips.BATCH).agg(F.count("*").alias("rows"))
    return counts.orderBy(trips.BATCH)


def month_counts_with_total(bronze: DataFrame) -> DataFrame:
    """As ``month_counts``, with one more row for the grand total; its month is null."""
    counts = bronze.rollup(trips.BATCH).agg(
        F.count("*").alias("rows"), F.grouping(trips.BATCH).alias("is_total")
    )
    return counts.orderBy("is_total", trips.BATCH)


def months_present(frame: DataFrame) -> DataFrame:
    return frame.select(trips.BATCH).distinct().orderBy(trips.BATCH)


def month_sample(rows: DataFrame, month: str, size: int, order_by: list[str]) -> DataFrame:
    """The first ``size`` rows of a pickup month; the order makes the sample repeatable.

    The month is written once, as the search for its first rows reads it several times.
    """
    chosen = rows.where(in_month(F.col(trips.TRIP_TIMES[0]), month))
    kept = Scratch(rows.sparkSession, "month").keep(chosen, "rows")
    return first_rows(kept, size, order_by)


def inspect(bronze: DataFrame, rows: int = 5) -> DataFrame:
    """A few rows with the audit columns in front."""
    leading = [name for name in trips.AUDIT_COLUMNS if name in bronze.columns]
    return columns_first(bronze, leading).limit(rows)
