"""Build silver for many months in one job: classify, set aside, deduplicate, enrich, prove."""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import ExitStack

from pyspark.sql import DataFrame, functions as F

from quaymill import trips
from quaymill.operators.dedup import keep_first_per_batch
from quaymill.operators.dimensions import broadcast_if_small
from quaymill.operators.quality import REASON, rejected
from quaymill.plans.bronze import TRIPS as BRONZE_TRIPS, ZONES as BRONZE_ZONES
from quaymill.sources.lake import Lake, Staged
from quaymill.sources.workspace import Scratch

TRIPS = "silver/trips"
LEDGER = "silver/recon"
QUARANTINE = "quarantine/trips"

LEDGER_SCHEMA = (
    "source_month string, bronze_rows bigint, silver_rows bigint, quarantined_rows bigint, "
    "duplicates_removed bigint"
)
COUNTS = ["bronze_rows", "silver_rows", "quarantined_rows", "duplicates_removed"]


class RowsLost(RuntimeError):
    """Some batch's rows are not all in silver, in quarantine or removed as duplicates."""


def reconcile(
    bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, removed: DataFrame
) -> DataFrame:
    """Ledger: the four counts per batch, zero where a frame has no row for it.

    ``removed`` already holds counts. Counts are stacked and summed, so null batches need no join
    and no count can multiply another.
    """

    def tally(frame: DataFrame, name: str, rows) -> DataFrame:
        zeros = [rows.alias(c) if c == name else F.lit(0).cast("bigint").alias(c) for c in COUNTS]
        return frame.groupBy(trips.BATCH).agg(*zeros)

    stacked = tally(bronze, COUNTS[0], F.count("*"))
    stacked = stacked.unionByName(tally(silver, COUNTS[1], F.count("*")))
    stacked = stacked.unionByName(tally(quarantine, COUNTS[2], F.count("*")))
    stacked = stacked.unionByName(tally(removed, COUNTS[3], F.sum("removed")))
    return stacked.groupBy(trips.BATCH).agg(*[F.sum(name).alias(name) for name in COUNTS])


def unbalanced(ledger: DataFrame) -> DataFrame:
    bronze, silver, quarantined, duplicates = (F.col(name) for name in COUNTS)
    return ledger.where(~trips.rows_balance(bronze, silver, quarantined, duplicates))


def build_silver(lake: Lake, months: Iterable[str | None] | None = None) -> DataFrame:
    """Rebuild silver, quarantine and ledger for the given months, or all; returns their ledger.

    Both outputs are staged first, and counted as written, before any of them is published. The
    duplicates are counted by the deduplication itself, so the proof covers joins and dedup.
    """
    present = lake.batches(BRONZE_TRIPS, trips.BATCH)
    months = present if months is None else list(months)
    unknown = set(months) - set(present)
    if unknown:
        raise ValueError(f"bronze has no rows for {unknown}")
    if not months:
        return lake.spark.createDataFrame([], LEDGER_SCHEMA)
    bronze = lake.read(BRONZE_TRIPS, partition_by=trips.BATCH)
    chosen = F.col(trips.BATCH).isin([month for month in months if month is not None])
    if None in months:
        chosen = chosen | F.col(trips.BATCH).isNull()
    bronze = bronze.where(chosen)
    with Scratch(lake.spark, "silver") as scratch, ExitStack() as leftovers:

        def stage(table: str, frame: DataFrame, partition_by: str | None = None) -> Staged:
            staged = lake.stage(table, frame, partition_by)
            leftovers.callback(lake.discard, staged)
            return staged

        # Written once: each of the passes below joins it in two roles.
        zones = scratch.keep(trips.zone_dimension(lake.read(BRONZE_ZONES)), "zones")
        lookup = broadcast_if_small(zones)
        classified = trips.classify_trips(bronze, lookup)
        unique = keep_first_per_batch(
            classified,
            trips.TRIP_KEY,
            trips.BATCH,
            exclude=F.col(REASON).isNotNull(),
            scratch=scratch,
        )
        set_aside = rejected(unique.aside).hint("rebalance", trips.BATCH)
        quarantine = stage(QUARANTINE, set_aside, trips.BATCH)
        silver = stage(TRIPS, trips.to_silver(unique.rows, lookup), trips.BATCH)
        counts = reconcile(bronze, silver.rows, quarantine.rows, unique.removed)
        ledger = stage(LEDGER, counts)
        wrong = unbalanced(ledger.rows).orderBy(trips.BATCH).limit(5).collect()
        if wrong:
            raise RowsLost(f"reconciliation failed, first batches: {wrong}")

        lake.publish_recorded(QUARANTINE, quarantine, trips.BATCH, months)
        lake.publish_recorded(TRIPS, silver, trips.BATCH, months)
        lake.replace_rows(LEDGER, ledger.rows, chosen)
    return lake.read(LEDGER).where(chosen)
