"""Lookup dimensions: cleanup, size-checked broadcast, membership flags and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 1_000_000


def clean_dimension(
    dimension: DataFrame, key: str, attributes: dict[str, str], key_name: str
) -> DataFrame:
    """Integer key, null keys dropped, one row per key; ``attributes`` maps source to output names.

    Among rows of one key the smallest attribute values win, so reruns agree.
    """
    renamed = [F.col(source).alias(name) for source, name in attributes.items()]
    typed = dimension.select(F.col(key).try_cast("int").alias(key_name), *renamed)
    typed = typed.where(F.col(key_name).isNotNull())
    if not attributes:
        return typed.distinct()
    row = F.min(F.struct(*attributes.values())).alias("row")
    return typed.groupBy(key_name).agg(row).select(key_name, "row.*")


def within_rows(frame: DataFrame, rows: int) -> bool:
    """Whether the frame holds at most ``rows`` rows. A full count, because a limit would first
    send that many rows of every partition to one task."""
    return frame.count() <= rows


def broadcast_if_small(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Ask for a broadcast only after counting; above the bound Spark picks a shuffled join,
    where adaptive execution splits hot keys."""
    return F.broadcast(frame) if within_rows(frame, rows) else frame


def flag_known(
    facts: DataFrame, ids: DataFrame, id_column: str, flags: dict[str, str]
) -> DataFrame:
    """Left join the unique ids once per key column; its flag is true on a match, else null."""
    for column, flag in flags.items():
        # A literal made from the key's presence on the id side, never a fact attribute.
        known = ids.select(F.col(id_column).alias(f"{flag}_id"), F.lit(True).alias(flag))
        facts = facts.join(known, F.col(column) == F.col(f"{flag}_id"), "left").drop(f"{flag}_id")
    return facts


def enrich(
    facts: DataFrame, dimension: DataFrame, key: str, roles: dict[str, dict[str, str]]
) -> DataFrame:
    """Left join one dimension in several roles.

    ``roles`` maps a fact key column to {dimension attribute: output column}.
    """
    for column, attributes in roles.items():
        role_key = f"_{column}_key"
        renamed = [F.col(source).alias(name) for source, name in attributes.items()]
        role = dimension.select(F.col(key).alias(role_key), *renamed)
        facts = facts.join(role, F.col(column) == F.col(role_key), "left").drop(role_key)
    return facts
