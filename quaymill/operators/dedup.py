"""Keep one row per business key, in one shuffle or, when duplicates are rare, nearly none."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from quaymill.operators.dimensions import BROADCAST_ROWS
from quaymill.sources.workspace import Scratch

COPIES = "_copies"
HASH = "_key_hash"
SUSPECT = "_suspect"
WORD = "_word"
# Suspect hashes per row of a full bit map: about a quarter of its 64 bits are set.
PER_WORD = 16


def keep_first(
    frame: DataFrame, keys: list[str], order_by: list[str] | None = None, copies: str | None = None
) -> DataFrame:
    """One row per key; nulls equal nulls, NaN equals NaN.

    The survivor is the smallest by ``order_by`` and then by all other columns, so it never
    depends on partitioning. Partial aggregation folds copies before the shuffle, which keeps a
    key that holds most rows from reaching one task. ``copies`` adds the group size.
    """
    others = [name for name in frame.columns if name not in keys]
    count = [F.count("*").alias(copies)] if copies else []
    if not others:
        return frame.groupBy(*keys).agg(*count) if count else frame.distinct()
    row = F.struct(*others)
    best = F.min_by(row, F.struct(*order_by, *others)) if order_by else F.min(row)
    survivors = frame.groupBy(*keys).agg(best.alias("_row"), *count)
    picked = [name if name in keys else F.col(f"_row.`{name}`") for name in frame.columns]
    return survivors.select(*picked, *([copies] if copies else []))


@dataclass(frozen=True)
class Deduplicated:
    rows: DataFrame
    removed: DataFrame
    """Rows removed per batch; batches without duplicates may be absent."""
    aside: DataFrame
    """Rows that took no part."""


def _marked_by_bits(hashed: DataFrame, suspects: DataFrame, words: int) -> DataFrame:
    """Mark every row whose hash has its bit set in a map of at most ``words`` rows of 64 bits."""
    word = F.pmod(F.col(HASH), F.lit(words)).alias(WORD)
    bit = F.shiftrightunsigned(HASH, 58).cast("int")
    single = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    bits = suspects.groupBy(word).agg(F.bit_or(single).alias("_bits"))
    joined = hashed.withColumn(WORD, word).join(F.broadcast(bits), WORD, "left")
    marked = joined.withColumn(SUSPECT, F.when(F.bit_get("_bits", bit) == 1, F.lit(True)))
    return marked.drop(HASH, WORD, "_bits")


def keep_first_per_batch(
    frame: DataFrame,
    keys: list[str],
    batch: str,
    order_by: list[str] | None = None,
    exclude: Column | None = None,
    suspect_limit: int = BROADCAST_ROWS,
    scratch: Scratch | None = None,
) -> Deduplicated:
    """``keep_first`` within each batch, for large frames where most keys are unique.

    Only an 8-byte hash of the key is shuffled to find hashes seen twice. Rows with any other
    hash are unique and pass through without a shuffle; the few suspects are resolved exactly,
    so hash collisions cost time but never rows. If the suspect hashes outnumber
    ``suspect_limit`` a bit map of so many words is broadcast instead, and up to a quarter of the
    unique rows is resolved with the suspects; beyond ``PER_WORD`` times the limit every row takes
    the shuffled way.

    Rows that meet ``exclude`` are left out and returned as ``aside``. They are picked up in the
    same pass as the suspects, which suits conditions that few rows meet. The result reads
    tables in ``scratch``.
    """
    scratch = scratch or Scratch(frame.sparkSession, "dedup")
    exclude = F.lit(False) if exclude is None else F.coalesce(exclude, F.lit(False))
    scope = [batch, *keys]
    hashed = frame.withColumn(HASH, F.xxhash64(*scope))
    repeated = hashed.where(~exclude).groupBy(HASH).agg(F.count("*").alias("n"))
    suspects = scratch.keep(repeated.where(F.col("n") > 1).select(HASH), "repeated-keys")

    found = suspects.count()
    if found <= PER_WORD * suspect_limit:
        if found <= suspect_limit:
            known = F.broadcast(suspects.withColumn(SUSPECT, F.lit(True)))
            marked = hashed.join(known, HASH, "left").drop(HASH)
        else:
            marked = _marked_by_bits(hashed, suspects, suspect_limit)
        # An excluded row may share a suspect hash; that changes nothing for it.
        suspect = F.col(SUSPECT).isNotNull()
        picked = scratch.keep(marked.where(exclude | suspect).drop(SUSPECT), "picked-rows")
        unique = marked.where(~exclude & ~suspect).select(*frame.columns)
    else:
        picked, unique = frame, None

    candidates = picked.where(~exclude)
    resolved = scratch.keep(keep_first(candidates, scope, order_by, COPIES), "resolved-keys")
    removed = resolved.groupBy(batch).agg(F.sum(F.col(COPIES) - 1).alias("removed"))
    rows = resolved.select(*frame.columns).hint("rebalance", batch)
    return Deduplicated(
        rows=rows if unique is None else unique.unionByName(rows),
        removed=removed,
        aside=picked.where(exclude).select(*frame.columns),
    )
