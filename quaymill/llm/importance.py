"""Importance resampling towards a target distribution, over hashed word runs.

A text's features are its runs of words; each falls into one of BUCKETS buckets. How much more
likely a bucket is in the target than in the corpus is its gain, counted over all texts of both.
The gains are an array of fixed length, looked up for all features of a batch of texts at once;
their sum, plus Gumbel noise from a hash of the id, is a text's score, and drawing the highest
scores draws without replacement in proportion to the weights.

The k-th score is found by distributed quickselect. Random rows of the part that is still open
serve as pivots; one aggregate counts exactly how many rows lie below, at and above each, which
leaves the stretch between two pivots, until a pivot is the k-th key itself. Keys are made
distinct by id and place, so ties cannot change how many are drawn. Only the drawn rows are
sorted and ranked. Counts and pivots alone reach the driver.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from quaymill.llm.common import append_columns, own_column, per_text, raw_bytes, scratch, text_slices, word_runs
from quaymill.sources.workspace import Scratch

BUCKETS = 10_000
LONGEST_RUN = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
PIVOTS = 15
# Longer words are hashed one by one.
_SHORT = 64

# Words are runs of ASCII letters (in lower case), digits and everything that is not ASCII.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _crc_step(crc: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    crc = crc ^ np.uint32(0xFFFFFFFF)
    return (_CRC[(crc ^ byte) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))) ^ np.uint32(0xFFFFFFFF)


def run_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """crc32 of parts of the data, each continuing the crc32 of what stands ``before`` it."""
    crcs = np.zeros(len(starts), np.uint32) if before is None else before.copy()
    sizes = ends - starts
    for row in np.flatnonzero(sizes > _SHORT).tolist():
        crcs[row] = zlib.crc32(data[starts[row] : ends[row]].tobytes(), int(crcs[row]))
    live = np.flatnonzero(sizes <= _SHORT)
    for step in range(_SHORT):
        live = live[sizes[live] > step]
        if not len(live):
            break
        crcs[live] = _crc_step(crcs[live], data[starts[live] + step])
    return crcs


def text_buckets(texts: pa.Array, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of every feature of every text, the text of each, and the words per text."""
    data, at = raw_bytes(texts)
    data = _LOWER[data]
    starts, ends = word_runs(data, at, _WORD)
    word_at = np.searchsorted(starts, at)
    text = np.repeat(np.arange(len(texts)), np.diff(word_at))
    found, owners = [], []
    crcs, first = run_crcs(data, starts, ends), np.arange(len(starts))
    for size in range(1, longest + 1):
        found.append(crcs % np.uint32(buckets))
        owners.append(text[first])
        # One word more, where the text has one.
        more = first + size < len(starts)
        more[more] = text[first[more] + size] == text[first[more]]
        crcs, first = crcs[more], first[more]
        crcs = run_crcs(data, starts[first + size], ends[first + size], _crc_step(crcs, 0x20))
    return np.concatenate(found).astype(np.int64), np.concatenate(owners), np.diff(word_at)


def bucket_counts(frame: DataFrame, text: str, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> DataFrame:
    """Rows (bucket, n): how many features of all texts fall into each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in text_slices(batch.column(0)):
                total += np.bincount(text_buckets(texts, buckets, longest)[0], minlength=buckets)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], ["bucket", "n"])

    counted = frame.select(text).mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln) of how much more likely each bucket is in the target, add-one smoothed.

    Both frames are ``bucket_counts``; at most ``buckets`` rows of each reach the driver.
    """
    counts = np.zeros((2, buckets), np.int64)
    for side, frame in enumerate((source, target)):
        for bucket, n in frame.collect():
            counts[side, bucket] = n
    s, t = counts.tolist()
    s_all, t_all = sum(s) + float(buckets), sum(t) + float(buckets)
    gains = [math.floor(1000 * math.log((t[b] + 1.0) * s_all / ((s[b] + 1.0) * t_all))) for b in range(buckets)]
    return np.array(gains, np.int64)


def _noise(doc_id: str, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of a hash of the id (null: empty)."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(named.cast("binary"), 256), F.lit(8)), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


# --- selection ------------------------------------------------------------------------------


def _literal(key: Row, kind: T.StructType) -> Column:
    return F.struct(*[F.lit(key[field.name]).cast(field.dataType).alias(field.name) for field in kind])


def kth_key(frame: DataFrame, key: str, place: str, k: int, pivots: int = PIVOTS) -> Row | None:
    """The k-th smallest value (from 1) of the struct column ``key``; null if there is none.

    ``place`` is a column of distinct numbers, by whose hash the pivots are drawn. Each round
    costs one bounded top-k and one aggregate and leaves, on average, about 1 in ``pivots`` of
    the open rows; the interval shrinks by a row at least, so it always ends.
    """
    kind = frame.schema[key].dataType
    value, is_open, below, turn = F.col(key), F.lit(True), 0, 0
    while True:
        inside = frame.where(is_open)
        drawn = inside.orderBy(F.xxhash64(F.lit(turn), place)).limit(pivots).select(key)
        marks = [row[0] for row in drawn.distinct().orderBy(key).collect()]
        if not marks:
            return None
        keys = [_literal(mark, kind) for mark in marks]
        passed = sum([(value > one).cast("int") for one in keys], F.lit(0))
        reached = sum([(value >= one).cast("int") for one in keys], F.lit(0))
        counted = inside.groupBy(passed.alias("passed"), reached.alias("reached")).count().collect()
        low = high = None
        for at in range(len(marks)):
            # Three-way partition by the pivot; what is not counted here lies above it.
            less = below + sum(row["count"] for row in counted if row["reached"] <= at)
            equal = sum(row["count"] for row in counted if row["passed"] == at and row["reached"] == at + 1)
            if less < k <= less + equal:
                return marks[at]
            if less + equal < k:
                low, low_rows = at, less + equal
            elif high is None:
                high = at
        if low is None and high is None:
            return None
        if low is not None:
            is_open, below = is_open & (value > keys[low]), low_rows
            if low == len(marks) - 1 and not any(row["passed"] > low for row in counted):
                return None
        if high is not None:
            is_open = is_open & (value < keys[high])
        turn += 1


def _ranked(frame: DataFrame, order: list[Column], rank: str, space: Scratch) -> DataFrame:
    """Append the place (1, 2, 3, ...) of each row in the order; sorted in ranges, never as one."""
    ranged = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id holds the partition in its upper bits and the row's place within it in the lower 33.
    placed = space.keep(ranged.withColumn("_id", F.monotonically_increasing_id()), "drawn")
    part = F.shiftright("_id", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition.
    starts = sizes.select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
    own = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    joined = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return joined.withColumn(rank, F.col("_start") + own + 1).drop("_id", "_part", "_start")


# --- results --------------------------------------------------------------------------------


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    keep: list[str] | None = None,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST_RUN,
    seed: int = SEED,
) -> DataFrame:
    """The kept columns (all but the text by default) and n_features, weight, score, rank.

    ``rank`` numbers the drawn rows from the highest score, ties to the smaller id (null last),
    then to fewer features; it is null where a row is not drawn. Drawn is the given percentage,
    rounded down, of the rows with at least ``least_words`` words. Rows that repeat id and text
    are rows of their own, each with its own rank. Null and empty texts have no features, weigh 0
    and are never drawn while ``least_words`` is over 0. A null id hashes as empty text. An empty
    target leaves smoothing alone; an empty table gives an empty result. A new column whose name
    is taken gets a trailing underscore.
    """
    space = scratch(docs.sparkSession, "importance")
    keep = [name for name in docs.columns if name != text] if keep is None else keep
    source_counts = space.keep(bucket_counts(docs, text, buckets, longest), "source")
    target_counts = space.keep(bucket_counts(target, target_text, buckets, longest), "target")
    gains = bucket_gains(source_counts, target_counts, buckets)

    def weigh(texts: pa.Array) -> dict[str, object]:
        bucket, owner, words = text_buckets(texts, buckets, longest)
        order = np.argsort(owner, kind="stable")
        features = np.bincount(owner, minlength=len(texts))
        at = np.concatenate([[0], np.cumsum(features)])
        return {
            "n_words": pa.array(words, pa.int64()),
            "n_features": pa.array(features, pa.int64()),
            "weight": pa.array(per_text(gains[bucket[order]], at), pa.int64()),
        }

    fields = [T.StructField(name, T.LongType()) for name in ("n_words", "n_features", "weight")]
    rows = docs.select(
        F.struct(*[F.col(name) for name in keep]).alias("row"),
        F.col(doc_id).alias("doc_id"),
        _noise(doc_id, seed).alias("noise"),
        F.col(text).alias("text"),
    )
    weighed = append_columns(rows, "text", fields, weigh, ["row", "doc_id", "noise"])
    scored = weighed.select(
        "row",
        "n_words",
        "weight",
        F.struct(
            (-(F.col("weight") + F.col("noise"))).alias("lack"),
            F.col("doc_id").isNull().alias("no_id"),
            "doc_id",
            "n_features",
            F.monotonically_increasing_id().alias("place"),
        ).alias("key"),
    )
    # Written, the places stay what they are and the rounds read a few numbers a row.
    scored = space.keep(scored, "scored")
    able = F.col("n_words") >= least_words
    eligible = scored.where(able)
    wanted = eligible.count() * percent // 100
    last = kth_key(eligible, "key", "key.place", wanted) if wanted else None
    drawn = F.lit(False) if last is None else able & (F.col("key") <= _literal(last, scored.schema["key"].dataType))
    order = [F.asc(f"key.{name}") for name in ("lack", "no_id", "doc_id", "n_features", "place")]
    ranked = _ranked(scored.where(drawn), order, "rank", space)
    others = scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    taken = docs.select(*keep)
    values = {
        "n_features": F.col("key.n_features"),
        "weight": F.col("weight"),
        "score": -F.col("key.lack"),
        "rank": F.col("rank"),
    }
    return ranked.unionByName(others).select(
        *[F.col(f"row.`{name}`").alias(name) for name in keep],
        *[value.alias(own_column(taken, name)) for name, value in values.items()],
    )
