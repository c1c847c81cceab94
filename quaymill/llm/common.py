"""What several text operators share: words, hashes, folds, scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quaymill.sources.workspace import Scratch

SHINGLE_WORDS = 5
# Text bytes worked on at once, so that a batch of very long texts fits in a Python worker.
SLICE_BYTES = 2_000_000

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BYTE_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64)

# Words for counting are runs of anything but ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
# Words for comparing texts are runs of letters, digits, underscores and non-ASCII characters.
TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), 0x5F, *range(0x80, 0x100)]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> Scratch:
    """Intermediate tables in the cluster's shared folder; they outlive the lazy result."""
    return Scratch(spark, f"llm-{label}")


def own_column(frame: DataFrame, name: str) -> str:
    """The name itself, or a longer one if the frame already has a column spelled like it."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def word_count(text: Column) -> Column:
    """How many runs of anything but ASCII white space; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread uint64 values over all bits."""
    values = (values ^ (values >> np.uint64(30))) * _MIX
    return values ^ (values >> np.uint64(29))


_powers = {_BASE: np.ones(1, np.uint64), _BASE_INVERSE: np.ones(1, np.uint64)}


def _power(base: int, count: int) -> np.ndarray:
    if len(_powers[base]) < count:
        steps = np.full(max(count, SLICE_BYTES), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:count]


def text_slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive parts of about SLICE_BYTES each, with the row at which each begins."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield start, texts.slice(start, end - start)


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and where each text begins and ends; null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, ends, data = texts.buffers()
    at = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(at) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def word_runs(data: np.ndarray, at: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the longest runs of bytes of a class begin and end; no run crosses two texts."""
    inside = kept[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    return starts, np.flatnonzero(inside & (~after | edge[1:])) + 1


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of parts of the data, equal in every process for equal bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _power(_BASE, len(data)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power(_BASE_INVERSE, len(data) + 1)[starts])


def word_hashes(texts: pa.Array, kept: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (run of bytes of a class), and where each text's words begin and end."""
    data, at = raw_bytes(texts)
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    starts, ends = word_runs(data, at, kept)
    return run_hashes(data, starts, ends), np.searchsorted(starts, at)


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of lower-case terms per text; a text of symbols only has its spaced pieces instead."""
    lowered = pc.utf8_lower(texts.fill_null("").cast(pa.large_string()))
    hashes, at = word_hashes(lowered, TERM)
    bare = np.flatnonzero(np.diff(at) == 0)
    if len(bare):
        pieces, piece_at = word_hashes(lowered.take(pa.array(bare)), NOT_SPACE)
        if len(pieces):
            sizes = np.diff(at)
            sizes[bare] = np.diff(piece_at)
            hashes = np.insert(hashes, np.repeat(at[bare], np.diff(piece_at)), pieces)
            at = np.concatenate([[0], np.cumsum(sizes)])
    return hashes, at


def per_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive positions; empty stretches sum to 0."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return np.diff(sums[at])


def append_columns(
    frame: DataFrame,
    text: str,
    fields: list[T.StructField],
    compute: Callable[[pa.Array], dict[str, object]],
    keep: list[str] | None = None,
) -> DataFrame:
    """The kept columns of each row (all by default) and what ``compute`` finds in its text.

    ``compute`` gets the texts of some rows and returns a value per row and field. Rows stay in
    their partitions; a task holds one Arrow batch and works on SLICE_BYTES of text at once.
    """
    keep = frame.columns if keep is None else keep
    read = list(dict.fromkeys([*keep, text]))
    schema = T.StructType([frame.schema[name] for name in keep] + fields)
    names = [field.name for field in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch.column(read.index(text))):
                found = compute(texts)
                kept = batch.slice(start, len(texts))
                columns = [kept.column(read.index(name)) for name in keep]
                columns += [pa.array(found[name]) for name in names]
                yield pa.RecordBatch.from_arrays(columns, [*keep, *names])

    return frame.select(*read).mapInArrow(run, schema)


def append_scores(
    docs: DataFrame, keep: list[str], held_out: Column, score: Callable[[pa.Array], np.ndarray]
) -> DataFrame:
    """The kept columns and held_out, score of the column ``text`` and predicted, under free names."""
    held_name, score_name, predicted = (own_column(docs.select(*keep), n) for n in ("held_out", "score", "predicted"))
    read = docs.withColumn(held_name, held_out) if held_name not in docs.columns else docs.select(*keep, "text", held_out.alias(held_name))
    fields = [T.StructField(score_name, T.DoubleType())]
    scored = append_columns(read, "text", fields, lambda texts: {score_name: score(texts)}, [*keep, held_name])
    return scored.withColumn(predicted, (F.col(score_name) >= 0.5).cast("int"))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; a shorter text is one run, an empty one has none."""
    size = min(size, len(words))
    if size == 0:
        return words
    count = len(words) - size + 1
    out = words[:count].copy()
    for step in range(1, size):
        out = out * np.uint64(_BASE) + words[step : step + count]
        out ^= out >> np.uint64(32)
    return mixed(out)


def _map_word(key: Column, words: int) -> Column:
    return F.pmod(key, F.lit(words)).cast("int")


def _map_bit(key: Column) -> Column:
    # Bits that the word number, a remainder, leaves unused.
    return F.shiftrightunsigned(key, 58).cast("int")


def bit_map(keys: DataFrame, words: int, space: Scratch, name: str) -> DataFrame:
    """At most ``words`` rows (word, bits) with the bit of every key in the column ``key`` set."""
    placed = keys.select(_map_word(F.col("key"), words).alias("word"), _map_bit(F.col("key")).alias("place"))
    bits = placed.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits"))
    return space.keep(bits, name)


def marked(frame: DataFrame, key: Column, bit_map: DataFrame, words: int, mark: str) -> DataFrame:
    """Append whether the key's bit is set, which it may be by another key. Broadcasts the bit map."""
    set_bits = bit_map.toDF(f"{mark}_word", f"{mark}_bits")
    joined = frame.withColumn(f"{mark}_key", key)
    joined = joined.join(
        F.broadcast(set_bits), _map_word(F.col(f"{mark}_key"), words) == F.col(f"{mark}_word"), "left"
    )
    is_set = F.getbit(F.coalesce(f"{mark}_bits", F.lit(0).cast("long")), _map_bit(F.col(f"{mark}_key"))) == 1
    return joined.withColumn(mark, is_set).drop(f"{mark}_key", f"{mark}_word", f"{mark}_bits")
