"""Mixing sources to target weights by hash-random order and distributed prefix sums.

Documents get a hash-random key and are range-sorted by source and key, so a source with a third
of all rows spreads over many range partitions. Each range partition adds up words as it streams
by; the totals of the partitions before it (one row per partition and source) complete the prefix
sums. A source takes whole epochs of its documents and then, in that order, documents up to the
exact word at which its budget is reached; the document at the cut gives its first words only.

Only scalars reach the driver. Budgets are exact integers until the final division.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quaymill.llm.common import own_column, scratch, word_count
from quaymill.sources.workspace import Scratch

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3

SOURCE = ["no_source", "source"]


def _running(value: str, groups: list[str]):
    """Append ``local``: the sum of ``value`` over earlier rows of the group in this partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            values = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.zeros(len(values), bool)
            for name in groups:
                coded = batch.column(name).dictionary_encode().indices.to_numpy()
                starts[1:] |= coded[1:] != coded[:-1]
            first = tuple(batch.column(name)[0].as_py() for name in groups)
            starts[0] = True
            before = np.cumsum(values) - values
            base = np.zeros(len(values), np.int64)
            at = np.flatnonzero(starts)
            base[at] = before[at]
            base = base[at][np.cumsum(starts) - 1]
            local = before - base
            if first == last:
                end = at[1] if len(at) > 1 else len(values)
                local[:end] += carried
            last = tuple(batch.column(name)[-1].as_py() for name in groups)
            carried = int(local[-1] + values[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(local, pa.int64())], [*batch.schema.names, "local"]
            )

    return run


def _sorted(
    frame: DataFrame, groups: list[str], order: list[str], value: str, space: Scratch, name: str
) -> DataFrame:
    """Range-sort by group and order; append part (the range partition) and local."""
    # One task per range partition: parts that are numbered in order must not be split or merged.
    ranged = frame.repartitionByRange(*groups, *order).sortWithinPartitions(*groups, *order)
    ranged = ranged.withColumn("part", F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, T.StructField("local", T.LongType())])
    # Written, the parts stay what they are even if an executor is lost.
    return space.keep(ranged.mapInArrow(_running(value, groups), schema), name)


def _offsets(ranged: DataFrame, groups: list[str], value: str) -> DataFrame:
    """part, the groups and ``offset``: the sum of ``value`` in the group's earlier parts."""
    sums = ranged.groupBy("part", *groups).agg(F.sum(value).alias("total"))
    earlier = (Window.partitionBy(*groups) if groups else Window).orderBy("part")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset")
    return sums.select("part", *groups, offset)


def source_targets(sizes: DataFrame, weights: tuple[int, ...], space: Scratch) -> DataFrame:
    """no_source, source, source_size and target of each source.

    Weights repeat over the sources by code point, null last. All words are shared by weight;
    a source whose share would pass MAX_EPOCHS times its size gets just that, and the rest is
    shared again among the others until none is above. Each round is one aggregate.
    """
    ranked = _sorted(sizes.withColumn("one", F.lit(1)), [], SOURCE, "one", space, "ranked")
    rank = F.col("local") + F.col("offset")
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    ranked = ranked.join(_offsets(ranked, [], "one"), "part").select(
        *SOURCE, "source_size", weight.cast("long").alias("weight")
    )
    ranked = space.keep(ranked, "weights")
    cap = F.col("source_size") * MAX_EPOCHS
    pool, weight_sum = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    pool, weight_sum = pool or 0, weight_sum or 0
    is_open = F.lit(True)
    while True:
        share = F.lit(Decimal(pool)).cast("decimal(38,0)") * F.col("weight")
        stays = is_open & (share <= cap.cast("decimal(38,0)") * F.lit(weight_sum))
        capped, gone = ranked.where(is_open & ~stays).agg(F.sum(cap), F.sum("weight")).first()
        if capped is None:
            break
        pool, weight_sum, is_open = pool - capped, weight_sum - gone, stays
    share = F.lit(float(pool)) * F.col("weight") / F.lit(float(max(weight_sum, 1)))
    target = F.when(is_open, share).otherwise(cap.cast("double")).alias("target")
    return ranked.select(*SOURCE, "source_size", target)


def _taken() -> Column:
    budget = F.round("target").cast("long")
    size, whole = F.col("size"), F.col("source_size")
    epochs = F.when(whole > 0, F.floor(budget / whole)).otherwise(0).cast("long")
    rest = budget - epochs * whole - F.col("offset") - F.col("local")
    return epochs * size + F.greatest(F.lit(0), F.least(size, rest))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    keep: list[str] | None = None,
    seed: int = 7,
) -> DataFrame:
    """The kept columns (all by default) and size, source_size, target, taken.

    ``size`` counts words (null text: 0), ``taken`` the words the mix takes of the document,
    repeats counted: size times whole epochs, plus what the last, partial epoch takes. A null
    source is a source of its own, the last. Order within a source is by hash of seed, id and
    text, so reruns agree; rows equal in all of these share the cut in either order. Null ids are
    allowed. Empty texts have size 0. An empty table gives an empty result. A new column whose
    name is taken gets a trailing underscore.
    """
    space = scratch(docs.sparkSession, "mix")
    keep = list(docs.columns) if keep is None else keep
    sized = docs.select(
        F.struct(*[F.col(name) for name in keep]).alias("row"),
        F.col(source).isNull().alias("no_source"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
        word_count(F.col(text)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(doc_id).cast("string"), F.col(text)).alias("key"),
        F.col(doc_id).cast("string").alias("tie"),
    )
    placed = _sorted(sized, SOURCE, ["key", "tie", "size"], "size", space, "placed")
    sizes = placed.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, space)
    # A source with very many rows has one row per part here, so no key of this join is hot.
    offsets = _offsets(placed, SOURCE, "size").join(targets, SOURCE)
    values = {
        "size": F.col("size"),
        "source_size": F.col("source_size"),
        "target": F.col("target"),
        "taken": _taken().cast("long"),
    }
    return placed.join(offsets, ["part", *SOURCE]).select(
        *[F.col(f"row.`{name}`").alias(name) for name in keep],
        *[value.alias(own_column(docs.select(*keep), name)) for name, value in values.items()],
    )


def mixed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: a row per document and epoch in which the mix takes words of it.

    All columns of ``docs`` and ``epoch`` (from 1) and ``words``. Where the last epoch takes only
    the first words of a document (one document of a source at most), its text is those words.
    """
    mixed = mix(docs, doc_id, text, source)
    size, taken = mixed[mixed.columns[-4]], mixed[mixed.columns[-1]]
    names = ("epoch", "words", "whole_words", "total_words")
    epoch, words, whole, total = (own_column(docs, name) for name in names)
    rows = mixed.where(taken > 0).select(
        *docs.columns,
        size.alias(whole),
        taken.alias(total),
        F.explode(F.sequence(F.lit(1), F.ceil(taken / size).cast("int"))).alias(epoch),
    )
    here = F.least(F.col(whole), F.col(total) - (F.col(epoch) - 1) * F.col(whole))
    rows = rows.withColumn(words, here)
    pieces = F.split(F.ltrim(F.translate(text, "\t\n\u000b\u000c\r", "     ")), " +")
    cut = F.array_join(F.slice(pieces, 1, F.col(words).cast("int")), " ")
    rows = rows.withColumn(text, F.when(F.col(words) < F.col(whole), cut).otherwise(F.col(text)))
    return rows.select(*docs.columns, epoch, words)
