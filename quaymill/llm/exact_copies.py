"""Exact copies by progressive refinement: length, then hash of a prefix, then hash of the whole.

One scan writes the length in bytes and a hash of the first HEAD_CHARS code points of every text,
16 bytes a row. Texts whose length no other has are settled by that; of the others those whose
length and prefix hash no other has are settled next. Only what is left is hashed as a whole, by
SHA-256, which decides: texts with one digest are taken for equal.

What survives a step is handed to the next as a bit map of at most ``filter_words`` words of 64
bits, which is broadcast, so no text is shuffled to learn whether it goes on. A bit that two
groups share lets a text go on that need not; it is then settled by its digest, so the size of
the map decides how much is hashed, never what is found.

Everything is a SQL function. Counts fold before each shuffle, and a group's total is written
before it is joined to its rows, so that adaptive execution can split a group of very many copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quaymill.llm.common import bit_map, marked, own_column, scratch
from quaymill.operators.dedup import keep_first
from quaymill.sources.workspace import Scratch

HEAD_CHARS = 64
# 2**16 words are 4 million bits; the broadcast rows are 16 bytes each.
FILTER_WORDS = 1 << 16


def _facets(text: str) -> tuple[Column, Column]:
    whole = F.coalesce(F.col(text), F.lit(""))
    return F.octet_length(whole).cast("long"), F.xxhash64(F.left(whole, F.lit(HEAD_CHARS)))


def _digest(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def _suspects(docs: DataFrame, text: str, words: int, space: Scratch) -> DataFrame:
    """The bit map of (length, prefix hash) that several texts have."""
    size, head = _facets(text)
    facets = space.keep(docs.select(size.alias("size"), head.alias("head")), "facets")
    lengths = facets.groupBy("size").agg(F.count("*").alias("n")).where("n > 1")
    by_length = bit_map(lengths.select(F.xxhash64("size").alias("key")), words, space, "lengths")
    going_on = marked(facets, F.xxhash64("size"), by_length, words, "shared").where("shared")
    heads = going_on.groupBy("size", "head").agg(F.count("*").alias("n")).where("n > 1")
    return bit_map(heads.select(F.xxhash64("size", "head").alias("key")), words, space, "heads")


def find_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
    filter_words: int = FILTER_WORDS,
) -> DataFrame:
    """The kept columns (all but the text by default) and keep_id, group_size, kept.

    Texts are equal when identical; a null text counts as empty. Of equal texts the row with the
    largest id stays (a null id is smaller than all others), and of rows that repeat this id and
    text one; ``keep_id`` is its id, null if all ids of the group are. ``group_size`` counts rows.
    An empty table gives an empty result. A new column whose name is taken gets a trailing
    underscore. The kept columns of all rows are written once, so leave texts out of them.
    """
    space = scratch(docs.sparkSession, "copies")
    keep = [name for name in docs.columns if name != text] if keep is None else keep
    known = _suspects(docs, text, filter_words, space)
    size, head = _facets(text)
    rows = docs.select(
        F.struct(*[F.col(name) for name in keep]).alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(size, head).alias("key"),
        _digest(text).alias("whole"),
    )
    hashed = marked(rows, F.col("key"), known, filter_words, "suspect").select(
        F.monotonically_increasing_id().alias("place"),
        "row",
        "doc_id",
        F.when(F.col("suspect"), F.col("whole")).alias("full"),
    )
    # Written, the places stay what they are.
    hashed = space.keep(hashed, "hashed")
    alike = hashed.where("full IS NOT NULL")
    groups = alike.groupBy("full").agg(
        F.count("*").alias("n"), F.max(F.struct("doc_id", "place")).alias("last")
    )
    groups = space.keep(groups.where("n > 1").select("full", "n", "last"), "groups")
    joined = alike.join(groups, "full", "left").select(
        "row",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("last.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("last.place") == F.col("place"), F.lit(True)).alias("kept"),
    )
    settled = hashed.where("full IS NULL").select(
        "row", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    taken = docs.select(*keep)
    return joined.unionByName(settled).select(
        *[F.col(f"row.`{name}`").alias(name) for name in keep],
        *[F.col(name).alias(own_column(taken, name)) for name in ("keep_id", "group_size", "kept")],
    )


def drop_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", filter_words: int = FILTER_WORDS
) -> DataFrame:
    """The rows that stay, with all their columns.

    Rows whose length and prefix hash no other text has go straight from the scan to the result;
    only the others are shuffled, once, by digest. Ties and nulls are settled as in
    ``find_copies``; of rows that repeat the id and text that stay, the smallest by its columns.
    """
    space = scratch(docs.sparkSession, "copies")
    known = _suspects(docs, text, filter_words, space)
    full, mark, best, id_tag = (own_column(docs, name) for name in ("full", "suspect", "best", "id_tag"))
    flagged = marked(docs, F.xxhash64(*_facets(text)), known, filter_words, mark)
    alike = flagged.where(F.col(mark)).drop(mark).withColumn(full, _digest(text))
    last = alike.groupBy(full).agg(F.max(F.col(doc_id)).alias(best))
    last = space.keep(last.select(F.col(full).alias("digest"), F.col(best).alias(id_tag)), "last")
    same = (alike[full] == last["digest"]) & alike[doc_id].eqNullSafe(last[id_tag])
    stays = keep_first(alike.join(last, same, "left_semi"), [full]).drop(full)
    return flagged.where(~F.col(mark)).select(*docs.columns).unionByName(stays.select(*docs.columns))
