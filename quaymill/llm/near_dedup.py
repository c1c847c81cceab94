"""Near-duplicate texts: Order MinHash proposes pairs, banded alignment decides.

Order MinHash. A text is the sequence of its lower-case terms. Each run of three terms is labelled
with how often it occurred before in the text. Each of SKETCHES hash functions picks the LEAST
labelled runs with the smallest hashes; these runs in text order are the sketch, so two texts
share it with a probability that falls with their edit distance. Texts of up to SHORT terms are
also sketched on pairs of terms, of which an edit breaks fewer.

Candidates. Texts with a sketch in common form a bucket. First each text is tested with up to four pivots, of all
that are drawn from its buckets and that length allows those which share most buckets with it; in a
bucket whose texts are in one class nothing is left to do. Then what is still open is settled: the texts
of a bucket that are not in its largest class are a query set, which is compared with all texts of
the bucket in blocks. Of two linked texts the longer one, of n terms, loses floor(n / 5) terms at most,
so both have n - floor(n / 5) in common; their counts over hashed terms, two cells to a term,
tell which pairs can. Only these leave the block, as lists of partners cut into tiles: a tile holds the
texts of some thousand pairs once, aligns the pairs that its links have not joined yet and
returns the links that join its texts, fewer than it has texts. There is no cap on buckets,
partners or candidates.

Decision. Two texts are linked if the edit distance of their term sequences is at most 20 % of
the longer one. It is computed exactly within that band, bit-parallel over the band's width, after
the counts of common terms and common pairs of neighbouring terms allow it.

Exact copies fold into one text before candidates are sought. Texts are read twice: once to be sketched
and, those in a bucket with others, once more for their terms, which later steps read. Classes are the
connected components of links.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quaymill.llm.common import (
    SLICE_BYTES,
    append_columns,
    bit_map,
    marked,
    mixed,
    own_column,
    scratch,
    shingle_hashes,
    term_hashes,
    text_slices,
)
from quaymill.llm.components import components
from quaymill.sources.workspace import Scratch

SIMILARITY = 0.8
SKETCHES = 64
LEAST = 2
# Texts of up to SHORT terms have sketches of pairs, texts of over SHORT * SIMILARITY have
# sketches of runs of three: two similar texts always have one kind in common.
SHORT = 60
SHORT_SHINGLE = 2
# Of runs of three enough stay whole at a similarity of 0.8, of runs of five they do not.
LONG_SHINGLE = 3

# Pivots per text and bucket in each round; a second round costs more than it settles.
PIVOTS = (4,)
# Terms of a bucket's texts that are compared with its query set at once; a text counts as
# SMALLEST terms at least. Their counts take 8 bytes a term at most.
BLOCK_TERMS = 1 << 21
SMALLEST = 128
# Cells of the counts of a text, as a power of two, at least.
LEAST_CELLS = 8
FULL = 65_535
# The most shared buckets of a block, of which each text has a bit.
COMMON_BUCKETS = 1 << 10
# Pairs of a tile, about.
TILE_PAIRS = 1 << 12
# Words of the broadcast bit map that tells which texts are read again.
FILTER_WORDS = 1 << 16

_SEEDS = np.random.default_rng(1).integers(1, 1 << 63, 2 * SKETCHES, np.uint64) | np.uint64(1)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


# --- sketches -------------------------------------------------------------------------------


def _labelled(runs: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Mix into each run's hash how often it occurred before in its text."""
    order = np.lexsort((runs, text))
    runs_in, text_in = runs[order], text[order]
    first = np.ones(len(runs), bool)
    first[1:] = (runs_in[1:] != runs_in[:-1]) | (text_in[1:] != text_in[:-1])
    places = np.arange(len(runs))
    label = np.empty(len(runs), np.uint64)
    label[order] = places - np.maximum.accumulate(np.where(first, places, 0))
    return mixed(runs + label * np.uint64(0xD6E8FEB86659FD93))


def _sketch_family(
    terms: np.ndarray, at: np.ndarray, chosen: np.ndarray, size: int, seeds: np.ndarray
) -> np.ndarray:
    """Sketches (one row per chosen text) of runs of ``size`` terms."""
    lengths = np.diff(at)[chosen]
    counts = np.maximum(lengths - size + 1, 1)
    ends = np.cumsum(counts)
    starts = ends - counts
    text = np.repeat(np.arange(len(chosen)), counts)
    places = at[chosen][text] + np.arange(ends[-1]) - starts[text]
    padded = np.concatenate([terms, np.zeros(size, np.uint64)])
    runs = shingle_hashes(padded, size)[places]
    for place in np.flatnonzero(lengths < size):
        runs[starts[place]] = shingle_hashes(terms[at[chosen[place]] : at[chosen[place] + 1]], size)[0]
    labelled = _labelled(runs, text)
    # The low bits of each hash give way to the place of the run, so a minimum tells where it is.
    bits = np.uint64(int(ends[-1]).bit_length())
    index = np.arange(ends[-1], dtype=np.uint64)
    place_of = (np.uint64(1) << bits) - np.uint64(1)
    out = np.empty((len(chosen), len(seeds)), np.uint64)
    for column, seed in enumerate(seeds):
        values = ((labelled * seed) & ~place_of) | index
        picked = np.empty((LEAST, len(chosen)), np.uint64)
        for turn in range(LEAST):
            smallest = np.minimum.reduceat(values, starts)
            found = smallest != _NONE
            picked[turn] = np.where(found, smallest & place_of, place_of)
            values[picked[turn][found].astype(np.int64)] = _NONE
        picked.sort(axis=0)
        key = np.full(len(chosen), seed)
        for turn in range(LEAST):
            there = picked[turn] != place_of
            run = runs[np.where(there, picked[turn], 0).astype(np.int64)]
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + np.where(there, run, np.uint64(turn)))
        out[:, column] = key
    return out


def order_minhash(texts: pa.Array) -> dict[str, object]:
    """The number of terms and the sketch hashes of each text; an empty text has no sketch."""
    terms, at = term_hashes(texts)
    lengths = np.diff(at)
    sketches: list[list[int]] = [[] for _ in range(len(texts))]
    families = (
        (lengths > SHORT * SIMILARITY, LONG_SHINGLE, _SEEDS[:SKETCHES]),
        ((lengths > 0) & (lengths <= SHORT), SHORT_SHINGLE, _SEEDS[SKETCHES:]),
    )
    for which, size, seeds in families:
        chosen = np.flatnonzero(which)
        if len(chosen):
            rows = _sketch_family(terms, at, chosen, size, seeds).view(np.int64).tolist()
            for text, row in zip(chosen.tolist(), rows):
                sketches[text] = sketches[text] + row
    return {
        "n_terms": pa.array(lengths, pa.int64()),
        "sketches": pa.array(sketches, pa.list_(pa.int64())),
    }


# --- alignment ------------------------------------------------------------------------------


def banded_distance(left: list[int], right: list[int], most: int) -> int | None:
    """The edit distance of two sequences if it is at most ``most``, else None.

    Only cells within ``most`` of the diagonal are computed; each column of the band is one
    integer of 2 * most + 1 bits, of which each step updates all rows at once.
    """
    start = 0
    end = min(len(left), len(right))
    while start < end and left[start] == right[start]:
        start += 1
    tail = 0
    while tail < end - start and left[-1 - tail] == right[-1 - tail]:
        tail += 1
    left, right = left[start : len(left) - tail], right[start : len(right) - tail]
    rows, columns = len(left), len(right)
    if abs(rows - columns) > most:
        return None
    if not rows or not columns:
        return max(rows, columns)
    most = min(most, max(rows, columns))
    width = 2 * most + 1
    mask = (1 << width) - 1
    low = 1 << (width - 1)
    where: dict[int, int] = {}
    for row, symbol in enumerate(left):
        where[symbol] = where.get(symbol, 0) | (1 << (row + most))
    plus = mask & ~((1 << most) - 1)
    minus = 0
    # The value on the band's lowest diagonal never falls; it bounds the result from below.
    score = most
    stop = most + (columns + most - rows)
    for column, symbol in enumerate(right):
        match = (where.get(symbol, 0) >> column) & mask
        diagonal = (((match & plus) + plus) ^ plus) | match | minus
        above = (minus | ~(diagonal | plus)) & mask
        below = diagonal & plus
        if not diagonal & low:
            score += 1
            if score > stop:
                return None
        shifted = (diagonal & mask) >> 1
        plus = below & mask | (~(shifted | above) & mask)
        minus = shifted & above
    first = rows + most - columns
    rest = ((1 << (2 * most)) - 1) >> first << first
    score -= (plus & rest).bit_count() - (minus & rest).bit_count()
    return score if score <= most else None


def alignment_similarity(left: np.ndarray, right: np.ndarray, least: float) -> float | None:
    """1 - distance / longer length where that is at least ``least``, else None."""
    longer = max(len(left), len(right))
    if longer == 0:
        return 1.0
    most = int((1 - least) * longer + 1e-9)
    if abs(len(left) - len(right)) > most:
        return None
    a, b = left.tolist(), right.tolist()
    # No alignment matches more terms than the two texts have in common.
    if longer - (Counter(a) & Counter(b)).total() > most:
        return None
    # An edit takes away two pairs of neighbours at most.
    if longer - 1 - (Counter(zip(a, a[1:])) & Counter(zip(b, b[1:]))).total() > 2 * most:
        return None
    distance = banded_distance(a, b, most)
    return None if distance is None else 1 - distance / longer


def _arrays(blobs: pa.Array, kind: type) -> Iterator[np.ndarray]:
    """Each binary value as an array, without a copy."""
    return (np.frombuffer(blob.as_buffer(), kind) for blob in blobs)


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(_arrays(batch.column("terms_a"), np.uint64), _arrays(batch.column("terms_b"), np.uint64))
        similarity = [alignment_similarity(a, b, SIMILARITY) for a, b in pairs]
        columns = [batch.column("a"), batch.column("b"), pa.array(similarity, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", "similarity"])


# --- candidates -----------------------------------------------------------------------------


def _may_link(left: str, right: str) -> Column:
    """Whether two texts of so many terms can be linked."""
    return F.least(left, right) >= F.lit(SIMILARITY) * F.greatest(left, right) - 1e-9


def _shared(buckets: DataFrame, space: Scratch) -> DataFrame:
    """Rows (bucket, tid, n_terms) of the buckets with several texts.

    Counts fold before the shuffle and are written, so that they share no stage with the join and
    adaptive execution can split it where a bucket holds very many texts.
    """
    found = buckets.groupBy("bucket").agg(F.count("*").alias("texts")).where("texts > 1")
    found = space.keep(found.select("bucket"), "buckets")
    return space.keep(buckets.join(found, "bucket"), "shared")


def _best_pivots(rows: DataFrame, turn: int, space: Scratch) -> DataFrame:
    """Pairs (a, b): each text with up to PIVOTS[turn] pivots, those that stand in most of its buckets.

    As many pivots are drawn of each bucket, by hash. Pivots of the text's own class settle
    nothing, and pivots whose length forbids a link are no pivots of that text.
    """
    width = PIVOTS[turn]
    drawn = [F.min_by(F.struct("tid", "n_terms", "class"), F.xxhash64(F.lit(place), "tid")) for place in range(width)]
    pivots = rows.groupBy("bucket").agg(F.array(*drawn).alias("pivots"))
    pivots = space.keep(pivots.select("bucket", F.array_distinct("pivots").alias("pivots")), f"pivots-{turn}")
    pairs = rows.join(pivots, "bucket").withColumn("pivot", F.explode("pivots"))
    pairs = pairs.select("tid", "n_terms", "class", F.col("pivot.tid").alias("other"), F.col("pivot.n_terms").alias("size"), F.col("pivot.class").alias("other_class"))
    pairs = pairs.where((F.col("class") != F.col("other_class")) & _may_link("n_terms", "size"))
    counted = pairs.groupBy("tid", "other").agg(F.count("*").alias("n"))
    # Pairs that meet in one bucket only are seldom linked; settling is cheaper for them than an alignment.
    counted = counted.where("n > 1")
    # At most width pivots for each sketch of a text.
    ranked = F.sort_array(F.collect_list(F.struct("n", "other")), asc=False)
    best = counted.groupBy("tid").agg(F.slice(ranked, 1, width).alias("best"))
    best = best.select("tid", F.explode("best.other").alias("other"))
    return best.select(F.least("tid", "other").alias("a"), F.greatest("tid", "other").alias("b")).distinct()


def _open(shared: DataFrame, stars: DataFrame, space: Scratch, name: str) -> DataFrame:
    """The rows of ``shared`` whose buckets hold texts of several classes, with each text's class."""
    classes = stars.toDF("tid", "least")
    classed = shared.join(classes, "tid", "left").withColumn("class", F.coalesce("least", "tid")).drop("least")
    classed = space.keep(classed, f"classed-{name}")
    several = classed.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    several = space.keep(several.where("low != high").select("bucket"), f"several-{name}")
    return classed.join(several, "bucket", "left_semi")


# --- settling -------------------------------------------------------------------------------


def term_counts(terms: np.ndarray) -> np.ndarray:
    """How many terms fall on each cell, at most FULL; a power of two of cells, two to a term or more."""
    bits = max(LEAST_CELLS, (max(2 * len(terms), 1) - 1).bit_length())
    counts = np.bincount((terms >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, FULL).astype(np.uint16)


def _narrow(counts: np.ndarray, cells: int) -> np.ndarray:
    """Counts over fewer cells, rows of a matrix."""
    return counts.reshape(len(counts), cells, -1).sum(axis=2, dtype=np.int64)


def most_common_terms(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Bounds from above on the terms that one text has in common with each of the others.

    A cell that is full may hold any number, so it counts as no bound.
    """
    cells = min(len(one), others.shape[1])
    if len(one) == others.shape[1]:
        least = np.minimum(one, others).sum(axis=1, dtype=np.int64)
    else:
        least = np.minimum(_narrow(one[None], cells), _narrow(others, cells)).sum(axis=1)
    if one.max(initial=0) == FULL:
        full = (_narrow(one[None] == FULL, cells) > 0) & (_narrow(others == FULL, cells) > 0)
        least += full.any(axis=1).astype(np.int64) << 40
    return least


def _count_blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blobs = [term_counts(terms).tobytes() for terms in _arrays(batch.column("terms"), np.uint64)]
        yield pa.RecordBatch.from_arrays([batch.column("tid"), pa.array(blobs, pa.binary())], ["tid", "counts"])


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """The rows of each value of the named columns; they come sorted by them and may span batches."""
    rest, key = [], None
    for batch in batches:
        keys = np.stack([batch.column(name).to_numpy() for name in names])
        edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        starts = [0, *edges.tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:]):
            if start < end:
                if rest and key != tuple(keys[:, start]):
                    yield pa.Table.from_batches(rest)
                    rest = []
                # The last group may go on in the next batch.
                key = tuple(keys[:, start])
                rest.append(batch.slice(start, end - start))
    if rest:
        yield pa.Table.from_batches(rest)


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of a query text and a text of its block that may be linked.

    A pair that meets in several buckets comes from the least of them.
    """
    for rows in _groups(batches, ["bucket", "part"]):
        pairs = _one_block(rows)
        if pairs.size:
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def _common_bits(bucket: int, buckets: pa.ChunkedArray) -> np.ndarray:
    """A row of bits per text: which of the smaller buckets that most texts here share hold it."""
    lists = buckets.combine_chunks()
    text = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    found = lists.flatten().to_numpy()
    text, found = text[found < bucket], found[found < bucket]
    values, place, times = np.unique(found, return_inverse=True, return_counts=True)
    most = np.argsort(-times, kind="stable")[:COMMON_BUCKETS]
    column = np.full(len(values), -1)
    column[most] = np.arange(len(most))
    known = column[place] >= 0
    bits = np.zeros((len(lists), max(len(most), 1)), bool)
    bits[text[known], column[place][known]] = True
    return np.packbits(bits, axis=1)


def _one_block(rows: pa.Table) -> np.ndarray:
    """The pairs of a block, the smaller tid of each above the larger."""
    tid, own, size, asks, home = (rows[name].to_numpy() for name in ("tid", "class", "n_terms", "asks", "home"))
    counts = [one for chunk in rows["counts"].chunks for one in _arrays(chunk, np.uint16)]
    cells = np.array([len(one) for one in counts])
    bucket = rows["bucket"][0].as_py()
    bits = _common_bits(bucket, rows["buckets"])
    # At most one bucket for each sketch of a text.
    buckets = [frozenset(found) for found in rows["buckets"].to_pylist()]
    lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for width in np.unique(cells[home]).tolist():
        here = np.flatnonzero(home & (cells == width))
        others = np.stack([counts[row] for row in here])
        for row in np.flatnonzero(asks).tolist():
            longer = np.maximum(size[here], size[row])
            most = ((1 - SIMILARITY) * longer + 1e-9).astype(np.int64)
            fits = np.flatnonzero((own[here] != own[row]) & (np.abs(size[here] - size[row]) <= most))
            # A smaller bucket in common has the pair.
            fits = fits[~(bits[here[fits]] & bits[row]).any(axis=1)]
            if len(fits):
                at_once = max(1, SLICE_BYTES // (2 * width))
                common = np.concatenate(
                    [most_common_terms(counts[row], others[fits[n : n + at_once]]) for n in range(0, len(fits), at_once)]
                )
                fits = fits[common >= longer[fits] - most[fits]]
                fits = fits[np.array([bucket == min(buckets[row] & buckets[other]) for other in here[fits].tolist()], bool)]
                lefts.append(np.full(len(fits), tid[row]))
                rights.append(tid[here[fits]])
    left, right = np.concatenate(lefts), np.concatenate(rights)
    return np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)]), axis=1)


# --- tiles ----------------------------------------------------------------------------------


def _block_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (tile, tid, partners) of the pairs of each block: each text of a tile once, with the larger texts to test it with.

    The texts of a block are cut into as many strips as make tiles of TILE_PAIRS pairs, a tile being two strips.
    """
    for rows in _groups(batches, ["bucket", "part"]):
        pairs = _one_block(rows)
        if not pairs.size:
            continue
        texts, place = np.unique(pairs, return_inverse=True)
        strips = int(np.ceil(np.sqrt(pairs.shape[1] / TILE_PAIRS)))
        first, second = place.reshape(pairs.shape) * strips // len(texts)
        seed = np.array([rows[name][0].as_py() for name in ("bucket", "part")]).view(np.uint64)
        for tile in np.unique(first * strips + second).tolist():
            left, right = pairs[:, first * strips + second == tile]
            order = np.argsort(left, kind="stable")
            members = np.unique(np.stack([left, right]))
            at = np.searchsorted(left[order], np.append(members, members[-1] + 1))
            partners = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(right[order]))
            key = mixed(mixed(seed[:1] + seed[1:] * np.uint64(0x9E3779B97F4A7C15)) + np.uint64(tile)).view(np.int64)
            columns = [pa.array(np.repeat(key, len(members))), pa.array(members), partners]
            yield pa.RecordBatch.from_arrays(columns, ["tile", "tid", "partners"])


def _occurrences(runs: np.ndarray) -> np.ndarray:
    """Each run with how often it occurred before, hashed and sorted: equal ones match one to one."""
    return np.sort(_labelled(runs, np.zeros(len(runs), np.int64)))


def _in_common(one: np.ndarray, other: np.ndarray) -> int:
    """How many values two sorted arrays without repeats have in common."""
    if not len(one) or not len(other):
        return 0
    place = np.minimum(np.searchsorted(one, other), len(one) - 1)
    return int((one[place] == other).sum())


def tile_links(terms: dict[int, np.ndarray], pairs: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Of the pairs of texts that are linked those that join two groups, which are all joined by links before."""
    single = {tid: _occurrences(one) for tid, one in terms.items()}
    double = {tid: _occurrences(shingle_hashes(one, 2)) for tid, one in terms.items()}
    above = {tid: tid for tid in terms}

    def top(tid: int) -> int:
        while above[tid] != tid:
            above[tid] = tid = above[above[tid]]
        return tid

    for a, b in pairs:
        if top(a) == top(b):
            continue
        longer = max(len(terms[a]), len(terms[b]))
        most = int((1 - SIMILARITY) * longer + 1e-9)
        # The bounds of alignment_similarity, from what is sorted once for all pairs of a text.
        if longer - _in_common(single[a], single[b]) > most or longer - 1 - _in_common(double[a], double[b]) > 2 * most:
            continue
        if banded_distance(terms[a].tolist(), terms[b].tolist(), most) is not None:
            above[top(a)] = top(b)
            yield a, b


def _tile_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _groups(batches, ["tile"]):
        tids = rows["tid"].to_pylist()
        terms = dict(zip(tids, (one for chunk in rows["terms"].chunks for one in _arrays(chunk, np.uint64))))
        pairs = ((a, b) for a, partners in zip(tids, rows["partners"].to_pylist()) for b in partners)
        links = list(tile_links(terms, pairs))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(end, pa.int64()) for end in zip(*links)], ["a", "b"])


def _open_links(rest: DataFrame, terms: DataFrame, space: Scratch) -> DataFrame:
    """Links that join all texts that are in different classes, share a bucket and are linked.

    ``rest`` has bucket, tid, n_terms and class of the open buckets; of those with the same texts
    one is read. The query set of a bucket is sent to each of its blocks, its other texts to one.
    """
    terms_in = F.sum(F.greatest("n_terms", F.lit(SMALLEST)))
    same = rest.groupBy("bucket").agg(
        terms_in.alias("terms_in"), *[F.bit_xor(F.xxhash64("tid", F.lit(seed))).alias(f"x{seed}") for seed in range(2)]
    )
    same = same.groupBy("terms_in", "x0", "x1").agg(F.min("bucket").alias("bucket"))
    per_class = rest.groupBy("bucket", "class").agg(F.count("*").alias("n"))
    largest = per_class.groupBy("bucket").agg(F.max_by("class", "n").alias("main"))
    buckets = space.keep(same.join(largest, "bucket").select("bucket", "terms_in", "main"), "settled")
    inside = rest.join(buckets, "bucket")
    lists = space.keep(inside.groupBy("tid").agg(F.collect_list("bucket").alias("buckets")), "lists")
    counts = lists.select("tid").join(terms, "tid").mapInArrow(_count_blobs, "tid long, counts binary")
    counts = space.keep(counts.join(lists, "tid"), "counts")
    parts = F.ceil(F.col("terms_in") / BLOCK_TERMS).cast("int")
    asks, home = F.col("class") != F.col("main"), F.pmod(F.xxhash64("tid"), F.col("parts")).cast("int")
    placed = inside.withColumn("parts", parts).withColumns({"asks": asks, "own_part": home})
    places = F.when(F.col("asks"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("own_part"))
    placed = placed.withColumn("part", F.explode(places)).withColumn("home", F.col("part") == F.col("own_part"))
    rows = placed.select("bucket", "part", "tid", "class", "n_terms", "asks", "home").join(counts, "tid")
    blocks = rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    tiles = space.keep(blocks.mapInArrow(_block_tiles, "tile long, tid long, partners array<long>"), "tiles")
    # Only texts of a tile are read, once for all their pairs in it.
    placed = tiles.join(terms, "tid").repartition("tile").sortWithinPartitions("tile")
    return placed.select("tile", "tid", "partners", "terms").mapInArrow(_tile_links, "a long, b long")


def _id_key(doc_id: str) -> Column:
    column = F.col(doc_id).cast("string")
    return F.when(column.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), column))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_key"),
        _id_key(doc_id).alias("id_key"),
    )


def text_classes(docs: DataFrame, doc_id: str, text: str, space: Scratch) -> DataFrame:
    """One row per distinct text: text_key, id_key and doc_id of its first document, class_key.

    Two texts have one class_key if a chain of links joins them. ``space`` holds the tables that
    the result reads.
    """
    keyed = _keyed(docs, doc_id, text)
    fields = [
        T.StructField("n_terms", T.LongType()),
        T.StructField("sketches", T.ArrayType(T.LongType())),
    ]
    sketched = append_columns(keyed, "text", fields, order_minhash, ["doc_id", "text_key", "id_key"])
    texts = sketched.groupBy("text_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "id_key")).alias("first"),
        *[F.any_value(field.name).alias(field.name) for field in fields],
    )
    # Once written, the numbers stay what they are.
    texts = space.keep(
        texts.select(
            F.monotonically_increasing_id().alias("tid"),
            "text_key",
            "first.doc_id",
            "first.id_key",
            *[field.name for field in fields],
        ),
        "texts",
    )
    shared = _shared(texts.select("tid", "n_terms", F.explode("sketches").alias("bucket")), space)
    terms = _terms(keyed, texts, shared.select("tid").distinct(), space)
    spark = docs.sparkSession
    done: list[str] = []
    stars = None

    def test(pairs: DataFrame) -> None:
        """Align pairs that are in different classes so far and grow the classes by their links."""
        nonlocal stars
        name = f"{len(done)}"
        if stars is not None:
            # Pairs within a class cannot change it; tested ones that are not linked stay so.
            ends = [stars.toDF(end, f"class_{end}") for end in ("a", "b")]
            pairs = pairs.join(ends[0], "a", "left").join(ends[1], "b", "left")
            apart = F.coalesce("class_a", "a") != F.coalesce("class_b", "b")
            pairs = pairs.where(apart).select("a", "b")
            pairs = pairs.join(spark.read.parquet(*done).select("a", "b"), ["a", "b"], "left_anti")
        pairs = space.keep(pairs, f"pairs-{name}")
        both = pairs.join(terms.toDF("a", "terms_a"), "a").join(terms.toDF("b", "terms_b"), "b")
        aligned = space.keep(both.mapInArrow(_align, "a long, b long, similarity double"), f"aligned-{name}")
        done.append(f"{space.path}/aligned-{name}")
        links = aligned.where("similarity IS NOT NULL").select("a", "b")
        # A class so far is a star; with the new links it gives what all links would.
        stars = components(links if stars is None else links.union(stars), space, f"stars-{name}")

    rest = shared.withColumn("class", F.col("tid"))
    for turn in range(len(PIVOTS)):
        test(_best_pivots(rest, turn, space))
        rest = _open(rest.select(*shared.columns), stars, space, f"{turn}")
    stars = components(_open_links(rest, terms, space).union(stars), space, "stars")
    return (
        texts.join(stars.toDF("tid", "least"), "tid", "left")
        .select("text_key", "doc_id", "id_key", F.coalesce("least", "tid").alias("class_key"))
    )


def _term_blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, texts in text_slices(batch.column("text")):
            terms, at = term_hashes(texts)
            blobs = [terms[at[row] : at[row + 1]].tobytes() for row in range(len(texts))]
            columns = [batch.column("tid").slice(start, len(texts)), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["tid", "terms"])


def _terms(keyed: DataFrame, texts: DataFrame, wanted: DataFrame, space: Scratch) -> DataFrame:
    """tid and the hashes of the terms of the wanted texts, each read from its first document.

    A bit map of the wanted ones keeps most other texts out of the shuffle.
    """
    needed = space.keep(texts.join(wanted, "tid", "left_semi").select("tid", "text_key", "id_key"), "needed")
    key = F.xxhash64("text_key", "id_key")
    known = bit_map(needed.select(key.alias("key")), FILTER_WORDS, space, "needed-bits")
    likely = marked(keyed.select("text_key", "id_key", "text"), key, known, FILTER_WORDS, "likely").where("likely")
    # Repeated rows are equal, so any one serves.
    read = likely.join(needed, ["text_key", "id_key"]).dropDuplicates(["text_key", "id_key"])
    return space.keep(read.select("tid", "text").mapInArrow(_term_blobs, "tid long, terms binary"), "terms")


# --- results --------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (the least id in the class), class_size (rows).

    Null and empty texts are the same, empty text: one class. A null id counts as the last of its
    class; class_id is null only if all ids of the class are. Repeated rows are members of one
    class each. An empty table gives an empty result. Other columns are not read.
    """
    space = scratch(docs.sparkSession, "near")
    classes = text_classes(docs, doc_id, text, space)
    keyed = _keyed(docs, doc_id, text).select("doc_id", "text_key")
    counted = keyed.groupBy("text_key").agg(F.count("*").alias("rows"))
    totals = (
        classes.join(counted, "text_key")
        .groupBy("class_key")
        .agg(F.min("doc_id").alias("class_id"), F.sum("rows").alias("class_size"))
    )
    # Written, the sums no longer share a stage with the join, which can then split a hot class.
    totals = space.keep(totals, "totals")
    totals = classes.join(totals, "class_key").select("text_key", "class_id", "class_size")
    return keyed.join(totals, "text_key").select("doc_id", "class_id", "class_size")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, all its columns: the one with the least id (null last), then text.

    Equal rows of the least id count as one. Rows with null or empty text form one class.
    """
    space = scratch(docs.sparkSession, "near")
    classes = text_classes(docs, doc_id, text, space)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "id_key"))
    text_key, id_key = own_column(docs, "text_key"), own_column(docs, "id_key")
    first = classes.groupBy("class_key").agg(least.alias("first")).select(
        F.col("first.text_key").alias(text_key), F.col("first.id_key").alias(id_key)
    )
    keyed = docs.withColumns(
        {
            text_key: F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")),
            id_key: _id_key(doc_id),
        }
    )
    kept = keyed.join(first, [text_key, id_key]).dropDuplicates([text_key, id_key])
    return kept.select(*docs.columns)
