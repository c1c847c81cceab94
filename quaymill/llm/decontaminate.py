"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact check.

A benchmark item and every window of a text with as many terms are bags of five-term shingles. A
shingle's weight is one over the number of items that have it. The fingerprint is the sign of the weighted sum of
the shingles' bits. Two fingerprints within RADIUS differ in at most BLOCK_RADIUS bits in at least
one of BLOCKS blocks, so looking up each block's neighbours in the index finds all of them.
Candidates are then held against the item exactly: the share of the item's shingle weight that the
window has must reach SIMILARITY.

A window without any shingle of an item cannot reach it, so only windows around such a shingle are
fingerprinted. That drops no match and spares nearly all texts.

Items come to the tasks in blocks of ITEMS_PER_BLOCK at most; a larger benchmark takes more
passes over the texts, so any size works. Texts never leave their task.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from quaymill.llm.common import SHINGLE_WORDS, scratch, shingle_hashes, term_hashes, text_slices

SIMILARITY = 0.8
BITS = 64
BLOCKS = 8
BLOCK_RADIUS = 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
ITEMS_PER_BLOCK = 50_000

_NEIGHBOURS = np.array([v for v in range(256) if v.bit_count() <= BLOCK_RADIUS], np.int64)
_SCREEN_BITS = 22


def _sign_sums(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Running sums (one row more than shingles) of each bit as +weight or -weight."""
    bits = np.unpackbits(shingles[:, None].view(np.uint8), axis=1).astype(np.float64)
    sums = np.zeros((len(shingles) + 1, BITS))
    np.cumsum((2 * bits - 1) * weights[:, None], axis=0, out=sums[1:])
    return sums


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    """One row of BLOCKS bytes per row of sums."""
    return np.packbits(sums > 1e-9, axis=1)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which range, and which number, for all numbers of all ranges."""
    which = np.repeat(np.arange(len(starts)), counts)
    first = np.cumsum(counts) - counts
    return which, starts[which] + np.arange(len(which)) - first[which]


class ItemIndex:
    """The items of one block: their shingles, fingerprints and the Hamming index."""

    def __init__(self, ids: list, texts: list[str | None], counts: dict[int, int] | None = None):
        """``counts`` has how many items of all blocks hold a shingle, where that is more than one."""
        terms, at = term_hashes(pa.array(texts, pa.string()))
        sizes = np.diff(at)
        kept = np.flatnonzero(sizes > 0)
        self.ids = [ids[item] for item in kept]
        self.sizes = sizes[kept]
        bags = [
            Counter(shingle_hashes(terms[at[item] : at[item + 1]], SHINGLE_WORDS).tolist()) for item in kept
        ]
        having: dict[int, list[int]] = defaultdict(list)
        for number, bag in enumerate(bags):
            for shingle in bag:
                having[shingle].append(number)
        items = {s: len(numbers) for s, numbers in having.items()} if counts is None else counts
        self.bags = [{s: (c, 1 / items.get(s, 1)) for s, c in bag.items()} for bag in bags]
        self.totals = [sum(c * w for c, w in bag.values()) for bag in self.bags]
        # The shingle lengths in use: five, or all terms of a shorter item.
        self.lengths = sorted(set(np.minimum(self.sizes, SHINGLE_WORDS).tolist()))
        self.known = np.array(sorted(having), np.uint64)
        self.weights = np.array([1 / items.get(s, 1) for s in self.known.tolist()])
        self.screen = np.zeros(1 << _SCREEN_BITS, bool)
        self.screen[self.known >> np.uint64(64 - _SCREEN_BITS)] = True
        # The window sizes that each shingle calls for.
        wanted = [sorted({int(self.sizes[n]) for n in having[s]}) for s in self.known.tolist()]
        self.size_at = np.concatenate([[0], np.cumsum([len(w) for w in wanted])]).astype(np.int64)
        self.size_of = np.array([n for w in wanted for n in w], np.int64)
        self._index()

    def _index(self) -> None:
        prints = np.zeros((len(self.ids), BLOCKS), np.uint8)
        for number, bag in enumerate(self.bags):
            shingles = np.array(list(bag), np.uint64)
            weights = np.array([c * w for c, w in bag.values()])
            prints[number] = _fingerprints(_sign_sums(shingles, weights)[-1:])[0]
        self.prints = prints
        self.groups = np.unique(self.sizes)
        group = np.searchsorted(self.groups, self.sizes)
        self.order, self.starts = [], []
        for block in range(BLOCKS):
            key = group * 256 + prints[:, block]
            self.order.append(np.argsort(key, kind="stable"))
            self.starts.append(np.searchsorted(key[self.order[-1]], np.arange(len(self.groups) * 256 + 1)))

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each shingle that an item has, else -1."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.screen[hashes >> np.uint64(64 - _SCREEN_BITS)])
        at = np.minimum(np.searchsorted(self.known, hashes[maybe]), len(self.known) - 1)
        found = self.known[at] == hashes[maybe]
        out[maybe[found]] = at[found]
        return out

    def near(self, prints: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of a window and an item of its size within RADIUS, by window."""
        base = np.searchsorted(self.groups, sizes) * 256
        pairs = []
        for block in range(BLOCKS):
            values = (prints[:, block].astype(np.int64)[:, None] ^ _NEIGHBOURS) + base[:, None]
            begin = self.starts[block][values].ravel()
            count = self.starts[block][values + 1].ravel() - begin
            which, place = _ranges(begin, count)
            pairs.append((which // len(_NEIGHBOURS)) * len(self.ids) + self.order[block][place])
        both = np.unique(np.concatenate(pairs))
        window, item = both // len(self.ids), both % len(self.ids)
        distance = np.bitwise_count(prints[window] ^ self.prints[item]).sum(axis=1)
        close = distance <= RADIUS
        return window[close], item[close]

    def similarity(self, item: int, shingles: list[int]) -> float:
        """The share of the item's shingle weight that a window has."""
        bag, seen = self.bags[item], Counter(shingles)
        return sum(w * min(c, seen[s]) for s, (c, w) in bag.items() if s in seen) / self.totals[item]

    def leaks(self, texts: pa.Array) -> list[tuple[int, int, float, int]]:
        """(text, item, similarity, first term) of the best window of each text and leaked item."""
        if not self.ids:
            return []
        terms, at = term_hashes(texts)
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for length in self.lengths:
            if len(terms) < length:
                continue
            hashes = shingle_hashes(terms, length)
            numbers = self.lookup(hashes)
            hits = np.flatnonzero(numbers >= 0)
            text = np.searchsorted(at, hits, side="right") - 1
            inside = hits + length <= at[text + 1]
            hits, text = hits[inside], text[inside]
            which, place = _ranges(self.size_at[numbers[hits]], np.diff(self.size_at)[numbers[hits]])
            size, hit, text = self.size_of[place], hits[which], text[which]
            fits = np.minimum(size, SHINGLE_WORDS) == length
            size, hit, text = size[fits], hit[fits], text[fits]
            # Every window of that size, inside the text, that holds the shingle.
            low = np.maximum(at[text], hit - size + length)
            high = np.maximum(np.minimum(hit, at[text + 1] - size), low)
            which, start = _ranges(low, high - low + 1)
            if not len(which):
                continue
            windows = np.unique(np.stack([text[which], start, size[which]]), axis=1)
            for key, found in self._windows(windows, hashes, at, length):
                best[key] = max(best.get(key, found), found, key=lambda f: (f[0], -f[1]))
        return [
            (text, item, share, start - int(at[text]))
            for (text, item), (share, start) in sorted(best.items())
        ]

    def _windows(
        self, windows: np.ndarray, hashes: np.ndarray, at: np.ndarray, length: int
    ) -> Iterator[tuple[tuple[int, int], tuple[float, int]]]:
        text, start, size = windows
        stop = np.minimum(start + size, at[text + 1]) - length + 1
        # Only shingles that lie in some window get their bits summed.
        change = np.zeros(len(hashes) + 2, np.int64)
        np.add.at(change, start, 1)
        np.add.at(change, stop, -1)
        used = np.flatnonzero(np.cumsum(change[:-1]) > 0)
        number = self.lookup(hashes[used])
        # What no item has tells items apart no more than silence, so it does not weigh in the fingerprint.
        weights = np.where(number >= 0, self.weights[np.maximum(number, 0)], 0.0)
        sums = _sign_sums(hashes[used], weights)
        begin = np.searchsorted(used, start)
        prints = _fingerprints(sums[begin + stop - start] - sums[begin])
        for window, item in zip(*(x.tolist() for x in self.near(prints, size))):
            share = self.similarity(item, hashes[start[window] : stop[window]].tolist())
            if share >= SIMILARITY:
                yield (int(text[window]), item), (share, int(start[window]))


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each item's shingles, each once, with the item's block."""
    for batch in batches:
        for start, texts in text_slices(batch.column("text")):
            terms, at = term_hashes(texts)
            bags = [
                np.unique(shingle_hashes(terms[low:high], SHINGLE_WORDS)).view(np.int64)
                for low, high in zip(at[:-1], at[1:])
            ]
            rows = np.repeat(np.arange(start, start + len(bags)), [len(bag) for bag in bags])
            shingles = np.concatenate([np.zeros(0, np.int64), *bags])
            columns = [batch.column("block").take(pa.array(rows, pa.int64())), pa.array(shingles)]
            yield pa.RecordBatch.from_arrays(columns, ["block", "shingle"])


def _indexes(benchmark: DataFrame, item_id: str, text: str, limit: int) -> Iterator[ItemIndex]:
    items = benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("text"))
    blocks = max(1, -(-items.count() // limit))
    block_of = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    shared = None
    if blocks > 1:
        # Counted over all items, so that a weight does not depend on the blocks.
        space = scratch(benchmark.sparkSession, "leaks")
        shingles = items.select(block_of.cast("long").alias("block"), "text")
        shingles = space.keep(shingles.mapInArrow(_item_shingles, "block long, shingle long"), "shingles")
        counts = space.keep(shingles.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"), "counts")
        shared = shingles.distinct().join(counts, "shingle")
    for block in range(blocks):
        rows = items.where(block_of == block).collect()
        counts = None
        if shared is not None:
            own = shared.where(F.col("block") == block).select("shingle", "n").toArrow()
            counts = dict(zip(own["shingle"].to_numpy().view(np.uint64).tolist(), own["n"].to_pylist()))
        yield ItemIndex([row["id"] for row in rows], [row["text"] for row in rows], counts)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    items_per_block: int = ITEMS_PER_BLOCK,
) -> DataFrame:
    """One row per text and item found in it: doc_id, item_id, similarity, first_term.

    ``first_term`` is the term (from 0) at which the best window begins, the first of equals.
    Null and empty texts and items match nothing. An item of under five terms is one shingle; a
    text shorter than an item is one window. Repeated rows give repeated rows; null ids are
    carried. Empty tables give empty results. Other columns are not read.
    """
    fields = [
        T.StructField("doc_id", docs.schema[doc_id].dataType),
        T.StructField("item_id", benchmark.schema[item_id].dataType),
        T.StructField("similarity", T.DoubleType()),
        T.StructField("first_term", T.LongType()),
    ]
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    item_type = pa.int64() if isinstance(fields[1].dataType, T.LongType) else None

    def passes(index: ItemIndex):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, texts in text_slices(batch.column("text")):
                    found = index.leaks(texts)
                    rows = pa.array([start + leak[0] for leak in found], pa.int64())
                    columns = [
                        batch.column("doc_id").take(rows),
                        pa.array([index.ids[leak[1]] for leak in found], item_type),
                        pa.array([leak[2] for leak in found], pa.float64()),
                        pa.array([leak[3] for leak in found], pa.int64()),
                    ]
                    if found:
                        yield pa.RecordBatch.from_arrays(columns, [field.name for field in fields])

        return run

    out = None
    for index in _indexes(benchmark, item_id, item_text, items_per_block):
        part = read.mapInArrow(passes(index), T.StructType(fields))
        out = part if out is None else out.union(part)
    return out


def drop_leaked(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    items_per_block: int = ITEMS_PER_BLOCK,
) -> DataFrame:
    """The rows whose text holds no item, all columns; see ``find_leaks``. Nothing is shuffled."""
    place = docs.columns.index(text)

    def passes(index: ItemIndex):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, texts in text_slices(batch.column(place)):
                    clean = np.ones(len(texts), bool)
                    clean[[leak[0] for leak in index.leaks(texts)]] = False
                    yield batch.slice(start, len(texts)).filter(pa.array(clean))

        return run

    out = docs
    for index in _indexes(benchmark, item_id, item_text, items_per_block):
        out = out.mapInArrow(passes(index), docs.schema)
    return out
