"""Open pairs are tested in tiles: rows grow with the texts of a tile, links with its groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from quaymill.llm import near_dedup


def _hashes(rng: np.random.Generator, n: int) -> np.ndarray:
    return rng.integers(0, 1 << 63, n, np.uint64) << np.uint64(1)


def _blocks(texts: list[np.ndarray], buckets: list[list[int]]) -> list[pa.RecordBatch]:
    found = sorted({bucket for own in buckets for bucket in own})
    rows = [
        (bucket, 0, n, n, len(text), True, True, near_dedup.term_counts(text).tobytes(), own)
        for bucket in found
        for n, (text, own) in enumerate(zip(texts, buckets))
        if bucket in own
    ]
    names = ["bucket", "part", "tid", "class", "n_terms", "asks", "home", "counts", "buckets"]
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, *[pa.bool_()] * 2, pa.binary(), pa.list_(pa.int64())]
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
    return pa.Table.from_arrays(columns, names).to_batches(max_chunksize=70)


def test_a_group_of_pairs_leaves_its_block_once_per_text_of_a_tile(monkeypatch):
    rng = np.random.default_rng(5)
    shared, n = _hashes(rng, 170), 150
    texts = [np.concatenate([shared, _hashes(rng, 30)]) for _ in range(n)]
    buckets = [[1, 2, 3] if text % 3 else [2, 3] for text in range(n)]
    for most, tiles in ((1 << 20, 2), (1000, None)):
        monkeypatch.setattr(near_dedup, "TILE_PAIRS", most)
        found = [row for out in near_dedup._block_tiles(iter(_blocks(texts, buckets))) for row in out.to_pylist()]
        pairs = sorted((row["tid"], other) for row in found for other in row["partners"])
        assert pairs == [(a, b) for a in range(n) for b in range(a + 1, n)]
        members = [(row["tile"], row["tid"]) for row in found]
        assert len(set(members)) == len(members) < len(pairs) / 4
        assert tiles is None or len({tile for tile, _ in members}) == tiles
        for row in found:
            assert {(row["tile"], other) for other in row["partners"]} <= set(members)


def test_a_tile_returns_links_that_join_what_all_links_join():
    rng = np.random.default_rng(6)
    base = _hashes(rng, 12)
    texts = {}
    for n in range(60):
        text = base[: int(rng.integers(5, 13))].copy()
        text[rng.integers(0, len(text), n % 3)] = 1
        texts[n] = text
    texts |= {60: base[:1], 61: base[:1].repeat(2), 62: np.zeros(0, np.uint64), 63: base[:1].copy()}
    pairs = [(a, b) for a in texts for b in texts if a < b]
    linked = [p for p in pairs if near_dedup.alignment_similarity(texts[p[0]], texts[p[1]], near_dedup.SIMILARITY) is not None]

    def groups(links: list[tuple[int, int]]) -> list[int]:
        least = list(range(len(texts)))
        for _ in texts:
            for a, b in links:
                least[a] = least[b] = min(least[a], least[b])
        return least

    found = list(near_dedup.tile_links(texts, iter(pairs)))
    assert set(found) <= set(linked)
    assert groups(found) == groups(linked)
    assert len(found) == len(texts) - len(set(groups(linked))) < len(linked)
