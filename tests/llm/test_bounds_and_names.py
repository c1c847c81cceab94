"""Bounded samples, whole training texts, clashing names, templated leaks and open buckets."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quaymill.llm import decontaminate, near_dedup, pii, quality_net, toxicity
from quaymill.llm.common import shingle_hashes, term_hashes
from quaymill.llm.sampling import labelled_sample


def test_a_repeated_id_does_not_pass_the_bound(spark):
    docs = [(1, f"text {n}") for n in range(300)] + [(n, "other") for n in range(2, 40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(1, 40)], "doc_id long, quality int")
    parts = [frame.repartition(n) for n in (1, 5)]
    first, again = (labelled_sample(part, labels, "quality", F.lit(True), 25).collect() for part in parts)
    assert Counter(first) == Counter(again)
    assert max(Counter(row["label"] for row in first).values()) <= 25


@pytest.mark.parametrize("score", [toxicity.score_toxicity, quality_net.score_quality])
def test_scores_beside_columns_of_their_names(spark, score):
    docs = [(n, "&&& $$$ zzscum " * 9 if n % 2 else "plain words here " * 9, "s", True, 7) for n in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, Score string, held_out boolean, predicted int")
    labels = spark.createDataFrame([(n, 1 - n % 2, n % 2) for n in range(40)], "doc_id long, quality int, toxic int")
    out = score(frame, labels)
    assert out.columns == [*frame.columns, "held_out_", "score_", "predicted_"]
    rows = out.collect()
    assert {(row["Score"], row["held_out"], row["predicted"]) for row in rows} == {("s", True, 7)}
    assert {row["predicted_"] for row in rows} <= {0, 1} and len({row["held_out_"] for row in rows}) == 2


def test_gradients_of_groups_add_up_to_those_of_all_texts():
    rng = np.random.default_rng(2)
    texts = pa.array([bytes(rng.integers(32, 127, size)).decode() for size in (0, 5, 300, 9_000, 700_000, 40)])
    labels = np.array([0, 1, 0, 1, 1, 0], float)
    net = quality_net.QualityNet()
    rows, text = quality_net.blocks_of(texts)
    whole = net.gradients(rows, text, labels)
    parts = net._step_gradients(texts, labels, np.arange(len(labels)))
    for name, gradient in whole.items():
        assert np.allclose(gradient, parts[name], rtol=1e-4, atol=1e-6), name


def test_the_network_equals_a_convolution_byte_by_byte():
    net = quality_net.QualityNet()
    text = bytes(np.random.default_rng(7).integers(0, 128, 700)).decode()
    data = text.encode() + bytes(2 * quality_net.BLOCK)
    v, count = net.values, -(-len(text) // quality_net.BLOCK)

    def response(block: int) -> np.ndarray:
        best = np.full(quality_net.FILTERS, -np.inf)
        for start in range(block * quality_net.BLOCK, (block + 1) * quality_net.BLOCK, quality_net.STRIDE):
            window = [data[at] if at < len(text) else 0 for at in range(start, start + quality_net.WIDTH)]
            best = np.maximum(best, np.einsum("we,wek->k", v["embedding"][window], v["filters"]))
        return best

    blocks = [response(n) for n in range(count)]
    chunks = [np.maximum(one, blocks[min(n + 1, count - 1)]) for n, one in enumerate(blocks)]
    evidence = np.mean([np.maximum(chunk + v["bias"], 0) @ v["dense"] for chunk in chunks]) + v["shift"][0]
    assert np.isclose(net.scores(pa.array([text]))[0], 1 / (1 + np.exp(-evidence)), atol=1e-5)


@pytest.mark.parametrize("template", [100, 200, 300])
def test_leaks_without_the_template_that_items_share(template):
    rng = random.Random(template)
    shared = [f"t{n}" for n in range(template)]
    items = [" ".join(shared + [f"i{k}x{n}" for n in range(60)]) for k in range(200)]
    index = decontaminate.ItemIndex(list(range(200)), items)
    docs = [" ".join([f"d{rng.randrange(9**6)}" for _ in range(template)] + item.split()[template:]) for item in items]
    hashes, at = term_hashes(pa.array(docs))
    runs = [shingle_hashes(hashes[a:b], 5).tolist() for a, b in zip(at, at[1:])]
    due = [k for k in range(200) if index.similarity(k, runs[k]) >= decontaminate.SIMILARITY]
    found = {(text, item) for text, item, _, _ in index.leaks(pa.array(docs))}
    assert len(due) > 150
    assert sum((k, k) in found for k in due) >= 0.9 * len(due)


def test_context_words_are_whole_words(spark):
    texts = ["please tell 555-123-4567 units", "my telephone 555-123-4567", "tel. 555-123-4567"]
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    got = [row["text"] for row in pii.redact_pii(frame, n_chars=None).collect()]
    assert got == [texts[0], "my telephone [LOCAL_PHONE]", "tel. [LOCAL_PHONE]"]


def test_common_terms_are_never_underrated():
    rng = np.random.default_rng(4)
    for _ in range(200):
        vocabulary = rng.integers(0, 1 << 63, int(rng.integers(1, 400)), np.uint64) << np.uint64(1)
        a, b = (rng.choice(vocabulary, int(rng.integers(0, 700))) for _ in range(2))
        common = (Counter(a.tolist()) & Counter(b.tolist())).total()
        bound = near_dedup.most_common_terms(near_dedup.term_counts(a), near_dedup.term_counts(b)[None])[0]
        assert common <= bound
    full = np.zeros(near_dedup.FULL + 9, np.uint64)
    bound = near_dedup.most_common_terms(near_dedup.term_counts(full), near_dedup.term_counts(full[2:])[None])[0]
    assert bound >= near_dedup.FULL + 7


def _blocks(rows: list[tuple], size: int) -> set[tuple[int, int]]:
    names = ["bucket", "part", "tid", "class", "n_terms", "asks", "home", "counts", "buckets"]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.binary(), pa.list_(pa.int64())]
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
    table = pa.Table.from_arrays(columns, names).to_batches(max_chunksize=size)
    return {pair for out in near_dedup._block_pairs(iter(table)) for pair in zip(*(c.to_pylist() for c in out.columns))}


def test_long_texts_with_one_passage_leave_few_open_pairs():
    """Only pairs that can be linked leave a block, however the rows are cut into batches."""
    rng = np.random.default_rng(9)
    passage = rng.integers(0, 1 << 63, 300, np.uint64) << np.uint64(1)
    texts = [np.concatenate([passage, rng.integers(0, 1 << 63, 300, np.uint64) << np.uint64(1)]) for _ in range(400)]
    texts[399] = texts[0].copy()
    texts[399][::7] = 5
    rows = [(1, 0, n, n, 600, n > 0, True, near_dedup.term_counts(t).tobytes(), [1]) for n, t in enumerate(texts)]
    assert _blocks(rows, 1000) == _blocks(rows, 37) == {(0, 399)}
    twice = rows + [(2, 0, *row[2:8], [1, 2]) for row in rows]
    assert _blocks([(*row[:8], [1, 2]) for row in rows] + [(2, *row[1:8], [1, 2]) for row in twice[400:]], 90) == {(0, 399)}
