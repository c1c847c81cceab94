"""Links that only a settled bucket or a short run can show."""

from __future__ import annotations

import random

from quaymill.llm import near_dedup


def _classes(spark, texts: list[str]) -> list[int]:
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {row["doc_id"]: row["class_id"] for row in near_dedup.near_duplicates(docs).collect()}
    return [found[n] for n in range(len(texts))]


def _every(words: list[str], step: int, mark: str) -> list[str]:
    return [f"{mark}{n}" if n % step == step - 1 else word for n, word in enumerate(words)]


def test_a_link_hidden_in_a_hot_passage_of_equal_lengths_is_found(spark):
    rng = random.Random(3)
    passage = [f"p{n}" for n in range(60)]
    tail = [f"t{n}" for n in range(65)]
    texts = [" ".join(passage + [f"w{rng.randrange(9**9)}" for _ in tail]) for _ in range(150)]
    texts += [" ".join(passage + _every(tail, 3, mark)) for mark in "xy"]
    classes = _classes(spark, texts)
    assert classes[150:] == [150, 150]
    assert classes[:150] == list(range(150))


def test_a_link_among_pivots_of_other_lengths_is_found(spark):
    rng = random.Random(4)
    passage = [f"p{n}" for n in range(80)]

    def text(more: int) -> str:
        return " ".join(passage + [f"w{rng.randrange(9**9)}" for _ in range(more)])

    texts = [text(50) for _ in range(300)] + [text(20), text(20)]
    classes = _classes(spark, texts)
    assert classes[300:] == [300, 300]
    assert classes[:300] == list(range(300))


def test_isolated_long_pairs_between_080_and_085_meet(spark):
    texts = []
    for pair in range(60):
        words = [f"v{pair}x{n}" for n in range(180)]
        texts += [" ".join(words), " ".join(_every(words, 5 if pair < 20 else 6, f"e{pair}x"))]
    classes = _classes(spark, texts)
    met = [classes[2 * pair + 1] == 2 * pair for pair in range(60)]
    assert sum(met[:20]) >= 19 and all(met[20:])
