"""Near copies, components, leaks and learned scores against brute force and held-out labels."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quaymill.llm import decontaminate, near_dedup, quality_net, toxicity
from quaymill.llm.common import scratch, table, term_hashes
from quaymill.llm.components import components

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _distance(a: list, b: list) -> int:
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


def test_banded_distance_equals_the_full_table():
    rng = random.Random(5)
    for _ in range(1500):
        a = [rng.randint(0, 3) for _ in range(rng.randint(0, 14))]
        b = [x if rng.random() < 0.8 else 9 for x in a][: rng.randint(0, 14)] + [rng.randint(0, 3)] * rng.randint(0, 2)
        full = _distance(a, b)
        for most in (0, 1, 2, 4, 9, 20):
            assert near_dedup.banded_distance(a, b, most) == (full if full <= most else None)


def _near_rows() -> list[tuple]:
    rng = random.Random(1)
    vocabulary = [f"w{n}" for n in range(3000)]
    rows: list[tuple] = []
    passage = rng.choices(vocabulary, k=60)
    for group in range(12):
        words = rng.choices(vocabulary, k=rng.choice([12, 40, 55, 150, 600]))
        for copy in range(rng.randint(1, 5)):
            changed = [w if rng.random() > 0.03 else rng.choice(vocabulary) for w in words]
            rows.append((len(rows), " ".join(changed if copy else words), "en", "s", group))
    for _ in range(30):
        rows.append((len(rows), " ".join(passage + rng.choices(vocabulary, k=90)), "en", "s", None))
    rows += [(900, None, None, None, None), (901, "", "en", "s", 0), (None, " \n", "en", "s", 0)]
    rows += [rows[0], rows[0], (None, rows[1][1], "en", "s", 0), (902, "... !!!", "en", "s", 0)]
    return rows


def _brute_classes(rows: list[tuple]) -> list[int]:
    texts = [row[1] or "" for row in rows]
    hashes, at = term_hashes(pa.array(texts))
    terms = [hashes[at[n] : at[n + 1]].tolist() for n in range(len(texts))]
    parent = list(range(len(rows)))

    def find(n: int) -> int:
        while parent[n] != n:
            n = parent[n]
        return n

    for i in range(len(rows)):
        for j in range(i):
            longer = max(len(terms[i]), len(terms[j]))
            most = int(0.2 * longer + 1e-9)
            same = texts[i] == texts[j]
            if same or (longer and abs(len(terms[i]) - len(terms[j])) <= most and find(i) != find(j)):
                if same or near_dedup.banded_distance(terms[i], terms[j], most) is not None:
                    parent[find(i)] = find(j)
    return [find(n) for n in range(len(rows))]


def test_near_copies_equal_a_comparison_of_all_pairs(spark):
    rows = _near_rows()
    frame = spark.createDataFrame(rows, DOCS).withColumn("text_key", F.lit("mine")).repartition(5)
    brute = _brute_classes(rows)
    members: dict[int, list] = {}
    for row, name in zip(rows, brute):
        members.setdefault(name, []).append(row[0])
    want = sorted(
        (
            (row[0], min((m for m in members[name] if m is not None), default=None), len(members[name]))
            for row, name in zip(rows, brute)
        ),
        key=repr,
    )
    got = sorted((tuple(row) for row in near_dedup.near_duplicates(frame).collect()), key=repr)
    assert got == want
    kept = near_dedup.drop_near_duplicates(frame).collect()
    assert len(kept) == len(members)
    assert sorted((row["doc_id"] for row in kept), key=repr) == sorted(
        (min((m for m in ids if m is not None), default=None) for ids in members.values()), key=repr
    )
    assert near_dedup.near_duplicates(frame.limit(0)).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 130)] + [(7, 7), (None, 3), (129, 200)]
    found = components(spark.createDataFrame(edges, "a long, b long"), scratch(spark, "test"))
    got = {row["u"]: row["v"] for row in found.collect()}
    assert got == {n: 0 for n in range(1, 41)} | {n: 100 for n in [*range(101, 130), 200]}


def test_leaks_equal_a_search_of_all_windows(spark):
    rng = random.Random(3)
    vocabulary = [f"w{n}" for n in range(500)]
    items = [(n, " ".join(rng.choices(vocabulary, k=size))) for n, size in enumerate([3, 5, 14, 36, 36, 59])]
    items += [(50, None), (51, ""), (None, items[3][1] + " extra words here")]
    docs = [(n, " ".join(rng.choices(vocabulary, k=200)), None, None, n) for n in range(40)]
    for number, (item, text) in enumerate(items[:6]):
        words = text.upper().split()
        docs.append((100 + number, " ".join(rng.choices(vocabulary, k=50) + words + ["end"]), "en", "s", 0))
        words[0] = "changed"
        docs.append((200 + number, "start, " + ", ".join(words), "en", "s", 0))
    docs += [(300, None, None, None, None), (301, "", "en", "s", 0), docs[-1]]
    frame, benchmark = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")

    def share(item: str, text: str) -> float:
        index = decontaminate.ItemIndex([0] * len(items), [i[1] for i in items])
        place = [i[1] for i in items if i[1]].index(item)
        terms, _ = term_hashes(pa.array([text]))
        size = int(index.sizes[place])
        length = min(size, 5)
        runs = decontaminate.shingle_hashes(terms, length) if len(terms) >= length else terms[:0]
        last = max(len(runs) - (size - length), 1)
        return max(index.similarity(place, runs[s : s + size - length + 1].tolist()) for s in range(last))

    want = sorted(
        ((d[0], i[0]) for d in docs for i in items if d[1] and i[1] and share(i[1], d[1]) >= 0.8), key=repr
    )
    for block in (50_000, 2):
        got = decontaminate.find_leaks(frame, benchmark, items_per_block=block).collect()
        assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=repr) == want
    clean = {row["doc_id"] for row in decontaminate.drop_leaked(frame, benchmark).collect()}
    assert clean == {d[0] for d in docs} - {w[0] for w in want}
    assert decontaminate.find_leaks(frame, benchmark.limit(0)).collect() == []


@pytest.mark.parametrize("score", [toxicity.score_toxicity, quality_net.score_quality])
def test_scores_of_every_row(spark, score):
    label = "toxic" if score is toxicity.score_toxicity else "quality"
    insult = " you are a zzidiot and a zzscum"
    docs = [(n, "plain words of a text here. " * 5 + (insult if n % 2 else ""), "en", "s", n) for n in range(60)]
    if label == "quality":
        docs = [(n, ("&&& $$$ " * 40) if n % 2 else "plain words of a text. " * 12, "en", "s", n) for n in range(60)]
    docs += [(60, None, None, None, None), (None, "", None, None, None), docs[0]]
    labels = [(n, 1 - n % 2, n % 2) for n in range(60)] + [(None, 1, 1), (999, 0, 0), (5, None, None)]
    frame = spark.createDataFrame(docs, DOCS).withColumn("label", F.lit("mine"))
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = score(frame, known).collect()
    assert len(got) == len(docs) and all(0 <= row["score"] <= 1 for row in got)
    held = [row for row in got if row["held_out"] and row["doc_id"] is not None and row["doc_id"] < 60]
    wanted = [row["doc_id"] % 2 if label == "toxic" else 1 - row["doc_id"] % 2 for row in held]
    assert held and np.mean([row["predicted"] == want for row, want in zip(held, wanted)]) > 0.9
    assert score(frame.limit(0), known).collect() == []
    assert len(score(frame, known.limit(0)).collect()) == len(docs)
