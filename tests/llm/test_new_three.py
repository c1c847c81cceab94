"""Resampling, exact copies and the prefix trie against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from quaymill.llm import exact_copies, importance, prefix_trie

# --- importance resampling -------------------------------------------------------------------

_WORDS = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _features(text: str | None, longest: int) -> list[bytes]:
    lowered = re.sub("[A-Z]", lambda found: found[0].lower(), text or "")
    words = _WORDS.findall(lowered.encode())
    return [b" ".join(words[at : at + n]) for n in range(1, longest + 1) for at in range(len(words) - n + 1)]


def _drawn(docs, target, percent, least_words, buckets, longest, seed=2024):
    """doc_id, n_features, weight, score and rank of every row, by plain loops."""
    counts = [Counter(), Counter()]
    for side, texts in enumerate(([text for _, text in docs], target)):
        for text in texts:
            counts[side].update(zlib.crc32(f) % buckets for f in _features(text, longest))
    s_all, t_all = (sum(c.values()) + buckets for c in counts)
    rows = []
    for place, (doc_id, text) in enumerate(docs):
        found = _features(text, longest)
        weight = 0
        for feature in found:
            bucket = zlib.crc32(feature) % buckets
            gain = (counts[1][bucket] + 1) * float(s_all) / ((counts[0][bucket] + 1) * float(t_all))
            weight += math.floor(1000 * math.log(gain))
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, len(_features(text, 1)), place])
    able = [row for row in rows if row[5] >= least_words]
    able.sort(key=lambda row: (-row[3], row[0] is None, row[0] or 0, row[1]))
    for rank, row in enumerate(able[: len(able) * percent // 100], 1):
        row[4] = rank
    return Counter(tuple(row[:5]) for row in rows)


def _texts(count: int) -> list[tuple[int | None, str | None]]:
    rng = np.random.default_rng(3)
    words = ["Übung", "the", "OF", "Wörter", "x1", "2024", "naïve", "a" * 90, "b" * 300, "—", "don't"]
    docs = [(n, " ".join(rng.choice(words, rng.integers(0, 40)))) for n in range(count)]
    docs += [(7, docs[7][1])] * 3 + [(None, "the of " * 15), (None, None), (900, ""), (901, None), (902, "the " * 30)]
    return docs


@pytest.mark.parametrize(("percent", "least_words", "buckets", "longest"), [(10, 20, 10_000, 1), (60, 0, 7, 1), (100, 3, 50, 3)])
def test_resampling_equals_plain_loops(spark, percent, least_words, buckets, longest):
    docs = _texts(150)
    target = ["the Übung of x1", "naïve the the", None, ""]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    goal = spark.createDataFrame([(text,) for text in target], "text string")
    got = importance.resample(
        frame, goal, percent=percent, least_words=least_words, buckets=buckets, longest=longest
    ).collect()
    assert Counter(map(tuple, got)) == _drawn(docs, target, percent, least_words, buckets, longest)


def test_resampling_of_nothing_and_clashing_names(spark):
    goal = spark.createDataFrame([("the of",)], "text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resample(none, goal).collect() == []
    docs = spark.createDataFrame([(1, "the " * 30, 5, "x")], "doc_id long, text string, rank int, Score string")
    out = importance.resample(docs, goal.limit(0), percent=100)
    assert out.columns == ["doc_id", "rank", "Score", "n_features", "weight", "score_", "rank_"]
    assert out.first()["rank_"] == 1 and out.first()["rank"] == 5


@given(st.lists(st.binary(max_size=90), max_size=20), st.binary(max_size=5))
@settings(max_examples=60, deadline=None)
def test_crcs_continue(parts, before):
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(part) for part in parts], dtype=np.int64) if parts else np.zeros(0, np.int64)
    starts = ends - np.array([len(part) for part in parts], np.int64)
    first = np.full(len(parts), zlib.crc32(before), np.uint32)
    want = [zlib.crc32(part, zlib.crc32(before)) for part in parts]
    assert importance.run_crcs(data, starts, ends, first).tolist() == want


@pytest.mark.parametrize("pivots", [1, 2, 15])
def test_quickselect_finds_every_place(spark, pivots):
    values = [3, 1, 1, 1, 2, 9, 9, -4, None, 3]
    rows = [((value, place), place) for place, value in enumerate(values)]
    frame = spark.createDataFrame(rows, "key struct<value:int, place:int>, place int").cache()
    order = sorted((value is not None, value or 0, place) for place, value in enumerate(values))
    for k in range(1, len(values) + 1, 3):
        assert importance.kth_key(frame, "key", "place", k, pivots)["place"] == order[k - 1][2]
    assert importance.kth_key(frame, "key", "place", len(values) + 1, pivots) is None


# --- exact copies ----------------------------------------------------------------------------


def _copies(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[text or ""].append(doc_id)
    out = Counter()
    for ids in groups.values():
        best = max((i for i in ids if i is not None), default=None)
        out.update((i, best, len(ids), False) for i in ids)
        out[(best, best, len(ids), False)] -= 1
        out[(best, best, len(ids), True)] += 1
    return +out


def _copied_texts():
    head = "h" * exact_copies.HEAD_CHARS
    texts = ["", None, "a", "b", "ab", "ba", head + "x", head + "y", head + "xy", "é", "é", "a ", " a", "a"]
    docs = [(n, text) for n, text in enumerate(texts)] + [(40 + n, f"unique {n}" * n) for n in range(20)]
    docs += [(100 + n, head + "x") for n in range(300)] + [(399, head + "x"), (None, "b"), (None, "ü"), (None, "ü")]
    return docs + [(500, "long " * 40_000), (501, "long " * 40_000), (502, "long " * 39_999 + "lonG ")]


@pytest.mark.parametrize("words", [1, 1 << 16])
def test_copies_equal_plain_groups(spark, words):
    docs = _copied_texts()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = exact_copies.find_copies(frame, filter_words=words).collect()
    assert Counter(map(tuple, got)) == _copies(docs)


def test_dropping_keeps_one_row_of_each_text(spark):
    docs = [(doc_id, text, n) for n, (doc_id, text) in enumerate(_copied_texts())]
    frame = spark.createDataFrame(docs, "doc_id long, text string, suspect int").repartition(4)
    kept = exact_copies.drop_copies(frame)
    assert kept.columns == frame.columns
    rows = kept.collect()
    want = Counter((row[0], row[1]) for row in _kept_texts())
    assert Counter((row["doc_id"], row["text"] or "") for row in rows) == want
    again = exact_copies.drop_copies(frame.repartition(2)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def _kept_texts():
    best: dict[str, int | None] = {}
    for doc_id, text in _copied_texts():
        here = best.get(text or "")
        best[text or ""] = doc_id if here is None else max(here, doc_id) if doc_id is not None else here
    return [(doc_id, text) for text, doc_id in best.items()]


def test_copies_of_nothing_and_clashing_names(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert exact_copies.find_copies(none).collect() == []
    assert exact_copies.drop_copies(none).collect() == []
    docs = spark.createDataFrame([(1, "a", 3), (2, "a", 4)], "doc_id long, text string, Kept int")
    out = exact_copies.find_copies(docs)
    assert out.columns == ["doc_id", "Kept", "keep_id", "group_size", "kept_"]
    assert Counter(map(tuple, out.collect())) == Counter([(1, 3, 2, 2, False), (2, 4, 2, 2, True)])


def test_unsuspected_texts_are_not_hashed_whole(spark):
    docs = spark.createDataFrame([(n, "x" * n) for n in range(50)] + [(90, "xx")], "doc_id long, text string")
    space = exact_copies.scratch(spark, "test")
    known = exact_copies._suspects(docs, "text", 1 << 16, space)
    assert sum(bin(row["bits"] & (2**64 - 1)).count("1") for row in known.collect()) == 1
    plan = exact_copies.find_copies(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- prefix trie -----------------------------------------------------------------------------


def _rebuild(rows, group, folds):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv_id: [(r, t) for _, _, r, t in sorted(found)] for conv_id, found in turns.items()}
    out = {}
    for conv_id, mine in own.items():
        h = 0 if conv_id is None else zlib.crc32(str(conv_id).encode()) % folds
        out[conv_id] = (own.get(conv_id - conv_id % group, [])[:h] if h else []) + mine[h:]
    return out


def _nodes(paths: dict[int | None, list[tuple[str, str]]]):
    members = defaultdict(list)
    for conv_id, path in paths.items():
        for depth in range(len(path) + 1):
            members[tuple(path[:depth])].append(conv_id)

    def least(node):
        return min((c for c in members[node] if c is not None), default=None)

    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node in members:
        cost = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        for depth in range(len(node) + 1):
            saved[node[:depth]] += cost
            leaves[node[:depth]] += node not in children
    out = Counter()
    for node in members:
        ends = sorted(c for c in members[node] if c is not None and tuple(paths[c]) == node)
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        above = least(node[:-1]) if node else None
        row = (least(node), len(node), above, len(members[node]), children[node], leaves[node], saved[node], digest)
        out[row] += 1
    return out


def _trie(spark, rows, group=100, folds=6):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    lists = prefix_trie.turn_lists(frame)
    built = prefix_trie.build_trie(prefix_trie.share_openings(lists, group, folds)).drop("name")
    assert built.columns == "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return Counter(map(tuple, built.collect()))


def test_trie_equals_plain_prefixes(spark):
    rng = np.random.default_rng(5)
    rows = []
    for conv_id in range(180):
        for turn in range(int(rng.integers(1, 12))):
            # Few choices, so that paths share much, end inside edges and repeat.
            rows.append((conv_id, turn, ["user", "assistant", None][turn % 3], ["a", "bé", "", None][int(rng.integers(0, 2 + (turn > 6) * 2))]))
    rows += [(200, None, "user", "first"), (200, 3, "user", "second"), (200, None, "user", "also first")]
    rows += [(300 + n, turn, "user", f"t{turn}") for n in range(25) for turn in range(n + 1)]
    rows += [(None, 0, "user", "x"), (None, 1, "user", "y"), (1200, 0, "user", "z"), (1201, 0, "user", "z")]
    assert _trie(spark, rows) == _nodes(_rebuild(rows, 100, 6))


def test_trie_of_one_long_path_and_its_beginnings(spark):
    # A spine that a conversation leaves at every depth, and one that is all of it.
    rows = []
    for conv_id in range(1, 40):
        rows += [(100 * conv_id, turn, "user", f"s{turn}") for turn in range(conv_id)]
        rows += [(100 * conv_id, 99, "user", f"own {conv_id}")] * (conv_id % 3)
    rows += [(90_000, turn, "user", f"s{turn}") for turn in range(300)]
    assert _trie(spark, rows, folds=1) == _nodes(_rebuild(rows, 100, 1))


def test_trie_of_nothing_of_equal_and_of_turnless_conversations(spark):
    assert not _trie(spark, [])
    same = [(conv_id, turn, "user", "x" * turn) for conv_id in range(50) for turn in range(4)]
    assert _trie(spark, same, folds=1) == _nodes(_rebuild(same, 100, 1))
    # Conversation 1 has fewer turns than it takes from an absent opener: it has none left.
    bare = [(conv_id, 0, "user", "x") for conv_id in range(101, 131)]
    want = _rebuild(bare, 100, 6)
    assert any(not path for path in want.values())
    assert _trie(spark, bare) == _nodes(want)


def test_two_fattest(spark):
    frame = spark.range(40).selectExpr("cast(id as int) AS low").crossJoin(spark.range(1, 40).selectExpr("cast(id as int) AS d"))
    from pyspark.sql import functions as F

    rows = frame.select("low", (F.col("low") + F.col("d")).alias("high")).withColumn(
        "f", prefix_trie.two_fattest(F.col("low"), F.col("high"))
    )
    for low, high, found in rows.collect():
        assert found == max(range(low + 1, high + 1), key=lambda n: n & -n)


def test_chained_names_tell_prefixes_apart():
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3]), pa.array([[b"a", b"b"], [b"a"], []], pa.list_(pa.binary())), pa.array([[1, 2], [1], []], pa.list_(pa.int64()))],
        ["conv_id", "names", "chars"],
    )
    (out,) = prefix_trie._chain(iter([batch]))
    paths, sums = out.column("path").to_pylist(), out.column("sums").to_pylist()
    assert paths[0][0] == paths[1][0] != paths[0][1] and paths[2] == []
    assert sums == [[1, 3], [1], []]
