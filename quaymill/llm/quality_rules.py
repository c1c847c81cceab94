"""Quality rules: repetition inside a text from its suffix array, next to simple counts.

The words of a text are sorted as suffixes by prefix doubling; only suffixes that still tie are
sorted again, so texts that repeat little cost about one sort. Longest common prefixes of
neighbours come from the ranks of the doubling. A position whose longest repeat has at least
``min_words`` words starts an occurrence of a maximal repeated substring; the union of those
occurrences is what is covered by repeats.

Null and empty texts have no words and fail. Every row is judged by itself, so repeated rows,
ties and null ids change nothing; an empty table gives an empty table. Other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from quaymill.llm.common import (
    NOT_SPACE,
    append_columns,
    own_column,
    per_text,
    raw_bytes,
    run_hashes,
    word_runs,
)

SYMBOLS = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
LINE = np.arange(256) != 0x0A

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
# The method's own verdict, on repeats of MIN_REPEAT words and more.
MIN_REPEAT = 5
MAX_COVERED_PERCENT = 40
MAX_LONGEST = 100

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
METHOD = ("covered_words", "longest_repeat")
FIELDS = [T.StructField(name, T.LongType()) for name in (*COUNTS, *METHOD)]


def longest_repeats(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each word, how many words from it on occur elsewhere in its text, by a suffix array.

    ``words`` holds the hashes of all texts, ``text`` the text of each word, ascending.
    """
    count = len(words)
    if count == 0:
        return np.zeros(0, np.int64)
    order = np.lexsort((words, text))
    same = (words[order][1:] == words[order][:-1]) & (text[order][1:] == text[order][:-1])
    rank = np.empty(count + 1, np.int64)
    rank[order] = _heads(same)
    # The end of everything; ends of texts need none, as ranks of two texts never agree.
    rank[count] = -1
    levels = [rank.copy()]
    tied = _tied(same)
    last = np.searchsorted(text, text, side="right")
    step = 1
    while tied.any():
        # Suffixes in tied groups are sorted by what follows; a text's end sorts first.
        places = np.flatnonzero(tied)
        suffix = order[places]
        follow = suffix + step
        follow = np.where(follow < last[suffix], rank[np.minimum(follow, count)], -1 - suffix)
        again = np.lexsort((follow, rank[suffix]))
        suffix, follow = suffix[again], follow[again]
        order[places] = suffix
        group = rank[suffix]
        equal = (group[1:] == group[:-1]) & (follow[1:] == follow[:-1])
        rank[suffix] = places[_heads(equal)]
        tied = np.zeros(count, bool)
        tied[places] = _tied(equal)
        step *= 2
        levels.append(rank.copy())
    # Binary lifting over the levels gives the common prefix of neighbours in the suffix array.
    left, right = order[:-1].copy(), order[1:].copy()
    near = levels[0][left] == levels[0][right]
    left, right, at = left[near], right[near], np.flatnonzero(near)
    common = np.zeros(len(at), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        ranks, size = levels[level], 1 << level
        while True:
            inside = (left < count) & (right < count)
            equal = inside & (ranks[np.minimum(left, count)] == ranks[np.minimum(right, count)])
            if not equal.any():
                break
            common[equal] += size
            left[equal] += size
            right[equal] += size
            if size < 1 << (len(levels) - 1):
                break
    prefix = np.zeros(count + 1, np.int64)
    prefix[at + 1] = common
    longest = np.empty(count, np.int64)
    longest[order] = np.maximum(prefix[:-1], prefix[1:])
    return longest


def _heads(same: np.ndarray) -> np.ndarray:
    """For each place of a sorted list, the first place of its run of equals."""
    first = np.concatenate([[True], ~same])
    return np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))


def _tied(same: np.ndarray) -> np.ndarray:
    tied = np.zeros(len(same) + 1, bool)
    tied[1:] = same
    tied[:-1] |= same
    return tied


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeat of at least ``least`` words."""
    change = np.zeros(len(longest) + 1, np.int64)
    starts = np.flatnonzero(longest >= least)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + longest[starts], -1)
    return np.cumsum(change[:-1]) > 0


def measure(texts: pa.Array) -> dict[str, object]:
    """The counts and the repeats of each text."""
    data, at = raw_bytes(texts)
    starts, ends = word_runs(data, at, NOT_SPACE)
    word_at = np.searchsorted(starts, at)
    lengths = np.diff(word_at)
    text = np.repeat(np.arange(len(texts)), lengths)
    longest = longest_repeats(run_hashes(data, starts, ends), text)
    begins = (data & 0xC0) != 0x80

    lines, line_ends = word_runs(data, at, LINE)
    solid = np.concatenate([[0], np.cumsum(NOT_SPACE[data])])
    full = solid[line_ends] > solid[lines]
    lines, line_ends = lines[full], line_ends[full]
    of = np.searchsorted(at, lines, side="right") - 1
    keys = np.unique(np.stack([of.astype(np.uint64), run_hashes(data, lines, line_ends)]), axis=1)
    distinct = np.bincount(keys[0].astype(np.int64), minlength=len(texts))

    most = np.zeros(len(texts), np.int64)
    np.maximum.at(most, text, longest)
    return {
        "n_words": lengths,
        "word_chars": per_text(begins & NOT_SPACE[data], at),
        "n_symbols": per_text(SYMBOLS[data], at),
        "n_dup_lines": np.bincount(of, minlength=len(texts)) - distinct,
        "n_repeat_words": per_text(covered(longest, WINDOW), word_at),
        "covered_words": per_text(covered(longest, MIN_REPEAT), word_at),
        "longest_repeat": most,
    }


def judge_quality(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append the counts, ``base_failed`` and, last, ``kept``; names that are taken get a trailing
    underscore.

    The base fails texts under MIN_WORDS words or with over MAX_REPEAT_PERCENT % of their words in
    repeated windows of WINDOW words. The method also rejects texts of which repeats of
    MIN_REPEAT words and more cover over MAX_COVERED_PERCENT %, or whose longest repeat has over
    MAX_LONGEST words.
    """
    kept_names = docs.select(*(docs.columns if keep is None else keep))
    name = {n: own_column(kept_names, n) for n in (*COUNTS, *METHOD, "base_failed", "kept")}
    fields = [T.StructField(name[field.name], field.dataType) for field in FIELDS]

    def found(texts: pa.Array) -> dict[str, object]:
        return {name[key]: values for key, values in measure(texts).items()}

    counted = append_columns(docs, text, fields, found, keep)
    n_words, repeated = F.col(name["n_words"]), F.col(name["n_repeat_words"])
    failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n_words)
    kept = (
        ~failed
        & (100 * F.col(name["covered_words"]) <= MAX_COVERED_PERCENT * n_words)
        & (F.col(name["longest_repeat"]) <= MAX_LONGEST)
    )
    return counted.withColumns({name["base_failed"]: failed, name["kept"]: kept})
