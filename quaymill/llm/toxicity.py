"""Toxicity by a weighted finite-state grammar over the clauses of a text.

Four transducers (``transducers.py``) each read what the last one writes, token by token:

* the lexicon turns a word into an insult, a threat verb, or a mark of the grammar (person, other person,
  negation, report, intent, quote, break). Insult words and word stems with their amounts are learned from
  labelled texts; the other classes are the closed lists below;
* reported speech marks what stands in quotes, over sentence ends too, or follows a verb of saying in its sentence;
* negation marks the rest of a clause after a negator;
* aim matches insult and target, intent, threat verb and target, or an insult alone, in either order: an insult
  or threat may be taken as aimed on credit, and a path that ends a sentence without the target is none.

The last three are arcs as data, composed once into one table. The best path through it decides which match each
insult or threat belongs to, and so the kind under which its amount counts. A text's score is a
logistic function of the sums by kind, fitted on the same labelled sample, so what a denied or reported
match is worth is learned as well.

Most texts have no insult or threat word at all, which a hash lookup over all of their words tells;
only sentences with such words of the others go through the table. Texts are read whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quaymill.llm.common import TERM, append_scores, fold, raw_bytes, run_hashes, scratch, text_slices, word_runs
from quaymill.llm.sampling import fit_logistic, labelled_sample
from quaymill.llm.transducers import OTHER, Arc, Transducer, best_path, compose

FOLDS, HELD_OUT = 5, 0
# Bound of the labelled rows that training may read.
SAMPLE_PER_CLASS = 5_000
STEM = 4
LEAST_TEXTS = 5
# A word weighs what its log odds surely reach (so many standard errors below the estimate).
SURE_ERRORS = 1.64
LEAST_LOG_ODDS = 1.3

PERSONS = frozenset("you your yours yourself u ur du dich dir ihr tu te vous toi usted ustedes".split())
OTHERS = frozenset("he him his she her hers they them their it its er sie il elle ils elles ella ellos".split())
THREATS = frozenset("kill hurt destroy burn shoot stab strangle beat hang murder smash cripple".split())
INTENTS = frozenset("will gonna shall ll going should must hope deserve".split())
NEGATORS = frozenset("not never no isn aren wasn don doesn didn nobody without nicht kein pas jamais nunca".split())
REPORTS = frozenset("said says say saying claimed claims called wrote writes quoted alleged reportedly".split())
QUOTES = frozenset("\"“”«»„")

KINDS = ("plain", "aimed", "threat", "denied", "reported")
_FOREIGN_GAP = re.compile(r"[^\w\x00-\x7f]+")
_TOKEN = re.compile(r"\w+|[\"“”«»„,]|\n[ \t\r]*\n|[.!?;\n]")
_WORD = re.compile(r"\w")

MARKS = {
    **dict.fromkeys(REPORTS, "report"),
    **dict.fromkeys(INTENTS, "intent"),
    **dict.fromkeys(NEGATORS, "negator"),
    **dict.fromkeys(OTHERS, "other"),
    **dict.fromkeys(PERSONS, "person"),
    **dict.fromkeys(QUOTES, "quote"),
    **dict.fromkeys(".!?;\n", "stop"),
    ",": "pause",
}
# "both" is a threat verb that the lexicon knows as an insult as well.
MATCHES = ("insult", "threat", "both")
CLASSES = [*dict.fromkeys(MARKS.values()), "paragraph", *MATCHES]

# What a match is worth to its path, so that the fullest reading of a sentence wins.
THREAT, AIMED, PLAIN = 3.0, 2.0, 1.0
LESS = {"denied": 1.0, "reported": 1.0}

REPORT = Transducer(
    "open",
    CLASSES,
    [
        Arc("open", "report", OTHER, "said"),
        Arc("open", "quote", OTHER, "quoted"),
        Arc("open", OTHER, OTHER, "open"),
        Arc("said", "quote", OTHER, "quoted"),
        Arc("said", "stop", OTHER, "open"),
        Arc("said", "paragraph", OTHER, "open"),
        *[Arc("said", match, "reported", "said") for match in MATCHES],
        Arc("said", OTHER, OTHER, "said"),
        Arc("quoted", "quote", OTHER, "open"),
        # A quote that is never closed ends with its paragraph.
        Arc("quoted", "paragraph", OTHER, "open"),
        *[Arc("quoted", match, "reported", "quoted") for match in MATCHES],
        Arc("quoted", OTHER, OTHER, "quoted"),
    ],
)
NEGATION = Transducer(
    "plain",
    [*CLASSES, "reported"],
    [
        Arc("plain", "negator", OTHER, "denying"),
        Arc("plain", OTHER, OTHER, "plain"),
        *[Arc("denying", end, OTHER, "plain") for end in ("stop", "paragraph", "pause", "quote")],
        *[Arc("denying", match, "denied", "denying") for match in MATCHES],
        Arc("denying", OTHER, OTHER, "denying"),
    ],
)


def _aim() -> Transducer:
    """Who is spoken of (nobody yet, you, another), whether intent was stated, and what is owed a person."""
    arcs = []
    for who in ("nobody", "you", "another"):
        for will in ("", "-will"):
            state = who + will
            arcs += [Arc(state, end, OTHER, "nobody") for end in ("stop", "paragraph")]
            arcs += [Arc(state, "person", OTHER, "you" + will), Arc(state, "other", OTHER, "another" + will)]
            arcs += [Arc(state, "intent", OTHER, who + "-will"), Arc(state, OTHER, OTHER, state)]
            for match in ("insult", "both"):
                # The target came before, is still to come, or there is none.
                if who == "you":
                    arcs.append(Arc(state, match, "aimed", state, AIMED))
                if who == "nobody":
                    arcs.append(Arc(state, match, "aimed", "owing" + will, AIMED))
                arcs.append(Arc(state, match, "plain", state, PLAIN))
            for match in ("threat", "both"):
                if will and who == "you":
                    arcs.append(Arc(state, match, "threat", state, THREAT))
                if will:
                    arcs.append(Arc(state, match, "threat", "owing-will", THREAT))
                if match == "threat":
                    arcs.append(Arc(state, match, OTHER, state))
            arcs += [Arc(state, kind, kind, state, weight) for kind, weight in LESS.items()]
    for will in ("", "-will"):
        owing = "owing" + will
        # A debt is paid by the next person named, who must be the one spoken to.
        arcs += [Arc(owing, "person", OTHER, "you" + will), Arc(owing, "intent", OTHER, "owing-will")]
        arcs += [Arc(owing, "insult", "aimed", owing, AIMED), Arc(owing, "both", "aimed", owing, AIMED)]
        if will:
            arcs += [Arc(owing, match, "threat", owing, THREAT) for match in ("threat", "both")]
        arcs += [Arc(owing, kind, kind, owing, weight) for kind, weight in LESS.items()]
        passed = [c for c in CLASSES if c not in ("person", "intent", "other", "stop", "paragraph", "insult", "both")]
        passed = [c for c in passed if c != "threat" or not will]
        arcs += [Arc(owing, symbol, OTHER, owing) for symbol in passed]
    return Transducer("nobody", [*CLASSES, "reported", "denied"], arcs)


AIM = _aim()
TABLE = compose(compose(REPORT, NEGATION), AIM)


class Grammar:
    """The composed transducers with a learned lexicon of words and stems."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems
        self.word_hashes = _hashes([*words, *THREATS])
        self.stem_hashes = _hashes(list(stems))

    def weight(self, word: str) -> float:
        weight = self.words.get(word, 0.0)
        return max(weight, self.stems.get(word[:STEM], 0.0)) if len(word) > STEM else weight

    def symbol(self, token: str) -> tuple[str | None, float]:
        """The class of a token, None if the grammar has no use for it, and its amount."""
        mark = MARKS.get(token)
        if mark is not None:
            return mark, 0.0
        if not _WORD.match(token):
            return "paragraph", 0.0
        weight = self.weight(token)
        if token in THREATS:
            return ("both", weight) if weight else ("threat", LEAST_LOG_ODDS)
        return ("insult", weight) if weight else (None, 0.0)

    def clauses(self, text: str):
        """Per sentence with a match, the amounts of its matches by kind."""
        state = TABLE.start
        symbols: list[str] = []
        amounts: list[float] = []
        for token in [*_TOKEN.findall(text.lower()), "."]:
            mark, amount = self.symbol(token)
            if mark is None:
                continue
            symbols.append(mark)
            amounts.append(amount)
            if mark not in ("stop", "paragraph"):
                continue
            written, state = best_path(TABLE, state, symbols, amounts)
            if written:
                sums = dict.fromkeys(KINDS, 0.0)
                for kind, value in written:
                    sums[kind] += value
                yield sums
            symbols, amounts = [], []

    def features(self, text: str) -> list[float]:
        sums = dict.fromkeys(KINDS, 0.0)
        strongest = 0.0
        for found in self.clauses(text):
            strongest = max(strongest, sum(found.values()))
            for kind, weight in found.items():
                sums[kind] += weight
        return [float(np.log1p(sums[kind])) for kind in KINDS] + [float(np.log1p(strongest))]

    def suspects(self, texts: pa.Array) -> np.ndarray:
        """Which texts have a word or stem of the lexicon, or a threat verb."""
        # The same letters and word ends as in the grammar; TERM only tells ASCII gaps.
        lowered = [(text or "").lower() for text in texts.to_pylist()]
        lowered = [text if text.isascii() else _FOREIGN_GAP.sub(" ", text) for text in lowered]
        data, at = raw_bytes(pa.array(lowered, pa.large_string()))
        if len(data) == 0:
            return np.zeros(len(texts), bool)
        starts, ends = word_runs(data, at, TERM)
        hit = _member(run_hashes(data, starts, ends), self.word_hashes)
        # Where the STEM-th character after each word's first one begins, within the word.
        chars = np.flatnonzero((data & 0xC0) != 0x80)
        stem_end = np.append(chars, np.full(STEM, len(data)))[np.searchsorted(chars, starts) + STEM]
        longer = stem_end < ends
        hit[longer] |= _member(run_hashes(data, starts[longer], stem_end[longer]), self.stem_hashes)
        text = np.searchsorted(at, starts[hit], side="right") - 1
        return np.bincount(text, minlength=len(texts)) > 0

    def measure(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros((len(texts), len(KINDS) + 1))
        for row in np.flatnonzero(self.suspects(texts)):
            out[row] = self.features(texts[int(row)].as_py())
        return out


def _hashes(words: list[str]) -> np.ndarray:
    data, at = raw_bytes(pa.array(words, pa.string()))
    return np.unique(run_hashes(data, at[:-1], at[1:])) if words else np.zeros(0, np.uint64)


def _member(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(hashes), bool)
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


def _lexicon(sample: DataFrame, stems: bool) -> dict[str, float]:
    """Words or stems of the sample's toxic texts with their log odds.

    The bounded sample bounds them; whether the odds are sure decides alone.
    """
    sizes = {row["label"]: row["n"] for row in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    units = F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}_]+")
    if stems:
        longer = F.filter(units, lambda word: F.length(word) > STEM)
        units = F.transform(longer, lambda word: F.left(word, F.lit(STEM)))
    units = sample.select("label", F.explode(F.array_distinct(units)).alias("unit")).where("unit != ''")
    counts = units.groupBy("unit").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
    )
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (toxic + 1)) - F.log(b / (clean + 1)) - SURE_ERRORS * F.sqrt(1 / a + 1 / b)
    rows = (
        counts.where(F.col("toxic") >= LEAST_TEXTS)
        .select("unit", "toxic", odds.alias("odds"))
        .where(F.col("odds") >= LEAST_LOG_ODDS)
        .collect()
    )
    return {row["unit"]: row["odds"] for row in rows}


class ToxicityModel:
    def __init__(self, grammar: Grammar, weights: np.ndarray):
        self.grammar, self.weights = grammar, weights

    def scores(self, texts: pa.Array) -> np.ndarray:
        values = self.grammar.measure(texts) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(values, -30, 30)))


def train_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel:
    """Lexicon and weights from up to ``per_class`` texts of either label outside the held-out fold.

    Without labelled texts of both kinds the lexicon is empty and every score is the share of
    toxic labels (0 without any).
    """
    training = fold(F.col("doc_id"), FOLDS) != HELD_OUT
    sample = labelled_sample(docs, labels, "toxic", training, per_class)
    sample = scratch(docs.sparkSession, "toxicity").keep(sample, "sample")
    grammar = Grammar(_lexicon(sample, stems=False), _lexicon(sample, stems=True))
    width = len(KINDS) + 1

    def features(batches):
        for batch in batches:
            for start, texts in text_slices(batch.column("text")):
                found = grammar.measure(texts)
                label = batch.column("label").slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [label, *(pa.array(found[:, n]) for n in range(width))],
                    ["label", *(f"f{n}" for n in range(width))],
                )

    schema = "label int, " + ", ".join(f"f{n} double" for n in range(width))
    table = sample.mapInArrow(features, schema).toArrow()
    values = np.array([column.to_numpy() for column in table.columns]).T.reshape(-1, width + 1)
    if not len(values):
        return ToxicityModel(grammar, np.append(np.zeros(width), -30.0))
    return ToxicityModel(grammar, fit_logistic(values[:, 1:], values[:, 0]))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, per_class: int = SAMPLE_PER_CLASS
) -> DataFrame:
    """The kept columns (all by default) and held_out, score, predicted for every row.

    Null and empty texts match nothing and get the score of such texts. Repeated rows score alike;
    labels for unknown ids are ignored. Only the text decides a score. Empty tables give empty results.
    A new column whose name is taken gets a trailing underscore.
    """
    model = train_toxicity(docs, labels, per_class)
    keep = docs.columns if keep is None else keep
    return append_scores(docs, keep, fold(F.col("doc_id"), FOLDS) == HELD_OUT, model.scores)
