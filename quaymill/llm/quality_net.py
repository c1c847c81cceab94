"""Quality by a byte-level convolutional network, in numpy.

A text's bytes are cut into blocks of BLOCK; a chunk is two neighbouring blocks, so chunks overlap by
half and cover the whole text. Learned filters over WIDTH embedded bytes slide over the chunks at
STRIDE; each filter's largest response in a chunk is kept, a dense layer turns these into the
chunk's evidence, and the mean evidence of all chunks gives the text's one probability.

Training (Adam on the logistic loss, on the driver) reads a bounded, documented sample. Scoring
reads every text whole, where it is; embedding and filters are multiplied out into one table per
filter byte beforehand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quaymill.llm.common import append_scores, fold, raw_bytes
from quaymill.llm.sampling import labelled_sample

FOLDS, HELD_OUT = 3, 1
# Bound of the labelled rows that training reads, each whole.
SAMPLE_PER_CLASS = 1_000

BLOCK, WIDTH, STRIDE = 128, 12, 4
EMBEDDING, FILTERS = 8, 20
EPOCHS, BATCH, RATE = 10, 64, 0.01
_AT_ONCE = 4096
# Blocks of which a gradient is taken at once; a longer text is a group of its own.
STEP_BLOCKS = 4096


def blocks_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of BLOCK bytes and the WIDTH that follow, zeros past the text's end; text of each row.

    An empty or null text has one row of zeros.
    """
    data, at = raw_bytes(texts)
    counts = np.maximum(-(-np.diff(at) // BLOCK), 1)
    text = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = (at[text] + number * BLOCK)[:, None] + np.arange(BLOCK + WIDTH)
    padded = np.append(data, np.uint8(0))
    return np.where(place < at[text + 1][:, None], padded[np.minimum(place, len(data))], 0), text


class QualityNet:
    def __init__(self, seed: int = 3):
        random = np.random.default_rng(seed)
        self.values = {
            "embedding": random.normal(0, 0.5, (256, EMBEDDING)),
            "filters": random.normal(0, 1 / np.sqrt(WIDTH * EMBEDDING), (WIDTH, EMBEDDING, FILTERS)),
            "bias": np.zeros(FILTERS),
            "dense": random.normal(0, 0.3, FILTERS),
            "shift": np.zeros(1),
        }

    def tables(self) -> np.ndarray:
        """The response that each byte at each place of a filter adds."""
        return np.einsum("be,wek->wbk", self.values["embedding"], self.values["filters"]).astype(np.float32)

    def _pooled(self, rows: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each filter's largest response in each block, and where it is."""
        windows = np.zeros((len(rows), BLOCK // STRIDE, FILTERS), np.float32)
        for step in range(WIDTH):
            windows += tables[step][rows[:, step : step + BLOCK : STRIDE]]
        best = windows.argmax(axis=1)
        return np.take_along_axis(windows, best[:, None], axis=1)[:, 0], best

    @staticmethod
    def _next(text: np.ndarray) -> np.ndarray:
        """The row that completes each row's chunk: the next of the text, or the row itself."""
        rows = np.arange(len(text))
        return np.where(np.append(text[1:] == text[:-1], False), rows + 1, rows)

    def _evidence(self, pooled: np.ndarray, text: np.ndarray, count: int) -> np.ndarray:
        chunk = np.maximum(pooled, pooled[self._next(text)]) + self.values["bias"]
        chunk = np.maximum(chunk, 0) @ self.values["dense"]
        sums = np.bincount(text, chunk, count) / np.bincount(text, minlength=count)
        return sums + self.values["shift"][0]

    def scores(self, texts: pa.Array, tables: np.ndarray | None = None) -> np.ndarray:
        if len(texts) == 0:
            return np.zeros(0)
        tables = self.tables() if tables is None else tables
        rows, text = blocks_of(texts)
        pooled = np.concatenate(
            [self._pooled(rows[at : at + _AT_ONCE], tables)[0] for at in range(0, len(rows), _AT_ONCE)]
        )
        return 1 / (1 + np.exp(-np.clip(self._evidence(pooled, text, len(texts)), -30, 30)))

    def gradients(self, rows: np.ndarray, text: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss of some texts; only the windows that were largest take part."""
        v = self.values
        pooled, best = self._pooled(rows, self.tables())
        after = self._next(text)
        own = pooled >= pooled[after]
        source = np.where(own, np.arange(len(rows))[:, None], after[:, None])
        chunk = np.maximum(pooled, pooled[after]) + v["bias"]
        active = np.maximum(chunk, 0)
        sizes = np.bincount(text, minlength=len(labels))
        logits = np.bincount(text, active @ v["dense"], len(labels)) / sizes + v["shift"][0]
        error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) / len(labels)
        per_chunk = (error / sizes)[text]
        down = per_chunk[:, None] * v["dense"] * (chunk > 0)
        out = {"shift": np.array([error.sum()]), "dense": per_chunk @ active, "bias": down.sum(axis=0)}
        out["filters"] = np.zeros_like(v["filters"])
        out["embedding"] = np.zeros_like(v["embedding"])
        for k in range(FILTERS):
            hot = np.flatnonzero(down[:, k])
            row = source[hot, k]
            window = rows[row[:, None], (best[row, k] * STRIDE)[:, None] + np.arange(WIDTH)]
            embedded = v["embedding"][window]
            out["filters"][:, :, k] = np.einsum("n,nwe->we", down[hot, k], embedded)
            pull = down[hot, k][:, None, None] * v["filters"][None, :, :, k]
            np.add.at(out["embedding"], window.ravel(), pull.reshape(-1, EMBEDDING))
        return out

    def _step_gradients(self, texts: pa.Array, labels: np.ndarray, chosen: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean loss of the chosen texts, added up over groups of them."""
        sizes = np.array([-(-len(texts[int(n)].as_buffer() or b"") // BLOCK) for n in chosen])
        group = np.cumsum(sizes) // STEP_BLOCKS
        total: dict[str, np.ndarray] = {}
        for number in np.unique(group):
            part = chosen[group == number]
            rows, text = blocks_of(texts.take(pa.array(part)))
            for name, gradient in self.gradients(rows, text, labels[part]).items():
                share = gradient * (len(part) / len(chosen))
                total[name] = total[name] + share if name in total else share
        return total

    def fit(self, texts: pa.Array, labels: np.ndarray, seed: int = 4) -> QualityNet:
        """Adam over shuffled batches with equal weight of both classes."""
        random = np.random.default_rng(seed)
        first = {name: np.zeros_like(value) for name, value in self.values.items()}
        second = {name: np.zeros_like(value) for name, value in self.values.items()}
        step = 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = random.permutation(len(labels))
            for at in range(0, len(order), BATCH):
                chosen = order[at : at + BATCH]
                step += 1
                for name, gradient in self._step_gradients(texts, labels, chosen).items():
                    first[name] += 0.1 * (gradient - first[name])
                    second[name] += 0.001 * (gradient**2 - second[name])
                    scaled = first[name] / (1 - 0.9**step)
                    self.values[name] -= rate * scaled / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
        return self


def train_quality(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> QualityNet:
    """A network from up to ``per_class`` texts of either label outside the held-out fold.

    Texts are read whole; a step takes the gradient of its texts in groups of about STEP_BLOCKS
    blocks, so its memory does not grow with their length. Without labelled texts all scores are one half.
    """
    training = fold(F.col("doc_id"), FOLDS) != HELD_OUT
    sample = labelled_sample(docs, labels, "quality", training, per_class)
    read = sample.orderBy(F.xxhash64("text"), "label", "text").toArrow()
    net = QualityNet()
    if not len(read):
        net.values["dense"][:] = 0
        return net
    return net.fit(read["text"].combine_chunks(), read["label"].to_numpy().astype(float))


def score_quality(
    docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, per_class: int = SAMPLE_PER_CLASS
) -> DataFrame:
    """The kept columns (all by default) and held_out, score (of label 1), predicted for every row.

    Null and empty texts are one block of zeros and score alike. Repeated rows score alike; labels
    for unknown ids are ignored. Only the text decides a score. Empty tables give empty results. A new
    column whose name is taken gets a trailing underscore.
    """
    net = train_quality(docs, labels, per_class)
    tables = net.tables()
    keep = docs.columns if keep is None else keep
    held_out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    return append_scores(docs, keep, held_out, lambda texts: net.scores(texts, tables))
