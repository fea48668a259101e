"""Toxic documents by subword-bag embeddings averaged into a linear softmax.

A window of words is the average of the embeddings of its character n-grams, hashed to a
fixed number of buckets, and a linear softmax over that average tells toxic from clean.
Embeddings and softmax are trained jointly in numpy, so a misspelling that was never seen
shares most of its n-grams with words that were. A document counts by its most toxic window:
a few words in a very long text are not averaged away. Training does the same: after a first
pass over all windows of toxic documents, only the window that looks most toxic is taken as
such, for clean documents as the hardest example of a clean one. The n-grams of a word equal to
the one before are replaced by a mark with an embedding of its own, so that a stuttered word
fills no window with its few n-grams.

After training, the softmax of the embedding of an n-gram is one number per bucket, and all
windows of a text come from one prefix sum over its whole length.

Null and empty texts and texts without letters score the share of toxic documents if that is
under a half, else just under a half. Equal texts have equal scores. With no labelled row of
one of the classes nothing is toxic. Ids are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import (
    gram_buckets,
    labelled_texts,
    letter_codes,
    map_rows,
    powers,
    ship,
)

GRAMS = (3, 4, 5)
BITS = 15
#: Stands for each n-gram of a word equal to the one before.
ECHO = 1 << BITS
DIMENSIONS = 8
WINDOW = 16
STRIDE = 8
#: Labelled documents of each class that the model is fitted on at most.
FIT_ROWS = 1200
#: Windows of a text that are fitted on at most, some 2,000 words; every text is scored whole.
FIT_WINDOWS = 256
#: Passes over the windows: two over all, then over the hardest of each text.
EPOCHS = 36
BATCH = 256
SCALE = 10.0


def grams_of(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Buckets of all n-grams, ordered by the word they are in, where words start, and how many."""
    codes = letter_codes(text or "")
    if len(codes) < 3:
        return np.empty(0, np.int64), np.zeros(1, np.int64), 0
    word_at = np.cumsum(codes == 32)  # the word that starts after each space
    n_words = int(word_at[-1]) - 1
    spaces = np.flatnonzero(codes == 32)
    up, down = powers(len(codes) + 1)
    sums = np.append(np.uint64(0), np.cumsum(codes * up[: len(codes)]))
    names = (sums[spaces[1:]] - sums[spaces[:-1] + 1]) * down[spaces[:-1] + 1]
    echoes = np.append(False, names[1:] == names[:-1])
    buckets, words = [], []
    for length in GRAMS:
        bucket, places = gram_buckets(codes, length, BITS)
        buckets.append(bucket)
        words.append(word_at[places] - 1)
    bucket, word = np.concatenate(buckets), np.concatenate(words)
    bucket[echoes[word]] = ECHO
    order = np.argsort(word, kind="stable")
    starts = np.searchsorted(word[order], np.arange(n_words + 1))
    return bucket[order], starts, n_words


def windows_of(n_words: int) -> np.ndarray:
    """First and last word of each window; the last window ends with the text."""
    starts = np.arange(0, max(n_words - WINDOW + STRIDE, 1), STRIDE)
    return np.stack([starts, np.minimum(starts + WINDOW, n_words)], axis=1)


@dataclass
class Model:
    """The difference of the two softmax terms for each bucket, and for nothing."""

    weight: np.ndarray
    bias: float
    base: float

    def score(self, text: str | None) -> float:
        buckets, starts, n_words = grams_of(text)
        if not n_words or not len(buckets):
            return self.base
        sums = np.concatenate(([0.0], np.cumsum(self.weight[buckets])))
        ends = starts[windows_of(n_words)]
        count = np.maximum(ends[:, 1] - ends[:, 0], 1)
        means = (sums[ends[:, 1]] - sums[ends[:, 0]]) / count
        return float(1 / (1 + np.exp(-np.clip(means.max() + self.bias, -30, 30))))


class _Adam:
    def __init__(self, *shapes: tuple[int, ...], rate: float = 0.02) -> None:
        self.rate, self.t = rate, 0
        self.m, self.v = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]

    def step(self, values: list[np.ndarray], grads: list[np.ndarray]) -> None:
        self.t += 1
        for x, g, m, v in zip(values, grads, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)


def some_windows(text: str) -> list[bytes]:
    """The n-grams of the windows of a text, as two bytes each; of a long text so many windows,
    chosen by a hash of what they hold."""
    buckets, starts, n_words = grams_of(text)
    if not n_words:
        return []
    parts = [buckets[starts[a] : starts[b]].astype(np.uint16).tobytes() for a, b in windows_of(n_words)]
    parts = [p for p in parts if p]
    if len(parts) > FIT_WINDOWS:
        kept = sorted(range(len(parts)), key=lambda i: (zlib.crc32(parts[i]), i))[:FIT_WINDOWS]
        parts = [parts[i] for i in sorted(kept)]
    return parts


def train(texts: list[str], labels: list[int], seed: int = 5) -> Model:
    """Fit on a bounded list of texts, 1 for toxic."""
    return train_windows([some_windows(t) for t in texts], labels, seed)


def train_windows(windows: list[list[bytes]], labels: list[int], seed: int = 5) -> Model:
    """Fit on the windows of each of a bounded list of texts."""
    y = np.array(labels, np.int64)
    base = min(float(y.mean()) if len(y) else 0.0, 0.49)
    if len(np.unique(y)) < 2 or len(np.unique([k for w, k in zip(windows, labels) if w])) < 2:
        return Model(np.zeros(ECHO + 1), -30.0, base)
    # all windows of all texts, flat: grams[edge[w]:edge[w + 1]] belong to window w
    sizes = [len(part) // 2 for own in windows for part in own]
    bounds, owner = np.append(0, np.cumsum(sizes)), [i for i, own in enumerate(windows) for _ in own]
    flat_grams = bytearray(2 * int(bounds[-1]))
    at = 0
    for own in windows:
        for part in own:
            flat_grams[at : at + len(part)] = part
            at += len(part)
        own.clear()
    grams, edge, doc = np.frombuffer(flat_grams, np.uint16), bounds, np.array(owner)
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.005, (ECHO + 1, DIMENSIONS))  # n-grams never seen weigh next to nothing
    soft = rng.normal(0, 0.3, (DIMENSIONS, 2))
    offset = np.zeros(2)
    adam = _Adam(table.shape, soft.shape, offset.shape)
    held = np.isin(doc, rng.permutation(len(y))[: len(y) // 5])  # sets the threshold
    length = np.diff(edge)

    def scores() -> np.ndarray:
        weight = SCALE * table @ (soft[:, 1] - soft[:, 0])
        sums = [
            np.add.reduceat(weight[grams[edge[w] : edge[min(w + 4096, len(doc))]]], edge[w : w + 4096][: len(doc) - w] - edge[w])
            for w in range(0, len(doc), 4096)
        ]
        return np.concatenate(sums) / length + offset[1] - offset[0]

    def best(chosen: np.ndarray, by: np.ndarray) -> np.ndarray:
        """Of each document, its window with the highest value."""
        order = chosen[np.lexsort((by[chosen], doc[chosen]))]
        return order[np.append(np.diff(doc[order]) != 0, True)]

    all_windows, seen = np.arange(len(doc)), np.flatnonzero(~held)
    for epoch in range(EPOCHS):
        if epoch < 2:
            chosen = seen
        else:
            some = best(seen[y[doc[seen]] == 0], rng.random(len(doc)))
            chosen = np.concatenate([best(seen, scores()), some])
        toxic = y[doc[chosen]] == 1
        share = np.where(toxic, 0.5 / max(toxic.sum(), 1), 0.5 / max((~toxic).sum(), 1)) * len(chosen)
        for batch in np.array_split(rng.permutation(len(chosen)), max(len(chosen) // BATCH, 1)):
            w = chosen[batch]
            flat = np.repeat(edge[w] - np.append(0, np.cumsum(length[w])[:-1]), length[w])
            g = grams[flat + np.arange(len(flat))].astype(np.int64)
            row = np.repeat(np.arange(len(w)), length[w])
            firsts = np.append(0, np.cumsum(length[w])[:-1])
            mean = SCALE * np.add.reduceat(table[g], firsts) / length[w][:, None]
            logit = mean @ soft + offset
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(w)), y[doc[w]]] -= 1
            p *= (share[batch] / len(w))[:, None]
            back = SCALE * (p @ soft.T) / length[w][:, None]
            grad = np.stack(
                [np.bincount(g, back[row, d], ECHO + 1) for d in range(DIMENSIONS)], axis=1
            )
            adam.step([table, soft, offset], [grad, mean.T @ p, p.sum(axis=0)])
    value = scores()
    top = best(all_windows, value)
    level, truth, mine = value[top], y[doc[top]], held[top]
    if len(np.unique(truth[mine])) < 2:
        mine[:] = True
    weight = SCALE * table @ (soft[:, 1] - soft[:, 0])
    shift = _threshold(level[mine], truth[mine])
    return Model(weight, float(offset[1] - offset[0] - shift), base)


def _threshold(level: np.ndarray, truth: np.ndarray) -> float:
    """The middle of the widest gap with the best balanced accuracy."""
    order = np.argsort(level, kind="stable")
    level, truth = level[order], truth[order]
    caught = 1 - np.cumsum(truth) / truth.sum()
    clean = np.cumsum(1 - truth) / (1 - truth).sum()
    value = caught[:-1] + clean[:-1]
    if not len(value):
        return 0.0
    good = np.flatnonzero(value >= value.max() - 1e-9)
    at = good[np.argmax(np.diff(level)[good])]
    return float((level[at] + level[at + 1]) / 2)


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "toxic", rows: int = FIT_ROWS,
) -> Model:
    """Fit on a bounded sample of documents joined with their labels.

    The tasks cut the texts into windows, at most FIT_WINDOWS of each of twice `rows` texts, and
    one task, which holds those only, trains on them. The driver gets the finished model.
    """
    found = labelled_texts(docs, labels, key, text, label, (0, 1), rows)

    def windows():
        return lambda label_, texts: (label_, [some_windows(t or "") for t in texts])

    cut = map_rows(found, [F.col("label").cast("int"), "text"], "label int, windows array<binary>", windows)

    def trained(batches):
        labels_, own = [], []
        for batch in batches:
            labels_ += batch.column(0).to_pylist()
            own += batch.column(1).to_pylist()
        order = sorted(range(len(own)), key=lambda i: (labels_[i], own[i]))
        made = train_windows([own[i] for i in order], [labels_[i] for i in order])
        row = [made.weight.astype("<f8").tobytes()], [made.bias], [made.base]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["weight", "bias", "base"])

    ship(docs.sparkSession)
    # the one partition there is, also without a row, which gives a model that finds nothing toxic
    one = cut.repartition(1).mapInArrow(trained, "weight binary, bias double, base double")
    weight, bias, base = one.first() or (np.zeros(ECHO + 1).tobytes(), -30.0, 0.0)
    return Model(np.frombuffer(weight, "<f8"), bias, base)


def predict(
    docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: key, the columns of `carry`, and score."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = held.value

        def work(*columns):
            return *columns[:-1], [model.score(t) for t in columns[-1]]

        return work

    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (key, *carry))
    return map_rows(
        docs, [key, *carry, F.col(text).alias("_text")], f"{types}, score double", make
    )
