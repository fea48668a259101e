"""Text quality from trusted positives and unlabelled text, by non-negative PU learning.

A small network over statistics of a text is fitted in numpy. The labels say only which texts
are trusted; everything else is unlabelled and may be good or bad. With the class prior p the
risk is p * (risk of positives as positive) + max(0, risk of unlabelled as negative - p * (risk
of positives as negative)). The part under max is what the negatives must cost, which cannot
be below zero; where a batch would make it so, the step goes back instead (the non-negative
correction), so a flexible model does not fit the unlabelled texts as negatives.

The prior is estimated first: a classifier of trusted against unlabelled texts ranks both,
and where trusted texts are dense, the ratio of the two shares is at most the prior's bound;
the smallest ratio over all thresholds, with its sampling error added, is taken.

Null and empty texts are scored like any other, by statistics that are all zero. Equal texts
have equal scores. With no trusted row, or nothing unlabelled, every score is the prior 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_sample, labelled_texts, map_rows, utf8, word_hashes

#: Trusted rows, and unlabelled rows, that the model is fitted on at most.
FIT_ROWS = 6000
HIDDEN = 24
EPOCHS = 60
BATCH = 500

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[*b"#*$%&|<>{}[]\\^~_=+@"]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*b".,;:!?\"'()-"]] = True
_RANGES = ((48, 57), (65, 90), (97, 122), (128, 255))
N_FEATURES = 20


def statistics(text: str | None) -> np.ndarray:
    """Shares and counts that tell prose from junk; none of them reads words as such."""
    data = utf8(text)
    raw = np.frombuffer(data, np.uint8)
    words = word_hashes(data)
    n, size = len(words), len(raw)
    out = np.zeros(N_FEATURES)
    if not n:
        return out
    out[0] = np.log1p(n)
    out[1] = size / n / 10
    out[2] = np.sqrt(_SYMBOLS[raw].mean())
    out[3] = np.sqrt(_PUNCTUATION[raw].mean())
    out[4:8] = [np.sqrt(((raw >= a) & (raw <= b)).mean()) for a, b in _RANGES]
    out[8] = (raw == 33).sum() / n
    out[9] = (words[1:] == words[:-1]).sum() / n
    _, counts = np.unique(words, return_counts=True)
    out[10] = len(counts) / n
    out[11] = counts.max() / n
    if n >= 3:
        grams = words[:-2] + words[1:-1] * np.uint64(3) + words[2:] * np.uint64(5)
        _, counts = np.unique(grams, return_counts=True)
        out[12] = 1 - len(counts) / len(grams)
        out[13] = counts.max() / len(grams)
    lines = [x for x in data.split(b"\n") if x.strip()]
    out[14] = 1 - len(set(lines)) / len(lines)
    out[15] = np.log1p(n / len(lines)) / 4
    out[16] = np.mean([x.rstrip()[-1:] in b".!?" for x in lines])
    out[17] = float(n < 20)
    out[18] = min(size / n / 10, 4) ** 2
    out[19] = np.sqrt((raw == 124).sum() / n)
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    prior: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        """Row by row: a product of all rows rounds by how many there are."""
        a, b, c, d = self.layers
        x = np.clip((features - self.mean) / self.scale, -8, 8)
        return np.array([np.tanh(row @ a + b) @ c[:, 0] + d[0] for row in x])

    def scores(self, features: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(features), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.logits(features), -30, 30)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _network(rng: np.random.Generator) -> list[np.ndarray]:
    a = rng.normal(0, N_FEATURES**-0.5, (N_FEATURES, HIDDEN))
    return [a, np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, (HIDDEN, 1)), np.zeros(1)]


def _descend(x: np.ndarray, slope, layers: list[np.ndarray], rng, epochs: int) -> None:
    """Adam on batches; `slope` gives the derivative of the risk by each logit of a batch."""
    m, v = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    t = 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(len(x) // BATCH, 1)):
            a, b, c, d = layers
            hidden = np.tanh(x[rows] @ a + b)
            g = slope((hidden @ c)[:, 0] + d[0], rows)[:, None]
            back = (g @ c.T) * (1 - hidden**2)
            grads = [x[rows].T @ back, back.sum(0), hidden.T @ g, g.sum(0)]
            t += 1
            for w, grad, mm, vv in zip(layers, grads, m, v):
                grad = grad + 1e-4 * w
                mm += 0.1 * (grad - mm)
                vv += 0.001 * (grad**2 - vv)
                w -= 0.01 * (mm / (1 - 0.9**t)) / (np.sqrt(vv / (1 - 0.999**t)) + 1e-8)


def _prior(x: np.ndarray, trusted: np.ndarray, rng) -> float:
    """Share of positives among the unlabelled, by the best bin of a held-out ranking."""
    held = rng.random(len(x)) < 0.5
    layers = _network(rng)
    weight = np.where(trusted, 0.5 / trusted.mean(), 0.5 / (1 - trusted.mean()))
    mine, sign, own = x[~held], trusted[~held].astype(float), weight[~held]

    def slope(logit, rows):
        return (_sigmoid(logit) - sign[rows]) * own[rows] / len(rows)

    _descend(mine, slope, layers, rng, 20)
    a, b, c, d = layers
    rank = (np.tanh(x[held] @ a + b) @ c)[:, 0] + d[0]
    good, rest = np.sort(rank[trusted[held]]), np.sort(rank[~trusted[held]])
    if not len(good) or not len(rest):
        return 0.5
    at = np.quantile(good, np.linspace(0.02, 0.95, 80))
    of_good = 1 - np.searchsorted(good, at) / len(good)
    of_rest = 1 - np.searchsorted(rest, at) / len(rest)
    error = np.sqrt(np.log(200) / 2) * (len(good) ** -0.5 + len(rest) ** -0.5)
    best = np.argmin((of_rest + error) / np.maximum(of_good, 1e-9))
    return float(np.clip(of_rest[best] / max(of_good[best], 1e-9), 0.05, 0.97))


def train(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 7) -> Model:
    """Fit on statistics of trusted and of unlabelled texts."""
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), [], 0.5)
    rng = np.random.default_rng(seed)
    features = np.concatenate([positive, unlabelled])
    mean, scale = features.mean(0), features.std(0) + 1e-6
    x = np.clip((features - mean) / scale, -8, 8)
    trusted = np.arange(len(x)) < len(positive)
    prior = _prior(x, trusted, rng)
    layers = _network(rng)

    def slope(logit, rows):
        p, is_p = _sigmoid(logit), trusted[rows]
        n_p, n_u = max(is_p.sum(), 1), max((~is_p).sum(), 1)
        loss_negative = np.logaddexp(0, logit)
        as_negative = loss_negative[~is_p].sum() / n_u - prior * loss_negative[is_p].sum() / n_p
        of_negatives = np.where(is_p, -prior * p / n_p, p / n_u)
        if as_negative < 0:
            return -of_negatives
        return np.where(is_p, prior * (p - 1) / n_p, 0) + of_negatives

    _descend(x, slope, layers, rng, EPOCHS)
    return Model(mean, scale, layers, prior)


def with_statistics(texts: DataFrame, text: str = "text") -> DataFrame:
    """Per row: features."""

    def make():
        return lambda some: ([statistics(t) for t in some],)

    return map_rows(texts, [text], "features array<double>", make)


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality", rows: int = FIT_ROWS,
) -> Model:
    """Fit on statistics of a bounded sample of trusted texts and one of all texts of `docs`.

    Only label 1 is read. Statistics are made in the tasks; no text comes to the driver.
    """
    trusted = labelled_texts(docs, labels, key, text, label, (1,), rows).select("text")
    some = bounded_sample(docs.select(F.col(text).alias("text")), rows, ["text"])
    frames = [with_statistics(d).toPandas() for d in (trusted, some)]
    made = [np.array(sorted(map(tuple, f["features"]))).reshape(-1, N_FEATURES) for f in frames]
    return train(*made)


def predict(
    docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: key, the columns of `carry`, and score, higher for better texts."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = held.value

        def work(*columns):
            features = np.array([statistics(t) for t in columns[-1]]).reshape(-1, N_FEATURES)
            return *columns[:-1], model.scores(features)

        return work

    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (key, *carry))
    columns = [key, *carry, F.col(text).alias("_text")]
    return map_rows(docs, columns, f"{types}, score double", make)
