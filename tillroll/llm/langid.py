"""Language of a text by the nearest of several centroids per language.

A text is the vector of its character n-grams (one to three letters, word edges included),
hashed to a fixed number of buckets, weighted by inverse document frequency and scaled to
length one. Spherical k-means splits the training texts of each language into a few clusters.
A text takes the language of the centroid with the highest cosine. If its distance from that
centroid is beyond what almost all training texts of the language keep, it is rejected: the
nearest language is still named, and `rejected` says not to trust it.

Null texts and texts without a letter are `und` with score 0 and rejected. Equal texts have
equal results. Ties go to the language that comes first in the alphabet. With nothing to learn
from, every text is `und`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import (
    bounded_sample,
    gram_buckets,
    has_letter,
    letter_codes,
    map_rows,
    ship,
)

BITS = 12
GRAMS = (1, 2, 3)
#: Texts that centroids are fitted on at most, over all languages of up to 120.
FIT_ROWS = 2400
#: Centroids of a language, or as many as it has distinct texts.
CLUSTERS = 4
#: Share of training texts that may lie beyond a language's distance.
REJECTED_SHARE = 0.002
UNKNOWN = "und"


def gram_counts(text: str) -> np.ndarray:
    codes = letter_codes(text)
    out = np.zeros(1 << BITS, np.float32)
    for length in GRAMS:
        buckets, _ = gram_buckets(codes, length, BITS)
        out += np.bincount(buckets, minlength=1 << BITS)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def vector(text: str, idf: np.ndarray) -> np.ndarray:
    return _unit(np.sqrt(gram_counts(text)) * idf)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]  # one per centroid
    reach: np.ndarray  # largest distance for each centroid

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        known = np.array([has_letter(t) for t in texts], bool)
        langs, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        if not known.any() or not self.langs:
            return langs, scores, rejected
        rows = np.flatnonzero(known)
        # text by text, as a product of many rounds by how many there are
        cosine = np.stack([self.centroids @ vector(texts[i], self.idf) for i in rows])
        near = cosine.argmax(axis=1)
        for i, c, v in zip(rows.tolist(), near.tolist(), cosine.max(axis=1).tolist()):
            langs[i], scores[i] = self.langs[c], min(max(v, 0.0), 1.0)
            rejected[i] = bool(1 - v > self.reach[c])
        return langs, scores, rejected


def document_frequency(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """How many texts have each bucket, and how many there are, over all rows.

    Each task adds up first; what is shuffled and returned is one row a bucket.
    """

    def count(batches):
        sums = np.zeros((1 << BITS) + 1, np.int64)
        for batch in batches:
            for t in batch.column(0):
                if value := t.as_py():
                    sums[:-1] += gram_counts(value) > 0
                    sums[-1] += 1
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["at", "n"])

    ship(docs.sparkSession)
    rows = (
        docs.select(text)
        .mapInArrow(count, "at bigint, n bigint")
        .groupBy("at")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    sums = np.zeros((1 << BITS) + 1, np.int64)
    sums[rows["at"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return sums[:-1], int(sums[-1])


def _clusters(x: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means, started from texts far from one another. There are as many distinct
    texts as clusters at least, so that several start apart."""
    centres = x[[rng.integers(len(x))]]
    while len(centres) < k:
        centres = np.concatenate([centres, x[[(x @ centres.T).max(axis=1).argmin()]]])
    for _ in range(15):
        mine = (x @ centres.T).argmax(axis=1)
        centres = np.stack(
            [_unit(x[mine == c].sum(0)) if (mine == c).any() else centres[c] for c in range(k)]
        )
    return centres, (x @ centres.T).max(axis=1)


def train(vectors: np.ndarray, langs: list[str], idf: np.ndarray, seed: int = 1) -> Model:
    rng = np.random.default_rng(seed)
    names = np.array(langs, object)
    centroids, owners, reach = [], [], []
    for lang in sorted(set(langs)):
        x = vectors[names == lang]
        centres, cosine = _clusters(x, min(CLUSTERS, len(np.unique(x, axis=0))), rng)
        centroids.append(centres)
        owners += [lang] * len(centres)
        reach += [1 - float(np.quantile(cosine, REJECTED_SHARE))] * len(centres)
    if not centroids:
        return Model(idf, np.zeros((0, len(idf)), np.float32), [], np.zeros(0))
    return Model(idf, np.concatenate(centroids).astype(np.float32), owners, np.array(reach))


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", rows: int = FIT_ROWS
) -> Model:
    """Document frequencies over all of `docs`; centroids from a bounded sample of each language."""
    docs = docs.where(F.col(lang).isNotNull() & (F.trim(text) != ""))
    frequency, n = document_frequency(docs, text)
    idf = (np.log((1 + n) / (1 + frequency)) + 1).astype(np.float32)
    each = max(rows // max(docs.select(lang).distinct().count(), 1), 20)
    held = docs.sparkSession.sparkContext.broadcast(idf)

    def make():
        def work(langs, texts):
            return langs, [vector(t, held.value).astype(np.float32).tobytes() for t in texts]

        return work

    labelled = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    some = bounded_sample(labelled, each, ["lang", "text"], by="lang")
    got = map_rows(some, ["lang", "text"], "lang string, v binary", make).toPandas()
    got = got.sort_values(["lang", "v"])
    vectors = np.frombuffer(b"".join(got["v"]), np.float32).reshape(len(got), 1 << BITS)
    kept = vectors.any(axis=1)
    return train(vectors[kept], [x for x, k in zip(got["lang"], kept) if k], idf)


def identify(
    docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: key, the columns of `carry`, lang_pred, score (cosine) and rejected."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = held.value

        def work(*columns):
            return *columns[:-1], *model.predict(columns[-1])

        return work

    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (key, *carry))
    schema = f"{types}, lang_pred string, score double, rejected boolean"
    return map_rows(docs, [key, *carry, F.col(text).alias("_text")], schema, make)
