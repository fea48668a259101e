"""The learned operators against slow versions of their scores, written letter by letter."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from tillroll.llm import langid, quality_pu, toxicity, urls

ODD = [
    None, "", " \n\t", "12 345 !!", "a", "Ünïcødé Straße ΣΊΣΥΦΟΣ", "very very bad bad BAD words", "x" * 300,
    "One line.\nOne line.\nOther | $$ lines!\n\n", "日本語 テキスト の 例", "word " * 90, "é İ ß",
    "The quick brown fox, it jumped over 13 lazy dogs; then it slept. " * 12, "½ ² Ⅷ",
]
MASK = (1 << 64) - 1


def words_by_hand(text):
    return "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()


def bucket(gram, bits):
    value = len(gram)
    for c in gram:
        value = (value * 0x100000001B3 + ord(c)) & MASK
    return ((value * 0x9E3779B97F4A7C15) & MASK) >> (64 - bits)


def grams_by_hand(word, lengths, bits):
    edged = f" {word} "
    return [bucket(edged[i : i + n], bits) for n in lengths for i in range(len(edged) - n + 1)]


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("documents", "labels", "pages")}


def test_language_by_cosine_of_dicts(spark, tables):
    model = langid.fit(tables["documents"])
    for row in langid.identify(docs_of(spark, ODD), model).collect():
        words = words_by_hand(ODD[row.doc_id])
        if not words:
            assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
            continue
        counts = Counter(g for w in words for g in grams_by_hand(w, (2, 3), langid.BITS))
        counts.update(bucket(c, langid.BITS) for c in " ".join(["", *words, ""]))
        weights = {g: math.sqrt(n) * float(model.idf[g]) for g, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in weights.values()))
        cosine = [sum(v * float(c[g]) for g, v in weights.items()) / norm for c in model.centroids]
        best = max(range(len(cosine)), key=lambda i: (cosine[i], -i))
        assert row.score == pytest.approx(max(cosine), abs=1e-4)
        near = [model.langs[i] for i, c in enumerate(cosine) if c > cosine[best] - 1e-4]
        assert row.lang_pred in near
    ties = langid.Model(model.idf, np.stack([model.centroids[0]] * 2), ["aa", "bb"], np.array([2.0, 2.0]))
    assert ties.predict(["some text"])[0] == ["aa"]


def test_document_frequencies_and_a_step_of_clustering(spark):
    found, n = langid.document_frequency(docs_of(spark, ODD))
    texts = [t for t in ODD if t]
    for text in ("a", "very very bad bad BAD words"):
        gram = bucket(" " + words_by_hand(text)[0][:2], langid.BITS)
        assert found[gram] == sum(langid.gram_counts(t)[gram] > 0 for t in texts)
    assert n == len(texts)
    x = np.eye(6)[[0, 0, 1, 1, 2, 2]] + 0.01
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres, cosine = langid._clusters(x, 3, np.random.default_rng(0))
    assert sorted(c.argmax() for c in centres) == [0, 1, 2] and (cosine > 0.999).all()


def test_url_regression_by_a_loop(spark):
    labelled = spark.createDataFrame(
        [(f"shop{i}.net", f"/buy/{i}", "block") for i in range(30)] + [(f"news{i}.org", f"/story/{i}", "allow") for i in range(30)],
        "host string, path string, verdict string",
    )
    pages = [(1, "http://SHOP77.net/buy/now"), (2, "https://news5.org/story?x=1"), (3, None), (4, "no scheme"), (5, "http://é.org/ü")]
    model = urls.train(labelled)
    index = HashingTF(numFeatures=urls.BUCKETS).indexOf
    judged = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), (), labelled)
    for row in judged.collect():
        grams = set()
        for mark, part in (("h", row.host), ("p", row.path)):
            edged = f"^{part}$"
            grams |= {index(mark + edged[i : i + urls.GRAM]) for i in range(max(len(edged) - urls.GRAM + 1, 1))}
        logit = model.intercept + sum(float(model.coefficients[g]) for g in grams)
        assert row.p_block == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-9)
        assert row.verdict == ("block" if row.p_block >= 0.5 else "allow")


def test_quality_scores_by_loops(spark, tables):
    model = quality_pu.fit(tables["documents"], tables["labels"])
    scores = {r.doc_id: r.score for r in quality_pu.predict(docs_of(spark, ODD * 2), model).collect()}
    for i, text in enumerate(ODD):
        raw = (text or "").encode()
        words = re.findall(rb"[^\x20\x09-\x0d]+", raw)
        made = quality_pu.statistics(text)
        if words:
            assert made[0] == pytest.approx(math.log1p(len(words)))
            assert made[9] == pytest.approx(sum(a == b for a, b in zip(words, words[1:])) / len(words))
            assert made[10] == pytest.approx(len(set(words)) / len(words))
            assert made[2] == pytest.approx(math.sqrt(sum(b in b"#*$%&|<>{}[]\\^~_=+@" for b in raw) / len(raw)))
        else:
            assert not made.any()
        x = [min(max((f - m) / s, -8), 8) for f, m, s in zip(made, model.mean, model.scale)]
        a, b, c, d = model.layers
        hidden = [math.tanh(sum(v * a[j, k] for j, v in enumerate(x)) + b[k]) for k in range(len(b))]
        logit = sum(h * c[k, 0] for k, h in enumerate(hidden)) + d[0]
        assert scores[i] == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-9)
        assert scores[i] == scores[i + len(ODD)]  # equal texts, equal scores


def test_the_non_negative_risk_and_its_slope(monkeypatch):
    """The slope that training follows is that of the risk, or goes back where it is negative."""
    seen = []
    monkeypatch.setattr(quality_pu, "_descend", lambda x, slope, layers, rng, epochs: seen.append((slope, epochs)))
    rng = np.random.default_rng(0)
    positive, unlabelled = rng.normal(1, 1, (30, quality_pu.N_FEATURES)), rng.normal(0, 1, (50, quality_pu.N_FEATURES))
    monkeypatch.setattr(quality_pu, "_prior", lambda *_: 0.4)
    model = quality_pu.train(positive, unlabelled)
    slope, rows = seen[-1][0], np.arange(80)
    log1p = lambda z: np.logaddexp(0, z)

    def risks(logit):
        p, u = logit[:30], logit[30:]
        return model.prior * log1p(-p).mean(), log1p(u).mean() - model.prior * log1p(p).mean()

    for shift in (0.0, -6.0):  # very negative logits of unlabelled texts make the second part negative
        logit = rng.normal(0, 1, 80)
        logit[30:] += shift
        of_positives, of_negatives = risks(logit)
        got = slope(logit, rows)
        for i in (0, 7, 31, 79):
            step = np.zeros(80)
            step[i] = 1e-6
            up, down = risks(logit + step), risks(logit - step)
            if of_negatives >= 0:
                want = (sum(up) - sum(down)) / 2e-6
            else:
                want = -(up[1] - down[1]) / 2e-6
            assert got[i] == pytest.approx(want, abs=1e-6)


def test_toxicity_by_windows_one_by_one(spark, tables):
    model = toxicity.fit(tables["documents"], tables["labels"])
    scores = {r.doc_id: r.score for r in toxicity.predict(docs_of(spark, ODD * 2), model).collect()}
    for i, text in enumerate(ODD):
        words = words_by_hand(text)
        grams = [
            [toxicity.ECHO if k and w == words[k - 1] else g for g in grams_by_hand(w, toxicity.GRAMS, toxicity.BITS)]
            for k, w in enumerate(words)
        ]
        means = []
        for start in range(0, max(len(words) - toxicity.WINDOW + toxicity.STRIDE, 1), toxicity.STRIDE):
            window = [model.weight[g] for own in grams[start : start + toxicity.WINDOW] for g in own]
            means.append(sum(window) / max(len(window), 1))
        if any(grams):
            logit = min(max(max(means) + model.bias, -30), 30)
            assert scores[i] == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-9)
        else:
            assert scores[i] == model.base < 0.5
        assert scores[i] == scores[i + len(ODD)]
    same = toxicity.fit(tables["documents"].repartition(5), tables["labels"])
    assert same.bias == model.bias and (same.weight == model.weight).all()


def test_null_labels_and_null_ids_teach_nothing(spark, tables):
    docs = docs_of(spark, ["good text here"] * 20 + [None])
    labels = spark.createDataFrame([(i, None, None) for i in range(20)] + [(None, 1, 1)], "doc_id long, toxic int, quality int")
    assert toxicity.predict(docs, toxicity.fit(docs, labels)).where("score >= 0.5").count() == 0
    assert {r.score for r in quality_pu.predict(docs, quality_pu.fit(docs, labels)).collect()} == {0.5}
    assert langid.identify(docs, langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))).where("lang_pred <> 'und'").count() == 0
