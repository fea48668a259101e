"""Extra columns with names of ours, repeated and null ids, and the bound of samples."""

import pytest
from pyspark.sql import functions as F

from tillroll.llm import langid, line_dedup, quality_pu, quality_rules, toxicity
from tillroll.llm.common import bounded_sample, has_letter, labelled_texts

PROSE = "The quiet river went past the old mill and the children, who had never seen it, were glad. "
JUNK = "### $$$ ||| buy buy buy now now now ### "
OURS = ("_key", "_label", "_text", "key", "label", "__gone", "__id", "__own", "__hash", "gone", "hash", "id", "own", "doc", "pos", "rank")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, PROSE * (1 + i % 3) if i % 2 else JUNK * (2 + i % 3) + str(i), "en") for i in range(60)]
    rows += [(7, PROSE * 4, "en")] * 40 + [(None, PROSE, "en"), (None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return frame.withColumns({name: F.lit(f"mine {name}") for name in OURS})


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(60)] + [(7, 1, 0)] * 30 + [(8, None, None), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_samples_are_bounded_whatever_repeats(spark, docs, labels):
    hot = spark.createDataFrame([(5, "x")] * 4000 + [(None, "y")] * 4000 + [(i, "z") for i in range(4000)], "id long, t string")
    some = bounded_sample(hot, 500, ["id", "t"])
    assert 150 < some.count() <= 500 and some.columns == ["id", "t"]
    assert sorted(map(repr, some.collect())) == sorted(map(repr, bounded_sample(hot.repartition(7), 500, ["id", "t"]).collect()))
    by = bounded_sample(hot, 100, ["id", "t"], by="t").groupBy("t").count().collect()
    assert all(r["count"] <= 100 for r in by)
    assert bounded_sample(hot.limit(0), 5, ["id"]).count() == 0
    found = labelled_texts(docs, labels, "doc_id", "text", "toxic", (0, 1), 9)
    assert found.count() <= 18 and found.columns == ["label", "text"]


def test_one_id_with_many_texts_stays_within_the_bound(spark, labels):
    many = spark.createDataFrame([(7, f"text {i}") for i in range(3000)], "doc_id long, text string")
    assert labelled_texts(many, labels, "doc_id", "text", "quality", (0, 1), 50).count() <= 100


def test_no_letter_is_und(spark, docs):
    assert not has_letter("½ ² Ⅷ 12 _ -") and has_letter("½ é") and not has_letter(None)
    model = langid.fit(docs)
    odd = spark.createDataFrame([(1, "½ ² Ⅷ"), (2, PROSE), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd, model).collect()}
    assert got[1] == got[3] == ("und", 0.0) and got[2][0] == "en"
    assert len(model.centroids) == min(langid.CLUSTERS, len(model.centroids)) >= 2


def test_names_of_ours_do_not_disturb_the_learned_operators(docs, labels):
    rules = quality_rules.fit(docs, labels)
    assert quality_rules.judge(docs, rules).columns[:8] == [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    ]
    model = quality_pu.fit(docs, labels)
    assert quality_pu.predict(docs, model).count() == docs.count()
    scored = toxicity.predict(docs, toxicity.fit(docs, labels), carry=("_label", "__hash"))
    assert {tuple(r) for r in scored.select("_label", "__hash").distinct().collect()} == {("mine _label", "mine __hash")}


def test_names_of_ours_come_back_from_line_dedup(docs):
    done = line_dedup.dedup_lines(docs)
    assert done.columns == [*docs.columns, "n_lines", "n_deleted"]
    for name in OURS:
        assert [r[0] for r in done.select(name).distinct().collect()] == [f"mine {name}"]


def test_windows_of_a_long_text_are_bounded():
    text = " ".join(f"word{i % 997} w{i % 13}" for i in range(9000))
    some = toxicity.some_windows(text)
    assert len(some) == toxicity.FIT_WINDOWS and some == toxicity.some_windows(text)
    assert toxicity.some_windows("") == [] == toxicity.some_windows("12 34")
    assert len(toxicity.some_windows("a short text")) == 1
