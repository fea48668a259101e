"""Each operator against brute force, a library, a round trip or held-out labels."""

from __future__ import annotations

import random
import re
import sys
from hashlib import sha256
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm import (
    bpe,
    chat,
    decontaminate,
    langid,
    line_dedup,
    near_dup,
    quality_pu,
    quality_rules,
    toxicity,
    urls,
)
from tillroll.llm.common import fold

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, score string, n_words string, keys string"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def docs_of(spark, texts, first=0):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(first + i, t, "x", "y", "z") for i, t in enumerate(texts)], DOCS)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def words(rng, n):
    return [rng.choice("abcdefgh") + rng.choice("aeiou") + rng.choice("klmn") for _ in range(n)]


@pytest.fixture(scope="module")
def family():
    """Texts with copies, edited copies, parts in common, odd ones, and nothing at all."""
    rng = random.Random(4)
    base = [words(rng, n) for n in (3, 5, 9, 30, 60, 150, 400)]
    texts: list[str | None] = [None, "", " \t\n", "One", "one two THREE", "x" * 30_000]
    for b in base:
        for k in (0, 0, 1, 2, 4, 8):
            edited = list(b)
            for _ in range(min(k, len(b) // 4)):
                edited[rng.randrange(len(b))] = rng.choice(["new", "other"]) + str(rng.random())[2:5]
            texts.append(" ".join(edited))
    shared = " ".join(words(rng, 70))
    texts += [shared + "\n" + " ".join(words(rng, 25)) for _ in range(12)]
    texts += [texts[-1], texts[-1].upper()]
    return texts


# --- BPE ---------------------------------------------------------------------------------


def test_bpe_gives_the_ids_of_the_library(spark):
    texts = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(150).collect()]
    texts += ["", "Don't 'stupid' I'LL we've", "a<|endoftext|>B<|startoftext|>", "x\x1cy z\x85w\u2003q",
              "ΑΣΑΣ ΣΑΣ İstanbul ß", "e\u0301 ñ", "日本語 १२३ 😀😀", "A" * 3000, "ab" * 600 + "!", "\r\n\t"]
    library = Tokenizer.from_file(VOCABULARY)
    got = {r["doc_id"]: r for r in bpe.digests(docs_of(spark, [*texts, None]), VOCABULARY).collect()}
    for i, text in enumerate([*texts, ""]):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i]["n_tokens"] == len(ids), text[:80]
        assert got[i]["ids_sha256"] == sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == sha256(decoded.encode()).hexdigest()


def test_bpe_long_words_merge_alike(monkeypatch):
    model = bpe.WordBpe(Path(VOCABULARY).read_bytes())
    rng = random.Random(1)
    for n in (2, 3, 40, 300):
        word = "".join(rng.choice("aeinrst") for _ in range(n)).encode()
        short = model.parts(word)
        monkeypatch.setattr(bpe, "LONG_WORD", 1)
        assert model.parts(word) == short
        monkeypatch.undo()


# --- decontamination ---------------------------------------------------------------------

_ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text):
    return _ITEM_WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute_overlaps(texts, items, size=13):
    out = []
    for i, text in enumerate(texts):
        doc, hit, names = item_words(text), set(), set()
        for key, item in items:
            w = item_words(item)
            for p in range(max(len(w) - size + 1, bool(w))):
                win = w[p : p + size]
                for q in range(len(doc) - len(win) + 1):
                    if doc[q : q + len(win)] == win:
                        hit |= set(range(q, q + len(win)))
                        names.add(str(key))
        digest = sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(doc), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(doc)))
    return out


@pytest.mark.parametrize("block", [200_000, 7])
def test_decontamination_equals_brute_force(spark, family, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "WINDOWS_PER_BLOCK", block)
    long = family[-4].split()
    items = [(1, None), (2, ""), (3, "One!"), (4, "two, three"), (10, " ".join(long[3:40])),
             (11, " ".join(long[3:40])), (12, "nothing that any document says at all"),
             (13, " ".join(long[60:73]))]
    texts = [*family, "ONE-two;three", "one two " * 40]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.report(docs_of(spark, texts), frame)
    assert rows_of(got) == sorted(brute_overlaps(texts, items), key=repr)


def test_decontamination_without_items_documents_or_distinct_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    twice = docs_of(spark, ["a b"]).union(docs_of(spark, ["a b"]))
    assert [r["n_hit"] for r in decontaminate.report(twice, none).collect()] == [0, 0]
    one = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert [r["contaminated"] for r in decontaminate.report(twice, one).collect()] == [True, True]
    assert decontaminate.report(docs_of(spark, []), one).count() == 0


# --- near-duplicates ---------------------------------------------------------------------


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, bool(w)))}


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(i, len(s), find(i), find(i) == i) for i, s in enumerate(sets)]


def test_near_duplicates_equal_brute_force(spark, family):
    got = near_dup.near_duplicates(docs_of(spark, family))
    assert rows_of(got) == sorted(brute_components(family), key=repr)


def test_near_duplicates_between_components_are_found(spark):
    """Members of one bucket linked with each other but not with its smallest."""
    rng = random.Random(9)
    base = words(rng, 120)
    texts = [" ".join(base)]
    for _ in range(20):
        edited = list(base)
        for _ in range(5):
            edited[rng.randrange(120)] = "e" + str(rng.random())[2:6]
        texts.append(" ".join(edited))
        one = list(edited)
        one[rng.randrange(120)] = "again"
        texts.append(" ".join(one))
    rng.shuffle(texts)
    got = near_dup.near_duplicates(docs_of(spark, texts))
    assert rows_of(got) == sorted(brute_components(texts), key=repr)


def test_near_duplicates_of_nothing_and_of_repeated_or_nameless_rows(spark):
    assert near_dup.near_duplicates(docs_of(spark, [])).count() == 0
    twice = docs_of(spark, ["a b c d e f"]).union(docs_of(spark, ["a b c d e f"]))
    nameless = twice.limit(1).withColumn("doc_id", F.lit(None).cast("long"))
    got = rows_of(near_dup.near_duplicates(twice.union(nameless)))
    assert got == sorted([(0, 2, 0, True), (0, 2, 0, True), (None, 2, None, True)], key=repr)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, 101)], "a long, b long")
    got = {r["id"]: r["root"] for r in near_dup.components(links).collect()}
    assert got == {**dict.fromkeys(range(21), 0), 100: 100, 101: 100}


# --- line dedup --------------------------------------------------------------------------


def brute_lines(texts, min_words):
    seqs = [
        [(a, x) for a, x in enumerate((t or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)]
        for t in texts
    ]
    out = []
    for d, s in enumerate(seqs):
        gone = set()
        for p in range(len(s)):
            best = 0
            for d2 in range(d + 1):
                for p2 in range(len(seqs[d2]) if d2 < d else p):
                    k = 0
                    while p + k < len(s) and p2 + k < len(seqs[d2]) and s[p + k][1] == seqs[d2][p2 + k][1]:
                        k += 1
                    if sum(len(x.split()) for _, x in s[p : p + k]) >= min_words:
                        best = max(best, k)
            gone |= {a for a, _ in s[p : p + best]}
        lines = (texts[d] or "").split("\n")
        rest = "\n".join(x for a, x in enumerate(lines) if a not in gone)
        out.append((d, texts[d] if texts[d] is None else rest, len(gone)))
    return out


@pytest.mark.parametrize("min_words", [1, 4, 9])
def test_line_dedup_equals_brute_force(spark, min_words):
    rng = random.Random(min_words)
    pool = ["a b c", "d", "e f g h", " ", "", "i j", "k l m n o p", "q"]
    texts = [None, "", "\n\n", *("\n".join(rng.choices(pool, k=rng.randrange(1, 14))) for _ in range(40))]
    got = line_dedup.dedup_lines(docs_of(spark, texts), min_words).select("doc_id", "text", "n_deleted")
    assert rows_of(got) == sorted(brute_lines(texts, min_words), key=repr)


def test_line_dedup_of_nothing_and_of_repeated_rows(spark):
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0
    long = " ".join(f"w{i}" for i in range(60))
    twice = docs_of(spark, [long]).union(docs_of(spark, [long]))
    got = line_dedup.dedup_lines(twice.union(docs_of(spark, [f"mine\n{long}\nmore"], first=5)))
    assert [(r[0], r[1]) for r in rows_of(got)] == [(0, long), (0, long), (5, "mine\nmore")]


# --- chat --------------------------------------------------------------------------------

NASTY = ["", "plain", "### user: hi", "\\### a: ", "\\\\### a: x", "</turn>", "\n</turn>\n", "x\\",
         "### ### a: ", "\\### Assistant: </turn> ok", "###  : ", "### é: ", "tail\n", "\n", "日本 ### b: 😀"]


def test_chat_reads_back_what_was_said(spark):
    rows = [(1, i, ["user", "assistant", "sys tem: é\n", None][i % 4], t) for i, t in enumerate(NASTY)]
    rows += [(2, 0, "assistant", None), (2, None, "assistant", "first"), (None, 0, "user", "u"),
             (3, 5, "user", "same"), (3, 5, "user", "same")]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    done = chat.format_conversations(frame.withColumn("mask", F.lit(1)))
    got = {r["conv_id"]: r for r in done.withColumn("loss", chat.masked_text()).withColumn(
        "turns", chat.parse(F.col("formatted"))).collect()}
    assert all(r["round_trip"] for r in got.values())
    assert [tuple(t) for t in got[1]["turns"]] == [(r or "", t) for _, _, r, t in rows[: len(NASTY)]]
    assert got[1]["loss"] == "".join(NASTY[1::4])
    assert got[2]["loss"] == "first" and got[2]["n_turns"] == 2 and got[3]["n_turns"] == 2
    spans = [got[1]["formatted"][s : s + n] for s, n in got[1]["mask"]]
    assert len(spans) == len(NASTY[1::4])


def test_chat_escapes_only_what_conflicts_and_takes_no_rows(spark):
    schema = "conv_id long, turn int, role string, text string"
    done = chat.format_conversations(spark.createDataFrame([(1, 0, "user", "a \\ b")], schema))
    assert done.first()["formatted"] == "### user: a \\ b\n</turn>\n"
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0


# --- learned operators -------------------------------------------------------------------


@pytest.fixture(scope="module")
def tables(spark):
    names = ("documents", "labels", "pages")
    return {n: spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in names}


ODD = [None, "", "  \n", "12 34", "x", "é" * 50_000]


def test_language_of_held_out_texts(spark, tables):
    docs, held = tables["documents"], fold(F.col("doc_id"), 5) == 0
    model = langid.fit(docs.where(~held))
    got = langid.identify(docs.where(held), model, carry=("lang",)).toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.97
    assert got["score"].between(0, 1).all()
    odd = [r["lang_pred"] for r in langid.identify(docs_of(spark, ODD), model).orderBy("doc_id").collect()]
    assert odd[:4] == ["und"] * 4 and "und" not in odd[4:]
    assert langid.identify(docs_of(spark, []), model).count() == 0
    empty = langid.fit(docs.limit(0))
    assert langid.identify(docs_of(spark, ["abc"]), empty).first()["lang_pred"] == "und"


def test_language_model_rejects_what_it_never_saw(spark, tables):
    model = langid.fit(tables["documents"])
    got = langid.identify(docs_of(spark, ["щука жук чаща " * 30]), model).first()
    assert got["rejected"]


def test_quality_of_held_out_texts(spark, tables):
    docs, labels, held = tables["documents"], tables["labels"], fold(F.col("doc_id"), 3) == 1
    model = quality_pu.fit(docs.where(~held), labels.where(~held))
    got = quality_pu.predict(docs.where(held), model).join(labels, "doc_id").toPandas()
    good = got["quality"] == 1
    assert (got["score"][good] >= 0.5).mean() > 0.95 and (got["score"][~good] < 0.5).mean() > 0.8
    odd = [r["score"] for r in quality_pu.predict(docs_of(spark, ODD), model).orderBy("doc_id").collect()]
    assert all(0 <= s <= 1 for s in odd) and odd[0] == odd[1]
    assert quality_pu.predict(docs_of(spark, []), model).count() == 0
    nothing = quality_pu.fit(docs, labels.where("false"))
    assert quality_pu.predict(docs_of(spark, ["a"]), nothing).first()["score"] == 0.5


def test_prior_is_near_the_share_of_positives():
    rng = np.random.default_rng(0)
    shift = np.zeros(quality_pu.N_FEATURES)
    shift[:3] = 2.5
    good = rng.normal(size=(3000, len(shift))) + shift
    mixed = np.concatenate([rng.normal(size=(2400, len(shift))) + shift, rng.normal(size=(1600, len(shift)))])
    assert abs(quality_pu.train(good, mixed).prior - 0.6) < 0.12


def test_toxicity_of_held_out_texts(spark, tables):
    docs, labels, held = tables["documents"], tables["labels"], fold(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, labels.where(~held))
    got = toxicity.predict(docs.where(held), model).join(labels, "doc_id").toPandas()
    toxic = got["toxic"] == 1
    assert got["score"][toxic].median() > 0.5 and (got["score"][~toxic] < 0.5).mean() > 0.85
    odd = [r["score"] for r in toxicity.predict(docs_of(spark, ODD), model).orderBy("doc_id").collect()]
    assert all(s < 0.5 for s in odd[:4]) and odd[0] == odd[1]
    assert toxicity.predict(docs_of(spark, []), model).count() == 0
    calm = toxicity.fit(docs, labels.where("toxic = 0"))
    assert toxicity.predict(docs_of(spark, ["idiot"]), calm).first()["score"] < 0.5


def test_toxicity_knows_unseen_misspellings():
    rng = random.Random(2)

    def text(n, *more):
        return " ".join(sorted([*words(rng, n), *more], key=lambda _: rng.random()))

    clean = [text(40) for _ in range(200)]
    toxic = [text(38, rng.choice(["blasterd", "zoggler"])) for _ in range(200)]
    model = toxicity.train(clean + toxic, [0] * 200 + [1] * 200)
    misspelt = [model.score(text(40, rng.choice(["blastterd", "zogler"]))) for _ in range(40)]
    others = [model.score(text(40)) for _ in range(40)]
    # words never seen stand well above clean text, by the n-grams they share
    assert np.median(misspelt) > max(np.quantile(others, 0.9), 0.5)
    assert np.mean(np.array(others) < 0.5) > 0.8


def test_toxicity_marks_words_that_echo():
    buckets, starts, n_words = toxicity.grams_of("Bad bad, BAD good bad")
    by_word = [buckets[a:b].tolist() for a, b in zip(starts, starts[1:])]
    assert n_words == 5 and by_word[0] == by_word[4] and len(by_word[1]) == len(by_word[0])
    assert set(by_word[1] + by_word[2]) == {toxicity.ECHO}
    assert toxicity.ECHO not in by_word[0] + by_word[3] + by_word[4]


def brute_facts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    again = {j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(again))


def test_facts_equal_brute_force(spark, family):
    texts = [*family, "a\n\na \na\n\na", "# * $ é|<日本>", "w " * 30, "1 2 3 4 5 6 7 8 " * 3, "a\u00a0b\u2003c"]
    got = quality_rules.with_facts(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [tuple(r)[1:6] for r in got] == [brute_facts(t) for t in texts]


def test_rules_drop_bad_and_keep_good_texts(spark, tables):
    docs, labels = tables["documents"], tables["labels"]
    rules = quality_rules.fit(docs, labels)
    got = quality_rules.judge(docs, rules).join(labels, "doc_id").toPandas()
    good, fired = got["quality"] == 1, got["rule"].notna()
    assert (~fired[good]).mean() > 0.98 and fired[~good].mean() > 0.6
    assert not got["kept"][got["base_failed"]].any()
    assert quality_rules.judge(docs_of(spark, []), rules).count() == 0
    assert [r["kept"] for r in quality_rules.judge(docs_of(spark, ODD[:3]), rules).collect()] == [False] * 3
    assert quality_rules.fit(docs, labels.where("quality = 1")) == []
    assert quality_rules.judge(docs_of(spark, ["a b " * 30, "q"]), []).count() == 2


# --- URLs --------------------------------------------------------------------------------

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"))


def brute_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")
    best = (None, None)
    for says, rule in RULES:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            if best[0] is None or len(rule) > len(best[0]):
                best = (rule, says)
    return host, path, *best


def test_url_rules_equal_brute_force(spark, tables):
    odd = [None, "", "no scheme", "://", "http://ORG", "http://a.ORG/x?y#z", "x://example.org?://b/",
           "http://example.org/en/1", "HTTP://www.Example.ORG/en/12#a", "http://notexample.org/es/",
           "ftp://É.com/fr/\n/x", "http://org#/"]
    pages = spark.createDataFrame([(-1 - i, u) for i, u in enumerate(odd)], "page_id long, url string")
    pages = pages.union(tables["pages"].select("page_id", "url")).withColumn("host", F.lit("clash"))
    got = {r["page_id"]: r for r in urls.judge(pages, RULES).collect()}
    for key, url, _ in pages.collect():
        host, path, rule, says = brute_rule(url)
        assert (got[key]["host"], got[key]["path"], got[key]["rule"]) == (host, path, rule), url
        assert got[key]["verdict"] in ({says} if says else {"allow", "block"})


def test_url_model_learns_from_its_table(spark):
    rows = [(i, h, f"/{i}", v) for i in range(60) for h, v in ((f"cheap-pills{i}.net", "block"), (f"news{i}.net", "allow"))]
    labelled = spark.createDataFrame(rows, "page_id long, host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://m.cheap-pills.net/9"), (2, "http://news.net/9")], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in urls.judge(pages, (), labelled).collect()}
    assert got == {1: "block", 2: "allow"}
    assert {r["verdict"] for r in urls.judge(pages, (), labelled.limit(0)).collect()} == {"allow"}
    assert urls.judge(pages.limit(0), RULES).count() == 0


# --- the pipeline ------------------------------------------------------------------------


def test_pipeline_equals_its_stages_by_brute_force(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(220).withColumn("score", F.lit(1)).withColumn("n_lines", F.lit("x"))
    docs.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    kept = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect() if model.score(r["text"]) < 0.5]
    lines = brute_lines([t for _, t in kept], line_dedup.MIN_WORDS)
    kept = [(k, t) for (k, _), (_, t, n) in zip(kept, lines) if not n or t.strip()]
    kept = [k for k, c in zip(kept, brute_components([t for _, t in kept])) if c[3]]
    items = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/benchmark.parquet").select("item_id", "text").collect()]
    hits = decontaminate_by_sets([t for _, t in kept], items)
    library = Tokenizer.from_file(VOCABULARY)
    want = {k: library.encode(t, add_special_tokens=False).ids for (k, t), bad in zip(kept, hits) if not bad}
    assert got == want


def decontaminate_by_sets(texts, items):
    wins = {tuple(w[p : p + 13]) for _, t in items if (w := item_words(t)) for p in range(max(len(w) - 12, 1))}
    out = []
    for text in texts:
        doc, hit = item_words(text), set()
        for n in {len(w) for w in wins}:
            for q in range(len(doc) - n + 1):
                if tuple(doc[q : q + n]) in wins:
                    hit |= set(range(q, q + n))
        out.append(bool(hit) and 20 * len(hit) >= len(doc))
    return out


def test_entry_works_without_this_subpackage(monkeypatch):
    for missing in ("corpus_pipeline", "tillroll.llm"):
        monkeypatch.setitem(sys.modules, missing, None)
    for loaded in [m for m in sys.modules if m.startswith("tillroll.llm.")]:
        monkeypatch.delitem(sys.modules, loaded)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    entry = __import__("__spark_entry__")
    assert "daily_report" in entry.queries() and not any(k.startswith("op") or k == "pipeline" for k in entry.queries())
    monkeypatch.undo()
    sys.modules.pop("__spark_entry__", None)
