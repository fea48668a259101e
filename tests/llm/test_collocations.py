"""Phrase collocations against counting by hand."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from __spark_entry__ import oracle_sql
from check import compare, connect
from tillroll.llm import collocations as c

TEXTS = [
    ("en", "New York is big. new york is old, and NEW YORK is far"),
    ("en", "new york is big! the city of new york\nis big: new york city"),
    (None, "new york is big"),
    ("und", "of the of the of the of the"),
    ("fr", "a a a a a a a"),
    ("fr", "a a a. b"),
    ("es", None),
    ("es", ""),
    ("es", " \t . ; \r"),
    ("de", "tab\tnext  wide\xa0space wide\xa0space ünder Über über über"),
    ("de", "x\x1cy z x\x1cy z x\x1cy z"),
]


def by_hand(rows, min_count, top):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 6):
                for i in range(len(words) - n + 1):
                    counts[lang][tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        found = []
        chosen = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        for p, a in chosen.items():
            if any(
                len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in chosen.items()
            ):
                continue
            cuts = []
            for k in range(1, len(p)):
                left, right = f[p[:k]], f[p[k:]]
                cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("min_count, top, held, burst", [(2, 50, 10**6, 4096), (1, 7, 3, 2), (3, None, 20, 1)])
def test_against_counting_by_hand(spark, min_count, top, held, burst):
    docs = spark.createDataFrame([(*t, 1, 2) for t in TEXTS], "lang string, text string, phrase int, n int")
    made = c.collocations(docs.repartition(3), min_count=min_count, top=top, held=held, burst=burst)
    assert sorted(map(tuple, made.collect())) == by_hand(TEXTS, min_count, top)


def test_blocks_words_and_bits_that_run_out(spark, monkeypatch):
    monkeypatch.setattr(c, "BLOCK", 5)
    task = c.Counting(5, [], 10**6, 2)
    text = "one two three four five six one two three four five six"
    for _ in range(2):
        task.add("en", c.spaced(text.encode()))
    rows = [r for b in task.runs(0, 6) for r in b.to_pylist()]
    found = {k: n for r in rows for k, n in zip(r["keys"], r["counts"])}
    assert found[b"en\xffone two three four five"] == 4 and found[b"en\xffsix one"] == 2
    assert found[b"en\xffsix"] == 4 and found[b"en\xff"] == 24
    assert all(r["keys"] == sorted(r["keys"]) for r in rows)
    assert [r["range"] for r in rows] == sorted({r["range"] for r in rows})
    assert list(task.runs(0, 6)) == []


def test_trie_bursts_and_gives_up_whole_subtrees():
    trie = c.HatTrie(burst=2)
    keys = {b"LLLL" + bytes([0, 0, i % 3, 1, 0, 0, 0, i]): i + 1 for i in range(12)}
    for key, n in keys.items():
        trie.add({key: n})
        trie.add({key: 1})
    assert any(isinstance(n, c.Node) for n in trie.root.values())
    some = dict(zip(*trie.take(8)))
    assert trie.size == 8 and len({k[:7] for k in some}) == 1
    assert some | dict(zip(*trie.take(0))) == {k: n + 1 for k, n in keys.items()} and not trie.root


def test_runs_of_slots_survive_packing():
    rng = np.random.default_rng(1)
    runs = [(np.unique(rng.integers(0, 1 << 40, 500, dtype=np.uint64)), None) for _ in range(3)]
    runs = [(s, rng.integers(1, 2**31, len(s))) for s, _ in runs] + [(runs[0][0], np.ones(len(runs[0][0]), np.int64))]
    again = [c.unpacked(c.packed(*r)) for r in runs]
    assert all((a == b).all() and (x == y).all() for (a, x), (b, y) in zip(runs, again))
    slots, times = c.added(again)
    want = Counter()
    for s, t in runs:
        for k, v in zip(s.tolist(), t.tolist()):
            want[k] += v
    assert dict(zip(slots.tolist(), times.tolist())) == want and (np.diff(slots.astype(np.int64)) > 0).all()


def test_slots_given_up_early_add_up_to_the_same():
    whole, parts = c.Counting(2, [], 10**6, 9), c.Counting(2, [], 10**6, 9)
    runs = []
    for lang, text in TEXTS * 2:
        data = c.spaced((text or "").encode())
        whole.add(lang or "und", data, by_slots=True)
        parts.add(lang or "und", data, by_slots=True)
        runs += [r for b in parts.slot_runs(6) for r in b.to_pylist()]
    (once,) = (b.to_pylist() for b in whole.slot_runs(6))
    by_range = {r["range"]: c.unpacked(r["run"]) for r in once}
    for key, (slots, times) in by_range.items():
        again = c.added([c.unpacked(r["run"]) for r in runs if r["range"] == key])
        assert (again[0] == slots).all() and (again[1] == times).all()
        assert (slots >> np.uint64(c.SLOT_BITS - 6) == key).all()
    pairs = sum(len(v) for v, _ in by_range.values())
    found = Counter((lang, p) for lang, rank, p, *_ in by_hand(TEXTS * 2, 1, None) if p.count(" ") == 1)
    assert pairs >= len(found)


def test_empty_table(spark):
    assert c.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_large_counts_stay_exact(spark, monkeypatch):
    big = 10**14
    rows = [("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 1)]
    frequent = spark.createDataFrame(rows, "lang string, phrase string, words int, n long")
    totals = spark.createDataFrame([("en", 9 * 10**15)], "lang string, n long")
    monkeypatch.setattr(c, "phrase_counts", lambda *_: (frequent, totals))
    made = c.collocations(spark.createDataFrame([], "lang string, text string")).collect()
    assert made[0].score == 1000 * (big - 1) * 9 * 10**15 // (big * (big + 1))


def test_query_equals_sql(spark):
    assert "op13_collocations" in oracle_sql()
    folder = "/root/testdata/sf0.01"
    assert compare(spark, connect(folder), "op13_collocations", folder) is None
