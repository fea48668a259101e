"""The conversation trie against one built by hand, and contraction against recursion."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

from __spark_entry__ import oracle_sql
from check import compare, connect
from tillroll.llm import prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string, node string, depth int"


def by_hand(rows):
    turns = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [(r, t.decode()) for *_, r, t in sorted(v)] for c, v in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        path = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(members[p]) - 1) * len(p[-1][1] if p else "")
    return sorted(
        (
            min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]),
            leaves[p], saved[p], sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p in members
    )


def made(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 9) for r in rows], SCHEMA)
    return sorted(map(tuple, prefix_trie.prefix_trie(frame.repartition(5)).collect()))


def test_against_a_trie_built_by_hand(spark):
    rng = random.Random(2)
    said = ["hi", "", "a long text ünd so", None]
    rows = []
    for c in [*range(0, 24), *range(95, 130), *range(200, 420, 7), -7, -150, 10**12]:
        for turn in range(rng.randint(1, 9)):
            rows.append((c, turn if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(said)))
    rows += [(None, 1, "user", "lost"), (5, 3, "user", "tie"), (5, 3, "user", "tie"), (5, 3, "a", "tie")]
    assert made(spark, rows) == by_hand(rows)


def test_long_conversations_and_many_that_start_alike(spark):
    rows = [(300 + c, t, "user", "same") for c in range(2) for t in range(90)]
    rows += [(c, t, "user", "first" if t < 6 else f"{c}") for c in range(1000, 1100) for t in range(8)]
    rows += [(c, 0, "user", "") for c in range(2000, 2300)]
    assert made(spark, rows) == by_hand(rows)


def test_no_conversation(spark):
    assert made(spark, [(None, 1, "user", "x")]) == []


def test_turnless_conversations_end_at_the_root(spark):
    bare = next(c for c in range(4, 100) if zlib.crc32(str(c).encode()) % 6 > 0)
    rows = [(bare, 0, "user", "all of it goes, as there is no conversation 0"), (3, None, None, None)]
    assert made(spark, rows) == by_hand(rows)
    assert by_hand(rows)[0][1:3] == (0, None)


def test_contraction_equals_recursion(spark):
    """A forest of chains, a star, a comb and a random tree."""
    rng, n = random.Random(5), 70
    shapes = {
        "chain": lambda i: i - 1,
        "star": lambda i: 0,
        "random": lambda i: rng.randrange(i),
        "comb": lambda i: i - 1 if i % 2 else max(i - 2, 0),
        "chains": lambda i: None if i % 9 == 0 else i - 1,
    }
    rows, want = [], {}
    for shape, up in shapes.items():
        parent = [None] + [up(i) for i in range(1, n)]
        value = [rng.randrange(100) for _ in range(n)]
        total = value[:]
        for i in reversed(range(n)):
            if parent[i] is not None:
                total[parent[i]] += total[i]
        rows += [(f"{shape}{i}", None if p is None else f"{shape}{p}", v) for i, (p, v) in enumerate(zip(parent, value))]
        want |= {f"{shape}{i}": t for i, t in enumerate(total)}
    tree = spark.createDataFrame(rows, "id string, parent string, v long")
    assert dict(prefix_trie.subtree_sums(tree, ["v"]).collect()) == want


def test_ids_are_hashed_run_by_run(spark, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        ends = spark.createDataFrame([("a", i) for i in range(-5, 60)] + [("b", 3)], "node string, conv long")
        got = dict(prefix_trie.joined_ids(ends).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {
        "a": sha256(",".join(map(str, range(-5, 60))).encode()).hexdigest(),
        "b": sha256(b"3").hexdigest(),
    }


def test_query_equals_sql(spark):
    assert "op11_prefix_trie" in oracle_sql()
    folder = "/root/testdata/sf0.01"
    assert compare(spark, connect(folder), "op11_prefix_trie", folder) is None
