"""The trie of conversation prefixes, with totals of every subtree by parallel contraction.

Conversations often start alike. Each distinct sequence of first turns is a node, and what a
node saves is the text that need not be stored, or computed, again for each conversation
through it.

1. Turns are numbered by a sort over all rows, dealt by range, and by adding up how many rows of
   a conversation lie in earlier ranges: a conversation with a third of all rows is in many tasks.
2. A prefix is named by sums of hashes of its turns, each hash taken with the turn's place, so
   that running sums, again by range, name all prefixes of a conversation of any length. Nodes
   are one aggregation over the names.
3. Totals of subtrees come from contraction in join rounds. Rake: leaves add what they have to
   their parents and go. Compress: in chains of nodes with one child, a node whose random rank
   is above those of its parent and its child is taken out, and its child hangs on its parent.
   Ranks are drawn anew in each round, so a chain loses a third of its nodes, and no two
   neighbours. A tree of any depth is gone after a logarithmic number of rounds; then the nodes
   taken out are put back, each with what lay below its child.
4. Ids that end in a node are joined to text in sorted runs and hashed run by run, so nothing
   holds all ids of a node.

In each round a parent is met once by the sum over its children, never by its children one by
one, so a root with most nodes under it is no hot key. The one join by parent takes parents
with over a thousandth of all nodes as children, which are a thousand at most, as a broadcast.

Null roles and texts count as empty, null turns come first, rows of one turn number are ordered
by role and text, equal rows all stay. Rows without a conversation id belong to no conversation
and are left out. Long texts are hashed early and go no further. An empty table gives an empty
result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm.common import ship, tidy, written

#: A conversation takes fewer than this many turns from the first of its hundred.
MOST_SHARED = 6
GROUP = 100
#: Parents with more than one in so many of all nodes as children are joined apart.
BUSY_SHARE = 1000
_SUMS = ("s1", "s2", "s3", "s4")


def _sorted(df: DataFrame) -> DataFrame:
    """The side of a join that is to be shuffled and sorted at any size: of dozens of rounds the
    driver would hold a broadcast table each."""
    return df.hint("merge")


def numbered_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns as (conv, part, at, said, chars): `at` orders the turns inside a part, parts are in
    order too, and `said` is a digest of role and text."""
    source = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    # starts of texts are enough to deal by: equal ones go to one part and are sorted there
    dealt = source.repartitionByRange("conv", "turn", F.left("role", F.lit(32)), F.left("text", F.lit(32)))
    placed = dealt.sortWithinPartitions("conv", "turn", "role", "text").withColumn(
        "place", F.monotonically_increasing_id()
    )
    said = F.md5(F.concat_ws(":", F.char_length("role").cast("string"), "role", "text"))
    return written(
        placed.select(
            "conv",
            F.shiftright("place", 33).alias("part"),
            F.col("place").bitwiseAND((1 << 33) - 1).alias("at"),
            said.alias("said"),
            F.char_length("text").cast("long").alias("chars"),
        )
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of rebuilt conversations (conv, part, depth, said, chars, length), and all
    conversations (conv, length)."""
    spans = turns.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = written(
        spans.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first"))
    )
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % MOST_SHARED
    convs = spans.groupBy("conv").agg(F.sum("n").alias("n")).withColumns(
        {"shared": shared, "base": F.col("conv") - F.col("conv") % GROUP}
    )
    bases = convs.where("conv = base").select("base", F.col("n").alias("base_n"))
    convs = convs.join(_sorted(bases), "base", "left").withColumn(
        "taken", F.least("shared", F.coalesce("base_n", F.lit(0)))
    )
    convs = convs.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("shared"), F.lit(0)))
    convs = written(convs.select("conv", "base", "shared", "taken", "length"))
    numbered = turns.join(_sorted(spans.join(_sorted(convs), "conv")), ["conv", "part"]).withColumn(
        "number", F.col("at") + F.col("before") + 1
    )
    own = numbered.where("number > shared").select(
        "conv", "part", (F.col("number") - F.col("shared") + F.col("taken")).alias("depth"),
        "said", "chars", "length",
    )
    heads = numbered.where(f"conv = base AND number < {MOST_SHARED}").select("base", "number", "said", "chars")
    given = (
        convs.where("taken > 0")
        .join(_sorted(heads), "base")
        .where("number <= taken")
        .select("conv", F.lit(-1).cast("long").alias("part"), F.col("number").alias("depth"), "said", "chars", "length")
    )
    return own.union(given), convs.select("conv", "length")


def named_prefixes(turns: DataFrame) -> DataFrame:
    """Each rebuilt turn with the names of the prefix it ends and of the one before."""
    one, other = F.xxhash64("depth", "said"), F.xxhash64("said", "depth")
    low = F.lit(0xFFFFFFFF).cast("long")
    pieces = [one.bitwiseAND(low), F.shiftrightunsigned(one, 32), other.bitwiseAND(low), F.shiftrightunsigned(other, 32)]
    hashed = turns.select("*", *(p.alias(f"own_{s}") for p, s in zip(pieces, _SUMS)))
    here = Window.partitionBy("conv", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = hashed.select("*", *(F.sum(f"own_{s}").over(here).alias(s) for s in _SUMS))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = hashed.groupBy("conv", "part").agg(*(F.sum(f"own_{s}").alias(s) for s in _SUMS))
    parts = parts.select(
        "conv", "part", *(F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"before_{s}") for s in _SUMS)
    )
    whole = running.join(_sorted(parts), ["conv", "part"])

    def name(depth: Column, sums: list[Column]) -> Column:
        return F.md5(F.concat_ws(".", *(c.cast("string") for c in (depth, *sums))))

    sums = [F.col(s) + F.col(f"before_{s}") for s in _SUMS]
    return whole.select(
        "conv",
        "depth",
        "chars",
        "length",
        name(F.col("depth"), sums).alias("node"),
        name(F.col("depth") - 1, [s - F.col(f"own_{n}") for s, n in zip(sums, _SUMS)]).alias("parent"),
    )


def subtree_sums(tree: DataFrame, values: Sequence[str]) -> DataFrame:
    """(id, *values) summed over the subtree of each node of a forest of (id, parent, *values).

    Ids are unique, roots have no parent. `edge` sums are what was taken out between a node and
    its present parent. A round is one job: what goes in it is read from what it wrote.
    """
    edges = [f"edge_{v}" for v in values]
    nothing = [F.lit(0).cast("long").alias(e) for e in edges]
    kids = tree.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("kids"))
    alive = written(
        tree.join(_sorted(kids), "id", "left").select(
            "id", "parent", *values, *nothing, F.coalesce("kids", F.lit(0)).alias("kids")
        )
    )
    raked, spliced = [], []
    while not alive.isEmpty():
        # what leaves add to a parent, and the children that are left to it
        leaf = F.col("kids") == 0
        below = alive.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(
            F.count_if(~leaf).alias("left"),
            F.min(F.when(~leaf, F.col("id"))).alias("only"),
            *(F.sum(F.when(leaf, F.col(v) + F.col(e)).otherwise(0)).alias(f"add_{v}") for v, e in zip(values, edges)),
        )
        rank = lambda c: F.xxhash64(F.lit(len(raked)), c)
        peak = (rank(F.col("id")) > rank(F.col("parent"))) & (rank(F.col("id")) > rank(F.col("only")))
        raised = alive.join(_sorted(below), "id", "left").select(
            "id", "parent", "only", *edges,
            *((F.col(v) + F.coalesce(f"add_{v}", F.lit(0))).alias(v) for v in values),
            F.coalesce("left", F.lit(0)).alias("left"),
            leaf.alias("leaf"),
            F.coalesce((F.col("left") == 1) & F.col("parent").isNotNull() & peak, F.lit(False)).alias("gone"),
        )
        gone = raised.where("gone").select(
            F.col("only").alias("id"), F.col("id").alias("above"), F.col("parent").alias("higher"),
            *(F.col(v).alias(f"above_{v}") for v in values),
            *((F.col(v) + F.col(e)).alias(f"more_{v}") for v, e in zip(values, edges)),
        )
        hung = written(raised.where("NOT gone").join(_sorted(gone), "id", "left"))
        raked.append(hung.where("leaf").select("id", *values))
        spliced.append(
            hung.where("above IS NOT NULL").select(
                F.col("above").alias("id"),
                F.col("id").alias("to"),
                *((F.col(f"above_{v}") + F.col(e)).alias(v) for v, e in zip(values, edges)),
            )
        )
        alive = hung.where("NOT leaf").select(
            "id",
            F.coalesce("higher", "parent").alias("parent"),
            *values,
            *((F.col(e) + F.coalesce(f"more_{v}", F.lit(0))).alias(e) for v, e in zip(values, edges)),
            F.col("left").alias("kids"),
        )
        tidy(tree.sparkSession)
    if not raked:
        return tree.select("id", *values)
    # on disk, as the plan of a union of dozens of frames is told anew after each of its stages
    done = written(reduce(DataFrame.union, raked))
    # a node taken out points to the one it hung above, which may have been taken out later:
    # pointers are doubled until they end at a raked node
    back = written(reduce(DataFrame.union, spliced))
    while True:
        ends = back.select(F.col("id").alias("to"), F.col("to").alias("next"), *(F.col(v).alias(f"add_{v}") for v in values))
        further = written(back.join(_sorted(ends), "to", "left"))
        if further.where("next IS NOT NULL").isEmpty():
            break
        back = further.select(
            "id",
            F.coalesce("next", "to").alias("to"),
            *((F.col(v) + F.coalesce(f"add_{v}", F.lit(0))).alias(v) for v in values),
        )
    totals = done.select(F.col("id").alias("to"), *(F.col(v).alias(f"add_{v}") for v in values))
    put_back = back.join(_sorted(totals), "to")
    return written(done.union(put_back.select("id", *((F.col(v) + F.col(f"add_{v}")).alias(v) for v in values))))


def joined_ids(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) from (node, conv): the ids of a node, ascending and comma-joined."""

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[tuple[str, int, str]] = []
            start = 0
            for i in range(1, len(nodes) + 1):
                if i == len(nodes) or nodes[i] != nodes[start]:
                    out.append((nodes[start], ids[start], ",".join(map(str, ids[start:i]))))
                    start = i
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["node", "first", "ids"])

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, sha256()
        for batch in batches:
            done = []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        done.append((node, digest.hexdigest()))
                    node, digest = name, sha256()
                digest.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([digest.hexdigest()])], ["node", "ends_sha256"])

    ship(ends.sparkSession)
    sorted_ = ends.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")
    parts = sorted_.mapInArrow(runs, "node string, first bigint, ids string")
    met = parts.repartition("node").sortWithinPartitions("node", "first").select("node", "ids")
    return met.mapInArrow(digests, "node string, ends_sha256 string")


def prefix_trie(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256. A node is known by its depth and its smallest conversation."""
    turns, convs = rebuilt(numbered_turns(rows, conv, turn, role, text))
    prefixes = written(named_prefixes(turns))
    tidy(rows.sparkSession)
    root = F.md5(F.lit("0.0.0.0.0"))
    nodes = prefixes.groupBy("node").agg(
        F.min("parent").alias("parent"),
        F.min("depth").alias("depth"),
        F.min("conv").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min("chars").alias("chars"),
    )
    top = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    top = top.select(
        root.alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"),
        "conv_id", "n_convs", F.lit(0).cast("long").alias("chars"),
    )
    nodes = written(nodes.union(top))
    kids = nodes.where("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children"))
    kids = kids.withColumnRenamed("parent", "node")
    known = written(nodes.join(_sorted(kids), "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))

    parents = known.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    many = known.count() // BUSY_SHARE
    busy = F.broadcast(parents.where(F.col("n_children") > many).drop("n_children"))
    quiet = parents.where((F.col("n_children") > 0) & (F.col("n_children") <= many)).drop("n_children")
    looked = known.join(busy, "parent", "left")
    found = looked.where("parent_conv_id IS NOT NULL OR parent IS NULL").unionByName(
        looked.where("parent_conv_id IS NULL AND parent IS NOT NULL").drop("parent_conv_id").join(_sorted(quiet), "parent")
    )

    leaves = (F.col("n_children") == 0).cast("long")
    saved = (F.col("n_convs") - 1) * F.col("chars")
    tree = known.select(F.col("node").alias("id"), "parent", leaves.alias("n_leaves"), saved.alias("saved_tokens"))
    sums = subtree_sums(tree, ["n_leaves", "saved_tokens"]).withColumnRenamed("id", "node")
    found = written(found)
    tidy(rows.sparkSession)
    ends = prefixes.where("depth = length").select("node", "conv").union(
        convs.where("length = 0").select(root, "conv")
    )
    return (
        found.join(_sorted(sums), "node")
        .join(_sorted(joined_ids(ends)), "node", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
