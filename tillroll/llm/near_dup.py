"""Near-duplicate documents by one-permutation hashing, with links confirmed on full sets.

1. A document's set is its distinct five-word shingles, hashed to 64 bits. One permutation
   splits the hashes over bins, and each bin keeps its smallest. Empty bins are densified
   optimally: each looks at bins in a random order of its own, the same for all documents,
   and copies the first that is filled.
2. Documents with equal sets are one class, whose smallest id stands for it. Grouping adds up
   in the map tasks first, so a class with a third of all rows is no hot key.
3. Bands of bins are bucket keys. In a bucket every class is a candidate of the smallest one
   only: a star, so a bucket of n has n - 1 candidate pairs. Sets of few shingles, where bins
   say little, also take their prefix shingles as keys, which no link of two such sets misses.
4. Candidates are confirmed on the full sets, and links give components.
5. A star is not enough where a bucket still holds two components: members may be linked with
   each other though not with the centre. For the members of such buckets alone a prefix
   filter on shingles ordered by rarity finds all their links, between components only.

Null and empty texts have no shingles and are linked with nothing. A text of fewer than five
words has one shingle, all of it. Equal rows are copies of each other. Rows that repeat an id
are linked as one document. A row without an id gets no component and is kept.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import LOWER_ASCII, map_rows, mix, tidy, utf8, word_hashes, written

WORDS = 5
BANDS = 40
ROWS = 5
BINS = BANDS * ROWS
#: Sets up to this size also take prefix shingles as keys.
SMALL_SET = 42
#: Bins that an empty bin looks at in random order before it takes the next filled one.
TRIES = 512

#: One for each word of a shingle, and one for each number of words under that.
_SALTS = mix(np.arange(101, 101 + 2 * WORDS, dtype=np.uint64)) | np.uint64(1)
_BAND_SALTS = mix(np.arange(501, 501 + ROWS, dtype=np.uint64)) | np.uint64(1)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = word_hashes(utf8(text).translate(LOWER_ASCII))
    if not len(words):
        return words
    if len(words) < WORDS:
        salted = np.append(words * _SALTS[: len(words)], _SALTS[WORDS + len(words)])
        return mix(salted.sum(dtype=np.uint64, keepdims=True))
    total = np.zeros(len(words) - WORDS + 1, np.uint64)
    for j in range(WORDS):
        total += words[j : len(words) - WORDS + 1 + j] * _SALTS[j]
    return np.unique(mix(total))


@cache
def _order() -> np.ndarray:
    """For each bin the order in which it looks at others when it is empty."""
    seeds = np.arange(BINS * TRIES, dtype=np.uint64) + np.uint64(1 << 40)
    return (mix(seeds) % np.uint64(BINS)).astype(np.int64).reshape(BINS, TRIES)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The smallest hash of each bin, empty bins filled."""
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    filled, first = np.unique(bins, return_index=True)  # sorted hashes: a bin is a run
    out = np.zeros(BINS, np.uint64)
    out[filled] = hashes[first]
    there = np.zeros(BINS, bool)
    there[filled] = True
    empty = np.flatnonzero(~there)
    looked = there[_order()[empty]]
    hit = looked.any(axis=1)
    source = _order()[empty, looked.argmax(axis=1)]
    source[~hit] = filled[np.searchsorted(filled, empty[~hit]) % len(filled)]
    out[empty] = out[source]
    return out


def bucket_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys under which a set looks for others."""
    rows = signature(hashes).reshape(BANDS, ROWS)
    keys = mix((rows * _BAND_SALTS).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
    if len(hashes) <= SMALL_SET:
        keys = np.append(keys, mix(hashes[: len(hashes) // 4 + 1] ^ np.uint64(0x5DEECE66D)))
    return keys


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: id, n_shingles, cls (a name of the set, null when empty) and its bucket keys."""

    def make():
        def work(ids, texts):
            sizes, names, keys = [], [], []
            for t in texts:
                hashes = shingle_set(t)
                sizes.append(len(hashes))
                if len(hashes):
                    total = mix(hashes + np.uint64(1)).sum(dtype=np.uint64)
                    names.append(f"{hashes.sum(dtype=np.uint64):x}.{total:x}.{len(hashes):x}")
                    keys.append(_signed(bucket_keys(hashes)))
                else:
                    names.append(None)
                    keys.append(None)
            return ids, sizes, names, keys

        return work

    kind = docs.schema[key].dataType.simpleString()
    schema = f"id {kind}, n_shingles bigint, cls string, keys array<bigint>"
    return map_rows(docs, [key, text], schema, make)


def confirmed(pairs: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough. b may be in very many pairs."""
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("words"))
    wide = (
        pairs.join(texts.select(F.col("id").alias("a"), F.col("words").alias("text_a")), "a")
        .join(texts.select(F.col("id").alias("b"), F.col("words").alias("text_b")), "b")
    )
    kind = docs.schema[key].dataType.simpleString()

    def make():
        last: list = [None, None]  # the centre of a star comes many times in a row

        def work(a, b, text_a, text_b):
            similar = []
            for x, y in zip(text_a, text_b):
                if y != last[0]:
                    last[:] = y, shingle_set(y)
                one, other = shingle_set(x), last[1]
                both = len(np.intersect1d(one, other, assume_unique=True))
                union = len(one) + len(other) - both
                similar.append(100 * both >= 75 * union and both > 0)
            return a, b, similar

        return work

    schema = f"a {kind}, b {kind}, similar boolean"
    return map_rows(wide, ["a", "b", "text_a", "text_b"], schema, make).where("similar").drop("similar")


def _sorted(df: DataFrame) -> DataFrame:
    """The side of a join in a loop, to be shuffled and sorted at any size: the driver would
    hold a broadcast table for each round."""
    return df.hint("merge")


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in the links (a, b): root is the smallest id it is linked with.

    Every id hooks on to its smallest neighbour, hooks are followed to their ends by doubling,
    and links are redrawn between those, until none is left. At least half of the ids go in
    each round, so there are about log n of them; a star takes one.
    """
    left = written(links.select("a", "b").where("a <> b").distinct())
    ids = left.select(F.col("a").alias("id")).union(left.select("b")).distinct()
    roots = ids.withColumn("root", F.col("id"))
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("root")).agg(F.min("b").alias("low"))
        hooks = written(hooks.select("root", F.least("root", "low").alias("to")))
        while True:
            ends = hooks.select(F.col("root").alias("to"), F.col("to").alias("end"))
            further = written(hooks.join(_sorted(ends), "to").select("root", "to", "end"))
            hooks = further.select("root", F.col("end").alias("to"))
            if further.where("end <> to").isEmpty():
                break
        roots = written(
            roots.join(_sorted(hooks), "root", "left").select("id", F.coalesce("to", "root").alias("root"))
        )
        left = written(
            left.join(_sorted(hooks.select(F.col("root").alias("a"), F.col("to").alias("x"))), "a")
            .join(_sorted(hooks.select(F.col("root").alias("b"), F.col("to").alias("y"))), "b")
            .where("x <> y")
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
            .distinct()
        )
        tidy(left.sparkSession)
    return roots


def remaining_links(
    buckets: DataFrame, roots: DataFrame, docs: DataFrame, key: str, text: str
) -> DataFrame:
    """Links between different components among classes that share a bucket.

    `buckets` has (bucket, id). Shingles that only one class has come first in the order of
    rarity and lead to no pair, so they are counted and not kept.
    """
    named = buckets.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = (
        named.groupBy("bucket")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low <> high")
    )
    open_ids = written(named.join(mixed, "bucket").select("id", "root").distinct())
    if open_ids.isEmpty():
        return open_ids.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(open_ids, "id")
    kind = docs.schema[key].dataType.simpleString()

    def make():
        def work(ids, roots_, texts_):
            sets = [shingle_set(t) for t in texts_]
            return ids, roots_, [_signed(s) for s in sets]

        return work

    sets = map_rows(
        texts, ["id", "root", "text"], f"id {kind}, root {kind}, tokens array<bigint>", make
    )
    tokens = sets.select("id", "root", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    # a token of one component only leads to no pair between components
    counts = tokens.groupBy("token").agg(
        F.count("*").alias("df"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    shared = (
        tokens.join(counts.where("low <> high").select("token", "df"), "token")
        .groupBy("id", "root", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
    )
    # tokens that no other component has are taken as the rarest: they fill the prefix first
    own = F.col("n") - F.size("shared")
    prefix = F.floor(F.col("n") / 4) + 1 - own
    heads = (
        shared.where(prefix > 0)
        .select("id", "root", "n", own.alias("own"), F.slice("shared", 1, prefix.cast("int")).alias("head"))
        .select("id", "root", "n", F.posexplode("head.token").alias("place", "token"), "own")
        .withColumn("place", F.col("place") + F.col("own"))
    )
    heads = written(heads.drop("own"))
    tidy(docs.sparkSession)
    # A pair of 0.75 shares 3/7 of both sizes. Its first common token therefore leaves that much
    # behind it in both sets, which rules out most sizes before any pair is made: a token far
    # back leads to smaller sets only, and those must have it further ahead.
    share = 3 * (F.col("n") + F.col("n_b"))
    sizes = heads.groupBy("token", F.col("n").alias("n_b")).agg(F.min("place").alias("place_b"))
    reach = (
        heads.join(sizes, "token")
        .where((7 * (F.col("n") - F.col("place")) >= share) & (7 * (F.col("n_b") - F.col("place_b")) >= share))
        .select(F.col("id").alias("a"), F.col("root").alias("root_a"), "n", "token", "n_b")
    )
    other = heads.select(
        "token",
        F.col("n").alias("n_b"),
        F.col("id").alias("b"),
        F.col("root").alias("root_b"),
        F.col("place").alias("place_b"),
    )
    pairs = (
        reach.join(other, ["token", "n_b"])
        .where((F.col("a") > F.col("b")) & (F.col("root_a") != F.col("root_b")))
        .where(7 * (F.col("n_b") - F.col("place_b")) >= share)
        .select("a", "b")
        .distinct()
    )
    return confirmed(pairs, docs, key, text)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: key, n_shingles, component_id and kept."""
    rows = written(sketches(docs, key, text))
    classes = (
        rows.where("cls is not null and id is not null")
        .groupBy("cls")
        .agg(F.min("id").alias("rep"), F.min_by("keys", "id").alias("keys"))
    )
    classes = written(classes)
    keyed = classes.select(F.col("rep").alias("id"), F.explode("keys").alias("bucket"))
    centres = (
        keyed.groupBy("bucket")
        .agg(F.min("id").alias("centre"), F.max("id").alias("last"))
        .where("centre <> last")
        .select("bucket", "centre")
    )
    buckets = written(keyed.join(centres, "bucket"))
    stars = buckets.where("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b"))
    links = written(confirmed(stars.distinct(), docs, key, text))
    tidy(docs.sparkSession)
    more = remaining_links(buckets.select("bucket", "id"), components(links), docs, key, text)
    roots = components(links.union(more))
    named = classes.select("cls", "rep").join(
        roots.select(F.col("id").alias("rep"), "root"), "rep", "left"
    )
    named = named.select("cls", F.coalesce("root", "rep").alias("component"))
    own: Column = F.coalesce("component", "id")
    return rows.join(named, "cls", "left").select(
        F.col("id").alias(key),
        "n_shingles",
        F.when(F.col("id").isNotNull(), own).alias("component_id"),
        F.coalesce(own == F.col("id"), F.lit(True)).alias("kept"),
    )
