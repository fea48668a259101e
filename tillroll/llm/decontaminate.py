"""Words of documents that repeat windows of benchmark items, by a prefix-filtered join.

A window is `size` consecutive words of an item (a shorter item is one window). Each window
is a set of shingles of up to three words, ordered by rarity over all documents. A document
that holds a window holds all of its shingles, so the necessary prefix is one shingle, the
rarest. Only places where a document has that shingle are candidates; the position of the
shingle in the window gives the place the window must start at, which has to leave room for
its length. Candidates are verified word by word.

Windows are taken in blocks of a bounded number, so what is sent to the executors does not
grow with the benchmark; each block is one more map over the documents, without a shuffle.

Null and empty texts have no words, no hits and are not contaminated. Repeated rows give
repeated rows. Without items nothing is hit. Items with equal windows all count.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import LOWER_ASCII, map_rows, ship, utf8
from tillroll.sources.shared import stage

#: Windows whose words are sent to the executors at once.
WINDOWS_PER_BLOCK = 200_000
#: Words of all windows of a block: the numbers of SHINGLE words must fit 63 bits.
WORDS_PER_BLOCK = 1_900_000
#: Candidates verified in one comparison.
CANDIDATES_PER_CALL = 50_000
SHINGLE = 3

_WORDS = bytes(
    b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in LOWER_ASCII
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits and of anything beyond ASCII."""
    return utf8(text).translate(_WORDS).split()


def item_windows(items: DataFrame, size: int, key: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item, win, words): win is a hash of the words, which stand with a space between."""

    def make():
        def work(keys, texts):
            ids, wins = [], []
            for k, t in zip(keys, texts):
                words = words_of(t)
                for i in range(max(len(words) - size + 1, bool(words))):
                    ids.append(k)
                    wins.append(b" ".join(words[i : i + size]).decode("utf-8", "surrogatepass"))
            return ids, wins

        return work

    found = map_rows(items, [F.col(key).cast("string"), text], "item string, words string", make)
    return found.distinct().withColumn("win", F.xxhash64("words"))


@dataclass
class Block:
    """Some windows: words as numbers, keys, and the distinct shingles by length."""

    vocabulary: dict[bytes, int]
    keys: np.ndarray
    windows: list[np.ndarray]
    shingles: dict[int, np.ndarray]

    @classmethod
    def of(cls, keys: list[int], texts: list[str]) -> Block:
        vocabulary: dict[bytes, int] = {}
        windows = [
            np.array([vocabulary.setdefault(w, len(vocabulary)) for w in utf8(t).split()], np.int64)
            for t in texts
        ]
        block = cls(vocabulary, np.array(keys, np.int64), windows, {})
        for k in sorted({min(SHINGLE, len(w)) for w in windows}):
            codes = [block.codes(w, k) for w in windows if min(SHINGLE, len(w)) == k]
            block.shingles[k] = np.unique(np.concatenate(codes))
        return block

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Words as numbers, -1 for those in no window."""
        return np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))

    def codes(self, numbers: np.ndarray, k: int) -> np.ndarray:
        """Shingles of k words as one number each, -1 where a word is in no window."""
        n = max(len(numbers) - k + 1, 0)
        code, absent = np.zeros(n, np.int64), np.zeros(n, bool)
        for j in range(k):
            part = numbers[j : j + n]
            code = code * len(self.vocabulary) + part
            absent |= part < 0
        return np.where(absent, -1, code)

    def found(self, numbers: np.ndarray, k: int, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of a text whose shingle is among the sorted ones given, and which it is."""
        codes = self.codes(numbers, k)
        places = np.flatnonzero(codes >= 0)
        at = np.minimum(np.searchsorted(among, codes[places]), len(among) - 1)
        same = among[at] == codes[places]
        return places[same], at[same]


@dataclass
class Index:
    """The rarest shingle of each window: which windows it leads to, and where in them it is."""

    block: Block
    prefixes: dict[int, np.ndarray]
    starts: dict[int, np.ndarray]
    window: dict[int, np.ndarray]
    offset: dict[int, np.ndarray]

    @classmethod
    def of(cls, block: Block, frequency: dict[int, np.ndarray]) -> Index:
        index = cls(block, {}, {}, {}, {})
        rarest: dict[int, list[tuple[int, int, int]]] = {k: [] for k in block.shingles}
        for w, window in enumerate(block.windows):
            k = min(SHINGLE, len(window))
            codes = block.codes(window, k)
            counts = frequency[k][np.searchsorted(block.shingles[k], codes)]
            at = np.lexsort((codes, counts))[0]
            if counts[at]:  # else no document has it
                rarest[k].append((codes[at], w, at))
        for k, rows in rarest.items():
            table = np.array(sorted(rows), np.int64).reshape(-1, 3)
            index.prefixes[k], starts = np.unique(table[:, 0], return_index=True)
            index.starts[k] = np.append(starts, len(table))
            index.window[k], index.offset[k] = table[:, 1], table[:, 2]
        index.lengths = np.array([len(w) for w in block.windows], np.int64)
        index.padded = np.full((len(block.windows), max(index.lengths, default=0)), -1, np.int64)
        for w, window in enumerate(block.windows):
            index.padded[w, : len(window)] = window
        return index

    def matches(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows in a text and the places they start at."""
        wins, starts = [], []
        for k, prefixes in self.prefixes.items():
            if not len(prefixes):
                continue
            places, which = self.block.found(numbers, k, prefixes)
            first, last = self.starts[k][which], self.starts[k][which + 1]
            # places that lead to few windows go together, a few at a time
            done, total = 0, np.cumsum(last - first)
            while done < len(places):
                before = total[done - 1] if done else 0
                upto = max(np.searchsorted(total, before + CANDIDATES_PER_CALL, "right"), done + 1)
                counts = (last - first)[done:upto]
                row = np.repeat(first[done:upto] - (np.cumsum(counts) - counts), counts)
                row += np.arange(len(row))
                win = self.window[k][row]
                start = np.repeat(places[done:upto], counts) - self.offset[k][row]
                fits = (start >= 0) & (start + self.lengths[win] <= len(numbers))
                win, start = win[fits], start[fits]
                for length in np.unique(self.lengths[win]):
                    mine = self.lengths[win] == length
                    w, s = win[mine], start[mine]
                    same = (numbers[s[:, None] + np.arange(length)] == self.padded[w, :length]).all(1)
                    wins.append(w[same])
                    starts.append(s[same])
                done = upto
        if not wins:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(wins), np.concatenate(starts)


def shingle_frequency(docs: DataFrame, text: str, held) -> dict[int, np.ndarray]:
    """In how many documents each shingle of a block occurs. One row a task and shingle is
    shuffled; what comes back is as large as the block."""

    def count(batches):
        import pyarrow as pa

        block = held.value
        sums = {k: np.zeros(len(s), np.int64) for k, s in block.shingles.items()}
        for batch in batches:
            for t in batch.column(0):
                numbers = block.numbers(words_of(t.as_py()))
                for k, among in block.shingles.items():
                    sums[k][np.unique(block.found(numbers, k, among)[1])] += 1
        for k, s in sums.items():
            there = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(there), k, np.int32)), pa.array(there), pa.array(s[there])],
                names=["k", "at", "n"],
            )

    ship(docs.sparkSession)
    rows = (
        docs.select(text)
        .mapInArrow(count, "k int, at bigint, n bigint")
        .groupBy("k", "at")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    sums = {k: np.zeros(len(s), np.int64) for k, s in held.value.shingles.items()}
    for k, mine in rows.groupby("k"):
        sums[k][mine["at"].to_numpy()] = mine["n"].to_numpy()
    return sums


def overlaps(
    docs: DataFrame, items: DataFrame, size: int = 13, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row of `docs`: key, the columns of `carry`, n_words, n_hit, hits and wins.

    hits are word ranges [start, end, start, end, ...]; wins are the windows found, by hash.
    """
    context = docs.sparkSession.sparkContext
    windows = item_windows(items, size, item_key, item_text).select("win", "words").distinct()
    # at least as many blocks as the bound asks for; which window is where depends on its hash
    per_block = max(min(WINDOWS_PER_BLOCK, WORDS_PER_BLOCK // size), 1)
    blocks = max(math.ceil(windows.count() / per_block), 1)
    out = docs.select(
        key, *carry, F.col(text).alias("_text"),
        F.array().cast("array<int>").alias("_hits"), F.array().cast("array<bigint>").alias("_wins"),
    )
    kept = [key, *carry]
    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    for b in range(blocks):
        mine = windows.where(F.pmod(F.xxhash64(F.lit(7), "win"), F.lit(blocks)) == b).toPandas()
        block = Block.of(mine["win"].tolist(), mine["words"].tolist())
        held = context.broadcast(block)
        index = context.broadcast(Index.of(block, shingle_frequency(docs, text, held)))

        def make(index=index, last=b == blocks - 1):
            found = index.value

            def work(*columns):
                *same, texts, hits, wins = columns
                n_words = []
                for i, t in enumerate(texts):
                    numbers = found.block.numbers(words_of(t))
                    n_words.append(len(numbers))
                    win, start = found.matches(numbers)
                    if len(win):
                        ends = start + found.lengths[win]
                        old = np.array(hits[i], np.int64).reshape(-1, 2)
                        edges = np.zeros(len(numbers) + 2, np.int64)
                        np.add.at(edges, np.append(start, old[:, 0]) + 1, 1)
                        np.add.at(edges, np.append(ends, old[:, 1]) + 1, -1)
                        hits[i] = np.flatnonzero(np.diff(np.cumsum(edges) > 0)).tolist()
                        wins[i] = sorted({*wins[i], *found.block.keys[win].tolist()})
                if not last:
                    return *same, texts, hits, wins
                return *same, n_words, [sum(h[1::2]) - sum(h[::2]) for h in hits], hits, wins

            return work

        counts = "n_words bigint, n_hit bigint, hits array<int>, wins array<bigint>"
        on = "_text string, _hits array<int>, _wins array<bigint>"
        schema = f"{types}, {counts if b == blocks - 1 else on}"
        out = map_rows(out, [*kept, "_text", "_hits", "_wins"], schema, make)
    return out


def contaminated() -> Column:
    """The rule: something is hit, and at least a twentieth of the words."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def report(
    docs: DataFrame, items: DataFrame, size: int = 13, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per row of `docs`: key, n_words, n_hit, n_items, items_sha256 and contaminated.

    Documents with the same set of windows share one look-up of its items, so a passage in
    a third of all documents is resolved once.
    """
    found = stage(
        overlaps(docs, items, size, key, text, item_key, item_text)
        .withColumn("same", F.sha2(F.array_join("wins", ","), 256))
        .drop("hits")
    )
    members = item_windows(items, size, item_key, item_text).select("win", "item")
    sets = (
        found.where(F.size("wins") > 0)
        .groupBy("same")
        .agg(F.first("wins").alias("wins"))
        .select("same", F.explode("wins").alias("win"))
        .join(members, "win")
        .groupBy("same")
        .agg(F.sort_array(F.collect_set("item")).alias("its"))
        .select("same", F.size("its").cast("long").alias("n_items"), F.array_join("its", ",").alias("its"))
    )
    clean = found.where(F.size("wins") == 0).withColumns(
        {"n_items": F.lit(0).cast("long"), "its": F.lit("")}
    )
    hit = found.where(F.size("wins") > 0).join(sets, "same")
    return clean.unionByName(hit).select(
        key,
        "n_words",
        "n_hit",
        "n_items",
        F.sha2("its", 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )

