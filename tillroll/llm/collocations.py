r"""Phrases whose words come together far more often than apart, counted in tries that spill.

Counting is done by a trie over word ids with hash containers under it. A container takes the
rest of a phrase under its first words; when it is full it bursts into containers one word
deeper, so the trie stays shallow where phrases are few. When the trie of a task holds too much,
its largest subtrees leave whole as sorted runs, and runs are added up per prefix partition: by
the language and the first three words of a phrase, so that neither a language nor a frequent
word or pair of words is one task.

A phrase can be frequent only if all its parts are, and most phrases are not. Before the trie
counts, words, then pairs of frequent words, then triples of frequent pairs are counted by
hashes alone: sorted runs of slots and counts, of three bytes or so a phrase, are added up per
range of slots. What reaches the count goes into a bit map of fixed size, the only thing that
is broadcast. Phrases that share a slot or a bit let one another through and no more: the trie
counts what is let through exactly, and the rare ones go at the end.

Scores are exact: decimals hold them up to 10**15 occurrences of a phrase and 10**16 words.

Words are runs of anything but space and tab, pieces end at `.,;:!?` and line ends, and A-Z are
lower-cased. Null and empty texts have no words, a null language is `und`. Equal rows count
again. Long texts are worked on in blocks; a phrase may reach across blocks, never across
pieces or texts. Ties in score go to the more frequent phrase, then to the first in byte order.
An empty table gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm.common import mix, ship
from tillroll.sources.shared import stage

MIN_COUNT = 100
LONGEST = 5
#: Rows of the result for a language.
TOP = 2000
#: Phrases that a container takes before it bursts.
BURST = 4096
#: Phrases that the trie, or slots that the runs, of a task hold before some leave it.
HELD = 600_000
SLOTS_HELD = 3_000_000
#: Words, and bytes of words, that a task numbers before it starts again.
WORDS_HELD = 400_000
WORD_BYTES_HELD = 64 << 20
#: Bytes of text that are cut into words at once.
BLOCK = 1 << 21
#: Bits of a slot, and of the map of frequent phrases: 8 MB, however many phrases there are.
SLOT_BITS = 40
MAP_BITS = 26
#: Words of the longest phrases that are counted by slots first.
SIFTED = 3
#: Ranges of slots are four for each task, up to so many.
MOST_RANGES_BITS = 16
#: Parts of a language that are ranked side by side before their best are ranked together.
SALTS = 32

_BREAK = 0xFF  # in no text, as UTF-8 has no such byte
_MAPPED = bytes(
    b + 32 if 65 <= b <= 90 else _BREAK if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b
    for b in range(256)
)
_END = bytes([_BREAK])  # of the language in a key


class Node(dict):
    """An inner node: the next word id, as four bytes, to a node or a container."""


#: Bytes of a key that the trie takes at its root: the language's id and all but one byte of the
#: first word's, so that a container there is shared by 256 words until it bursts.
_TOP = 7


class HatTrie:
    """Counts of phrases, given as a language's id and word ids of four bytes each."""

    def __init__(self, burst: int = BURST) -> None:
        self.burst = burst
        self.root: dict[bytes, Node | dict] = {}
        self.size = 0

    def add(self, counts: dict[bytes, int]) -> None:
        root, burst, fresh = self.root, self.burst, 0
        for key, n in counts.items():
            name, at = key[:_TOP], _TOP
            above, held = root, root.get(name)
            while held.__class__ is Node:
                step = at + (1 if at == _TOP else 4)
                above, name, at = held, key[at:step], step
                held = above.get(name)
            if held is None:
                held = above[name] = {}
            rest = key[at:]
            if rest in held:
                held[rest] += n
                continue
            held[rest] = n
            fresh += 1
            if len(held) > burst and rest:
                above[name] = self._burst(held, 1 if at == _TOP else 4)
        self.size += fresh

    @staticmethod
    def _burst(container: dict[bytes, int], step: int) -> Node:
        node = Node()
        for rest, n in container.items():
            part = node.get(rest[:step])
            if part is None:
                part = node[rest[:step]] = {}
            part[rest[step:]] = n
        return node

    def _gather(self, at: bytes, held: Node | dict, keys: list[bytes], counts: list[int]) -> None:
        if held.__class__ is Node:
            for name, part in held.items():
                self._gather(at + name, part, keys, counts)
        else:
            keys += [at + rest for rest in held]
            counts += held.values()

    def _size(self, held: Node | dict) -> int:
        return sum(map(self._size, held.values())) if held.__class__ is Node else len(held)

    def take(self, down_to: int) -> tuple[list[bytes], list[int]]:
        """Remove whole subtrees, largest first, until no more than so many phrases are left:
        their keys and counts."""
        keys: list[bytes] = []
        counts: list[int] = []
        sizes = {top: self._size(held) for top, held in self.root.items()}
        for top in sorted(sizes, key=sizes.__getitem__, reverse=True):
            if self.size <= down_to:
                break
            self._gather(top, self.root.pop(top), keys, counts)
            self.size -= sizes[top]
        return keys, counts


def blocks(data: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """A text in parts that end between words."""
    start = 0
    while start < len(data):
        end = data.find(b" ", start + size)
        end = len(data) if end < 0 else end
        yield data[start:end]
        start = end


class Counting:
    """What a task of one pass holds: numbered words, and the trie over them or their slots."""

    def __init__(self, longest: int, maps: list[np.ndarray], held: int, burst: int) -> None:
        self.longest, self.maps, self.held = longest, maps, held
        self.trie = HatTrie(burst)
        self.totals: Counter[bytes] = Counter()
        self.slots: list[tuple[np.ndarray, np.ndarray]] = []
        self.slots_held = 0
        self._start()

    def _start(self) -> None:
        self.ids: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.ids[bytes([_BREAK])]
        self.names: list[bytes] = []
        self.hashes = np.zeros(1, np.uint64)
        self.bytes_held = 0

    def _numbered(self) -> None:
        """Names and hashes of the words that came since the last call."""
        known = len(self.names)
        fresh = list(islice(self.ids, known, None))
        self.names += fresh
        self.bytes_held += sum(map(len, fresh))
        made = mix(np.fromiter(map(zlib.crc32, fresh), np.uint64, len(fresh)))
        if len(self.names) > len(self.hashes):
            self.hashes = np.resize(self.hashes, 2 * len(self.names))
        self.hashes[known : len(self.names)] = made

    @staticmethod
    def salt(lang: bytes) -> np.uint64:
        return mix(np.array([zlib.crc32(lang) + 1], np.uint64))[0]

    def _hashed(self, ids: np.ndarray, n: int, salt: np.uint64) -> np.ndarray:
        """64 bits for the phrase of n words at each place."""
        one = self.hashes[ids]
        size = len(ids) - n + 1
        out = one[:size] + salt
        for k in range(1, n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + one[k : k + size]
        return mix(out)

    def _sifted(self, ids: np.ndarray, salt: np.uint64) -> Iterator[tuple[int, np.ndarray]]:
        """For each length of phrase where one starts whose parts, as far as is known, and which
        itself, may be frequent."""
        good = ids != 0
        for n in range(1, self.longest + 1):
            if n > 1:
                good = good[:-1] & good[1:]
            if not good.any():
                return
            if n <= len(self.maps):
                at = self._hashed(ids, n, salt)[good] >> np.uint64(64 - MAP_BITS)
                bits = self.maps[n - 1][at >> np.uint64(3)]
                good[good] = (bits >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            yield n, good

    def add(self, lang: str, data: bytes, by_slots: bool = False) -> None:
        """Count the phrases of text that was mapped and spaced, of one language."""
        tag = lang.encode("utf-8", "surrogatepass")
        salt = self.salt(tag)
        before = np.zeros(0, np.int64)
        for block in blocks(data):
            ids = np.fromiter(map(self.ids.__getitem__, block.split()), np.int64)
            lang_id = self.ids[b"\xfe" + tag]
            self._numbered()
            seen, ids = len(before), np.append(before, ids)
            self.totals[tag] += int(np.count_nonzero(ids[seen:]))
            for n, good in self._sifted(ids, salt):
                starts = np.flatnonzero(good)
                starts = starts[starts + n > seen]  # others ended in an earlier block
                if not len(starts):
                    continue
                if by_slots:
                    if n == self.longest:
                        self._add_slots(self._hashed(ids, n, salt)[starts] >> np.uint64(64 - SLOT_BITS))
                elif n == 1:  # most words repeat within a block, and numbers sort faster than bytes
                    words, times = np.unique(ids[starts], return_counts=True)
                    self.trie.add(dict(zip(self._keys(words[:, None], lang_id), times.tolist())))
                else:
                    self.trie.add(Counter(self._keys(ids[starts[:, None] + np.arange(n)], lang_id)))
            before = ids[len(ids) - self.longest + 1 :] if self.longest > 1 else before

    def _add_slots(self, slots: np.ndarray) -> None:
        found, times = np.unique(slots, return_counts=True)
        self.slots.append((found, times))
        self.slots_held += len(found)

    def slot_runs(self, range_bits: int) -> Iterator[pa.RecordBatch]:
        """All slots as sorted runs, a row for each range of slots."""
        if not self.slots:
            return
        slots, times = added(self.slots)
        self.slots, self.slots_held = [], 0
        ranges = slots >> np.uint64(SLOT_BITS - range_bits)
        starts = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1]))
        ends = np.append(starts[1:], len(slots))
        rows = [packed(slots[a:b], times[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ranges[starts].astype(np.int64)), pa.array(rows, pa.binary())], ["range", "run"]
        )

    @staticmethod
    def _keys(words: np.ndarray, lang_id: int) -> list[bytes]:
        """Rows of word ids as keys of the trie."""
        rows = np.empty((len(words), words.shape[1] + 1), ">u4")
        rows[:, 0] = lang_id
        rows[:, 1:] = words
        data, width = rows.tobytes(), 4 * rows.shape[1]
        return [data[i : i + width] for i in range(0, len(data), width)]

    def worn(self) -> bool:
        return len(self.ids) > WORDS_HELD or self.bytes_held > WORD_BYTES_HELD

    def runs(self, down_to: int, range_bits: int) -> Iterator[pa.RecordBatch]:
        """Subtrees as sorted runs, a row for each range of prefixes: keys, which are a language
        and a phrase, and their counts."""
        keys, counts = self.trie.take(down_to)
        by_size: dict[int, tuple[list[bytes], list[int]]] = defaultdict(lambda: ([], []))
        for key, n in zip(keys, counts):
            some = by_size[len(key)]
            some[0].append(key)
            some[1].append(n)
        name = self.names.__getitem__
        spelt_out, ranges, times = [], [], []
        for size, (some, n) in by_size.items():
            ids = np.frombuffer(b"".join(some), ">u4").reshape(-1, size // 4).astype(np.int64)
            langs, words = ids[:, 0].tolist(), ids[:, 1:]
            tags = {i: name(i)[1:] for i in set(langs)}
            head = {i: tag + _END for i, tag in tags.items()}
            spelt = [list(map(name, column)) for column in words.T.tolist()]
            phrases = spelt[0] if len(spelt) == 1 else map(b" ".join, zip(*spelt))
            spelt_out += [head[i] + p for i, p in zip(langs, phrases)]
            salt_of = {i: self.salt(tag) for i, tag in tags.items()}
            prefix = np.fromiter(map(salt_of.__getitem__, langs), np.uint64, len(langs))
            for k in range(min(words.shape[1], SIFTED)):
                prefix = prefix * np.uint64(0x9E3779B97F4A7C15) + self.hashes[words[:, k]]
            ranges.append(mix(prefix) >> np.uint64(64 - range_bits))
            times += n
        for tag, n in self.totals.items():  # all words of a language count as a phrase of none
            spelt_out.append(tag + _END)
            ranges.append(np.array([self.salt(tag) >> np.uint64(64 - range_bits)]))
            times.append(n)
        self.totals.clear()
        if spelt_out:
            at = np.concatenate(ranges).astype(np.int64)
            run = pa.table({"range": at, "key": pa.array(spelt_out, pa.binary()), "n": pa.array(times, pa.int64())})
            run = run.sort_by([("range", "ascending"), ("key", "ascending")]).combine_chunks()
            at = run["range"].to_numpy()
            starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            offsets = pa.array(np.append(starts, len(at)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, run[c].combine_chunks()) for c in ("key", "n")]
            yield pa.RecordBatch.from_arrays([pa.array(at[starts]), *lists], ["range", "keys", "counts"])


def added(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of slots and counts as one, slots ascending and counts added up."""
    slots, times = (np.concatenate(c) for c in zip(*runs))
    order = np.argsort(slots, kind="stable")
    slots, times = slots[order], times[order]
    first = np.flatnonzero(np.append(True, slots[1:] != slots[:-1]))
    return slots[first], np.add.reduceat(times, first)


def packed(slots: np.ndarray, times: np.ndarray) -> bytes:
    """A sorted run as steps and counts, like bytes side by side, which compresses well."""
    steps = np.diff(slots, prepend=np.uint64(0)).astype("<u8")
    planes = steps.view(np.uint8).reshape(-1, 8).T, times.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return b"".join(p.tobytes() for p in planes)


def unpacked(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(run) // 12
    bytes_ = np.frombuffer(run, np.uint8)
    steps = np.ascontiguousarray(bytes_[: 8 * n].reshape(8, n).T).view("<u8")[:, 0]
    return np.cumsum(steps, dtype=np.uint64), np.ascontiguousarray(bytes_[8 * n :].reshape(4, n).T).view("<u4")[:, 0].astype(np.int64)


def spaced(text: bytes) -> bytes:
    """A text with its words apart by spaces and a mark around each end of a piece."""
    mark = bytes([_BREAK])
    return text.translate(_MAPPED).replace(mark, b" " + mark + b" ")


def _run(texts: DataFrame, ddl: str, make: Callable[[], Counting], by_slots: bool, full, end) -> DataFrame:
    """Feed a `Counting` in each task, by language and in blocks. `full` gives what has to leave
    it after some work, `end` the rest; both take the task and whether its words are many."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = make()
        waiting: dict[str, list[bytes]] = defaultdict(list)
        size = 0

        def work() -> Iterator[pa.RecordBatch]:
            for lang, parts in waiting.items():
                task.add(lang, b" \xff ".join(parts), by_slots)
                yield from full(task)
            waiting.clear()
            if task.worn():
                yield from end(task)
                task._start()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = spaced(text.as_py())
                waiting[lang].append(data)
                size += len(data)
                if size > BLOCK:
                    yield from work()
                    size = 0
        yield from work()
        yield from end(task)

    ship(texts.sparkSession)
    return texts.mapInArrow(run, ddl)


def _broadcast(texts: DataFrame, maps: list[np.ndarray]) -> Callable[[], list[np.ndarray]]:
    sent = [texts.sparkSession.sparkContext.broadcast(m) for m in maps]
    return lambda: [m.value for m in sent]


def _range_bits(texts: DataFrame) -> int:
    """Ranges grow with the tasks that send to them, so what meets in one does not."""
    return min(max(texts.rdd.getNumPartitions() * 4, 64).bit_length(), MOST_RANGES_BITS)


def frequent_slots(texts: DataFrame, n: int, maps: list[np.ndarray], min_count: int) -> DataFrame:
    """Slots of phrases of n words that come often enough, among those the maps let through."""
    range_bits = _range_bits(texts)
    held = _broadcast(texts, maps)

    def full(task: Counting) -> Iterator[pa.RecordBatch]:
        if task.slots_held > SLOTS_HELD:
            yield from task.slot_runs(range_bits)

    runs = _run(
        texts, "range bigint, run binary", lambda: Counting(n, held(), HELD, BURST), True,
        full, lambda task: task.slot_runs(range_bits),
    )

    def merge(table: pa.Table) -> pa.Table:
        slots, times = added([unpacked(r.as_py()) for r in table.column("run")])
        return pa.table({"slot": slots[times >= min_count].astype(np.int64)})

    return runs.groupBy("range").applyInArrow(merge, "slot bigint")


def counted(
    texts: DataFrame, longest: int, maps: list[np.ndarray], min_count: int, held: int, burst: int
) -> DataFrame:
    """Frequent phrases among those the maps let through: lang, phrase, words and n. Rows of no
    words have all word occurrences of a language."""
    range_bits, sent = _range_bits(texts), _broadcast(texts, maps)

    def full(task: Counting) -> Iterator[pa.RecordBatch]:
        if task.trie.size > held:
            yield from task.runs(held // 2, range_bits)

    runs = _run(
        texts, "range bigint, keys array<binary>, counts array<bigint>",
        lambda: Counting(longest, sent(), held, burst), False, full, lambda task: task.runs(0, range_bits),
    )

    def merge(table: pa.Table) -> pa.Table:
        keys, n = (pc.list_flatten(table.column(c)) for c in ("keys", "counts"))
        sums = pa.table({"key": keys, "n": n}).group_by("key").aggregate([("n", "sum")])
        kept = [
            (*key.split(_END), n)
            for key, n in zip(sums["key"].to_pylist(), sums["n_sum"].to_pylist())
            if n >= min_count or key.endswith(_END)
        ]
        return pa.table(
            {
                "lang": pa.array([k[0].decode("utf-8", "surrogatepass") for k in kept], pa.string()),
                "phrase": pa.array([k[1] for k in kept], pa.binary()),
                "words": pa.array([k[1].count(b" ") + bool(k[1]) for k in kept], pa.int32()),
                "n": pa.array([k[2] for k in kept], pa.int64()),
            }
        )

    return runs.groupBy("range").applyInArrow(merge, "lang string, phrase binary, words int, n bigint")


def bit_map(slots: DataFrame) -> np.ndarray:
    """Slots as a map of fixed size."""
    bit = F.shiftright("slot", SLOT_BITS - MAP_BITS)
    parts = (
        slots.groupBy(F.shiftright(bit, 15).alias("part"))
        .agg(F.bitmap_construct_agg(bit.bitwiseAND(32767)).alias("bits"))
        .collect()
    )
    out = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    for part, bits in parts:
        out[part * 4096 : part * 4096 + 4096] |= np.frombuffer(bits, np.uint8)
    return out


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
    longest: int = LONGEST, held: int = HELD, burst: int = BURST,
) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases (lang, phrase, words, n) and all word occurrences (lang, n)."""
    texts = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.col(text).cast("string").cast("binary").alias("text"),
    )
    maps: list[np.ndarray] = []
    for n in range(1, min(SIFTED, longest) + 1):
        maps.append(bit_map(frequent_slots(texts, n, maps, min_count)))
    kept = stage(counted(texts, longest, maps, min_count, held, burst))
    totals = kept.where("words = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    phrases = kept.where("words > 0").select("lang", F.col("phrase").cast("string").alias("phrase"), "words", "n")
    return phrases, totals


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
    longest: int = LONGEST, top: int | None = TOP, held: int = HELD, burst: int = BURST,
) -> DataFrame:
    """Per language its phrases by score: lang, rank, phrase, a, l, r, n and score."""
    frequent, totals = phrase_counts(docs, text, lang, min_count, longest, held, burst)
    salted = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = salted.withColumnRenamed("n", "all_words")
    candidates = frequent.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    split = candidates.withColumn("its", F.split("phrase", " "))

    def joined(start, size):
        return F.array_join(F.slice("its", start, size), " ")

    cuts = split.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "a", "k",
        joined(F.lit(1), F.col("k")).alias("head"),
        joined(F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"),
        F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    heads = frequent.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = frequent.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    exact = (
        "CAST(1000 * CAST(a AS DECIMAL(15, 0)) * CAST(all_words AS DECIMAL(16, 0)) AS DECIMAL(38, 0)) "
        "div (CAST(l AS DECIMAL(15, 0)) * CAST(r AS DECIMAL(15, 0)))"
    )
    scored = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .join(salted, ["lang", "salt"])
        .withColumn("score", F.expr(exact))
        .groupBy("lang", "phrase", "salt")
        .agg(
            F.min(F.struct("score", "k", "l", "r", "a", F.col("all_words").alias("n"))).alias("cut")
        )
        .select("lang", "phrase", "salt", "cut.*")
    )
    inner = (
        split.where("words > 2")
        .withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
        .select("lang", joined(F.col("start"), F.col("size")).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    alone = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") < F.col("a"))
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:  # the best of each part first, so that no task sees a whole language
        place = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
        alone = alone.withColumn("place", place).where(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = alone.withColumn("rank", rank.cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
