"""What the operators of this package share: Arrow maps over texts, bounded samples, hashing."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tillroll.sources.shared import new_folder

#: Rows, and bytes of them, that one call of a task's function sees; bounds what a worker holds
#: in Python. A single row may be larger.
TEXTS_PER_CALL = 256
BYTES_PER_CALL = 16 << 20

LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MASK = (1 << 64) - 1


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors of a session, once, as one archive.

    Tasks load functions by name, so they need it wherever the driver was started.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def written(df: DataFrame) -> DataFrame:
    """Compute a frame once and read it back from the shared folder.

    Like a checkpoint, but nothing of the old plan comes along. A checkpoint keeps what the
    optimizer knew about the columns, and in a loop of joins that grows from round to round until
    it fills the driver.
    """
    folder = new_folder(df.sparkSession, "written")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def tidy(spark: SparkSession) -> None:
    """Have the driver collect its garbage between the rounds of a job.

    Spark removes shuffle files and checkpoints of frames that nothing refers to any more, but
    only finds them so when a collection runs, which in a driver with a large heap may be long
    after they have filled a disk; the plans of earlier rounds go with them.
    """
    gc.collect()
    spark._jvm.System.gc()


def map_rows(
    df: DataFrame, columns: Iterable[Column | str], schema: str, make: Callable[[], Callable]
) -> DataFrame:
    """Run a function over the given columns, a few hundred rows at a time.

    `make` is called once per task and returns the function, which takes one list per
    column and returns one list or array per field of `schema`.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            size = batch.nbytes // max(batch.num_rows, 1)
            rows = min(TEXTS_PER_CALL, max(BYTES_PER_CALL // max(size, 1), 1))
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                made = work(*(c.to_pylist() for c in part.columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(made, arrow, strict=True)], schema=arrow
                )

    ship(df.sparkSession)
    return df.select(*columns).mapInArrow(run, schema)


class Kept:
    """A map of bounded size: when the young half is full it becomes the old half. Keys and values
    should be short."""

    def __init__(self, entries: int) -> None:
        self.entries = entries
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.entries:
            self.old, self.young = self.young, {}
        self.young[key] = value


def fold(key: Column, of: int) -> Column:
    """The remainder by which rows are held out: crc32 of the id as text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % of


def bounded_sample(
    df: DataFrame, rows: int, columns: Sequence[str], by: str | None = None
) -> DataFrame:
    """At most `rows` distinct rows, or `rows` for each value of `by`, chosen by a hash of all of
    `columns`, the only ones that are kept.

    The share to look at is set from a count; equal rows are one, in the map tasks already; and
    what is left is cut by number. So the bound holds for repeated and null ids too, and the
    choice depends on what the rows hold, not on where they lie.
    """
    df = df.select(*columns)
    mark = F.xxhash64(F.lit(20_011), *columns)
    unit = mark.bitwiseAND(F.lit(0xFFFFFFFF)) / F.lit(2.0**32)
    if by is None:
        share = F.lit(rows / max(df.count(), 1))
    else:
        share = F.lit(0.0)
        for value, n in df.where(F.col(by).isNotNull()).groupBy(by).count().collect():
            share = F.when(F.col(by) == F.lit(value), F.lit(rows / n)).otherwise(share)
    some = df.where(unit < share).distinct()
    order = Window.partitionBy(by if by else F.lit(0)).orderBy(mark, *columns)
    return some.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= rows).drop("_place")


def labelled_texts(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, values: Sequence, rows: int
) -> DataFrame:
    """(label, text) of a bounded sample of labelled documents, at most `rows` for each value.

    Ids are sampled first, from the labels, and broadcast: a few thousand, however large the
    tables are. Where ids repeat in the documents, their texts are cut by number as well.
    """
    known = labels.where(F.col(label).isin(*values)).select(F.col(key).alias("key"), F.col(label).alias("label"))
    chosen = F.broadcast(bounded_sample(known, rows, ["key", "label"], by="label"))
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = texts.join(chosen, "key").select("label", "text").distinct()
    return found.orderBy(F.xxhash64("label", "text"), "label", "text").limit(rows * len(values))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _geometric(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(n, np.uint64)
    filled = 1
    while filled < n:
        step = min(filled, n - filled)
        out[filled : filled + step] = out[:step] * np.uint64(pow(base, filled, 1 << 64))
        filled += step
    return out


#: Powers that are kept; those for longer texts are made for one text and go with it.
_POWERS_KEPT = 1 << 20


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, enough for n bytes."""
    if n > _POWERS_KEPT:
        return _geometric(_BASE, n), _geometric(pow(_BASE, -1, 1 << 64), n)
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        _powers[0] = _geometric(_BASE, size)
        _powers[1] = _geometric(pow(_BASE, -1, 1 << 64), size)
    return _powers[0], _powers[1]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word (between ASCII white space) of a text, all at once.

    A prefix sum over all bytes gives each word's polynomial in one subtraction.
    """
    bytes_ = np.frombuffer(data, np.uint8)
    space = np.ones(len(bytes_) + 2, bool)
    space[1:-1] = _SPACE[bytes_]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = powers(len(bytes_) + 1)
    sums = np.zeros(len(bytes_) + 1, np.uint64)
    np.cumsum(_BYTE[bytes_] * up[: len(bytes_)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


@cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def letter_codes(text: str) -> np.ndarray:
    """Lower-cased letters as code points, every run of anything else as one 32.

    Starts and ends with 32; a text without letters is a single 32.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.concatenate(([np.uint32(32)], np.where(letters()[codes], codes, 32), [np.uint32(32)]))
    gap = codes == 32
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    return codes[keep].astype(np.uint64)


def gram_buckets(codes: np.ndarray, length: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash bucket of the n-gram at each place, and the places inside one word and its edges."""
    n = len(codes) - length + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    value = np.full(n, length, np.uint64)
    inner = np.zeros(n, bool)
    for k in range(length):
        part = codes[k : k + n]
        value = value * np.uint64(0x100000001B3) + part
        if 0 < k < length - 1:
            inner |= part == 32
    places = np.flatnonzero(~inner)
    value = value[places] * np.uint64(0x9E3779B97F4A7C15)
    return (value >> np.uint64(64 - bits)).astype(np.int64), places


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))
