"""The lake: a date-partitioned fact, two dimensions, summaries and the high-water mark.

Loads lie side by side, each in folders of its own, and the newest manifest says which of them
are read. Overwriting, appending and compacting are the same thing: write folders, then publish
a manifest. Readers see the lake before a change or after it.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.functions import with_partition_columns
from tillroll.operators.star import GRAINS, summed, summed_again
from tillroll.schemas import (
    LAKE_TRANSACTION,
    PARTITION_COLUMNS,
    PAYMENT,
    SUMMARY,
    TRANSACTION,
    TRUCK,
    Star,
)
from tillroll.sources.manifest import Manifest, newest, publish
from tillroll.sources.shared import remove_folder, subfolders

# Upper bound on the rows of one file, so that a day holding a large share of the
# table is many files and not one.
MAX_RECORDS_PER_FILE = 20_000_000

_PARTITIONS_PER_CALL = 200
_DIMENSIONS = {"payment": PAYMENT, "truck": TRUCK}


@dataclass(frozen=True)
class Lake:
    root: str

    @property
    def transactions(self) -> str:
        return f"{self.root}/transaction_table"

    @property
    def summaries(self) -> str:
        return f"{self.root}/summary_table"

    @property
    def manifest(self) -> str:
        return f"{self.root}/_state/manifest"

    def dimension(self, name: str) -> str:
        return f"{self.root}/{name}_table"


def _load(path: str, number: int) -> str:
    return f"{path}/load={number:012d}"


def _day(path: str, number: int, day: date) -> str:
    return f"{_load(path, number)}/year={day.year}/month={day.month}/day={day.day}"


@dataclass(frozen=True)
class Written:
    """What a load of sales brought: rows, latest sale and days."""

    rows: int = 0
    latest: datetime | None = None
    days: frozenset[date] = frozenset()


def _partitioned(fact: DataFrame, path: str) -> Written:
    """Write sales by year, month and day, and count them on the way.

    The rebalance hint groups rows by day without tying a day to one task: at run time a
    day above the advisory partition size is split over several tasks and small days are
    packed together. Sorting by `at` inside a task keeps row-group ranges narrow and
    doubles as the ordering the partitioned writer needs. Rows and latest sale are observed
    by the write itself; the days are the folders it made. Sales without a time are not landed.
    """
    keys = [F.col(name) for name in PARTITION_COLUMNS]
    seen = Observation()
    (
        with_partition_columns(fact.select(*TRANSACTION.names).where(F.col("at").isNotNull()))
        .observe(seen, F.count(F.lit(1)).alias("rows"), F.max("at").alias("latest"))
        .hint("rebalance", *keys)
        .sortWithinPartitions(*keys, "at")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(path)
    )
    files = fact.sparkSession.read.schema(LAKE_TRANSACTION).parquet(path).inputFiles()
    days = frozenset(map(day_of, files)) - {None}
    if not days:  # an empty frame can be planned away together with what observes it
        return Written()
    found = seen.get
    return Written(found["rows"], found["latest"], days)


_DAY_IN_PATH = re.compile(r"/year=(\d+)/month=(\d+)/day=(\d+)/")


def day_of(file: str) -> date | None:
    """The day a file of sales belongs to; none for the file of an empty load."""
    found = _DAY_IN_PATH.search(file)
    return date(*map(int, found.groups())) if found else None


class Draft:
    """A change of the lake that is being written. Nothing of it is seen before it ends."""

    def __init__(self, spark: SparkSession, lake: Lake) -> None:
        self.spark, self.lake = spark, lake
        self.before = newest(spark, lake.manifest)
        self.state = replace(self.before, number=self.before.number + 1)

    @property
    def number(self) -> int:
        return self.state.number

    @property
    def mark(self) -> datetime | None:
        return self.state.mark

    @mark.setter
    def mark(self, mark: datetime) -> None:
        self.state = replace(self.state, mark=mark)

    def add_sales(self, fact: DataFrame) -> Written:
        """Write sales as one more load."""
        done = _partitioned(fact, _load(self.lake.transactions, self.number))
        if done.days:
            state = self.state
            self.state = replace(
                state,
                latest=max(filter(None, (state.latest, done.latest))),
                days={**state.days, self.number: done.days},
                whole=state.whole | {self.number},
            )
        return done

    def replace_sales(self, fact: DataFrame) -> Written:
        """Write sales as all there are. Sales may be read from the lake to be replaced."""
        self.state = replace(
            self.state, latest=None, days={}, whole=frozenset(),
            summaries=frozenset(), summarised=frozenset(),
        )
        return self.add_sales(fact)

    def rewrite_days(self, days: Collection[date]) -> Written:
        """Write the sales of some days anew, as one load, so that each is in one folder."""
        done = _partitioned(
            read_days(self.spark, self.lake, days, self.before), _load(self.lake.transactions, self.number)
        )
        state, gone = self.state, frozenset(days)
        left = {load: some - gone for load, some in state.days.items()}
        kept = {load: some for load, some in left.items() if some}
        self.state = replace(
            state,
            days={**kept, self.number: done.days},
            whole=frozenset(x for x in state.whole if kept.get(x) == state.days.get(x)) | {self.number},
            # where sums are kept, what is written anew is in them
            summarised=(state.summarised & kept.keys()) | ({self.number} if state.summaries else set()),
        )
        return done

    def put_dimension(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(_load(self.lake.dimension(name), self.number))
        self.state = replace(self.state, dimensions={**self.state.dimensions, name: self.number})

    def put_summary(self, sums: DataFrame, of: Collection[int], instead: bool = False) -> None:
        """Write sums of some loads of sales, beside the ones there are or instead of them."""
        target = _load(self.lake.summaries, self.number)
        sums.select(*SUMMARY.names).hint("rebalance", F.col("date")).write.mode("overwrite").parquet(target)
        state = self.state
        self.state = replace(
            state,
            summaries=(frozenset() if instead else state.summaries) | {self.number},
            summarised=state.summarised | frozenset(of),
        )

    def landed_batch(self, stream: str, batch: int) -> None:
        self.state = replace(self.state, batches={**self.state.batches, stream: batch})

    def publish(self) -> None:
        if replace(self.state, number=self.before.number) != self.before:
            publish(self.spark, self.lake.manifest, self.state)


@contextmanager
def changing(spark: SparkSession, lake: Lake) -> Iterator[Draft]:
    """A change that is published when the block ends well. One writer at a time: where two
    meet, the slower gets `LakeChanged`."""
    draft = Draft(spark, lake)
    yield draft
    draft.publish()


def write_transactions(fact: DataFrame, lake: Lake, mode: str) -> Written:
    """Land sales: `overwrite` replaces every day, `append` adds a load."""
    with changing(fact.sparkSession, lake) as draft:
        return draft.replace_sales(fact) if mode == "overwrite" else draft.add_sales(fact)


def write_dimension(dimension: DataFrame, lake: Lake, name: str) -> None:
    """Replace the dimension `payment` or `truck`."""
    with changing(dimension.sparkSession, lake) as draft:
        draft.put_dimension(name, dimension)


def manifest(spark: SparkSession, lake: Lake) -> Manifest:
    return newest(spark, lake.manifest)


def _read(spark: SparkSession, schema: StructType, paths: list[str], base: str) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", base).parquet(*paths)
    return found.select(*schema.names)


def read_transactions(spark: SparkSession, lake: Lake, state: Manifest | None = None) -> DataFrame:
    """The landed fact; no rows when nothing has been landed yet."""
    state = state or manifest(spark, lake)
    paths = []
    for load, days in sorted(state.days.items()):
        if load in state.whole:
            paths.append(_load(lake.transactions, load))
        else:
            paths += [_day(lake.transactions, load, day) for day in sorted(days)]
    return _read(spark, LAKE_TRANSACTION, paths, lake.transactions)


def read_days(
    spark: SparkSession, lake: Lake, days: Iterable[date], state: Manifest | None = None
) -> DataFrame:
    """The landed fact of some days, in one scan. The manifest names their folders, so nothing
    is listed but those, however old the lake is; days not landed have no rows."""
    state = state or manifest(spark, lake)
    paths = [
        _day(lake.transactions, load, day) for day in sorted(set(days)) for load in state.loads_of(day)
    ]
    return _read(spark, LAKE_TRANSACTION, paths, lake.transactions)


def read_loads(
    spark: SparkSession, lake: Lake, loads: Iterable[int], state: Manifest
) -> DataFrame:
    """The landed fact of some loads."""
    some = {load: state.days[load] for load in loads}
    return read_transactions(spark, lake, replace(state, days=some))


def read_dimension(spark: SparkSession, lake: Lake, name: str, state: Manifest | None = None) -> DataFrame:
    state = state or manifest(spark, lake)
    number = state.dimensions.get(name)
    paths = [] if number is None else [_load(lake.dimension(name), number)]
    return _read(spark, _DIMENSIONS[name], paths, lake.dimension(name))


def read_summaries(spark: SparkSession, lake: Lake, state: Manifest) -> DataFrame:
    """All kept sums; a group can be in several loads."""
    paths = [_load(lake.summaries, number) for number in sorted(state.summaries)]
    return _read(spark, SUMMARY, paths, lake.summaries)


def read_lake(spark: SparkSession, lake: Lake, days: Iterable[date] | None = None) -> Star:
    """The lake as a star, of all days or of some."""
    state = manifest(spark, lake)
    return Star(
        read_transactions(spark, lake, state) if days is None else read_days(spark, lake, days, state),
        read_dimension(spark, lake, "payment", state),
        read_dimension(spark, lake, "truck", state),
    )


def read_catalog(spark: SparkSession, database: str) -> Star:
    """The registered lake as a star; day filters prune partitions in the catalog."""
    return Star(
        spark.table(f"{database}.transaction_table"),
        spark.table(f"{database}.payment_table"),
        spark.table(f"{database}.truck_table"),
    )


def _moment(value) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def read_mark(spark: SparkSession, lake: Lake, default) -> DataFrame:
    """The high-water mark as one row, `default` before the first load."""
    mark = manifest(spark, lake).mark
    return spark.range(1).select(_moment(default if mark is None else mark).alias("mark"))


def write_mark(spark: SparkSession, lake: Lake, mark: datetime) -> None:
    """Move the mark, microseconds kept, forward or back."""
    with changing(spark, lake) as draft:
        draft.mark = mark


def refresh_summary(spark: SparkSession, lake: Lake) -> frozenset[int]:
    """Add what came since the last time to the kept sums, and return the loads it came with.

    Only new loads are read. A sum is additive, so a load adds rows of its own and no day is
    summed again; after an overwrite all sums are made anew, as the loads all are.
    """
    state = manifest(spark, lake)
    fresh = frozenset(state.days.keys() - state.summarised)
    if fresh:
        with changing(spark, lake) as draft:
            draft.put_summary(summed(read_loads(spark, lake, fresh, state), *GRAINS), fresh)
    return fresh


def compact(spark: SparkSession, lake: Lake, days: Iterable[date] | None = None) -> frozenset[date]:
    """Put the files of days that several loads brought together, and return those days.

    Only these days, of the given ones or of all, are read and written; the others keep their
    files. The writer packs rows into files of the advisory partition size. Kept sums are put
    together too, those of one group into one row.
    """
    state = manifest(spark, lake)
    chosen = state.all_days() if days is None else set(days)
    torn = frozenset(day for day in chosen if len(state.loads_of(day)) > 1)
    if not torn:
        return torn
    if state.summaries:
        refresh_summary(spark, lake)  # sums are known by load, and loads are about to change
    with changing(spark, lake) as draft:
        draft.rewrite_days(torn)
        if len(draft.before.summaries) > 1:
            draft.put_summary(summed_again(read_summaries(spark, lake, draft.before), *GRAINS), (), instead=True)
    return torn


def vacuum(spark: SparkSession, lake: Lake) -> int:
    """Delete folders of loads that the lake no longer reads, and count them. Readers that
    began before the last change may still need them, so it is a job of its own."""
    state, gone = manifest(spark, lake), 0
    used = {
        lake.transactions: set(state.days),
        lake.summaries: set(state.summaries),
        **{lake.dimension(n): {state.dimensions.get(n)} for n in _DIMENSIONS},
    }
    for path, numbers in used.items():
        for name in subfolders(spark, path):
            found = re.fullmatch(r"load=(\d+)", name)
            if found and int(found[1]) not in numbers:
                remove_folder(spark, f"{path}/{name}")
                gone += 1
    return gone


def register_lake(spark: SparkSession, lake: Lake, database: str) -> None:
    """Make the lake tables of `database`, with the days as partitions.

    A partition of a catalog is one folder, so days in several loads are put together first.
    """
    compact(spark, lake)
    state = manifest(spark, lake)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{lake.root}/_catalog'")
    for name, schema in _DIMENSIONS.items():
        if name in state.dimensions:
            folder = _load(lake.dimension(name), state.dimensions[name])
            _create_table(spark, f"{database}.{name}_table", schema, folder)
    table = f"{database}.transaction_table"
    _create_table(spark, table, LAKE_TRANSACTION, lake.transactions)
    there = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    _each(spark, f"ALTER TABLE {table} DROP IF EXISTS", [f"PARTITION ({p.replace('/', ', ')})" for p in there], ", ")
    _add(spark, lake, table, state, state.all_days())
    spark.catalog.refreshTable(table)


def _create_table(spark: SparkSession, name: str, schema: StructType, path: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioned = (
        f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)})"
        if set(PARTITION_COLUMNS) <= set(schema.names)
        else ""
    )
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {partitioned} LOCATION '{path}'")


def _each(spark: SparkSession, start: str, parts: list[str], between: str) -> None:
    for first in range(0, len(parts), _PARTITIONS_PER_CALL):
        spark.sql(f"{start} {between.join(parts[first : first + _PARTITIONS_PER_CALL])}")


def _partition(day: date) -> str:
    return f"PARTITION (year={day.year}, month={day.month}, day={day.day})"


def _add(spark: SparkSession, lake: Lake, table: str, state: Manifest, days: Iterable[date]) -> None:
    """Show days in the catalog, each where its one load lies."""
    parts = [
        f"{_partition(d)} LOCATION '{_day(lake.transactions, load, d)}'"
        for d in sorted(days)
        for load in state.loads_of(d)[:1]
    ]
    _each(spark, f"ALTER TABLE {table} ADD IF NOT EXISTS", parts, " ")


def add_partitions(spark: SparkSession, lake: Lake, table: str, days: Iterable[date]) -> None:
    """Show freshly landed days in the catalog, without listing the lake: those that were there
    before are put together and change their folder."""
    days = frozenset(days)
    compact(spark, lake, days)
    _each(spark, f"ALTER TABLE {table} DROP IF EXISTS", [_partition(d) for d in sorted(days)], ", ")
    _add(spark, lake, table, manifest(spark, lake), days)
    spark.catalog.refreshTable(table)
