"""Manifests: which folders make up the lake.

Every change of the lake writes its data into folders of its own and then a manifest with the
next number. The newest manifest counts. So a change is there as a whole or not at all: a crash
before the manifest leaves folders that nothing names, and the next change, which has the same
number, replaces them. A manifest is one small file; a few old ones are kept for readers that
have just looked, the others go after the new one is safe.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from tillroll.schemas import MANIFEST
from tillroll.sources.shared import remove_folder

#: Manifests that stay, the newest included.
KEPT = 4


class LakeChanged(RuntimeError):
    """Another writer has changed the lake meanwhile."""


@dataclass(frozen=True)
class Manifest:
    """A state of the lake.

    A load is known by the number of the manifest that brought it. `days` has, for each load of
    sales, the days that are read from it; a load that is not in `whole` has more days than
    those, which later loads replace. `summaries` are loads of sums, `summarised` the loads of
    sales that they cover. `batches` has the last batch landed of each stream.
    """

    number: int = 0
    mark: datetime | None = None
    latest: datetime | None = None
    days: Mapping[int, frozenset[date]] = field(default_factory=dict)
    whole: frozenset[int] = frozenset()
    summaries: frozenset[int] = frozenset()
    summarised: frozenset[int] = frozenset()
    dimensions: Mapping[str, int] = field(default_factory=dict)
    batches: Mapping[str, int] = field(default_factory=dict)

    def loads_of(self, day: date) -> list[int]:
        return sorted(load for load, days in self.days.items() if day in days)

    def all_days(self) -> set[date]:
        return set().union(*self.days.values())

    def rows(self) -> Iterable[tuple]:
        yield "mark", None, None, None, self.mark
        yield "latest", None, None, None, self.latest
        for load, days in self.days.items():
            yield from (("sales", None, load, day, None) for day in days)
        for kind in ("whole", "summaries", "summarised"):
            yield from ((kind, None, load, None, None) for load in getattr(self, kind))
        for kind in ("dimensions", "batches"):
            yield from ((kind, name, load, None, None) for name, load in getattr(self, kind).items())


def _from_rows(number: int, rows: list) -> Manifest:
    def loads(kind: str) -> frozenset[int]:
        return frozenset(r.load for r in rows if r.kind == kind)

    def names(kind: str) -> dict[str, int]:
        return {r.name: r.load for r in rows if r.kind == kind}

    days: dict[int, set[date]] = {}
    for r in rows:
        if r.kind == "sales":
            days.setdefault(r.load, set()).add(r.day)
    moments = {r.kind: r.at for r in rows if r.kind in ("mark", "latest")}
    return Manifest(
        number,
        moments["mark"],
        moments["latest"],
        {load: frozenset(some) for load, some in days.items()},
        loads("whole"),
        loads("summaries"),
        loads("summarised"),
        names("dimensions"),
        names("batches"),
    )


def _folder(path: str, number: int) -> str:
    return f"{path}/number={number:012d}"


def _numbers(spark: SparkSession, path: str) -> set[int]:
    """Numbers of the complete manifests."""
    try:
        files = spark.read.schema(MANIFEST).parquet(path).inputFiles()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    return {int(found[1]) for f in files if (found := re.search(r"/number=(\d+)/[^/]+$", f))}


def newest(spark: SparkSession, path: str) -> Manifest:
    """The manifest that counts; an empty one before the first change."""
    number = max(_numbers(spark, path), default=0)
    if not number:
        return Manifest()
    return _from_rows(number, spark.read.schema(MANIFEST).parquet(_folder(path, number)).collect())


def publish(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Make a manifest the newest. It must follow the one that counts now."""
    there = _numbers(spark, path)
    if max(there, default=0) != manifest.number - 1:
        raise LakeChanged(f"manifest {manifest.number} does not follow {max(there, default=0)}")
    rows = spark.createDataFrame(list(manifest.rows()), MANIFEST).coalesce(1)
    rows.write.mode("overwrite").parquet(_folder(path, manifest.number))
    for old in sorted(there):
        if old <= manifest.number - KEPT:
            remove_folder(spark, _folder(path, old))
