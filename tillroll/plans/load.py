"""Loading the lake: history once, then increments after the high-water mark."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import sale_date
from tillroll.operators.clean import Validity, clean_transactions
from tillroll.schemas import HISTORY_CUTOFF, TRANSACTION, Star
from tillroll.sources.lake import Lake, Written, add_partitions, changing, read_days
from tillroll.sources.manifest import Manifest
from tillroll.sources.tables import after, up_to


def initial_load(
    star: Star, lake: Lake, cutoff=HISTORY_CUTOFF, rule: Validity | None = Validity()
) -> Written:
    """Replace the lake with the history up to the cutoff, cleaned unless `rule` is None.

    Sales, dimensions and the mark, which goes back to the cutoff, change together: readers,
    and the next load after a crash, find the old lake or the new one.
    """
    history = star.fact.where(up_to(cutoff))
    with changing(star.fact.sparkSession, lake) as draft:
        found = draft.replace_sales(history if rule is None else clean_transactions(history, rule))
        draft.put_dimension("payment", star.payment)
        draft.put_dimension("truck", star.truck)
        draft.mark = datetime.fromisoformat(str(cutoff))
    return found


def increment_stats(increment: DataFrame) -> DataFrame:
    """Row count and latest sale of an increment, in one pass."""
    return increment.agg(
        F.count(F.lit(1)).alias("row_count"), F.max("at").alias("latest")
    )


def profile(increment: DataFrame) -> Written:
    """Measure an increment in one pass over `at`; the driver gets one row per day."""
    by_day = (
        increment.groupBy(sale_date(F.col("at")).alias("date"))
        .agg(F.count(F.lit(1)).alias("row_count"), F.max("at").alias("latest"))
        .where(F.col("date").isNotNull())
        .collect()
    )
    if not by_day:
        return Written()
    return Written(
        rows=sum(r["row_count"] for r in by_day),
        latest=max(r["latest"] for r in by_day),
        days=frozenset(r["date"] for r in by_day),
    )


# A sale is known by its id and its time, a sale without an id by all its columns. Spelled
# out as plain columns so that dropping repeats and the anti join share one shuffle.
_IDENTITY = ["_id", "_no_id", "_rest", "at"]


def _identified(sales: DataFrame) -> DataFrame:
    others = [
        F.coalesce(F.col(name).cast("string"), F.lit("-"))
        for name in TRANSACTION.names
        if name not in ("transaction_id", "at")
    ]
    return sales.withColumns(
        {
            "_id": F.coalesce("transaction_id", F.lit(0)),
            "_no_id": F.col("transaction_id").isNull(),
            "_rest": F.when(F.col("transaction_id").isNull(), F.concat_ws(",", *others)).otherwise(""),
        }
    )


def unlanded(
    increment: DataFrame, lake: Lake, state: Manifest, days: Collection[date], once: bool = False
) -> DataFrame:
    """The rows of these days that the lake does not hold; with `once`, one row for each sale.

    Only the folders of these days are read, and only the identity columns; repeated
    identities are collapsed before the shuffle.
    """
    arriving = _identified(increment)
    if once:
        arriving = arriving.dropDuplicates(_IDENTITY)
    landed = read_days(increment.sparkSession, lake, days, state)
    known = _identified(landed).select(*_IDENTITY).distinct()
    return arriving.join(known, _IDENTITY, "left_anti").select(*TRANSACTION.names)


def append_new(
    increment: DataFrame, lake: Lake, days: Collection[date], once: bool = False
) -> Written:
    """Append the rows of these days that the lake does not hold yet, as one load."""
    with changing(increment.sparkSession, lake) as draft:
        return draft.add_sales(unlanded(increment, lake, draft.before, days, once))


def incremental_load(
    fact: DataFrame,
    lake: Lake,
    default_mark=HISTORY_CUTOFF,
    rule: Validity | None = None,
    table: str | None = None,
    look_back: timedelta = timedelta(0),
) -> Written:
    """Append sales newer than the mark and move the mark to the newest of them, together.

    Increments are not cleaned unless a `rule` is given. With `look_back`, sales that arrived
    late, within so long before the mark, are taken too; the mark never goes back for them.
    The source is scanned once: the write itself counts the rows and finds the latest. What
    the lake holds already is left out. The lake knows its latest sale, so where none is newer
    than the start of the window, as after loads that followed each other, nothing is joined.
    Older sales are left to `streaming.landing`. One writer at a time.
    """
    spark = fact.sparkSession
    with changing(spark, lake) as draft:
        mark = draft.mark or datetime.fromisoformat(str(default_mark))
        start = mark - look_back
        increment = fact.where(after(start))
        if rule is not None:
            increment = clean_transactions(increment, rule)
        latest = draft.before.latest
        if latest is not None and latest > start:
            open_days = [day for day in draft.before.all_days() if day >= start.date()]
            increment = unlanded(increment, lake, draft.before, open_days)
        found = draft.add_sales(increment)
        if found.latest is not None and found.latest > mark:
            draft.mark = found.latest
    if table is not None and found.days:
        add_partitions(spark, lake, table, found.days)
    return found
