"""Landing files of sales in the lake as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillroll.plans.load import profile, unlanded
from tillroll.schemas import TRANSACTION
from tillroll.sources.lake import Lake, changing

FILES_PER_BATCH = "1000"


def land_batch(batch: DataFrame, lake: Lake, stream: str | None = None, number: int = 0) -> None:
    """Append one micro-batch, each sale once however often it was delivered.

    The lake remembers the last batch of a stream, together with its sales. A batch replayed
    after a failure between the append and the commit of its offsets is known by its number
    and is not even read; a file delivered twice finds its sales in the lake and adds nothing.
    """
    with changing(batch.sparkSession, lake) as draft:
        if stream is not None:
            if draft.before.batches.get(stream, -1) >= number:
                return
            draft.landed_batch(stream, number)
        dated = batch.where(F.col("at").isNotNull())
        days = profile(dated).days
        if days:
            draft.add_sales(unlanded(dated, lake, draft.before, days, once=True))


def _stream_id(batch: DataFrame) -> str | None:
    """The id of the running stream, which is kept in its checkpoint and never used again."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def land_stream(
    spark: SparkSession,
    path: str,
    lake: Lake,
    checkpoint: str,
    schema: StructType = TRANSACTION,
    to_fact: Callable[[DataFrame], DataFrame] | None = None,
    **options: str,
) -> StreamingQuery:
    """Land every file not seen before, then stop; the checkpoint remembers them.

    There is no watermark: it would drop sales that arrive late, and what has to be
    remembered to recognise repeats is in the lake, not in streaming state. A backlog is
    taken in batches of bounded size; `maxFilesPerTrigger` or `maxBytesPerTrigger` set
    another bound. `to_fact` maps other layouts to the fact's columns.
    """
    if not {"maxFilesPerTrigger", "maxBytesPerTrigger"} & set(options):
        options["maxFilesPerTrigger"] = FILES_PER_BATCH
    arriving = spark.readStream.schema(schema).options(**options).parquet(path)
    fact = to_fact(arriving) if to_fact else arriving
    return (
        fact.writeStream.foreachBatch(
            lambda batch, number: land_batch(batch, lake, _stream_id(batch), number)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
