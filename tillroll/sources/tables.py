"""Reading source tables and CSV hand-offs under a declared schema."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillroll.functions import ntz
from tillroll.schemas import PAYMENT, TRANSACTION, TRUCK, Star


@dataclass(frozen=True)
class TableSource:
    """Any Spark batch source.

    A database is `TableSource("jdbc", options={"url": ..., "dbtable": ...})`; for a
    large table also set `partitionColumn`, `lowerBound`, `upperBound` and
    `numPartitions`, so that executors read slices in parallel, and `preferTimestampNTZ`,
    so that bounds on the sale time are left to the database. Files whose layout is known
    should name it in `layout`, which saves the job that reads it from footers.
    """

    format: str
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    layout: StructType | None = None


def read_table(spark: SparkSession, source: TableSource, schema: StructType) -> DataFrame:
    """Full read of a table as `schema`, extra source columns left unread."""
    reader = spark.read.format(source.format).options(**source.options)
    if source.layout is not None:
        reader = reader.schema(source.layout)
    loaded = reader.load(source.path) if source.path else reader.load()
    return loaded.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def read_star(
    spark: SparkSession, fact: TableSource, payment: TableSource, truck: TableSource
) -> Star:
    return Star(
        fact=read_table(spark, fact, TRANSACTION),
        payment=read_table(spark, payment, PAYMENT),
        truck=read_table(spark, truck, TRUCK),
    )


def up_to(cutoff) -> Column:
    """History slice: at or before the cutoff."""
    return F.col("at") <= ntz(cutoff)


def after(mark) -> Column:
    """Increment slice: strictly after the mark."""
    return F.col("at") > ntz(mark)


# Spark's default CSV timestamp stops at milliseconds; its writer trims texts and escapes quotes
# in a way that its reader does not undo.
_CSV = {
    "header": "true",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
_LINE = "_line"


def write_csv(df: DataFrame, path: str) -> None:
    """Texts come back as they are: with quotes, line ends, spaces, empty or missing."""
    df.write.mode("overwrite").options(**_CSV).csv(path)


def _csv_reader(spark: SparkSession, schema: StructType):
    """Only tables with texts can have line ends in a row, and are read file by file for that;
    others are split."""
    texts = any(isinstance(f.dataType, StringType) for f in schema.fields)
    # an empty field is missing and a quoted empty one is not, so no text may stand for null
    return spark.read.options(**_CSV, multiLine=str(texts).lower(), nullValue="\0")


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return _csv_reader(spark, schema).schema(schema).csv(path)


def read_csv_checked(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and the others as (line, reason).

    A row with too few or too many fields, or a field that is no value of its type, is not
    turned into nulls, which cleaning would drop unseen, but put aside with what is wrong first.
    """
    fields = [StructField(f.name, StringType()) for f in schema.fields]
    # texts alone cannot fail to parse, so a corrupt line is one with a wrong number of fields
    raw = (
        _csv_reader(spark, schema)
        .schema(StructType([*fields, StructField(_LINE, StringType())]))
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=_LINE)
        .csv(path)
    )
    casts = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema.fields}
    number = F.when(F.col(_LINE).isNotNull(), F.lit("wrong number of fields"))
    wrong = [
        F.when(
            F.col(f"`{f.name}`").isNotNull() & casts[f.name].isNull(),
            F.lit(f"{f.name} is no {f.dataType.simpleString()}"),
        )
        for f in schema.fields
    ]
    judged = raw.withColumn("_reason", F.coalesce(number, *wrong))
    good = judged.where("_reason IS NULL").select(*(c.alias(n) for n, c in casts.items()))
    whole = F.coalesce(F.col(_LINE), F.to_csv(F.struct(*(F.col(f"`{f.name}`") for f in fields))))
    rejected = judged.where("_reason IS NOT NULL").select(whole.alias("line"), F.col("_reason").alias("reason"))
    return good, rejected
