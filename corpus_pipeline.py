"""Documents to token ids: toxicity, line dedup, near-dedup, decontamination, BPE.

Each stage takes the documents its predecessor kept and returns what it keeps with the columns
of documents; the last returns ids. What a stage returns is written as Parquet into the shared
folder and read again, so a lost executor never reaches back beyond one stage.

In every stage null texts count as empty, rows without an id are kept and never linked, and
columns beyond doc_id and text, whatever their names, are carried as they are. Documents without
text are neither toxic nor contaminated nor near copies of anything, so they stay. Rows equal in
id and text are treated alike; of rows that share an id, near-dedup keeps or drops all. Long
texts are judged whole. An empty table stays empty through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bpe, decontaminate, line_dedup, near_dup, toxicity
from tillroll.llm.queries import VOCABULARY, table
from tillroll.sources.shared import new_folder, remove_folder


def numbered(docs: DataFrame) -> tuple[DataFrame, str, str, tuple[str, ...]]:
    """`docs` with columns named by number, so that no name clashes with an operator's: the
    frame, the names of doc_id and text in it, and the others."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    key, text = names[docs.columns.index("doc_id")], names[docs.columns.index("text")]
    return docs.toDF(*names), key, text, tuple(n for n in names if n != key)


def named_again(kept: DataFrame, docs: DataFrame) -> DataFrame:
    return kept.select(*(f"_c{i}" for i in range(len(docs.columns)))).toDF(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds toxic go. It learns from the labelled ones among
    `docs`, and judges all of them."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    plain, key, text, others = numbered(docs)
    scored = toxicity.predict(plain, model, key, text, carry=others)
    return named_again(scored.where("score < 0.5"), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines go, and documents that had nothing else."""
    plain, key, text, _ = numbered(docs)
    done = line_dedup.dedup_lines(plain, key=key, text=text)
    left = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = done.where((F.col("n_deleted") == 0) | left)
    if "n_chars" in docs.columns:
        n_chars = f"_c{docs.columns.index('n_chars')}"
        chars = F.when(F.col("n_deleted") > 0, F.char_length(text)).otherwise(F.col(n_chars))
        kept = kept.withColumn(n_chars, chars.cast(docs.schema["n_chars"].dataType))
    return named_again(kept, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id."""
    gone = near_dup.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat benchmark items in a twentieth of their words or more go."""
    plain, key, text, others = numbered(docs)
    found = decontaminate.overlaps(
        plain, table(spark, sf_dir, "benchmark"), key=key, text=text, carry=others
    )
    return named_again(found.where(~decontaminate.contaminated()), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and the text decoded from them."""
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: A trained classifier has no SQL, so the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents. What a stage wrote goes when the next has been written; the
    result stays in the shared folder."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before is not None:
            remove_folder(spark, before)
        before = folder
    return docs
