"""Repeated runs of lines, by prefix doubling over sequences of line ids. Built-in columns only.

Every line with a word has an id; a document is a sequence of ids, and its suffixes start at
its lines. Prefix doubling gives each suffix a rank for its first 1, 2, 4, ... lines: suffixes
have the same rank just when those lines are the same. The rank of twice the length is a group
of pairs of ranks, named by the smallest place in it. Two ranks that overlap tell whether
suffixes agree on any length in between, so they show which suffixes are in one interval of
the suffix array with at least that longest common prefix, without sorting the suffixes.

A repeated run is a maximal stretch of lines, at least `min_words` words together, that also
stands at an earlier place (smaller id, or above in the same document; the two may overlap).
Its lines are deleted there and stay at the first place. The union of all runs is the union of
the shortest stretches of `min_words` words that begin or end at a line and occur earlier, so
only those are looked up. They have at most `min_words` lines, which bounds the rounds of
doubling by its logarithm, at any size of the input.

Only lines that occur twice take part beyond the count. Grouping adds up in map tasks, and the
joins back are between a hot side and one row per group, which adaptive execution splits.

Null texts stay null and empty texts empty. Lines without a word are in no run and stay. Rows
equal in id and text are one document and treated alike; rows that share an id only are two
documents, ordered by a hash of their texts. Rows without an id come first in the order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import tidy
from tillroll.sources.shared import stage

MIN_WORDS = 50

_WORD = r"[^\x20\x09-\x0D]+"


def document(key: str, text: str) -> Column:
    """Names a document, in the order in which the first copy is the one that stays."""
    return F.struct(F.col(key).alias("id"), F.xxhash64(text).alias("own"))


def lines_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, pos, at, a, b, words) of the lines with a word.

    `pos` numbers them without gaps, `at` counts all lines of the text from 0, and a and b
    are the id of the line, two hashes of 64 bits.
    """
    parts = F.filter(
        F.transform(
            F.split(text, "\n"),
            lambda x, i: F.struct(
                i.alias("at"),
                F.xxhash64(x).alias("a"),
                F.xxhash64(F.lit(1), x).alias("b"),
                F.regexp_count(x, F.lit(_WORD)).alias("words"),
            ),
        ),
        lambda x: x["words"] > 0,
    )
    named = docs.where(F.col(text) != "").select(document(key, text).alias("doc"), parts.alias("parts"))
    return named.select("doc", F.posexplode("parts").alias("pos", "part")).select("doc", "pos", "part.*")


def _groups(suffixes: DataFrame, *by: str) -> DataFrame:
    """The first place of each group that has more than one member.

    On disk, so that a join with it shuffles both sides and a hot group can be split.
    """
    return stage(
        suffixes.groupBy(*by)
        .agg(F.min(F.struct("doc", "pos")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )


def _sorted(df: DataFrame) -> DataFrame:
    """The side of a join, to be shuffled and sorted at any size: dozens of joins follow one
    another, and the driver would hold a broadcast table for each."""
    return df.hint("merge")


def _stretches(active: DataFrame, min_words: int) -> DataFrame:
    """(doc, pos, length) of the shortest stretches of enough words that begin or end at a line.

    A sum over the words above is larger by at least one from line to line, so a frame by
    value finds the other end. All windows are over the lines of one document.
    """
    one_doc = Window.partitionBy("doc").orderBy("pos")
    runs = active.withColumn("run", F.col("pos") - F.row_number().over(one_doc))
    run = Window.partitionBy("doc", "run")
    sums = runs.withColumn("upto", F.sum("words").over(run.orderBy("pos"))).withColumn(
        "before", F.col("upto") - F.col("words")
    )
    far = (Window.unboundedPreceding, -min_words)
    sums = (
        sums.withColumn("below", F.last("pos").over(run.orderBy(-F.col("before")).rangeBetween(*far)))
        .withColumn("above", F.last("pos").over(run.orderBy("upto").rangeBetween(*far)))
        .withColumn("top", F.min("pos").over(run))
        .withColumn("bottom", F.max("pos").over(run))
        .withColumn("all", F.max("upto").over(run))
    )
    last = F.coalesce(
        F.col("below") - 1, F.when(F.col("all") - F.col("before") >= min_words, F.col("bottom"))
    )
    first = F.coalesce(F.col("above") + 1, F.when(F.col("upto") >= min_words, F.col("top")))
    begun = sums.select("doc", "pos", (last - F.col("pos") + 1).alias("length"))
    ended = sums.select("doc", first.alias("pos"), (F.col("pos") - first + 1).alias("length"))
    return begun.union(ended).where("length is not null").distinct()


def repeated_lines(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, at) of every line in a repeated run that also stands at an earlier place."""
    names = _groups(lines, "a", "b").withColumnRenamed("first", "rank")
    active = stage(
        lines.join(_sorted(names), ["a", "b"]).select("doc", "pos", "at", "words", "rank").distinct()
    )
    stretches = stage(_stretches(active, min_words))
    longest = stretches.agg(F.max("length")).first()[0] or 0
    ranks, size = active.select("doc", "pos", "rank"), 1
    levels = ranks.withColumn("size", F.lit(1))
    while 2 * size <= longest:
        ahead = Window.partitionBy("doc").orderBy("pos").rangeBetween(size, size)
        pairs = ranks.withColumn("rank_tail", F.first("rank").over(ahead)).where("rank_tail is not null")
        doubled = _groups(pairs, "rank", "rank_tail")
        ranks = stage(
            pairs.join(_sorted(doubled), ["rank", "rank_tail"]).select("doc", "pos", F.col("first").alias("rank"))
        )
        size *= 2
        levels = levels.union(ranks.withColumn("size", F.lit(size)))
        tidy(lines.sparkSession)
    # the first and the last lines of a stretch, the largest power of two of them, overlap and
    # so name the whole
    halves = stretches.withColumn("size", F.expr("shiftleft(1, length(bin(length)) - 1)"))
    tails = levels.select("doc", F.col("pos").alias("tail"), "size", F.col("rank").alias("rank_tail"))
    named = stage(
        halves.withColumn("tail", F.col("pos") + F.col("length") - F.col("size"))
        .join(_sorted(levels), ["doc", "pos", "size"])
        .join(_sorted(tails), ["doc", "tail", "size"])
        .select("doc", "pos", "rank", "rank_tail", "length")
    )
    same = ["rank", "rank_tail", "length"]
    later = (
        named.join(_sorted(_groups(named, *same)), same)
        .where(F.struct("doc", "pos") > F.col("first"))
        .select("doc", F.explode(F.expr("sequence(pos, pos + length - 1)")).alias("pos"))
        .distinct()
    )
    places = active.select("doc", "pos", "at")
    return places.join(_sorted(later), ["doc", "pos"]).select("doc", "at")


def dedup_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All columns of `docs`, `text` without the later copies, and n_lines and n_deleted, which
    replace columns of that name.

    Kept lines are cut out as slices between the deleted ones, in one pass over the text.
    """
    # numbered, so that no column of `docs` can clash with one of ours
    plain = docs.toDF(*(f"_c{i}" for i in range(len(docs.columns))))
    id_, said = (F.col(f"_c{docs.columns.index(c)}") for c in (key, text))
    lines = stage(lines_of(plain, f"_c{docs.columns.index(key)}", f"_c{docs.columns.index(text)}"))  # read twice
    gone = (
        repeated_lines(lines, min_words)
        .groupBy("doc")
        .agg(F.sort_array(F.collect_set("at")).alias("gone"))
        .select(F.col("doc.id").alias("id"), F.col("doc.own").alias("own"), "gone")
    )
    joined = plain.withColumn("hash", F.xxhash64(said)).join(
        gone, id_.eqNullSafe(F.col("id")) & (F.col("hash") == F.col("own")), "left"
    )
    added = ("n_lines", "n_deleted")
    lines, n = F.split(said, "\n"), F.size(F.split(said, "\n"))
    slices = F.zip_with(
        F.concat(F.array(F.lit(-1)), "gone"),
        F.concat("gone", F.array(n)),
        lambda a, b: F.slice(lines, a + 2, b - a - 1),
    )
    rest = F.when(F.col("gone").isNull(), said).otherwise(F.array_join(F.flatten(slices), "\n"))
    return joined.select(
        *(
            (rest if c == text else F.col(f"_c{i}")).alias(c)
            for i, c in enumerate(docs.columns)
            if c not in added
        ),
        F.when(said.isNotNull(), n).otherwise(0).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_deleted"),
    )
