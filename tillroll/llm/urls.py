"""URL filters: allow and block rules, and a logistic regression for what no rule fits.

The regression reads hashed character n-grams of host and path, and is trained from a small
table of labelled URLs. Everything is columns and the DataFrame estimators of Spark, so no row
leaves the JVM.

Null URLs and URLs without `://` have an empty host and path and fit no rule; the regression
judges them like any other. Equal URLs have equal verdicts. A label table that is empty gives
`allow`, one of a single label gives that label.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_sample
from tillroll.sources.shared import stage

#: (verdict, host/path), the host with all its subdomains, the path as a beginning.
Rules = tuple[tuple[str, str], ...]
#: Labelled URLs of each verdict that the regression is fitted on at most.
FIT_ROWS = 1000
BUCKETS = 2048
GRAM = 4
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def longest_rule(rules: Rules, host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null where none does.

    The rules become one conditional, longest first, so they are meant to be some dozens.
    """
    rule, verdict = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(""))
    for says, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, verdict = rule.when(fits, F.lit(text)), verdict.when(fits, F.lit(says))
    return rule, verdict


def _grams(part: Column, mark: str) -> Column:
    """Character n-grams of a host or path, its ends marked."""
    text = F.concat(F.lit("^"), part, F.lit("$"))
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(text) - GRAM + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substr(text, i, F.lit(GRAM))))


def with_features(urls: DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    """`urls` with a vector of hashed n-grams, whether each is there."""
    grams = F.concat(_grams(F.col(host), "h"), _grams(F.col(path), "p"))
    hashing = HashingTF(numFeatures=BUCKETS, binary=True, inputCol="_grams", outputCol="_features")
    return hashing.transform(urls.withColumn("_grams", grams)).drop("_grams")


def train(labelled: DataFrame, rows: int = FIT_ROWS) -> LogisticRegressionModel | str:
    """Fit on labelled URLs (host, path, verdict), or the one verdict there is."""
    counts = labelled.groupBy("verdict").count().collect()
    if len(counts) < 2:
        return counts[0]["verdict"] if counts else "allow"
    # a few thousand rows, read again in each pass of the fit
    chosen = bounded_sample(labelled, rows, ["host", "path", "verdict"], by="verdict")
    some = stage(chosen.orderBy("host", "path", "verdict").coalesce(1))
    data = with_features(some).withColumn("_label", (F.col("verdict") == "block").cast("double"))
    estimator = LogisticRegression(
        featuresCol="_features", labelCol="_label", regParam=0.001, maxIter=60,
        rawPredictionCol="_raw", probabilityCol="_probability", predictionCol="_prediction",
    )
    return estimator.fit(data)


def judge(
    pages: DataFrame, rules: Rules, labelled: DataFrame | None = None, key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """Per row of `pages`: key, host, path, rule, verdict and p_block (the regression's).

    `labelled` has (host, path, verdict). Without it the pages that a rule fits are the
    labelled URLs, so the regression carries the rules over to similar hosts and paths.
    """
    parts = pages.select(key, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule, says = longest_rule(rules, F.col("host"), F.col("path"))
    ruled = parts.withColumns({"rule": rule, "verdict": says})
    model = train(ruled.where("verdict is not null") if labelled is None else labelled)
    if isinstance(model, str):
        scored = ruled.withColumn("p_block", F.lit(float(model == "block")))
    else:
        made = model.transform(with_features(ruled))
        scored = made.withColumn("p_block", vector_to_array("_probability")[1])
    learned = F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")
    return scored.select(
        key, "host", "path", "rule", F.coalesce("verdict", learned).alias("verdict"), "p_block"
    )
