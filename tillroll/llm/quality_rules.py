"""Quality rules learned as a decision list over countable facts of a text.

Sequential covering: a rule is grown on two thirds of the labelled rows by adding the
threshold with the highest information gain, then pruned on the other third by cutting
conditions off its end while that helps. The rows it covers leave, and the next rule is
grown, until no bad row is left. A rule that is not precise on the other third is thrown away,
and the bad rows it was grown for are given up. The list comes out as ordered Spark
conditional expressions over the columns of facts, so it can be read, stored and changed.

Null and empty texts have no words: all counts are 0 and the base rule fails. Ratios with
nothing below the line are 0. Equal texts have equal facts. With labels of one kind only, the
list is empty and the base rule alone decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import labelled_texts, map_rows, utf8, word_hashes

#: Labelled rows of each kind that rules are learned from at most.
FIT_ROWS = 6000
WINDOW = 8
MAX_CONDITIONS = 3
#: Share of bad rows among those a rule covers, on rows it was not grown on.
MIN_PRECISION = 0.95
#: Thresholds tried for each fact.
CUTS = 64

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_echoes",
    "n_capitals",
)
BASE_COUNTS = COUNTS[:5]
#: What rules may look at: a count, or one count by another.
FACTS = {
    "words": ("n_words", None),
    "mean word length": ("word_chars", "n_words"),
    "symbols per character": ("n_symbols", "word_chars"),
    "repeated lines per line": ("n_dup_lines", "n_lines"),
    "words in repeated windows": ("n_repeat_words", "n_words"),
    "words equal to the one before": ("n_echoes", "n_words"),
    "words per line": ("n_words", "n_lines"),
    "capitals per character": ("n_capitals", "word_chars"),
}

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[*b"#*$%&|<>"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SALTS = word_hashes(b"a b c d e f g h") | np.uint64(1)


def facts_of(text: str | None) -> tuple[int, ...]:
    """The counts of a whole text, in the order of COUNTS."""
    data = utf8(text)
    raw, words = np.frombuffer(data, np.uint8), word_hashes(data)
    n = len(words)
    if not n:
        return (0,) * len(COUNTS)
    starts = (raw & 0xC0) != 0x80  # the first byte of each character
    lines = [x for x in data.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    repeated = 0
    if n > WINDOW:
        total = np.zeros(n - WINDOW + 1, np.uint64)
        for j in range(WINDOW):
            total += words[j : n - WINDOW + 1 + j] * _SALTS[j]
        _, which, counts = np.unique(total, return_inverse=True, return_counts=True)
        edges = np.zeros(n + 1, np.int64)
        again = np.flatnonzero(counts[which] > 1)
        edges[again] += 1
        edges[again + WINDOW] -= 1
        repeated = int((np.cumsum(edges) > 0).sum())
    return (
        n,
        int((starts & ~_SPACE[raw]).sum()),
        int(_SYMBOLS[raw].sum()),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        int((words[1:] == words[:-1]).sum()),
        int(((raw >= 65) & (raw <= 90)).sum()),
    )


def with_facts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """Per row: key, the columns of `carry`, and the counts."""

    def make():
        def work(*columns):
            made = list(zip(*map(facts_of, columns[-1]))) or [()] * len(COUNTS)
            return *columns[:-1], *made

        return work

    types = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (key, *carry)]
    schema = ", ".join([*types, *(f"{c} bigint" for c in COUNTS)])
    return map_rows(docs, [key, *carry, F.col(text).alias("_text")], schema, make)


@dataclass(frozen=True)
class Condition:
    fact: str
    at_least: bool
    cut: float

    def __str__(self) -> str:
        return f"{self.fact} {'>=' if self.at_least else '<'} {self.cut:.6g}"

    def column(self) -> Column:
        over, under = FACTS[self.fact]
        value = F.col(over).cast("double")
        if under:
            value = F.when(F.col(under) > 0, value / F.col(under)).otherwise(F.lit(0.0))
        return value >= self.cut if self.at_least else value < self.cut

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.fact] >= self.cut if self.at_least else values[self.fact] < self.cut


Rule = tuple[Condition, ...]


def fact_values(counts: np.ndarray) -> dict[str, np.ndarray]:
    at = {c: counts[:, i].astype(float) for i, c in enumerate(COUNTS)}
    return {
        name: at[over] if under is None else at[over] / np.where(at[under] > 0, at[under], np.inf)
        for name, (over, under) in FACTS.items()
    }


def _covered(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for condition in rule:
        out &= condition.holds(values)
    return out


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Add the condition with the highest gain until the rule covers bad rows only."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and (inside & ~bad).any():
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        best, choice = 1e-9, None
        for fact, v in values.items():
            mine, truth = v[inside], bad[inside]
            cuts = np.unique(np.quantile(np.concatenate([mine, mine[truth]]), np.linspace(0, 1, CUTS)))
            order = np.argsort(mine)
            below = np.searchsorted(mine[order], cuts)
            sums = np.append(0, np.cumsum(truth[order]))
            for at_least in (True, False):
                p1 = p - sums[below] if at_least else sums[below]
                all1 = len(mine) - below if at_least else below
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = p1 * (np.log2(p1 / all1) - np.log2(p / (p + n)))
                gain = np.nan_to_num(gain, nan=-1.0, neginf=-1.0)
                k = int(np.argmax(gain))
                if gain[k] > best:
                    # between the cut and the next value on the other side
                    lower = mine[order][below[k] - 1] if below[k] else cuts[k]
                    best = gain[k]
                    choice = Condition(fact, at_least, float((cuts[k] + lower) / 2))
        if choice is None:
            break
        rule += (choice,)
        inside &= choice.holds(values)
    return rule


def _worth(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> float:
    inside = _covered(rule, values, len(bad))
    p, n = (inside & bad).sum(), (inside & ~bad).sum()
    return float((p - n) / (p + n)) if p + n else -1.0


def learn(counts: np.ndarray, bad: np.ndarray, seed: int = 3) -> list[Rule]:
    """An ordered list of rules that tell bad rows."""
    rules: list[Rule] = []
    rng = np.random.default_rng(seed)
    part = rng.random(len(bad)) < 2 / 3
    values = fact_values(counts)
    alive = np.ones(len(bad), bool)
    while (bad & alive & part).any() and (~bad & alive & part).any():
        grown, other = alive & part, alive & ~part
        take = {f: v[grown] for f, v in values.items()}
        check = {f: v[other] for f, v in values.items()}
        rule = _grow(take, bad[grown])
        if not rule:
            break
        # the shortest of the best beginnings
        rule = max((rule[: k + 1] for k in range(len(rule))), key=lambda r: (_worth(r, check, bad[other]), -len(r)))
        inside = _covered(rule, check, int(other.sum()))
        covered = _covered(rule, values, len(bad))
        if not (covered & grown & bad).any():
            break
        if inside.any() and bad[other][inside].mean() >= MIN_PRECISION:
            rules.append(rule)
            alive &= ~covered
        else:
            alive &= ~(covered & grown & bad)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered conditional: false where a rule fires, else true."""
    out: Column | None = None
    for rule in rules:
        condition = rule[0].column()
        for c in rule[1:]:
            condition = condition & c.column()
        out = F.when(condition, False) if out is None else out.when(condition, False)
    return F.lit(True) if out is None else out.otherwise(True)


def reason(rules: list[Rule]) -> Column:
    """The first rule that fires, in words, or null."""
    out: Column | None = None
    for rule in rules:
        condition, words = rule[0].column(), " and ".join(map(str, rule))
        for c in rule[1:]:
            condition = condition & c.column()
        out = F.when(condition, words) if out is None else out.when(condition, words)
    return F.lit(None).cast("string") if out is None else out


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality", rows: int = FIT_ROWS,
) -> list[Rule]:
    """Learn from the counts of a bounded sample of labelled rows; texts stay in the tasks."""
    found = labelled_texts(docs, labels, key, text, label, (0, 1), rows)
    got = with_facts(found, "label", "text").toPandas().sort_values(["label", *COUNTS])
    return learn(got[[*COUNTS]].to_numpy(np.int64), got["label"].to_numpy() == 0)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judge(
    docs: DataFrame, rules: list[Rule], key: str = "doc_id", text: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: key, the columns of `carry`, the counts of the base, base_failed, kept, and then
    the other counts and the rule that fired."""
    return with_facts(docs, key, text, carry).select(
        key,
        *carry,
        *BASE_COUNTS,
        base_failed().alias("base_failed"),
        F.when(base_failed(), False).otherwise(verdict(rules)).alias("kept"),
        *(c for c in COUNTS if c not in BASE_COUNTS),
        reason(rules).alias("rule"),
    )
