"""Operator 6, quality rules learned as decision lists.

Statistics of whole texts are DataFrame expressions. Rules are learned from
labelled rows by sequential covering: a rule is grown condition by condition
(the threshold with the largest information gain for the bad class), pruned
from its end on rows that growing did not see, kept if it is still precise
there, and the bad rows that it covers are taken away before the next one. The list
becomes one ordered ``when ... when ... otherwise`` expression.

The learner runs on the driver over at most about ``SAMPLE`` labelled rows
of a dozen numbers; everything else is expressions over all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import SPACE, documents, own_names, text_or_empty, without

#: Labelled rows that rules are learned from, about; a hash of doc_id picks them.
SAMPLE = 6_000
#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
MIN_PRECISION = 0.95
#: Bad rows that each condition must keep, and that a rule must cover of those that growing did not see.
MIN_COVER = 6
#: Rules in a row that may be tried and not taken before the list ends.
MISSES = 8
THRESHOLDS = 64

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Name of each ratio that rules may use, with its SQL over the statistics.
FEATURES = {
    "symbol_share": "n_symbols / word_chars",
    "mark_share": "n_marks / word_chars",
    "upper_share": "n_upper / word_chars",
    "digit_share": "n_digits / word_chars",
    "word_length": "word_chars / n_words",
    "distinct_share": "n_distinct_words / n_words",
    "repeat_share": "n_repeat_words / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "line_words": "n_words / n_lines",
    "words": "n_words",
}


def _less(text: Column, characters: str) -> Column:
    """How many of the characters the text has."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words inside WINDOW-word windows that occur at least twice.

    Windows are hashed to 64 bits, sorted with their places, and equal neighbours kept;
    the words under the kept places are counted from the gaps between them.
    """
    count = F.size(words)
    windows = F.when(
        count >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), count - WINDOW),
            lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]).alias("h"), i.alias("i")),
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    return F.sort_array(windows)


def with_statistics(df: DataFrame) -> DataFrame:
    """``df`` with its texts' statistics (BASE, a few more counts, FEATURES) as columns.

    A null text has no words. Equal-named columns of ``df`` are replaced.
    """
    extra = ("n_lines", "n_distinct_words", "n_upper", "n_marks", "n_digits")
    out = without(df, *BASE, *extra, *FEATURES, "_text", "_words", "_lines", "_windows", "_places")
    text = F.col("_text")
    out = out.withColumn("_text", text_or_empty())
    out = out.withColumns({
        "_words": F.filter(F.split(text, SPACE + "+"), lambda w: w != ""),
        "_lines": F.filter(F.split(text, "\n"), lambda s: F.translate(s, WHITE, "") != ""),
    })
    out = out.withColumns({
        "_windows": _repeat_words(F.col("_words")),
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.translate(text, WHITE, "")).cast("long"),
        "n_symbols": _less(text, SYMBOLS),
        "n_marks": _less(text, "!?"),
        "n_digits": _less(text, "0123456789"),
        "n_upper": (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long"),
        "n_distinct_words": F.size(F.array_distinct("_words")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    })
    windows = F.col("_windows")
    twice = F.filter(
        windows,
        lambda x, k: (x["h"] == F.get(windows, k - 1)["h"]).eqNullSafe(True) | (x["h"] == F.get(windows, k + 1)["h"]).eqNullSafe(True),
    )
    out = out.withColumn("_places", F.sort_array(F.transform(twice, lambda x: x["i"])))
    places = F.col("_places")
    covered = F.transform(places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW))))
    n_repeat = F.aggregate(covered, F.lit(0), lambda a, x: a + x).cast("long").alias("n_repeat_words")
    counts = [c for c in (*BASE, *extra) if c != "n_repeat_words"]
    # The counts pass through a generator of one row, so that a filter on them is not
    # pushed down into a copy of these long expressions.
    hidden = {"_text", "_words", "_lines", "_windows", "_places", *counts}
    own = [F.col(f"`{c}`") for c in out.columns if c not in hidden]
    out = out.select(*own, F.inline(F.array(F.struct(*counts, n_repeat))))
    ratios = {name: F.expr("coalesce(" + (f"try_divide({sql.replace(' / ', ', ')})" if "/" in sql else f"double({sql})") + ", 0D)") for name, sql in FEATURES.items()}
    return out.withColumns(ratios)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value > threshold, else value <= threshold
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.feature]
        return x > self.threshold if self.above else x <= self.threshold

    def column(self) -> Column:
        x = F.col(self.feature)
        return x > self.threshold if self.above else x <= self.threshold


Rule = tuple[Condition, ...]


def _covers(rule: Rule, values: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    for c in rule:
        rows = rows & c.holds(values)
    return rows


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
    rule: Rule = ()
    while True:
        p0, n0 = np.count_nonzero(bad & rows), np.count_nonzero(~bad & rows)
        if not p0 or not n0:
            break
        best, gain = None, 1e-9
        for name, x in values.items():
            held = x[rows]
            cuts = np.unique(np.quantile(held, np.linspace(0, 1, THRESHOLDS + 1)[:-1], method="lower"))
            for cut in cuts.tolist():
                for above in (True, False):
                    took = rows & (x > cut if above else x <= cut)
                    p, n = np.count_nonzero(bad & took), np.count_nonzero(~bad & took)
                    if p >= MIN_COVER and (g := p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))) > gain:
                        best, gain = Condition(name, above, cut), g
        if best is None:
            break
        held = values[best.feature][rows]
        # Halfway to the next value that was seen: the same rows, the widest margin.
        best = Condition(best.feature, best.above, float((best.threshold + held[held > best.threshold].min(initial=np.inf, where=True)) / 2) if (held > best.threshold).any() else best.threshold)
        rule, rows = (*rule, best), rows & best.holds(values)
    return rule


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        took = _covers(r, values, rows)
        p, n = np.count_nonzero(bad & took), np.count_nonzero(~bad & took)
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)


def learn_rules(values: dict[str, np.ndarray], bad: np.ndarray, fold: np.ndarray) -> list[Rule]:
    """A decision list for the bad rows; ``fold`` (0, 1 or 2) 2 is kept for pruning.

    A rule is taken if its precision on all remaining rows and on the pruning
    rows is at least MIN_PRECISION and it covers MIN_COVER bad ones of the
    latter, so clean rows are left alone. The bad rows of one that is not taken
    start no other rule; after MISSES of those in a row, or when too few bad
    rows are left, the list ends. No bad rows give no rules.
    """
    rules: list[Rule] = []
    rest, untried, misses = np.ones(len(bad), bool), np.ones(len(bad), bool), 0
    while misses < MISSES and np.count_nonzero(bad & rest & untried) >= MIN_COVER:
        rule = _grow(values, bad, rest & untried & (fold != 2))
        if not rule:
            break
        rule = _prune(rule, values, bad, rest & (fold == 2))
        took = _covers(rule, values, rest)
        unseen = took & (fold == 2)
        if all(np.count_nonzero(bad & rows) >= max(MIN_COVER, MIN_PRECISION * np.count_nonzero(rows)) for rows in (took, unseen)):
            rules.append(rule)
            rest &= ~took
            misses = 0
        else:
            untried &= ~(took & bad)
            misses += 1
    return rules


def fit(df: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Rules for rows of ``df`` (doc_id, text) whose label (doc_id, quality 0 or 1) is 0.

    Only rows that pass the base limits are learned from. Rows without a
    label, or with a null one, are ignored; no labels give no rules. A doc_id
    that is labelled or held several times counts once, by its lowest label and numbers.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    count = known.count()
    if not count:
        return []
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003))
    chosen = known.where(pick < F.lit(min(1.0, sample / count) * 1_000_003))  # about `sample` rows: small enough to broadcast
    rows = with_statistics(df.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")).where(~base_failed())
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(3)).alias("fold")
    picked = rows.select("doc_id", fold, F.struct("quality", *FEATURES).alias("row")).groupBy("doc_id", "fold").agg(F.min("row").alias("row"))
    got = sorted(picked.select("doc_id", "fold", "row.*").collect())
    if not got:
        return []
    values = {name: np.array([r[name] for r in got], float) for name in FEATURES}
    return learn_rules(values, np.array([r["quality"] == 0 for r in got]), np.array([r["fold"] for r in got]))


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule (from 1) that rejects a row, as ordered conditions; null if none does."""
    column = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        column = F.when(test, number).otherwise(column)
    return column


def judge(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``df`` with statistics, base_failed, rule (the rejecting rule's number) and kept.

    An empty or null text fails the base limits. Rows are answered one for
    one; an empty table gives no rows.
    """
    out = with_statistics(without(df, "base_failed", "rule", "kept"))
    out = out.withColumn("base_failed", base_failed())
    out = out.withColumn("rule", F.when(~F.col("base_failed"), verdict(rules)))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows of ``df`` that ``judge`` keeps; columns and values stay as they are, whatever their names."""
    base, own = own_names(df, "text")
    return judge(base, rules).where("kept").select(*own.values())


def op6_quality(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rules = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, rules).select("doc_id", *BASE, "base_failed", "kept", "rule")
