"""Quality rules learned as a decision list and applied as Spark conditions.

Statistics of labelled documents come from Spark expressions. Sequential covering
then grows a rule, a conjunction of thresholds, on two thirds of the labelled
sample, prunes it on the rest, keeps it if it is precise enough there, takes away
what it covers and goes on with what is left. The rules are readable and become
one ordered ``CASE`` expression: the first rule that holds rejects.

Applying it is DataFrame expressions only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.shared import GAP, WORD, text_or_empty

SAMPLE = 20_000
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"

# Statistics a rule may test, from the columns of ``text_statistics``.
RATES = {
    "words": "n_words",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "repeated_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
}


def text_statistics(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: ``row`` (all its columns) and counts over the whole text.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``,
    ``n_dup_lines`` (lines with a word that equal an earlier line),
    ``n_repeat_words`` (words in windows of ``window`` words that occur twice or
    more), and ``n_lines``, ``n_distinct``, ``n_upper``, ``n_marks``, ``n_digits``
    for the rules. Null text counts as empty: every count is 0.

    Windows are compared by a 64-bit hash. Positions of repeated windows come from
    one sort of the row's own windows, and only for rows that have any.
    """
    base = docs.select(F.struct("*").alias("row"), text_or_empty(text).alias("t"))
    words = base.select(
        "row", "t", F.array_remove(F.split("t", GAP), "").alias("words"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD))
        .alias("lines"),
        F.regexp_replace("t", GAP, "").alias("solid"))
    hashes = words.select("row", "solid", "lines", F.size("words").cast("long").alias("n_words"),
                          F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    # a window of hashes starts at each word that has enough words after it
    starts = F.col("n_words").cast("int") - (window - 1)
    grams = F.when(starts > 1, F.transform(
        F.slice("hashes", F.lit(1), F.greatest(starts, F.lit(0))),
        lambda _, i: F.xxhash64(F.slice("hashes", i + 1, F.lit(window)))))
    windows = hashes.select("row", "solid", "lines", "n_words", grams.alias("grams"),
                            F.size(F.array_distinct("hashes")).cast("long").alias("n_distinct"))
    some = F.size(F.array_distinct("grams")) < F.size("grams")
    ordered = F.when(some, F.sort_array(F.transform(
        "grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    sorted_ = windows.select("row", "solid", "lines", "n_words", "n_distinct",
                             ordered.alias("ordered"))
    # ``ordered`` is used twice, so the optimizer leaves it where it is computed
    met = F.sort_array(F.transform(F.filter("ordered", lambda x, i: (
        (x["g"] == F.get("ordered", i + 1).getField("g"))
        | (x["g"] == F.get("ordered", i - 1).getField("g")))), lambda x: x["i"]))
    positions = sorted_.select("row", "solid", "lines", "n_words", "n_distinct",
                               met.alias("positions"))
    covered = F.aggregate(
        "positions", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct((a["n"] + p + window - F.greatest(p, a["end"])).alias("n"),
                              (p + window).alias("end")))["n"]
    solid = F.col("solid")

    def count_of(chars: str) -> Column:
        return F.regexp_count(solid, F.lit(chars)).cast("long")

    return positions.select(
        "row", "n_words", F.char_length(solid).cast("long").alias("word_chars"),
        count_of(SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"), "n_distinct",
        count_of("[A-Z]").alias("n_upper"), count_of("[.,;:!?\"'()\\[\\]{}]").alias("n_marks"),
        count_of("[0-9]").alias("n_digits"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Test:
    """One threshold: the statistic is at least (or at most) the bound."""

    name: str
    above: bool
    bound: float

    def holds(self, row: dict) -> bool:
        return row[self.name] >= self.bound if self.above else row[self.name] <= self.bound

    def condition(self) -> Column:
        value = F.expr(RATES[self.name])
        return value >= F.lit(self.bound) if self.above else value <= F.lit(self.bound)


Rule = tuple[Test, ...]


def _covered(rule: Sequence[Test], rows: list[dict]) -> list[dict]:
    return [r for r in rows if all(t.holds(r) for t in rule)]


def _bounds(rows: list[dict], bins: int) -> list[Test]:
    """Thresholds at the quantiles of each statistic, midway between neighbours."""
    tests = []
    for name in RATES:
        values = sorted({r[name] for r in rows})
        steps = sorted({round(i * (len(values) - 1) / bins) for i in range(bins + 1)})
        for i in steps:
            if i + 1 < len(values):
                middle = (values[i] + values[i + 1]) / 2
                tests += [Test(name, True, middle), Test(name, False, middle)]
    return tests


def _grow(rows: list[dict], bins: int, longest: int) -> Rule:
    """Add the threshold with the greatest information gain until no good row is covered."""
    rule: list[Test] = []
    while len(rule) < longest and any(not r["bad"] for r in rows):
        bad = sum(r["bad"] for r in rows)
        if not bad:
            break
        before = math.log2(bad / len(rows))
        best, gain = None, 1e-9
        for test in _bounds(rows, bins):
            inside = [r for r in rows if test.holds(r)]
            hits = sum(r["bad"] for r in inside)
            if hits:
                now = hits * (math.log2(hits / len(inside)) - before)
                if now > gain:
                    best, gain = test, now
        if best is None:
            break
        rule.append(best)
        rows = [r for r in rows if best.holds(r)]
    return tuple(rule)


def _worth(rule: Sequence[Test], rows: list[dict]) -> float:
    inside = _covered(rule, rows)
    bad = sum(r["bad"] for r in inside)
    return (bad - (len(inside) - bad)) / max(len(inside), 1)


def _prune(rule: Rule, rows: list[dict]) -> Rule:
    """The shortest beginning of the rule that is worth most on rows it was not grown on."""
    ends = [(_worth(rule[:i], rows), -i) for i in range(1, len(rule) + 1)]
    return rule[:-max(ends)[1]] if ends else rule


def learn(rows: list[dict], precision: float = 0.95, least: int = 5, most_rules: int = 12,
          longest: int = 4, bins: int = 24) -> list[Rule]:
    """Ordered reject rules from rows with the statistics of ``RATES`` and ``bad`` (bool).

    A rule stays if at least ``least`` held-back rows are covered and ``precision``
    of them are bad. Without rows of both kinds there are no rules.
    """
    rules: list[Rule] = []
    grow_on, prune_on = rows[0::3] + rows[1::3], rows[2::3]
    while len(rules) < most_rules and any(r["bad"] for r in grow_on) and not all(
            r["bad"] for r in grow_on):
        rule = _prune(_grow(grow_on, bins, longest), prune_on)
        inside = _covered(rule, prune_on)
        if not rule or len(inside) < least or (
                sum(r["bad"] for r in inside) < precision * len(inside)):
            break
        rules.append(rule)
        grow_on = [r for r in grow_on if not all(t.holds(r) for t in rule)]
        prune_on = [r for r in prune_on if not all(t.holds(r) for t in rule)]
    return rules


def labelled_rows(docs: DataFrame, labels: DataFrame, text: str = "text",
                  doc_id: str = "doc_id", sample: int = SAMPLE) -> list[dict]:
    """Statistics of at most ``sample`` labelled documents, least hashes of the id first.

    Rows without id or label are left out. ``sample`` bounds what is broadcast
    and what comes to the driver.
    """
    chosen = (labels.where(F.col("quality").isNotNull() & F.col(doc_id).isNotNull())
              .groupBy(F.col(doc_id).alias("label_id"))
              .agg((F.max("quality") == 0).alias("bad"))
              .orderBy(F.xxhash64("label_id"), "label_id").limit(sample))
    found = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(
        F.broadcast(chosen), F.col("id") == F.col("label_id"))
    stats = text_statistics(found)
    rows = (stats.select("row.id", "row.bad", *[F.expr(e).cast("double").alias(n)
                                                for n, e in RATES.items()])
            .orderBy(F.xxhash64("id"), "id", *RATES).limit(sample).collect())
    return [r.asDict() for r in rows]


def rejects(rules: Sequence[Rule]) -> Column:
    """The decision list as one ordered conditional over ``text_statistics``."""
    verdict = F.lit(False)
    for rule in reversed(rules):
        holds = F.lit(True)
        for test in rule:
            holds = holds & test.condition()
        verdict = F.when(holds, F.lit(True)).otherwise(verdict)
    return verdict


def describe(rules: Sequence[Rule]) -> list[str]:
    return [" and ".join(f"{t.name} {'>=' if t.above else '<='} {t.bound:g}" for t in rule)
            for rule in rules]


def judged(docs: DataFrame, labels: DataFrame, text: str = "text",
           doc_id: str = "doc_id") -> DataFrame:
    """``text_statistics`` with ``base_failed`` and ``kept``.

    A row that fails the base rules is not kept; else the learned list decides.
    Null and empty texts fail the base rules. Without labels of both kinds only the
    base rules reject. Repeated rows are judged alike; an empty table gives an
    empty result.
    """
    rules = learn(labelled_rows(docs, labels, text, doc_id))
    return (text_statistics(docs, text).withColumn("base_failed", base_failed())
            .withColumn("kept", F.when(F.col("base_failed"), False)
                        .otherwise(~rejects(rules))))


def quality_filter(docs: DataFrame, labels: DataFrame, text: str = "text",
                   doc_id: str = "doc_id") -> DataFrame:
    """The documents that pass, columns as they were."""
    # a filter over a row number stays above the statistics; pushed below them, it
    # would work them out again inside of their own lambdas
    return (judged(docs, labels, text, doc_id)
            .withColumn("place", F.monotonically_increasing_id())
            .where(F.col("kept") & (F.col("place") >= 0)).select("row.*"))
