"""Quality rules: word statistics, and a decision list learned from labelled documents.

Everything is a DataFrame expression. The statistics of a text are computed inside its row, from sorted
arrays, so nothing is shuffled and a long text costs n log n.

The list is learned by sequential covering. Labelled statistics are counted by cells (the bins of all
features, cut at quantiles), half of them for growing and half for pruning. A rule is a conjunction of
thresholds: it grows by the condition of the largest information gain until it covers low quality
alone, loses last conditions while that improves it on the pruning cells, and what it covers is
removed before the next one. The rules become one ordered conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import letters

BLANK = r"[\x20\x09-\x0D]+"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: Bounds of the fit: labelled rows (chosen by a hash of their id), cuts a feature, conditions a rule
#: and rules. The rows bound the cells, which the driver holds.
SAMPLE_ROWS = 200_000
CUTS = 12
MAX_CONDITIONS = 4
MAX_RULES = 12
#: A rule must be right this often on the pruning cells, and cover so many rows of all.
LEAST_PRECISION = 0.95
LEAST_COVER = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK), "")


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, by 64-bit hashes of the windows."""
    places = F.sequence(F.lit(0), F.size(words) - 3)
    windows = F.transform(places, lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))

    def twice(s: Column) -> Column:
        found = F.transform(s, lambda x, j: F.when((x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]), x["i"]))
        return F.sort_array(F.filter(found, lambda i: i.isNotNull()))

    def covered(starts: Column) -> Column:
        parts = F.transform(starts, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(starts, j + 1) - x, F.lit(3))))
        return F.aggregate(parts, F.lit(0), lambda a, b: a + b)

    counted = let(let(F.sort_array(windows), twice), covered)
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(counted).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line, and lines with a word."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"), F.size(x).cast("long").alias("n_lines")))


def count_of(text: Column, pattern: str) -> Column:
    """Characters outside of runs of ``pattern`` (a negated class): what is left of the text."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def word_statistics(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of each whole text: words, their characters, symbols, capitals, marks, repeats.

    A NULL text has no words, so all counts are 0. Repeated rows give repeated rows; other columns are
    not read; no rows give no rows.
    """
    whole = letters(F.col("text"))
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = chosen.select(
        "doc_id",
        let(word_array(whole), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeated"))).alias("words"),
        count_of(whole, r"[\x20\x09-\x0D]+").alias("word_chars"),
        count_of(whole, r"[^#*$%&|<>]+").alias("n_symbols"),
        repeated_lines(whole).alias("lines"),
        count_of(whole, r"\P{Lu}+").alias("n_capitals"),
        count_of(whole, r"[^!?]+").alias("n_marks"),
    )
    return counted.select(
        "doc_id",
        F.col("words.n").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("lines.n_dup_lines").alias("n_dup_lines"),
        F.col("words.repeated").alias("n_repeat_words"),
        F.col("lines.n_lines").alias("n_lines"),
        "n_capitals",
        "n_marks",
    )


def share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))


def features() -> dict[str, Column]:
    """What rules may compare with thresholds."""
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
        "marks_per_word": share("n_marks", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    """``feature > cut`` if above, else ``feature <= cut``; ``bin`` is the cut's place among the cuts."""

    feature: str
    bin: int
    cut: float
    above: bool

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.cut if self.above else value <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:g}"


Rule = tuple[Condition, ...]
Cell = tuple[tuple[int, ...], int, int]  # bins, rows of low quality, other rows


def _within(cells: list[Cell], rule: Rule, names: list[str]) -> list[Cell]:
    for c in rule:
        k = names.index(c.feature)
        cells = [x for x in cells if (x[0][k] > c.bin) == c.above]
    return cells


def _sums(cells: list[Cell]) -> tuple[int, int]:
    return sum(x[1] for x in cells), sum(x[2] for x in cells)


def _best(cells: list[Cell], cuts: dict[str, list[float]]) -> Condition | None:
    """The condition of the largest information gain (positives kept times bits gained)."""
    low, other = _sums(cells)
    if not low or not other:
        return None
    base = math.log2(low / (low + other))
    best, gain = None, 1e-9
    for k, (name, values) in enumerate(cuts.items()):
        lows, others = [0] * (len(values) + 1), [0] * (len(values) + 1)
        for bins, a, b in cells:
            lows[bins[k]] += a
            others[bins[k]] += b
        a = b = 0
        for i, cut in enumerate(values):
            a, b = a + lows[i], b + others[i]
            for above, p, n in ((False, a, b), (True, low - a, other - b)):
                if p and (found := p * (math.log2(p / (p + n)) - base)) > gain:
                    best, gain = Condition(name, i, cut, above), found
    return best


def cover(grow: list[Cell], prune: list[Cell], cuts: dict[str, list[float]], max_rules: int, max_conditions: int, least: float) -> list[Rule]:
    """Rules for low quality, in order, by sequential covering."""
    names = list(cuts)
    rules: list[Rule] = []
    while len(rules) < max_rules:
        rule: Rule = ()
        cells = grow
        while len(rule) < max_conditions and (found := _best(cells, cuts)):
            rule += (found,)
            cells = _within(cells, (found,), names)
        if not rule:
            break

        def worth(part: Rule) -> float:
            p, n = _sums(_within(prune, part, names))
            return (p - n) / (p + n) if p + n else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        p, n = _sums(_within(prune, rule, names))
        q, m = _sums(_within(grow, rule, names))
        if p + q < LEAST_COVER or p + q < least * (p + q + n + m) or p < least * (p + n):
            break
        rules.append(rule)
        covered = {x[0] for x in _within(grow, rule, names) + _within(prune, rule, names)}
        grow, prune = ([x for x in cells if x[0] not in covered] for cells in (grow, prune))
    return rules


def learn_rules(
    statistics: DataFrame,
    labels: DataFrame,
    *,
    sample_rows: int = SAMPLE_ROWS,
    cuts: int = CUTS,
    max_rules: int = MAX_RULES,
    max_conditions: int = MAX_CONDITIONS,
    least_precision: float = LEAST_PRECISION,
) -> list[Rule]:
    """A decision list from ``labels`` (doc_id, quality: 0 is low) and ``word_statistics``.

    Rows without a label or id are not used; a document labelled twice has its lower label. Without
    labels of both kinds there are no rules. The result does not depend on the order of rows.
    """
    names = list(features())
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"))
    total = known.count()
    if not total:
        return []
    span = 1 << 31
    rate = min(span, int(span * sample_rows / total) + 1)
    chosen = known.where(F.pmod(F.xxhash64(F.lit("rules"), "doc_id"), F.lit(span)) < rate)
    rows = statistics.join(chosen, "doc_id").select("doc_id", "quality", *[v.alias(k) for k, v in features().items()])
    steps = [(i + 0.5) / cuts for i in range(cuts)]
    low_first = [F.percentile_approx(F.when(F.col("quality") == q, F.col(n)), F.array(*map(F.lit, steps)), F.lit(10_000)).alias(f"{n}{q}") for n in names for q in (0, 1)]
    found = rows.agg(*low_first).first()
    # Cuts lie halfway between neighbouring quantiles, so that a rule keeps a margin to either side.
    values = {n: sorted({v for q in (0, 1) for v in found[f"{n}{q}"] or []}) for n in names}
    limits = {n: [(a + b) / 2 for a, b in zip(v, v[1:], strict=False)] for n, v in values.items()}
    bins = [sum(((F.col(n) > v).cast("int") for v in limits[n]), F.lit(0)).alias(n) for n in names]
    half = (F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0).alias("grows")
    low = F.sum((F.col("quality") == 0).cast("long")).alias("low")
    counted = rows.select(half, "quality", *bins).groupBy("grows", *names).agg(low, F.count("*").alias("n")).collect()
    cells: dict[bool, list[Cell]] = {True: [], False: []}
    for r in sorted(counted, key=lambda r: tuple(r[n] for n in names)):
        cells[r["grows"]].append((tuple(r[n] for n in names), r["low"], r["n"] - r["low"]))
    return cover(cells[True], cells[False], limits, max_rules, max_conditions, least_precision)


def failed_rule(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that holds, else 0."""
    chain = F.lit(0)
    for i, rule in reversed(list(enumerate(rules, 1))):
        held = F.lit(True)
        for condition in rule:
            held = held & condition.column()
        chain = F.when(held, F.lit(i)).otherwise(chain)
    return chain


def judge(statistics: DataFrame, rules: list[Rule], *, least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED_PERCENT) -> DataFrame:
    """``statistics`` with base_failed, rule (the first that holds, else 0) and kept."""
    base = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    judged = statistics.withColumn("base_failed", base).withColumn("rule", failed_rule(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
