"""Quality rules as learned decision lists (operator 2), in DataFrame and SQL functions alone.

Every text's statistics come from JVM expressions. Sequential covering learns rules for labelled bad documents that pass
the fixed base rules: a rule grows by the threshold condition of the highest information gain, is pruned to the prefix that does
best on rows kept apart for that, and takes the rows it covers out of the rest. Each step sums labelled rows by feature and bin in one
aggregation, so that the driver sees a few hundred sums whatever the rows number. The result is an ordered conditional
expression over the statistics.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.llm.common import cut, fold, spread, table, unique_labels

WINDOW = 8
MIN_WORDS = 20
#: Candidate thresholds of a feature lie between quantiles over the labelled rows.
BINS = 32
MAX_RULES = 16
MAX_CONDITIONS = 4
#: Share of bad rows that a rule must reach where it was grown and where it was pruned, and bad rows it must cover there.
PRECISION = 0.95
MIN_COVER = 3

_SPACES = "\\u0009\\u000A\\u000B\\u000C\\u000D"
_TEXT = "coalesce(text, '')"
#: One space for each white space character, then all words.
_WORDS = f"filter(split(translate({_TEXT}, '{_SPACES}', '     '), ' '), x -> x != '')"
_NO_SPACE = f"translate({_TEXT}, ' {_SPACES}', '')"
_LINES = f"filter(split({_TEXT}, '\\n'), x -> translate(x, ' {_SPACES}', '') != '')"
_WINDOWS = f"CASE WHEN size(words) >= {WINDOW} THEN transform(array(transform(words, x -> xxhash64(x))), h -> transform(sequence(1, size(h) - {WINDOW - 1}), i -> xxhash64(slice(h, i, {WINDOW}))))[0] ELSE array() END"
#: Sorted (hash, position) pairs, of which those with an equal neighbour are repeats; then the length of the union of their windows.
_REPEATED = f"""CASE WHEN size(array_distinct(windows)) = size(windows) THEN 0L ELSE
transform(array(array_sort(transform(windows, (h, i) -> struct(h, i)))), s ->
  aggregate(
    array_sort(transform(filter(s, (x, i) -> coalesce(get(s, i - 1).h = x.h, false) OR coalesce(get(s, i + 1).h = x.h, false)), x -> x.i)),
    struct(0L AS n, 0 AS upto),
    (a, p) -> struct(a.n + least({WINDOW}, p + {WINDOW} - a.upto) AS n, p + {WINDOW} AS upto),
    a -> a.n))[0] END"""
_SYMBOLS = "#*$%&|<>"

#: Name and expression of each feature that conditions test; ratios of texts without words are 0.
FEATURES = {
    "words": "CAST(n_words AS double)",
    "word_length": "coalesce(try_divide(word_chars, n_words), 0D)",
    "symbols": "coalesce(try_divide(n_symbols, word_chars), 0D)",
    "dup_lines": "coalesce(try_divide(n_dup_lines, n_lines), 0D)",
    "repeats": "coalesce(try_divide(n_repeat_words, n_words), 0D)",
    "capitals": "coalesce(try_divide(n_capitals, word_chars), 0D)",
    "digits": "coalesce(try_divide(n_digits, word_chars), 0D)",
    "exclaims": "coalesce(try_divide(n_exclaims, n_words), 0D)",
    "stops": "coalesce(try_divide(n_stops, n_words), 0D)",
    "distinct": "coalesce(try_divide(n_distinct, n_words), 0D)",
    "line_words": "coalesce(try_divide(n_words, n_lines), 0D)",
}


def _count(characters: str) -> str:
    return f"CAST(char_length({_TEXT}) - char_length(translate({_TEXT}, '{characters}', '')) AS bigint)"


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics, and those that features are made of, for each row; null texts have no words and no lines."""
    step = docs.select("doc_id", "text", F.expr(_WORDS).alias("words"), F.expr(_LINES).alias("lines"))
    step = step.withColumn("windows", F.expr(_WINDOWS))
    return step.select(
        "doc_id",
        F.expr("CAST(size(words) AS bigint)").alias("n_words"),
        F.expr(f"CAST(char_length({_NO_SPACE}) AS bigint)").alias("word_chars"),
        F.expr(_count(_SYMBOLS)).alias("n_symbols"),
        F.expr("CAST(size(lines) - size(array_distinct(lines)) AS bigint)").alias("n_dup_lines"),
        F.expr(_REPEATED).cast("long").alias("n_repeat_words"),
        F.expr("CAST(size(lines) AS bigint)").alias("n_lines"),
        F.expr(f"CAST(char_length({_TEXT}) - char_length(regexp_replace({_TEXT}, '\\\\p{{Lu}}', '')) AS bigint)").alias("n_capitals"),
        F.expr(_count("0123456789")).alias("n_digits"),
        F.expr(_count("!")).alias("n_exclaims"),
        F.expr(_count(".")).alias("n_stops"),
        F.expr("CAST(size(array_distinct(words)) AS bigint)").alias("n_distinct"),
    )


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 30 * n_words")


@dataclass(frozen=True)
class Condition:
    """feature <= threshold if low, else feature > threshold; bin is the threshold's place among the feature's candidates."""

    feature: str
    low: bool
    bin: int
    threshold: float

    def binned(self) -> Column:
        return F.col(self.feature) <= self.bin if self.low else F.col(self.feature) > self.bin

    def plain(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value <= F.lit(self.threshold) if self.low else value > F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'<=' if self.low else '>'} {self.threshold:.6g}"


def _all(conditions, how: str) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & getattr(c, how)()
    return out


def _gain(p: float, n: float, all_p: float, all_n: float) -> float:
    """Information gain of a condition that leaves p of all_p bad and n of all_n good rows."""
    if p <= 0:
        return -1.0
    return p * (math.log2(p / (p + n)) - math.log2(all_p / (all_p + all_n)))


def _best_condition(rows: DataFrame, thresholds: dict[str, list[float]], rule: list[Condition]):
    """The condition of the highest gain on rows that satisfy the rule, and the bad and good rows before and after it."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in thresholds]))
    sums = rows.where(_all(rule, "binned")).select("bad", "n", pairs.alias("x")).groupBy("x.f", "x.b").agg(F.sum(F.col("n") * F.col("bad")).alias("p"), F.sum(F.col("n") * (1 - F.col("bad"))).alias("q"))
    found: dict[str, dict[int, tuple[int, int]]] = {}
    for r in sums.collect():  # at most BINS + 1 sums a feature
        found.setdefault(r["f"], {})[r["b"]] = (r["p"], r["q"])
    if not found:
        return None, (0, 0), (0, 0)
    one = next(iter(found.values()))
    total = (sum(p for p, _ in one.values()), sum(q for _, q in one.values()))
    best, best_gain, left = None, 1e-9, (0, 0)
    for f in sorted(found):
        p = q = 0
        for b, t in enumerate(thresholds[f]):
            dp, dq = found[f].get(b, (0, 0))
            p, q = p + dp, q + dq
            for low, (x, y) in ((True, (p, q)), (False, (total[0] - p, total[1] - q))):
                if x + y < sum(total) and (gain := _gain(x, y, *total)) > best_gain:
                    best, best_gain, left = Condition(f, low, b, t), gain, (x, y)
    return best, total, left


def learn(stats: DataFrame, labels: DataFrame) -> list[list[Condition]]:
    """Rules that drop a document, in order; none if there are no labelled bad documents.

    One row in three, by the id's hash, is kept apart for pruning. Documents without a quality label, and labels without a document, aren't used.
    """
    labelled = stats.where(~base_failed()).join(unique_labels(labels, "quality"), "doc_id").select(fold("doc_id", 3).alias("part"), (F.col("label") <= 0).cast("int").alias("bad"), *[F.expr(e).alias(f) for f, e in FEATURES.items()])
    labelled = cut(labelled)
    points = [i / BINS for i in range(1, BINS)]
    # exact to a thousandth of a rank; bad rows have candidates of their own, as they are few
    cuts = labelled.agg(*[F.percentile_approx(f, points, 1000).alias(f) for f in FEATURES], *[F.percentile_approx(F.when(F.col("bad") == 1, F.col(f)), points, 1000).alias(f"{f}_bad") for f in FEATURES]).first()
    # half-way between neighbours, so that a threshold keeps its distance from what it was learned on
    points = {f: sorted({*(cuts[f] or []), *(cuts[f"{f}_bad"] or [])}) for f in FEATURES}
    thresholds = {f: [(a + b) / 2 for a, b in zip(t[:-1], t[1:], strict=True)] for f, t in points.items()}
    thresholds = {f: t for f, t in thresholds.items() if t}
    if not thresholds:
        return []
    # a value's bin is the number of thresholds below it
    binned = [F.expr(f"size(filter(array({', '.join(f'{x!r}D' for x in t)}), x -> x < `{f}`))").alias(f) for f, t in thresholds.items()]
    rows = cut(labelled.select("part", "bad", *binned).groupBy("part", "bad", *thresholds).agg(F.count("*").alias("n")))
    rules: list[list[Condition]] = []
    rest = F.lit(True)
    while len(rules) < MAX_RULES:
        left = rows.where(rest)
        rule: list[Condition] = []
        while len(rule) < MAX_CONDITIONS:
            condition, _, (p, q) = _best_condition(left.where("part != 1"), thresholds, rule)
            if condition is None:
                break
            rule.append(condition)
            if q == 0:
                break
        if not rule:
            break
        covers = [_all(rule[: i + 1], "binned") for i in range(len(rule))]
        sums = left.groupBy((F.col("part") == 1).alias("apart")).agg(*[F.sum(F.when(c, F.col("n") * F.col("bad")).otherwise(0)).alias(f"p{i}") for i, c in enumerate(covers)], *[F.sum(F.when(c, F.col("n") * (1 - F.col("bad"))).otherwise(0)).alias(f"q{i}") for i, c in enumerate(covers)]).collect()
        tally = {r["apart"]: [(r[f"p{i}"], r[f"q{i}"]) for i in range(len(rule))] for r in sums}
        grown, pruned = (tally.get(k, [(0, 0)] * len(rule)) for k in (False, True))
        good = [i for i in range(len(rule)) if grown[i][0] >= MIN_COVER and grown[i][0] >= PRECISION * sum(grown[i]) and pruned[i][0] >= PRECISION * sum(pruned[i])]
        if not good:
            break
        # the prefix that is worth most on the rows kept apart; the shorter of equals
        best = max(good, key=lambda i: (pruned[i][0] - 2 * pruned[i][1], -i))
        rule = rule[: best + 1]
        rules.append(rule)
        rest = rest & ~_all(rule, "binned")
    return rules


def expression(rules: list[list[Condition]]) -> Column:
    """The ordered conditional: false from the first rule that holds, else true."""
    out = None
    for rule in rules:
        test = _all(rule, "plain")
        out = F.when(test, False) if out is None else out.when(test, False)
    return F.lit(True) if out is None else out.otherwise(True)


def filtered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each row of docs (doc_id, text): the statistics of its whole text, base_failed, and kept.

    A null text is as an empty one: it fails the base. Rows that repeat an id are judged each by their own text.
    """
    stats = cut(statistics(docs))
    rules = learn(stats, labels)
    out = stats.withColumn("base_failed", base_failed())
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.when(F.col("base_failed"), False).otherwise(expression(rules)).alias("kept"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtered(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))


QUERIES = {"op2_quality_rules": op2}
