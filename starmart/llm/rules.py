"""Quality rules: an ordered decision list learned from labelled statistics.

Statistics of a text are DataFrame expressions. Rules that reject are learned one after the other
by sequential covering: a conjunction of thresholds is grown by information gain on two thirds of
the labelled rows, its tail is pruned on the rest, and the rows it covers are set aside. Every
step is one small grouping of binned statistics, of which a histogram reaches the driver. The
list becomes one conditional expression. No Python runs on the executors.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.arrays import upto
from starmart.llm.common import WORD, let, scratch, smallest_present, written

WINDOW = 5
# Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"
FIT_ROWS = 20_000
BINS = 32
MOST_RULES, MOST_CONDITIONS = 8, 3
LEAST_COVERED = 3
# A rule must be right for so large a part of the rows it covers outside its own training.
LEAST_PRECISION = 0.95
FEATURES = (
    "n_words", "mean_chars", "symbol_share", "mark_share", "upper_share", "digit_share",
    "repeat_share", "distinct_share", "dup_line_share", "words_per_line",
)


class Condition(NamedTuple):
    feature: str
    at_least: bool
    threshold: float

    def holds(self) -> Column:
        column = F.col(self.feature)
        return column >= self.threshold if self.at_least else column < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:g}"


Rule = tuple[Condition, ...]


# ---- statistics -------------------------------------------------------------------


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """How many words lie in a window of width words that is found twice or more.

    Windows are hashed; where all hashes differ, which is the rule, nothing repeats. Otherwise
    the windows themselves are sorted, and those equal to a neighbour counted by their places.
    """

    def hashes(w: Column) -> Column:
        return F.transform(upto(F.size(w) - (width - 1)), lambda i: F.xxhash64(
            *[F.get(w, i + k) for k in range(width)]))

    def exact(w: Column) -> Column:
        windows = F.transform(upto(F.size(w) - (width - 1)), lambda i: F.struct(
            F.concat_ws(" ", *[F.get(w, i + k) for k in range(width)]).alias("x"), i.alias("i")))
        return let(F.sort_array(windows), lambda s: let(F.sort_array(places(s)), covered))

    def places(s: Column) -> Column:
        found = F.filter(s, lambda e, k: F.coalesce(
            F.get(s, k - 1)["x"] == e["x"], F.lit(False)
        ) | F.coalesce(F.get(s, k + 1)["x"] == e["x"], F.lit(False)))
        return F.transform(found, lambda e: e["i"])

    def covered(p: Column) -> Column:
        return F.aggregate(upto(F.size(p)), F.lit(0).cast("long"), lambda total, k: total + F.least(
            F.lit(width), F.coalesce(F.get(p, k + 1) - F.get(p, k), F.lit(width))))

    none = F.lit(0).cast("long")
    return let(words, lambda w: F.when(F.size(w) <= width, none).otherwise(
        F.when(let(hashes(w), lambda h: F.size(F.array_distinct(h)) == F.size(h)), none)
        .otherwise(exact(w))))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every row of docs (doc_id, text). No shuffle."""
    text = F.col("text")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    without = F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")
    rows = rows.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(without).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(
            F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.size(F.array_distinct("_words")).alias("_distinct"),
        F.length(F.regexp_replace(without, r"[\p{L}\p{Nd}]+", "")).alias("_marks"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).alias("_upper"),
        F.length(F.regexp_replace(text, r"[^0-9]+", "")).alias("_digits"),
    )
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    n_lines = F.greatest(F.col("_lines.n"), F.lit(1))
    dup = (F.col("_lines.n") - F.col("_lines.d")).cast("long")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", dup.alias("n_dup_lines"), "n_repeat_words",
        (F.col("word_chars") / words).alias("mean_chars"),
        (F.col("n_symbols") / chars).alias("symbol_share"),
        (F.col("_marks") / chars).alias("mark_share"),
        (F.col("_upper") / chars).alias("upper_share"),
        (F.col("_digits") / chars).alias("digit_share"),
        (F.col("n_repeat_words") / words).alias("repeat_share"),
        (F.col("_distinct") / words).alias("distinct_share"),
        (dup / n_lines).alias("dup_line_share"),
        (F.col("n_words") / n_lines).alias("words_per_line"),
    )


# ---- learning -----------------------------------------------------------------------


def labelled_statistics(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """Statistics and label (bad) of at most `most` labelled documents, those of smallest hash in docs.

    A document with contradicting labels, or without one, is not used.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("low"), F.max("quality").alias("high")
    ).where("low = high").select("doc_id", (F.col("low") == 0).alias("bad"))
    chosen = smallest_present(known, docs, most, scratch(docs.sparkSession, "rules-labels"))
    # At most `most` ids are broadcast; the texts stay where they are.
    some = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id",
                                             "left_semi")
    return statistics(some).join(F.broadcast(chosen), "doc_id")


def learn(rows: DataFrame) -> list[Rule]:
    """Rules that reject, in order, from statistics with a label (bad). None without both labels."""
    folder = scratch(rows.sparkSession, "rules")
    rows = written(
        rows.select("bad", *[F.col(f).cast("double").alias(f) for f in FEATURES],
                    (F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)) == 0).alias("held")),
        f"{folder}/fit",
    )
    shares = F.array(*[F.lit((i + 0.5) / BINS) for i in range(BINS)])
    # Thresholds from either label's quantiles, so that a rare one has its own.
    cuts = rows.groupBy("bad").agg(*[F.percentile(f, shares).alias(f) for f in FEATURES]).collect()
    if len(cuts) < 2:
        return []
    steps = {f: sorted({x for row in cuts for x in row[f]}) for f in FEATURES}
    binned = written(
        rows.select("bad", "held", *FEATURES, F.array(*[
            sum((F.col(f) >= t).cast("int") for t in steps[f]) for f in FEATURES
        ]).alias("bins")),
        f"{folder}/binned",
    )
    left, rules = binned, []
    while len(rules) < MOST_RULES:
        rule = _prune(left.where("held"), _grow(left.where("not held"), steps))
        if not rule:
            break
        rules.append(rule)
        left = left.where(~covers(rule))
    return rules


def covers(rule: Rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.holds()
    return out


def _grow(rows: DataFrame, steps: dict[str, list[float]]) -> Rule:
    """Add the condition with the most information gain while good rows are still covered."""
    rule: list[Condition] = []
    while len(rule) < MOST_CONDITIONS:
        histogram = rows.where(covers(tuple(rule))).select(
            "bad", F.posexplode("bins").alias("feature", "bin")
        ).groupBy("feature", "bin").agg(
            F.sum(F.col("bad").cast("long")).alias("bad"), F.count(F.lit(1)).alias("n")
        ).collect()
        best = _best(histogram, steps)
        if best is None:
            break
        rule.append(best[0])
        if best[1] == 0:
            break
    return tuple(rule)


def _best(histogram: list, steps: dict[str, list[float]]) -> tuple[Condition, int] | None:
    by_feature: dict[int, dict[int, tuple[int, int]]] = {}
    for r in histogram:
        by_feature.setdefault(r["feature"], {})[r["bin"]] = (r["bad"], r["n"] - r["bad"])
    best = None
    for feature, bins in by_feature.items():
        name = FEATURES[feature]
        bad, good = (sum(v[i] for v in bins.values()) for i in (0, 1))
        if not bad or not good:
            return None
        before = math.log2(bad / (bad + good))
        for place, threshold in enumerate(steps[name]):
            high = [sum(v[i] for b, v in bins.items() if b > place) for i in (0, 1)]
            for at_least, p, n in ((True, *high), (False, bad - high[0], good - high[1])):
                if p < LEAST_COVERED:
                    continue
                gain = p * (math.log2(p / (p + n)) - before)
                if gain > 1e-9 and (best is None or gain > best[0]):
                    best = (gain, Condition(name, at_least, threshold), n)
    return best and best[1:]


def _prune(rows: DataFrame, rule: Rule) -> Rule:
    """The beginning of the rule that is best on held rows, if it is good enough."""
    if not rule:
        return ()
    starts = [rule[: k + 1] for k in range(len(rule))]
    counts = rows.agg(*[
        F.coalesce(F.sum((covers(s) & (F.col("bad") == want)).cast("long")), F.lit(0))
        for s in starts for want in (True, False)
    ]).first()
    scored = [
        (p / (p + n), p, -len(s), s)
        for s, p, n in zip(starts, counts[::2], counts[1::2], strict=True) if p + n
    ]
    worth = [x for x in scored if x[0] >= LEAST_PRECISION]
    return max(worth, key=lambda x: ((x[0] * 2 - 1) * x[1] / (x[1] + 1), x[2]))[3] if worth else ()


# ---- the operator -------------------------------------------------------------------


def decision(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; NULL where none does."""
    out = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(covers(rule), F.lit(number)).otherwise(out)
    return out


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per row of docs (doc_id, text): base statistics, the base verdict and the rules'.

    (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rule).
    rule is the number of the rejecting rule, asked of every row.

    Defined cases: NULL and empty texts have no words, fail the base and are not kept. Rows are
    judged one by one, so equal rows give equal rows; a NULL doc_id is kept as such. Without rules
    (no labels, or only of one kind) the base decides alone. No rows give no rows. Other columns
    are not read.
    """
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = statistics(docs).withColumns({"base_failed": failed, "rule": decision(rules)})
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule",
    )
