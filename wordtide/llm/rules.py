"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

A document fails the base rules if it has fewer than 20 words, or more than 30 % of its words
lie in repeated windows of eight words. What else is rejected is learned from the labelled
documents: each signal (share of symbols, of repeated lines, of repeated words, of capitals,
of exclamation marks) has a fixed ladder of cutoffs, and a document goes if a signal is above
the signal's cutoff in the document's stratum.

A cutoff may be used in a stratum if, among the stratum's `n` good labelled documents, so
few are above it that their true share is below the signal's part of `risk`: the exact
binomial probability of so few at that share is at most `delta`, divided by the number of
cutoffs tested in all strata (Bonferroni). Then with probability `1 - delta` no stratum loses
more than `risk` of its good documents to the cutoffs. The lowest such cutoff is taken; a
stratum with too few labels gets none and is judged by the base rules alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from wordtide.llm.tables import written

#: Contract: white space between words, symbols, windows and limits of the base rules.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SYMBOL = r"[^#*$%&|<>]+"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

RISK, DELTA = 0.05, 0.05
#: Cutoffs by signal, tested in every stratum.
LADDERS = {
    "symbol_share": (0.02, 0.05, 0.1, 0.2, 0.3),
    "dup_line_share": (0.05, 0.1, 0.2, 0.3, 0.5),
    "repeat_share": (0.05, 0.1, 0.15, 0.2, 0.25),
    "capital_share": (0.2, 0.3, 0.5, 0.7, 0.9),
    "shout_share": (0.02, 0.05, 0.1, 0.2, 0.4),
}


def words_of(text: Column) -> Column:
    """Runs of anything but white space; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.array_remove(parts, "")


def _chars(text: Column, dropped: str) -> Column:
    return F.char_length(F.regexp_replace(text, dropped, "")).cast("bigint")


def _doubled(hashes: Column, step: int) -> Column:
    """Hash of a run of 2 * step from the hashes of runs of step; nulls at the end."""
    later = F.slice(hashes, F.lit(step + 1), F.greatest(F.size(hashes) - step, F.lit(0)))
    return F.zip_with(hashes, later, lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))


def with_measures(docs: DataFrame) -> DataFrame:
    """`docs` with `words`-based measures in a struct column `measures`.

    Windows of eight words are compared by 64-bit hashes within one text. Only texts that
    repeat a window sort theirs.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    step = docs.withColumn("_words", words_of(F.col("text"))).withColumn("_lines", F.filter(
        F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    ))
    step = step.withColumn("_runs", F.transform("_words", lambda w: F.xxhash64(w)))
    for length in (1, 2, 4):
        step = step.withColumn("_runs", _doubled(F.col("_runs"), length))
    count = F.size("_words")
    step = step.withColumn("_runs", F.slice("_runs", F.lit(1), F.greatest(count - (WINDOW - 1), F.lit(0))))
    repeats = F.size(F.array_distinct("_runs")) < F.size("_runs")
    placed = F.transform("_runs", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    step = step.withColumn("_placed", F.when(repeats, F.sort_array(placed)))
    same = lambda x, i: (
        (F.get(F.col("_placed"), i - 1)["h"] == x["h"]) | (F.get(F.col("_placed"), i + 1)["h"] == x["h"])
    )
    found = F.transform(F.filter("_placed", lambda x, i: F.coalesce(same(x, i), F.lit(False))), lambda x: x["i"])
    step = step.withColumn("_found", F.sort_array(found))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        "_found", start,
        lambda s, i: F.struct(
            (s["n"] + i + WINDOW - F.greatest(s["end"], i)).cast("bigint").alias("n"), (i + WINDOW).alias("end")
        ),
        lambda s: s["n"],
    )
    measures = F.struct(
        count.cast("bigint").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        _chars(text, NOT_SYMBOL).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        _chars(text, "[^A-Z]+").alias("n_capitals"),
        _chars(text, "[^!]+").alias("n_shouts"),
    )
    return step.select(*[F.col(f"`{c}`") for c in docs.columns if c != "measures"], measures.alias("measures"))


def base_failed(measures: str = "m") -> Column:
    n, repeated = F.col(f"{measures}.n_words"), F.col(f"{measures}.n_repeat_words")
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n)


def signals(measures: str = "m") -> dict[str, Column]:
    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(f"{measures}.{part}"), F.col(f"{measures}.{whole}")), F.lit(0.0))

    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "capital_share": share("n_capitals", "word_chars"),
        "shout_share": share("n_shouts", "n_words"),
    }


def log_tail(k: Column, n: Column, p: float) -> Column:
    """Logarithm of the probability of at most `k` of `n` at a rate of `p`, exact but for rounding.

    Terms are added in log space, since the first may be below the least double.
    """
    odds = math.log(p) - math.log1p(-p)
    start = F.struct((n * math.log1p(-p)).alias("term"), (n * math.log1p(-p)).alias("total"))

    def add(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((n - i + 1) / i) + odds
        high, low = F.greatest(term, state["total"]), F.least(term, state["total"])
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(steps, start, add, lambda s: s["total"])


def cutoffs(labelled: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """`stratum` and the cutoff of each signal, null where none may be used.

    `labelled` has the good labelled documents: `stratum` and `m`. The counts of all cutoffs
    are one aggregation; then there is a row per stratum, signal and cutoff.
    """
    share = risk / len(LADDERS)
    values = signals()
    counts = [
        F.count_if(values[s] > c).alias(f"{s}_{i}") for s, ladder in LADDERS.items() for i, c in enumerate(ladder)
    ]
    per_stratum = written(labelled.groupBy("stratum").agg(F.count("*").alias("n"), *counts), "holdout")
    tests = per_stratum.agg(F.count("*")).first()[0] * sum(map(len, LADDERS.values()))
    level = math.log(delta / tests) if tests else 0.0
    chosen = []
    for signal, ladder in LADDERS.items():
        tried = [
            # At the rate itself or above it no test can pass; that also bounds the sum.
            F.when(
                (F.col(f"{signal}_{i}") < F.col("n") * share)
                & (log_tail(F.least(F.col(f"{signal}_{i}"), F.ceil(F.col("n") * share)), F.col("n"), share) <= level),
                F.lit(cutoff),
            )
            for i, cutoff in enumerate(ladder)
        ]
        chosen.append(F.least(*tried).alias(signal))
    return per_stratum.select("stratum", *chosen)


def judged(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA
) -> DataFrame:
    """One row per row of `docs`: `doc_id, tid`, measures `m`, `base_failed`, `rejected_by`, `kept`.

    `tid` tells texts with one id apart. Documents are matched to `labels` (`doc_id`,
    `quality`) by id; a repeated label counts once, and one with both values as not good.
    A null stratum is a stratum; a signal without base (no words) is 0. Without labels the
    base rules alone decide.
    """
    measured = with_measures(docs.select("doc_id", "text", F.col(f"`{stratum}`").alias("stratum")))
    tid = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = written(measured.select("doc_id", tid.alias("tid"), "stratum", F.col("measures").alias("m")), "measures")
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("least")).where("least = 1").select("doc_id")
    limits = written(cutoffs(rows.join(good, "doc_id", "left_semi"), risk, delta), "cutoffs")
    placed = rows.join(limits.withColumnRenamed("stratum", "of"), F.col("stratum").eqNullSafe(F.col("of")), "left")
    above = [
        F.when(~base_failed() & (value > F.col(name)), F.lit(name)) for name, value in signals().items()
    ]
    failed = base_failed()
    rejected = F.array_compact(F.array(*above))
    return placed.select(
        "doc_id", "tid", "m", failed.alias("base_failed"), rejected.alias("rejected_by"),
        (~failed & (F.size(rejected) == 0)).alias("kept"),
    )


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """`doc_id`, the contract's measures, `base_failed`, `kept` and `rejected_by`."""
    own = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged(docs, labels, stratum).select(
        "doc_id", *[F.col(f"m.{c}").alias(c) for c in own], "base_failed", "kept",
        F.array_join("rejected_by", ",").alias("rejected_by"),
    )


def kept_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of `docs` that the rules keep; rows that are equal are judged alike."""
    verdicts = judged(docs, labels, stratum)
    gone = verdicts.where("NOT kept").select(F.col("doc_id").alias("_id"), F.col("tid").alias("_tid")).distinct()
    tid = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]) & (tid == gone["_tid"]), "left_anti")
