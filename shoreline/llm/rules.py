"""Quality rules as weak supervision, in SQL functions only.

Each rule votes good, bad or abstains. Expectation-maximisation over the counts of vote
patterns estimates how often each rule is right, without labels, and the posterior
probability of good quality takes the place of "every rule must pass".
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.base import Workspace

SPACE = r"[\x20\x09-\x0D]"
WINDOW = 3
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Frequent short words of the corpus' languages.
FUNCTION_WORDS = ("the of and to a in is that it de la le les des et en un une que el los y se con del "
                  "der die das und ist den ein zu von nicht").split()
#: Accuracies on good and on bad documents stay in these ranges: on good ones every rule is right more often than not.
ON_GOOD, ON_BAD = (0.51, 0.999), (0.15, 0.98)
PRIOR = (0.05, 0.95)
#: Vote patterns that one file holds.
PATTERNS_A_FILE = 50_000


def measured(documents: DataFrame, carry: Sequence[Column]) -> DataFrame:
    """The given columns and the measures of each whole text, row by row.

    Measures: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and, for the votes,
    _lines, _ended, _upper, _letters, _shouts, _function. A null or empty text has zero of
    everything. Windows are compared by a 64-bit hash, sorted inside the row; no row moves.
    """
    split = documents.select(*carry, F.coalesce(F.col("text"), F.lit("")).alias("_text")).withColumn(
        "_words", F.array_remove(F.split("_text", f"{SPACE}+"), "")).withColumn(
        "_filled", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    starts = F.when(F.size("_words") >= WINDOW, F.sequence(F.lit(0), F.size("_words") - WINDOW)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)]))
    hashed = split.withColumn("_hashes", hashes)
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    ordered = hashed.withColumn("_order", F.when(repeats, F.sort_array(F.transform(
        "_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.filter("_order", lambda x, j: F.coalesce(x["h"] == F.get("_order", j - 1)["h"], F.lit(False))
                     | F.coalesce(x["h"] == F.get("_order", j + 1)["h"], F.lit(False)))
    placed = ordered.withColumn("_again", F.sort_array(F.transform(again, lambda x: x["i"])))
    covered = F.aggregate(F.transform("_again", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_again", j + 1) - p, F.lit(WINDOW)))),
                          F.lit(0), lambda total, x: total + x)

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace("_text", pattern, "")).cast("long")

    return placed.select(
        *[c for c in split.columns if c not in ("_text", "_words", "_filled")],
        F.size("_words").cast("long").alias("n_words"), left(f"{SPACE}+").alias("word_chars"), left(r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("_filled") - F.size(F.array_distinct("_filled"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), F.size("_filled").alias("_lines"),
        F.size(F.filter("_filled", lambda x: F.substring(F.rtrim(x), -1, 1).isin(*'.!?:;"»)'))).alias("_ended"),
        left(r"[^\p{Lu}]+").alias("_upper"), left(r"[^\p{L}]+").alias("_letters"), left(r"[^!?]+").alias("_shouts"),
        F.size(F.filter("_words", lambda x: x.isin(*FUNCTION_WORDS))).alias("_function"))


def votes() -> dict[str, Column]:
    """Each rule's vote from the measures: 1 good, -1 bad, 0 abstains."""
    def vote(bad: Column, good: Column) -> Column:
        return F.coalesce(F.when(bad, -1).when(good, 1), F.lit(0))

    n, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("_lines"), F.lit(1))
    symbols, length = F.col("n_symbols") / n, F.col("word_chars") / n
    upper, shouts = F.col("_upper") / F.greatest(F.col("_letters"), F.lit(1)), F.col("_shouts") / n
    letters = F.col("_letters") / F.greatest(F.col("word_chars"), F.lit(1))
    again, repeated = F.col("n_dup_lines") / lines, F.col("n_repeat_words") / n
    ended, function = F.col("_ended") / lines, F.col("_function") / n
    return {
        "length": vote(F.col("n_words") < 20, F.col("n_words") >= 60),
        "symbols": vote(symbols > 0.2, symbols < 0.02),
        "letters": vote(letters < 0.85, letters > 0.93),
        "upper": vote(upper > 0.5, upper < 0.2),
        "shouts": vote(shouts > 0.5, shouts < 0.1),
        "word_length": vote((length < 2.5) | (length > 14), (length >= 3.5) & (length <= 10)),
        "dup_lines": vote(again > 0.4, (again < 0.1) & (F.col("_lines") > 1)),
        "repeats": vote(repeated > 0.4, (repeated < 0.2) & (F.col("n_words") >= WINDOW)),
        "endings": vote(ended < 0.1, ended > 0.6),
        "function_words": vote(function < 0.02, function > 0.1),
    }


def log_odds(prior: float, accuracies: dict[str, tuple[float, float]], of: Column) -> Column:
    """Log odds of good quality given the array of votes, the rules taken as independent.

    What a vote adds enters the plan as array literals, so that plans of later rounds compile
    to the same code.
    """
    yes = F.lit([math.log(on_good / (1 - on_bad)) for on_good, on_bad in accuracies.values()])
    no = F.lit([math.log((1 - on_good) / on_bad) for on_good, on_bad in accuracies.values()])
    for_good = F.zip_with(of, yes, lambda vote, adds: F.when(vote == 1, adds).otherwise(0.0))
    against = F.zip_with(of, no, lambda vote, adds: F.when(vote == -1, adds).otherwise(0.0))
    return F.aggregate(F.concat(for_good, against), F.lit(math.log(prior / (1 - prior))), lambda total, x: total + x)


def fit_accuracies(patterns: DataFrame, names: Sequence[str], rounds: int = 30,
                   tolerance: float = 1e-4) -> tuple[float, dict[str, tuple[float, float]]]:
    """Prior and accuracies of every rule by expectation-maximisation over pattern counts.

    A rule has two accuracies: how often its vote is right on good and on bad documents.
    ``patterns`` has an array ``votes`` in the order of the names and ``rows``; it holds at most 3^rules lines however
    many documents were counted. Each round is one aggregate that returns one line. Rounds
    end when no number moves by more than ``tolerance``. Without documents the starting
    values remain. A rule that always abstains keeps its accuracies.
    """
    def share(part: float, whole: float, limits: tuple[float, float], before: float) -> float:
        return min(max(part / whole, limits[0]), limits[1]) if whole else before

    prior, accuracies = 0.8, dict.fromkeys(names, (0.95, 0.5))
    for _ in range(rounds):
        good = 1 / (1 + F.exp(-log_odds(prior, accuracies, F.col("votes"))))
        sums = []
        for i in range(len(names)):
            vote = F.get(F.col("votes"), F.lit(i))
            yes, no = F.col("rows") * (vote == 1).cast("int"), F.col("rows") * (vote == -1).cast("int")
            sums.append(F.array(*[F.sum(x * y) for x in (yes, no) for y in (F.col("_good"), 1 - F.col("_good"))]))
        row = patterns.withColumn("_good", good).agg(F.sum("rows"), F.sum(F.col("rows") * F.col("_good")), *sums).collect()[0]
        if not row[0]:
            break
        fitted = {}
        for n, (yes_good, yes_bad, no_good, no_bad) in zip(names, row[2:]):
            fitted[n] = (share(yes_good, yes_good + no_good, ON_GOOD, accuracies[n][0]),
                         share(no_bad, yes_bad + no_bad, ON_BAD, accuracies[n][1]))
        moved = max(abs(x - y) for n in names for x, y in zip(fitted[n], accuracies[n]))
        before, prior, accuracies = prior, share(row[1], row[0], PRIOR, prior), fitted
        if max(moved, abs(prior - before)) < tolerance:
            break
    return prior, accuracies


def judge_quality(documents: DataFrame, carry: Sequence[Column], threshold: float = 0.5) -> DataFrame:
    """Measures, votes, posterior and verdict of every row.

    Returns the carried columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed (under 50 words, or more than half of them in repeated windows), posterior
    (probability of good quality) and kept: not base_failed and posterior >= threshold.

    Every row is judged alone, so null ids, ties and repeated rows change nothing; a null
    text is empty and fails. Other columns of the input are ignored, whatever their names. An
    empty table gives an empty one. The texts are read twice, for the vote patterns and for the
    verdicts; only the patterns are written.
    """
    named = votes()
    voted = F.array(*[v.cast("int") for v in named.values()])
    work = Workspace(documents.sparkSession, "quality-rules")
    counted = measured(documents, []).select(voted.alias("votes")).groupBy("votes").agg(F.count("*").alias("rows"))
    patterns = work.put("patterns", counted.coalesce(-(-3 ** len(named) // PATTERNS_A_FILE)))
    prior, accuracies = fit_accuracies(patterns, list(named))
    work.drop("patterns")
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    seen = measured(documents, carry).withColumn("_votes", voted).withColumn("base_failed", base_failed)
    judged = seen.withColumn("posterior", 1 / (1 + F.exp(-log_odds(prior, accuracies, F.col("_votes")))))
    verdict = F.struct(*[F.col(c).alias(c) for c in (*MEASURES, "base_failed", "posterior")],
                       (~F.col("base_failed") & (F.col("posterior") >= threshold)).alias("kept"))
    # a generator stands between the measures and what filters on the verdict, which would else repeat them
    return judged.select(*[F.col(f"`{c}`") for c in judged.columns[:len(carry)]], F.inline(F.array(verdict)))
