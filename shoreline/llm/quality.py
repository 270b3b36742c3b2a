"""Quality classifier by co-training of two views.

One classifier sees measures of the text alone, the other the metadata alone (language,
source, declared length). Starting from labelled documents, each gives the other its most
confident guesses on unlabelled ones, over a few rounds. Both are then calibrated on labelled
documents that took no part in training, and their log odds are added.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.base import Workspace, text_or_empty
from shoreline.llm.logistic import Logistic, fit_logistic, log_odds

SOURCE_BUCKETS, LANGUAGE_BUCKETS = 32, 8
#: About so many labelled rows are fitted on, those whose id has the smallest hash.
LABELLED_ROWS = 20_000
ROUNDS, GIVEN_PER_ROUND, GUESS_WEIGHT = 3, 500, 0.2
HELD_OUT = 4
#: Guesses are ranked by bins of their log odds: bins in one unit, log odds of the outermost ones, least for a guess.
BINS, OUTERMOST, CONFIDENT = 20, 40, 2


def text_view(text: Column) -> Column:
    """Measures of a whole text, as an array of doubles."""
    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("double")

    words, letters = count(r"[^\x20\x09-\x0D]+"), F.length(F.regexp_replace(text, r"[^\p{L}]+", "")).cast("double")
    dense, upper = F.length(F.regexp_replace(text, r"\s+", "")).cast("double"), count(r"\p{Lu}")
    symbols, ends, digits = count(r"[#*$%&|<>{}\[\]=+~^_\\]"), count(r"[.!?]+(?=\s|$)"), count(r"[0-9]")
    distinct = F.size(F.array_distinct(F.split(text, r"[\x20\x09-\x0D]+"))).cast("double")
    filled = F.filter(F.split(text, "\n"), lambda x: x != "")
    repeated = (F.size(filled) - F.size(F.array_distinct(filled))).cast("double")
    shouts, lines = count(r"[!?]{2,}"), count(r"[^\n]+")
    parts = F.struct(words.alias("w"), letters.alias("l"), dense.alias("d"), upper.alias("u"), symbols.alias("s"), ends.alias("e"),
                     digits.alias("g"), shouts.alias("x"), lines.alias("n"), distinct.alias("k"), repeated.alias("r"))

    def shaped(p: Column) -> Column:
        def per(a: str, b: str) -> Column:
            return p[a] / F.greatest(p[b], F.lit(1.0))
        return F.array(F.log1p(p["w"]), per("l", "d"), per("u", "l"), F.log1p(10 * per("s", "w")), F.log1p(10 * per("e", "w")),
                       per("g", "d"), F.log1p(10 * per("x", "w")), per("d", "w"), F.log1p(per("w", "n")), F.log1p(p["n"]),
                       F.log1p(p["k"]) / F.log1p(F.greatest(p["w"], F.lit(1.0))), per("k", "w"), per("r", "n"),
                       (per("u", "l") > 0.5).cast("double"), (per("s", "w") > 0.1).cast("double"))
    return F.transform(F.array(parts), shaped)[0]


def metadata_view(lang: Column, source: Column, n_chars: Column) -> Column:
    """Language and source as hashed indicators, and the declared length."""
    size = F.coalesce(n_chars.cast("double"), F.lit(0.0))
    flags = [(F.pmod(F.xxhash64(column), F.lit(buckets)) == i).cast("double")
             for column, buckets in ((lang, LANGUAGE_BUCKETS), (source, SOURCE_BUCKETS)) for i in range(buckets)]
    return F.array(F.log1p(F.greatest(size, F.lit(0.0))), (size < 300).cast("double"), n_chars.isNull().cast("double"), *flags)


VIEWS = {"_text_view": 15, "_meta_view": 3 + LANGUAGE_BUCKETS + SOURCE_BUCKETS}


@dataclass(frozen=True)
class CoTrained:
    """Both views with their calibrations, and the share of good documents."""
    views: dict[str, tuple[Logistic, Logistic]]
    prior: float

    def score(self) -> Column:
        """Probability of good quality from both views, taken as independent given the class."""
        prior = log_odds(self.prior)
        total = F.lit(prior)
        for name, (view, calibration) in self.views.items():
            slope = float(calibration.weights[0] / calibration.scale[0])
            total = total + view.column(name) * slope + float(calibration.intercept - calibration.mean[0] * slope) - prior
        return 1 / (1 + F.exp(-total))


def _array(rows: pa.Table, column: str) -> np.ndarray:
    """A column of arrays of one length as a matrix."""
    return rows[column].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(rows), VIEWS[column])


def _share(hashed: Column, share: float) -> Column:
    """Whether a 63-bit hash lies in the first share of its range."""
    return hashed <= F.lit(min(int(min(share, 1.0) * (1 << 63)), (1 << 63) - 1))


def confident(pool: DataFrame, logit: Column, view: str, wanted: int = GIVEN_PER_ROUND) -> tuple[np.ndarray, np.ndarray]:
    """About ``wanted`` rows with the highest and with the lowest log odds: their view and guessed label.

    Rows are counted by bins of log odds, of which there is a fixed number. The outermost bins
    are taken whole as long as they fit, and the share of the next one that is still wanted, by
    hash. So tasks pass on only what is used, at most twice what is wanted of each class.
    """
    placed = pool.withColumn("_bin", F.floor(F.greatest(F.least(logit, F.lit(float(OUTERMOST))), F.lit(-float(OUTERMOST))) * BINS))
    sizes = {r["_bin"]: r["count"] for r in placed.groupBy("_bin").count().collect() if r["_bin"] is not None}
    taken = []
    for sign, label in ((1, 1.0), (-1, 0.0)):
        left, test = wanted, F.lit(False)
        for place in sorted((b for b in sizes if (b >= CONFIDENT * BINS if sign > 0 else b < -CONFIDENT * BINS)), key=lambda b: -b * sign):
            own = F.col("_bin") == place
            test = test | (own if sizes[place] <= left else own & _share(F.col("_pick"), left / sizes[place]))
            left -= sizes[place]
            if left <= 0:
                break
        taken.append(placed.filter(test).select("_pick", view, F.lit(label).alias("_guess")).limit(2 * wanted))
    found = taken[0].unionAll(taken[1]).toArrow().sort_by([("_pick", "ascending"), ("_guess", "ascending")])
    return _array(found, view), found["_guess"].to_numpy()


def co_train(rows: DataFrame) -> CoTrained | None:
    """Fit on a table of doc_id, _label (0, 1 or null) and both views; None without both classes.

    Fits see about LABELLED_ROWS labelled rows and, per round and view, about GIVEN_PER_ROUND
    guesses of each class. Every round draws from its own part of the unlabelled rows, by
    hash, so no row is guessed twice and all are candidates. Where the labelled rows that are
    held out for calibration lack a class, none are held out and the training rows calibrate.
    """
    hashed = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    rows = rows.withColumn("_pick", F.shiftrightunsigned(F.xxhash64("doc_id", *VIEWS), 1)).withColumn("_order", hashed)
    known = rows.filter(F.col("_label").isNotNull())
    share = LABELLED_ROWS / max(1, known.count())
    labelled = known.filter(_share(F.col("_order"), share)).select("_order", "_pick", "_label", *VIEWS).limit(2 * LABELLED_ROWS).toArrow().sort_by(
        [("_order", "ascending"), ("_pick", "ascending")])
    y = labelled["_label"].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return None
    held = (labelled["_order"].to_numpy() >> 7) % HELD_OUT == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    seen = {v: _array(labelled, v) for v in VIEWS}
    guessed = {v: (np.empty((0, width)), np.empty(0)) for v, width in VIEWS.items()}

    def fitted(v: str) -> Logistic:
        x, t = guessed[v]
        own = np.count_nonzero(~held)
        weights = np.r_[np.ones(own), np.full(len(t), GUESS_WEIGHT)]
        return fit_logistic(np.r_[seen[v][~held], x], np.r_[y[~held], t], weights)

    unlabelled = rows.filter(F.col("_label").isNull())
    for i in range(ROUNDS):
        pool = unlabelled.filter(F.pmod(F.col("_pick"), F.lit(ROUNDS)) == i)
        for giver, taker in (tuple(VIEWS), tuple(VIEWS)[::-1]):
            x, t = confident(pool, fitted(giver).column(giver), taker)
            guessed[taker] = (np.r_[guessed[taker][0], x], np.r_[guessed[taker][1], t])
    part = held if held.any() else ~held
    views = {}
    for v in VIEWS:
        view = fitted(v)
        views[v] = (view, fit_logistic(view.logits(seen[v][part])[:, None], y[part], l2=0.1))
    return CoTrained(views, float(y.mean()))


def classify(documents: DataFrame, labels: DataFrame, carry: list[Column], threshold: float = 0.3) -> DataFrame:
    """The carried columns, score (probability of good quality) and kept of every document row.

    Takes doc_id, text, lang, source and n_chars of the documents and doc_id and quality of the
    labels; other columns are ignored, whatever their names. Null texts are empty; null
    metadata is a value of its own. A document with several labels has the smallest; labels
    other than 0 and 1 are ignored. Rows are scored one by one, so repeated rows score alike.
    Without labels of both classes the score is 0.5 and everything is kept. An empty table
    gives an empty one.

    Training reads the views of every row from the shared folder, without texts; scoring
    computes them again beside the carried columns, so no text is written or moved.
    """
    def viewed(*columns: Column) -> DataFrame:
        return documents.select(*columns, text_view(text_or_empty()).alias("_text_view"),
                                metadata_view(F.col("lang"), F.col("source"), F.col("n_chars")).alias("_meta_view"))

    work = Workspace(documents.sparkSession, "quality")
    marks = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("_label"))
    model = co_train(work.put("views", viewed(F.col("doc_id")).join(marks, "doc_id", "left")))
    work.drop("views")
    judged = viewed(*carry).withColumn("score", F.lit(0.5) if model is None else model.score())
    return judged.withColumn("kept", F.col("score") >= threshold).drop(*VIEWS)
