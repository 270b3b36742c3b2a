"""Toxic spans by a linear-chain conditional random field.

Labels are given per document, so token labels come first: a word form is toxic where it
occurs far more often in toxic training documents than chance allows, and a token is labelled
toxic where such a form stands in a toxic document. The field is trained on windows of these
labelled tokens. Forward-backward marginals over a whole text give the offending offsets, and
the strongest of them, calibrated on training documents, gives the document's score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.base import text_or_empty
from shoreline.llm.logistic import Logistic, fit_logistic
from shoreline.llm.shingles import shingle_set

WORD = re.compile(r"[^\W\d_]+")
FEATURE_BITS = 18
#: Bounds of the fit: documents of each class, windows of each kind, words per window, windows of one document.
TRAINING_DOCS, TRAINING_WINDOWS, WINDOW, DOCUMENT_WINDOWS = 2_000, 4_000, 32, 512
#: A form is toxic if chance would put it into toxic documents alone once in exp(SURPRISE) forms.
SURPRISE, PURITY = 13.8, 0.95
#: Words whose emission a worker remembers.
REMEMBERED_WORDS = 400_000
#: Padded positions that one pass of the recursions holds.
PASS_TOKENS = 1 << 21


def forms(word: str) -> tuple[str, ...]:
    """The word and its beginnings, marked by kind."""
    return ("w" + word, *[f"{n}{word[:n]}" for n in (4, 5, 6) if len(word) > n])


def form_ids(word: str) -> list[int]:
    return [zlib.crc32(f.encode()) & ((1 << FEATURE_BITS) - 1) for f in forms(word)]


def toxic_forms(documents: list[list[str]], labels: list[int]) -> set[str]:
    """Forms that stand in toxic documents too often for chance."""
    seen, toxic = Counter(), Counter()
    for words, label in zip(documents, labels):
        present = {f for w in set(words) for f in forms(w)}
        seen.update(present)
        if label:
            toxic.update(present)
    share = max(sum(labels), 1) / max(len(labels), 1)
    needed = SURPRISE / -np.log(min(share, 0.999))
    return {f for f, n in toxic.items() if n >= needed and n >= PURITY * seen[f]}


@dataclass(frozen=True)
class ChainField:
    """Weights of the forms, bias and transition weights of a two-state chain, and the calibration."""
    weights: np.ndarray
    bias: float
    transitions: np.ndarray
    calibration: Logistic

    def emission(self, word: str) -> float:
        """Log odds of the toxic state from the word alone."""
        return float(self.weights[form_ids(word)].sum() + self.bias)


def marginals(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Probability of the toxic state at each position of many chains, sorted by falling length.

    ``emissions`` is (chains, longest), padded; forward and backward messages are kept as log
    odds, so each step is one exact update of all chains that are long enough.
    """
    stay, enter, leave, keep = transitions[0, 0], transitions[0, 1], transitions[1, 0], transitions[1, 1]
    chains, longest = emissions.shape
    alive = np.searchsorted(-lengths, -np.arange(longest), side="left")
    forward = np.zeros((longest, chains))
    backward = np.zeros((longest, chains))
    column = np.ascontiguousarray(emissions.T)
    if longest:
        forward[0] = column[0]
    for t in range(1, longest):
        n = alive[t]
        a = forward[t - 1, :n]
        forward[t, :n] = column[t, :n] + np.logaddexp(enter, keep + a) - np.logaddexp(stay, leave + a)
    for t in range(longest - 2, -1, -1):
        n = alive[t + 1]
        b = backward[t + 1, :n] + column[t + 1, :n]
        backward[t, :n] = np.logaddexp(leave, keep + b) - np.logaddexp(stay, enter + b)
    return 1 / (1 + np.exp(-(forward + backward).T))


def fit_chain(windows: np.ndarray, ids: list[list[int]], labels: np.ndarray, rounds: int = 60, rate: float = 0.5,
              l2: float = 1e-5) -> tuple[np.ndarray, float, np.ndarray]:
    """Maximum likelihood by Adagrad over all windows; windows hold word numbers, -1 pads the end.

    Gradients are observed minus expected counts, from forward-backward marginals.
    """
    real = windows >= 0
    lengths = real.sum(1)
    order = np.argsort(-lengths, kind="stable")
    windows, labels, real, lengths = windows[order], labels[order], real[order], lengths[order]
    flat = windows[real]
    word_of = np.concatenate([np.full(len(x), i) for i, x in enumerate(ids)])
    form_of = np.concatenate([np.array(x) for x in ids])
    weights, bias, transitions = np.zeros(1 << FEATURE_BITS), -3.0, np.array([[0.0, -1.0], [0.0, 0.0]])
    gw, gb, gt = np.full(1 << FEATURE_BITS, 1e-6), 1e-6, np.full((2, 2), 1e-6)
    total = max(1, real.sum())
    follows = real[:, 1:]
    observed = np.zeros((2, 2))
    np.add.at(observed, (labels[:, :-1][follows], labels[:, 1:][follows]), 1)
    for _ in range(rounds):
        scores = np.bincount(word_of, weights[form_of], len(ids)) + bias
        emissions = np.where(real, scores[np.maximum(windows, 0)], 0.0)
        p = marginals(emissions, lengths, transitions)
        difference = (labels - p)[real]
        per_word = np.bincount(flat, difference, len(ids))
        dw = np.bincount(form_of, per_word[word_of], 1 << FEATURE_BITS) / total * 100 - l2 * weights
        db = difference.sum() / total
        expected = _expected_steps(emissions, follows, transitions, lengths)
        dt = (observed - expected) / total
        gw += dw * dw
        gb += db * db
        gt += dt * dt
        weights += rate * dw / np.sqrt(gw)
        bias += rate * db / np.sqrt(gb)
        transitions = np.clip(transitions + rate * dt / np.sqrt(gt), -4, 4)
    return weights, float(bias), transitions


def _expected_steps(emissions: np.ndarray, follows: np.ndarray, transitions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Expected number of steps between states, from pairwise marginals of short chains."""
    chains, longest = emissions.shape
    forward = np.zeros((longest, chains, 2))
    forward[0, :, 1] = emissions[:, 0]
    for t in range(1, longest):
        before = forward[t - 1][:, :, None] + transitions[None]
        forward[t] = np.logaddexp(before[:, 0], before[:, 1])
        forward[t, :, 1] += emissions[:, t]
    backward = np.zeros((longest, chains, 2))
    for t in range(longest - 2, -1, -1):
        after = transitions[None] + (np.c_[np.zeros(chains), emissions[:, t + 1]] + backward[t + 1])[:, None, :]
        backward[t] = np.where(follows[:, t][:, None], np.logaddexp(after[:, :, 0], after[:, :, 1]), 0.0)
    pair = (forward[:-1, :, :, None] + transitions[None, None]
            + (np.stack([np.zeros((longest, chains)), emissions.T], -1) + backward)[1:, :, None, :])
    pair -= pair.max((2, 3), keepdims=True)
    pair = np.exp(pair)
    pair /= pair.sum((2, 3), keepdims=True)
    return pair[follows.T].sum(0)


def window_rank(doc: int | None, number: int) -> int:
    """Order in which windows are chosen: by a hash of document and window number."""
    return zlib.crc32(f"{doc} {number}".encode())


_SAMPLED = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("copy", pa.int64()), ("words", pa.list_(pa.string()))])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of training documents, of very long ones DOCUMENT_WINDOWS windows in text order; copies share a number."""
    for batch in batches:
        for doc, toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            text = text.as_py()
            words = WORD.findall(text.lower())
            count = -(-len(words) // WINDOW)
            if count > DOCUMENT_WINDOWS:
                numbers = sorted(sorted(range(count), key=lambda n: window_rank(doc, n))[:DOCUMENT_WINDOWS])
                words = [w for n in numbers for w in words[n * WINDOW:(n + 1) * WINDOW]]
            smallest = int(shingle_set(text)[:1].view(np.int64)[0]) if words else 0
            yield pa.record_batch([pa.array([x], f.type) for x, f in zip((doc, toxic, smallest, words), _SAMPLED)], schema=_SAMPLED)


def training_windows(documents: list[tuple[int, list[str], list[int]]]) -> dict[bool, list[tuple[int, int]]]:
    """Windows (document, start) with and without a toxic word, at most TRAINING_WINDOWS of each kind.

    Every document gives its windows in the order of their rank, first one each, then a second
    one, and so on, so that no long text takes the place of others.
    """
    turns: dict[bool, list[tuple[int, int, int, int]]] = {True: [], False: []}
    for i, (doc, words, marks) in enumerate(documents):
        own: dict[bool, list[tuple[int, int]]] = {True: [], False: []}
        for at in range(0, len(words), WINDOW):
            own[any(marks[at:at + WINDOW])].append((window_rank(doc, at // WINDOW), at))
        for kind, found in own.items():
            turns[kind] += [(turn, rank, i, at) for turn, (rank, at) in enumerate(sorted(found))]
    return {kind: [(i, at) for _, _, i, at in sorted(t)[:TRAINING_WINDOWS]] for kind, t in turns.items()}


def train(documents: DataFrame, marks: DataFrame) -> ChainField:
    """Fit on a bounded sample of the labelled documents (doc_id, text) with ``marks`` (doc_id, toxic).

    At most TRAINING_DOCS ids of each class are taken, the first by a hash of the id; they are
    chosen from the labels alone, and so few can be broadcast to fetch their texts. Very long
    texts send DOCUMENT_WINDOWS windows, chosen by hash. Of copies with one label, which would
    make each of their words look toxic, one is used, and one row of each id. Without labels of
    both classes the field knows no toxic form, and every score is the same.
    """
    order = F.xxhash64("doc_id")
    chosen_ids = [marks.filter(F.col("toxic") == label).orderBy(order, "doc_id").limit(TRAINING_DOCS) for label in (0, 1)]
    texts = documents.join(F.broadcast(chosen_ids[0].unionByName(chosen_ids[1])), "doc_id").groupBy("doc_id", "toxic").agg(F.min(text_or_empty()).alias("text"))
    found = texts.mapInArrow(_sampled, "doc_id long, toxic int, copy long, words array<string>").collect()
    singles: dict[tuple[int, int], tuple[int, list[str], int]] = {}
    for r in sorted(found, key=lambda r: (r["toxic"], r["doc_id"])):
        singles.setdefault((r["copy"], r["toxic"]), (r["doc_id"], r["words"], r["toxic"]))
    rows = list(singles.values())
    documents, labels = [words for _, words, _ in rows], [y for _, _, y in rows]
    toxic = toxic_forms(documents, labels) if 0 < sum(labels) < len(labels) else set()
    bad: dict[str, bool] = {}
    numbers: dict[str, int] = {}
    for words in documents:
        for w in words:
            if w not in bad:
                numbers[w] = len(numbers)
                bad[w] = not toxic.isdisjoint(forms(w))
    marked = [(doc, words, [int(label and bad[w]) for w in words]) for doc, words, label in rows]
    chosen = {kind: [([numbers[w] for w in marked[i][1][at:at + WINDOW]], marked[i][2][at:at + WINDOW]) for i, at in places]
              for kind, places in training_windows(marked).items()}
    windows = chosen[True] + chosen[False]
    if not chosen[True]:
        return ChainField(np.zeros(1 << FEATURE_BITS), -5.0, np.zeros((2, 2)), fit_logistic(np.zeros((0, 1)), np.zeros(0)))
    grid, marks = np.full((len(windows), WINDOW), -1), np.zeros((len(windows), WINDOW), np.int64)
    for i, (part, m) in enumerate(windows):
        grid[i, :len(part)], marks[i, :len(part)] = part, m
    used = np.unique(grid[grid >= 0])
    names = list(numbers)
    place = np.full(len(names), -1)
    place[used] = np.arange(len(used))
    grid = np.where(grid >= 0, place[np.maximum(grid, 0)], -1)
    weights, bias, transitions = fit_chain(grid, [form_ids(names[i]) for i in used], marks)
    plain = ChainField(weights, bias, transitions, fit_logistic(np.zeros((0, 1)), np.zeros(0)))
    strongest = np.array([strength(p) for p in tag(plain, documents, {})])
    return ChainField(weights, bias, transitions, fit_logistic(strongest[:, None], np.array(labels, float), l2=0.1))


def strength(probabilities: np.ndarray) -> float:
    """Log odds of the strongest toxic token of a text; a low constant without words."""
    top = float(probabilities.max()) if len(probabilities) else 0.0
    return float(np.log(max(top, 1e-6) / max(1 - top, 1e-6)))


def tag(field: ChainField, documents: list[list[str]], known: dict[str, float]) -> list[np.ndarray]:
    """Toxic probabilities of the tokens of each document, from all of its tokens."""
    found: list[np.ndarray] = [np.empty(0)] * len(documents)
    lengths = np.array([len(d) for d in documents], np.int64)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    at = 0
    while at < len(order):
        count = max(1, PASS_TOKENS // int(lengths[order[at]]))
        group = order[at:at + count]
        at += count
        emissions = np.zeros((len(group), int(lengths[group[0]])))
        for row, i in enumerate(group):
            words = documents[i]
            values = [known.get(w) for w in words]
            if None in values:
                for j, v in enumerate(values):
                    if v is None:
                        values[j] = known.get(words[j])
                        if values[j] is None:
                            values[j] = field.emission(words[j])
                            if len(known) < REMEMBERED_WORDS:
                                known[words[j]] = values[j]
            emissions[row, :len(words)] = values
        p = marginals(emissions, lengths[group], field.transitions)
        for row, i in enumerate(group):
            found[i] = p[row, :lengths[i]]
    return found


_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()),
                     ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def _score(field: ChainField):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                texts = [t.as_py().lower() for t in part.column(2)]
                tagged = tag(field, [WORD.findall(t) for t in texts], known)
                logits = field.calibration.logits(np.array([strength(p) for p in tagged])[:, None])
                spans = []
                for text, p in zip(texts, tagged):
                    hot = set(np.flatnonzero(p > 0.5).tolist())
                    spans.append([{"start": m.start(), "end": m.end()} for i, m in enumerate(WORD.finditer(text)) if i in hot] if hot else [])
                yield pa.record_batch([part.column(0), part.column(1), pa.array(1 / (1 + np.exp(-np.clip(logits, -30, 30)))),
                                       pa.array(spans, _SCORED.field("spans").type)], schema=_SCORED)
    return rows


def held_out() -> Column:
    """Whether a document's label must not be learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % 4 == 2


def score_toxicity(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted and spans (offsets of toxic words) of every document row.

    Takes doc_id and text of the documents and doc_id and toxic of the labels; other columns
    are ignored. Only documents whose crc32(doc_id as text) mod 4 is not 2 are learnt from.
    Null and empty texts have no words and get the score of the lowest strength. A document
    with several labels has the largest; labels other than 0 and 1 and null ids are ignored.
    Rows are scored one by one from their whole text. Offsets count code points of the
    lower-cased text. An empty table gives an empty one.

    The trained field has a fixed size and travels with the tasks; no document moves but the
    bounded training sample.
    """
    given = documents.select("doc_id", held_out().alias("held_out"), text_or_empty().alias("text"))
    marks = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    field = train(given, marks.filter(~held_out()))
    scored = given.mapInArrow(_score(field), "doc_id long, held_out boolean, score double, spans array<struct<start:int,end:int>>")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
