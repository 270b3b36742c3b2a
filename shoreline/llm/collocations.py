"""Phrase collocations by vertical partitioning of a depth-truncated suffix tree.

Every word opens a suffix of at most four words that ends with its piece. A suffix can only
hold frequent phrases as far as its words and word pairs are frequent, so words and pairs are
counted first and suffixes are cut where one is not. The rest of the suffix tree is cut by
word prefixes: a prefix with more leaves than the memory budget is extended by a word, and
whole prefixes are packed into groups of about that many leaves. Each group's subtrees are
built on their own; a node's count is the total of the leaves below it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoreline.llm.base import Workspace, bitmap_of, in_bitmap
from shoreline.operators.joins import broadcast_if_small

#: Words of the longest phrase, rows of the least frequent one.
DEPTH, LEAST = 4, 30
#: Bytes of text that a task holds as words before it passes its counts on.
HELD_BYTES = 1 << 24
#: Leaves of a group of subtrees, in rows.
BUDGET = 1 << 18
MAP_BITS, SPREAD = 24, 0x9E3779

#: Bytes as words and pieces see them: A-Z in lower case, tabs as spaces, every piece end as a line feed.
_BYTES = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_END = b"\n"


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    return zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())


_COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])
_COUNTED_DDL = "lang string, phrase string, n long"


def _rows(lang: str, words: pa.Array, numbers: list[np.ndarray], counts: np.ndarray, step: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Phrases from the numbers of their words, some at a time."""
    for at in range(0, len(counts), step):
        columns = [words.take(pa.array(n[at:at + step])) for n in numbers]
        phrases = pc.binary_join_element_wise(*columns, b" ") if len(columns) > 1 else columns[0]
        yield pa.record_batch([pa.array([lang] * len(phrases)), phrases.cast(pa.string()), pa.array(counts[at:at + step], pa.int64())], schema=_COUNTED)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words per language, combined over many documents of the task."""
    def flushed() -> Iterator[pa.RecordBatch]:
        for lang, count in counts.items():
            yield from _rows(lang, pa.array(list(count), pa.binary()), [np.arange(len(count))], np.fromiter(count.values(), np.int64, len(count)))
        counts.clear()

    counts: dict[str, Counter] = {}
    held = 0
    for batch in batches:
        for lang, text in _texts(batch):
            counts.setdefault(lang, Counter()).update(text.translate(_BYTES).split())
            held += len(text)
            if held > HELD_BYTES:
                yield from flushed()
                held = 0
    yield from flushed()


class _Numbers(dict):
    """Numbers of words in order of their first sight; the end of a piece is 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Held:
    """Words of one language that a task holds: their numbers in text order, with an end after every piece."""

    def __init__(self):
        self.numbers, self.parts = _Numbers({_END: 0}), []

    def add(self, text: bytes) -> None:
        words: list[bytes] = []
        for piece in text.translate(_BYTES).split(_END):
            if piece and (found := piece.split()):
                words += found
                words.append(_END)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))

    def frequent(self, lang: str, bitmap: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Words by number; numbers in text order; checksums by number; which numbers may be frequent."""
        sums = np.fromiter((zlib.crc32(w) for w in self.numbers), np.int64, len(self.numbers))
        words = pa.array(list(self.numbers), pa.binary())
        maybe = in_bitmap(bitmap, _word_bits(sums, zlib.crc32(lang.encode())))
        maybe[0] = False
        order = np.concatenate(self.parts) if self.parts else np.empty(0, np.int32)
        self.numbers, self.parts = _Numbers(), []
        return words, order, sums, maybe


def _word_bits(sums: np.ndarray, lang: int) -> np.ndarray:
    return (sums * SPREAD + lang & 0xFFFFFFFF) >> (32 - MAP_BITS)


def _pair_bits(first: np.ndarray, second: np.ndarray, lang: int) -> np.ndarray:
    return ((first * SPREAD + second & 0xFFFFFFFF) * SPREAD + lang & 0xFFFFFFFF) >> (32 - MAP_BITS)


def word_bit(word: Column) -> Column:
    """The bit of a word of a language, as tasks compute it."""
    return F.shiftright((F.crc32(word) * SPREAD + F.crc32("lang")).bitwiseAND(F.lit(0xFFFFFFFF)), 32 - MAP_BITS)


def pair_bit(first: Column, second: Column) -> Column:
    inner = (F.crc32(first) * SPREAD + F.crc32(second)).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftright((inner * SPREAD + F.crc32("lang")).bitwiseAND(F.lit(0xFFFFFFFF)), 32 - MAP_BITS)


def _over_held_words(counted):
    """Run ``counted(lang, held)`` over the words of each language whenever a task holds enough of them."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Held] = {}
        size = 0
        for batch in batches:
            for lang, text in _texts(batch):
                held.setdefault(lang, _Held()).add(text)
                size += len(text)
                if size > HELD_BYTES:
                    for name in list(held):
                        yield from counted(name, held.pop(name))
                    size = 0
        for name in list(held):
            yield from counted(name, held.pop(name))
    return rows


def _pair_counts(frequent_words: np.ndarray):
    """Counts of word pairs inside pieces whose words may both be frequent."""
    def counted(lang: str, held: _Held) -> Iterator[pa.RecordBatch]:
        words, order, _, maybe = held.frequent(lang, frequent_words)
        good = maybe[order]
        at = np.flatnonzero(good[:-1] & good[1:])
        pairs, counts = np.unique(order[at].astype(np.int64) << 32 | order[at + 1], return_counts=True)
        yield from _rows(lang, words, [pairs >> 32, pairs & 0xFFFFFFFF], counts)
    return _over_held_words(counted)


def _leaves(frequent_words: np.ndarray, frequent_pairs: np.ndarray):
    """Suffixes of three or four words, as far as their word pairs may be frequent, with their counts."""
    def counted(lang: str, held: _Held) -> Iterator[pa.RecordBatch]:
        words, order, sums, maybe = held.frequent(lang, frequent_words)
        good = maybe[order]
        at = np.flatnonzero(good[:-1] & good[1:])
        pairs, which = np.unique(order[at].astype(np.int64) << 32 | order[at + 1], return_inverse=True)
        del good
        kept = in_bitmap(frequent_pairs, _pair_bits(sums[pairs >> 32], sums[pairs & 0xFFFFFFFF], zlib.crc32(lang.encode())))
        pair = np.full(len(order) + DEPTH, -1, np.int64)
        pair[at] = np.where(kept[which], which, -1)
        del at, which
        first = np.flatnonzero((pair[:-1] >= 0) & (pair[1:] >= 0))
        four = pair[first + 2] >= 0
        for starts, width in ((first[four], 4), (first[~four], 3)):
            codes = pair[starts] * max(1, len(pairs)) + pair[starts + width - 2]
            _, place, counts = np.unique(codes, return_index=True, return_counts=True)
            yield from _rows(lang, words, [order[starts[place] + k] for k in range(width)], counts)
    return _over_held_words(counted)


def prefix(words: int) -> Column:
    return F.substring_index("phrase", " ", words)


def vertical_partition(leaves: DataFrame, work: Workspace, budget: int) -> DataFrame:
    """Leaves with their prefix and its depth.

    A prefix starts as one word. Where more leaves than the budget share it, it is extended by
    a word, until it is the whole suffix: of such prefixes there are never more than leaves
    over budget.
    """
    parted = leaves.withColumn("prefix", prefix(1)).withColumn("depth", F.lit(1))
    for width in range(2, DEPTH + 1):
        heavy = work.put(f"heavy-{width}", parted.groupBy("lang", "prefix").agg(F.count("*").alias("_heavy")).filter(F.col("_heavy") > budget))
        if heavy.isEmpty():
            break
        extended = F.col("_heavy").isNotNull()
        parted = parted.join(broadcast_if_small(heavy), ["lang", "prefix"], "left").withColumns({
            "prefix": F.when(extended, prefix(width)).otherwise(F.col("prefix")),
            "depth": F.when(extended, width).otherwise(F.col("depth"))}).drop("_heavy")
    return parted.select("lang", "prefix", "depth", "phrase", "n")


def packed_groups(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.Table]:
    """Sorted leaves cut into groups of whole prefixes, with less than twice the budget of leaves each.

    Only equal suffixes, which cannot be parted, may be more.
    """
    held: list[pa.RecordBatch] = []
    size, full = 0, budget
    for batch in batches:
        for at in range(0, batch.num_rows, budget):
            held.append(batch.slice(at, budget))
            size += held[-1].num_rows
            if size < full:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            last = pc.and_(pc.equal(table["prefix"], table["prefix"][-1]), pc.equal(table["lang"], table["lang"][-1]))
            end = size - pc.sum(last).as_py()
            if end:
                yield table.slice(0, end)
            held = table.slice(end).to_batches()
            size -= end
            full = budget if end else 2 * size
    if size:
        yield pa.Table.from_batches(held)


_NODES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


def subtree_counts(leaves: pa.Table) -> pa.Table:
    """Nodes of three and four words of a group's subtrees, with the totals of their leaves.

    Nodes at or below the prefix of their subtree are whole, and dropped where they are rare;
    nodes above an extended prefix are passed on with what this group adds to them.
    """
    split = pc.split_pattern(leaves["phrase"].combine_chunks(), " ")
    words = pc.list_flatten(split).dictionary_encode()
    ends = split.offsets.to_numpy()
    width = np.diff(ends)
    codes = np.full((len(width), DEPTH), -1, np.int64)
    codes[np.repeat(np.arange(len(width)), width), np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], width)] = words.indices.to_numpy()
    langs = leaves["lang"].combine_chunks().dictionary_encode()
    lang = langs.indices.to_numpy().astype(np.int64)
    counts, whole = leaves["n"].to_numpy(), leaves["depth"].to_numpy()
    order = np.lexsort((*codes.T[::-1], lang))
    path = np.c_[lang, codes][order]
    changed = np.logical_or.accumulate(np.r_[np.ones((1, DEPTH + 1), bool), path[1:] != path[:-1]], axis=1)
    out = []
    for depth in (3, 4):
        heads = np.flatnonzero(changed[:, depth] & (width[order] >= depth))
        if not len(heads):
            continue
        # a leaf that ends above this depth is a run of its own, so that its count goes nowhere
        runs = np.flatnonzero(changed[:, depth] | (width[order] < depth))
        totals = np.add.reduceat(counts[order], runs)[np.searchsorted(runs, heads)]
        keep = (totals >= LEAST) | (whole[order][heads] > depth)
        heads, totals = heads[keep], totals[keep]
        columns = [words.dictionary.take(pa.array(path[heads, 1 + k])) for k in range(depth)]
        phrases = pc.binary_join_element_wise(*columns, " ") if len(heads) else pa.array([], pa.string())
        out.append(pa.table([langs.dictionary.take(pa.array(lang[order][heads])), phrases, pa.array(totals, pa.int64())], schema=_NODES))
    return pa.concat_tables(out) if out else _NODES.empty_table()


def _subtrees(budget: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in packed_groups(batches, budget):
            yield from subtree_counts(group).to_batches()
    return rows


def count_phrases(documents: DataFrame, work: Workspace, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n, width) of every phrase of one to four words met LEAST times or more, and (lang, n) of all words."""
    given = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    vocabulary = work.put("words", given.mapInArrow(_word_counts, _COUNTED_DDL).groupBy("lang", "phrase").agg(F.sum("n").alias("n")))
    sizes = work.put("sizes", vocabulary.groupBy("lang").agg(F.sum("n").alias("n")))
    words = vocabulary.filter(F.col("n") >= LEAST)
    word_map = bitmap_of(words.select(word_bit(F.col("phrase")).alias("bit")), MAP_BITS)
    pairs = work.put("pairs", given.mapInArrow(_pair_counts(word_map), _COUNTED_DDL).groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST))
    pair_map = bitmap_of(pairs.select(pair_bit(prefix(1), prefix(-1)).alias("bit")), MAP_BITS)
    leaves = work.put("leaves", given.mapInArrow(_leaves(word_map, pair_map), _COUNTED_DDL))
    parted = vertical_partition(leaves, work, budget).repartition("lang", "prefix").sortWithinPartitions("lang", "prefix")
    nodes = parted.mapInArrow(_subtrees(budget), _COUNTED_DDL)
    longer = nodes.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST)
    counted = words.unionByName(pairs).unionByName(longer).withColumn("width", F.size(F.split("phrase", " ")))
    phrases = work.put("phrases", counted)
    work.drop("words", "pairs", "leaves", *[f"heavy-{width}" for width in range(2, DEPTH + 1)])
    return phrases, sizes


def collocations(documents: DataFrame, top: int = 2000, budget: int = BUDGET) -> DataFrame:
    """The best-scoring phrases of every language: lang, rank, phrase, a, l, r, n and score.

    Phrases of two to four words that stand LEAST times or more inside pieces are candidates. A
    candidate cut after its first k words scores floor(2000000 * a / (l + r)), from its count
    and those of both parts; its lowest cut counts, ties to the smallest k. Candidates inside a
    longer candidate with at least 80 % of their count are dropped. Ranks go by score, then
    count, then phrase in byte order. Arithmetic is decimal, so no product overflows.

    Takes lang and text; other columns are ignored. A null lang is 'und', a null text empty.
    Repeated rows count each time, very long texts whole. An empty table gives an empty one.
    """
    work = Workspace(documents.sparkSession, "collocations")
    phrases, sizes = count_phrases(documents, work, budget)
    candidates = phrases.filter("width > 1")
    split = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("width") - 1)).alias("k"),
                             split.alias("_w"), "width")
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("_w", F.lit(1), F.col("k")), " ").alias("_left"),
                       F.array_join(F.slice("_w", F.col("k") + 1, F.col("width") - F.col("k")), " ").alias("_right"))
    for side, count in (("_left", "l"), ("_right", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(side), F.col("n").alias(count)), ["lang", side])
    score = F.expr("CAST(CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(20, 0)) div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0))) AS BIGINT)")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
    inside = candidates.filter("width > 2").select("lang", F.col("n").alias("_longer"), F.explode(F.array_distinct(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("width") - 1), lambda size: F.transform(
            F.sequence(F.lit(1), F.col("width") - size + 1), lambda at: F.array_join(F.slice(split, at, size), " ")))))).alias("phrase"))
    covered = inside.groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
    kept = lowest.join(covered, ["lang", "phrase"], "left").filter(
        F.expr("_longer IS NULL OR CAST(_longer AS DECIMAL(20, 0)) * 100 < CAST(a AS DECIMAL(20, 0)) * 80"))
    best = Window.partitionBy("lang").orderBy(F.desc("_cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(broadcast_if_small(sizes), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), "n",
        F.col("_cut.score").alias("score"))
