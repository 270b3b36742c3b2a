"""Hard-negative mining with segment summaries.

Every vector is stored with the mean and the deviation of its segments, for one, four and
sixteen segments. The inner product of two segments is the product of their means times their
length, plus or minus at most the product of their deviations, so a pair's summaries bound
its score. Bounds are refined from the whole vector down to the smallest segments, and only
pairs that they leave open are scored exactly.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoreline.llm.base import Workspace
from shoreline.llm.topk import quantised

#: Segments a vector is cut into, level by level; every level cuts the one before.
LEVELS = (1, 4, 16)


def segment_summary(vectors: np.ndarray) -> np.ndarray:
    """Per level, every segment's mean times the root of its length, then its deviation (root of the sum of squares)."""
    rows, dims = vectors.shape
    out = []
    for level in LEVELS:
        cuts = np.arange(level + 1) * dims // level
        means, devs = np.zeros((rows, level)), np.zeros((rows, level))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                part = vectors[:, a:b].astype(np.float64)
                mean = part.mean(1)
                means[:, i] = mean * math.sqrt(b - a)
                devs[:, i] = np.sqrt(((part - mean[:, None]) ** 2).sum(1))
        out += [means, devs]
    return np.concatenate(out, 1)


def _matrix(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    """A list column whose lists have one length."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(whole), -1)


def _summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The given columns (the last is the vector) and the summaries of every vector."""
    for batch in batches:
        vectors = batch.column(batch.num_columns - 1)
        lengths = vectors.value_lengths().to_numpy()
        for dims in np.unique(lengths):
            own = batch.filter(pa.array(lengths == dims))
            found = segment_summary(_matrix(own.column(own.num_columns - 1), np.int64) if dims else np.zeros((own.num_rows, 0)))
            yield pa.record_batch([*own.columns, pa.array(list(found))], [*own.schema.names, "_summary"])


def bounded_search(vectors: np.ndarray, summary: np.ndarray, open_rows: np.ndarray, vector: np.ndarray, own: np.ndarray,
                   windows: Sequence[tuple[float, float]], k: int, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window of scores, the k best rows among the open ones and their exact scores.

    A row is given up when its bounds miss every window, or lie below the k-th best lower
    bound of rows that are inside a window for certain. Higher scores come first, then smaller ids.
    """
    rows, at = np.flatnonzero(open_rows), 0
    for level in LEVELS:
        seen = summary[rows, at:at + 2 * level]
        middle, radius = seen[:, :level] @ own[at:at + level], seen[:, level:] @ own[at + level:at + 2 * level]
        # what rounding can add, from the lengths of both vectors
        radius += 1e-10 * np.hypot(summary[rows, 0], summary[rows, 1]) * math.hypot(own[0], own[1]) + 1e-6
        lower, upper = middle - radius, middle + radius
        kept = np.zeros(len(rows), bool)
        for low, high in windows:
            fits = (upper >= low) & (lower <= high)
            certain = lower[(lower >= low) & (upper <= high)]
            if len(certain) >= k:
                fits &= upper >= np.partition(certain, len(certain) - k)[len(certain) - k]
            kept |= fits
        rows, at = rows[kept], at + 2 * level
    scores = vectors[rows] @ vector
    order = np.lexsort((ids[rows], -scores))
    rows, scores = rows[order], scores[order]
    inside = [np.flatnonzero((scores >= low) & (scores <= high))[:k] for low, high in windows]
    return [(rows[i], scores[i]) for i in inside]


_KEYS = ["_dim", "_block", "_asking"]
_FOUND = pa.schema([("anchor_id", pa.int64()), ("_anchor", pa.int64()), ("place", pa.int32()), ("other_id", pa.int64()), ("score", pa.int64())])


def _meet(same_label: bool, k: int, windows_of: Callable[[dict], list[tuple[float, float]]]):
    """Search of one block of rows for one block of anchors."""
    def found(block: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(block) or not len(asked):
            return _FOUND.empty_table()
        vectors, summary = _matrix(block["_v"], np.int64), _matrix(block["_summary"], np.float64)
        ids, labels = block["vec_id"].to_numpy(), block["label"].to_numpy()
        anchors, summaries = _matrix(asked["_v"], np.int64), _matrix(asked["_summary"], np.float64)
        if not vectors.size:
            vectors, anchors = np.zeros((len(block), 0), np.int64), np.zeros((len(asked), 0), np.int64)
        out = []
        for i, row in enumerate(asked.drop_columns(["_v", "_summary"]).to_pylist()):
            may = (labels == row["label"]) == same_label
            may &= ids != row["vec_id"]
            for place, (rows, scores) in enumerate(bounded_search(vectors, summary, may, anchors[i], summaries[i], windows_of(row), k, ids)):
                size = len(rows)
                out.append((np.full(size, row["vec_id"]), np.full(size, row["_anchor"]), np.full(size, place + 1, np.int32), ids[rows], scores))
        return pa.table([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*out), _FOUND)], schema=_FOUND)
    return found


def mine_hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                        scale: int = 256, block_rows: int = 4096, block_anchors: int = 8192) -> DataFrame:
    """Per anchor and positive, the best-scoring rows of other labels within a band of the positive's score.

    Returns anchor_id, positive_id, positive_rank, rank, negative_id, positive_score and
    negative_score. A score is the integer inner product of floor(scale * x) of both sides
    (components must stay below 2^24 after scaling). Positives are the anchor's best rows of
    its own label; a negative's score lies between ``low`` and ``high`` percent of the
    positive's. Ties go to the smaller vec_id. A positive without such rows gives none.

    Takes vec_id, label and embedding; other columns are ignored. Rows without id, label or
    vector, and vectors with a null or non-finite component, take no part; only vectors of equal
    length meet. Repeated rows are candidates each, up to the number that can be returned;
    equal anchor rows ask once, different rows with one anchor id ask one by one, and none of
    an anchor id's rows answers it. An empty table gives an empty one.

    Rows and anchors are cut into blocks by hash, and every pair of blocks is one task of
    bounded size that passes on the best few rows of each anchor.
    """
    work = Workspace(vectors.sparkSession, "negatives")
    good = vectors.select("vec_id", F.col("label").cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("_asks"),
                          quantised(F.col("embedding"), scale).alias("_v")).filter("vec_id IS NOT NULL AND label IS NOT NULL AND _v IS NOT NULL")
    copies = Window.partitionBy("vec_id", "label", "_v").orderBy("_asks")
    rows = good.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= max(positives, negatives))
    columns = rows.select("vec_id", "label", "_asks", "_copy", F.xxhash64("label", "_v").alias("_anchor"), F.size("_v").alias("_dim"), "_v")
    index = work.put("index", columns.mapInArrow(
        _summarised, "vec_id long, label long, _asks boolean, _copy int, _anchor long, _dim int, _v array<long>, _summary array<double>"))
    counted = index.agg(F.count("*"), F.count_if(F.col("_asks") & (F.col("_copy") == 1))).collect()[0]
    row_blocks, anchor_blocks = (max(1, math.ceil(n / size)) for n, size in zip(counted, (block_rows, block_anchors)))

    def block(count: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", "_v", "_copy"), F.lit(count)).cast("int")

    def beside(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = index.select("*", block(row_blocks).alias("_block"), beside(anchor_blocks).alias("_asking"))
    anchors = index.filter(F.col("_asks") & (F.col("_copy") == 1))

    def search(asking: DataFrame, same_label: bool, k: int, windows_of) -> DataFrame:
        right = asking.select("*", block(anchor_blocks).alias("_asking"), beside(row_blocks).alias("_block"))
        met = left.groupBy(*_KEYS).cogroup(right.toDF(*right.columns).groupBy(*_KEYS)).applyInArrow(
            _meet(same_label, k, windows_of), "anchor_id long, _anchor long, place int, other_id long, score long")
        best = Window.partitionBy("anchor_id", "_anchor", "place").orderBy(F.desc("score"), F.asc("other_id"))
        return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    near = work.put("positives", search(anchors, True, positives, lambda row: [(-math.inf, math.inf)]).drop("place"))
    listed = near.groupBy(F.col("anchor_id").alias("vec_id"), "_anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("_near"))

    def bands(row: dict) -> list[tuple[float, float]]:
        return [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in row["_near"]]

    found = search(anchors.join(listed, ["vec_id", "_anchor"]), False, negatives, bands)
    named = near.select("anchor_id", "_anchor", F.col("rank").alias("place"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(named, ["anchor_id", "_anchor", "place"]).select(
        "anchor_id", "positive_id", F.col("place").alias("positive_rank"), "rank", F.col("other_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
