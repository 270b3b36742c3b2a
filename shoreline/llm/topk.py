"""Exact top-k inner-product search with a bit-sliced index.

Vectors are cut into blocks. In a block every attribute is quantised to a few bits and kept
as bit slices: one bitmap over the block's rows per bit. A query's approximate scores are
sums of shifted slices, added with bitmap carries, for all its rows at once; walking the sum
from the most significant slice downward gives the k-th best approximate score. Rows within
the quantisation error of it are the boundary, and their scores are computed exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoreline.llm.base import stored

ATTRIBUTE_BITS = 7


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, or null where one is null or not finite."""
    as_double = F.transform(vector, lambda x: x.cast("double"))
    good = F.forall(as_double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(good, F.transform(as_double, lambda x: F.floor(F.lit(float(scale)) * x)))


def bit_slices(values: np.ndarray, bits: int) -> np.ndarray:
    """Bitmaps (attribute, bit, word) over the rows of a block of small non-negative values."""
    rows, dims = values.shape
    words = -(-rows // 64)
    planes = (values.T[:, None, :] >> np.arange(bits)[None, :, None]) & 1
    padded = np.zeros((dims, bits, words * 64), np.uint8)
    padded[:, :, :rows] = planes
    return np.packbits(padded, axis=2, bitorder="little").view(np.uint64)


def sliced_sums(slices: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Slices of every query's sum of |weight| * value, with the value's complement under negative weights."""
    dims, bits, words = slices.shape
    largest = int(np.abs(weights).sum(1).max(initial=0)) * ((1 << bits) - 1)
    total = [np.zeros((len(weights), words), np.uint64) for _ in range(max(1, largest.bit_length()))]
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for d in range(dims):
        w = weights[:, d]
        flip = np.where(w < 0, full, np.uint64(0))[:, None]
        size = np.abs(w)
        value = [slices[d, b][None, :] ^ flip for b in range(bits)]
        for shift in range(int(size.max(initial=0)).bit_length()):
            chosen = np.where((size >> shift) & 1, full, np.uint64(0))[:, None]
            carry = None
            for b in range(shift, len(total)):
                if b - shift < bits:
                    add = value[b - shift] & chosen
                    half = total[b] ^ add
                    if carry is None:
                        carry, total[b] = total[b] & add, half
                    else:
                        carry, total[b] = (total[b] & add) | (carry & half), half ^ carry
                else:
                    total[b], carry = total[b] ^ carry, total[b] & carry
                    if not carry.any():
                        break
    return total


def kth_largest(total: list[np.ndarray], rows: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest sum of each query among its rows, from the top slice down; the smallest if fewer."""
    certain, open_rows = np.zeros_like(rows), rows.copy()
    value = np.zeros(len(rows), np.int64)
    wanted = np.minimum(k, np.bitwise_count(rows).sum(1))
    for b in range(len(total) - 1, -1, -1):
        ones = open_rows & total[b]
        enough = np.bitwise_count(certain | ones).sum(1) >= wanted
        value += np.where(enough, 1 << b, 0)
        take = enough[:, None]
        certain = np.where(take, certain, certain | ones)
        open_rows = np.where(take, ones, open_rows & ~total[b])
    return value


def at_least(total: list[np.ndarray], bound: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Bitmap of the rows whose sum is the bound or more."""
    above, equal = np.zeros_like(rows), rows.copy()
    for b in range(len(total) - 1, -1, -1):
        bit = ((bound >> b) & 1).astype(bool)[:, None]
        above = np.where(bit, above, above | (equal & total[b]))
        equal = np.where(bit, equal & total[b], equal & ~total[b])
    out = above | equal
    out[bound >= (1 << len(total))] = 0
    return out


def block_top_k(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int,
                bits: int = ATTRIBUTE_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best k rows of one block for each query, without rows of the query's own id."""
    low, high = vectors.min(0), vectors.max(0)
    step = max(0, int((high - low).max(initial=0)).bit_length() - bits)
    top = (1 << bits) - 1
    small = (vectors - low) >> step
    total = sliced_sums(bit_slices(small, bits), queries)
    words = total[0].shape[1]
    live = np.zeros((len(queries), words * 64), np.uint8)
    live[:, :len(ids)] = ids[None, :] != query_ids[:, None]
    rows = np.packbits(live, axis=1, bitorder="little").view(np.uint64)
    # score = 2^step * sum + constant + rest, where |rest| comes from the cut low bits alone
    rest = np.abs(queries).sum(1) * ((1 << step) - 1)
    slack = -(-rest // (1 << step))
    bound = np.maximum(0, kth_largest(total, rows, k) - slack)
    near = np.unpackbits(at_least(total, bound, rows).view(np.uint8), axis=1, bitorder="little")[:, :len(ids)]
    q, r = np.nonzero(near)
    scores = np.empty(len(q), np.int64)
    for at in range(0, len(q), 1 << 16):
        part = slice(at, at + (1 << 16))
        scores[part] = np.einsum("ij,ij->i", queries[q[part]], vectors[r[part]])
    order = np.lexsort((ids[r], -scores, q))
    q, r, scores = q[order], r[order], scores[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    best = place < k
    return query_ids[q[best]], ids[r[best]], scores[best]


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256,
                block_rows: int = 4096, block_queries: int = 512) -> DataFrame:
    """The k best-scoring other vectors of each query, as query_id, rank, vec_id, score.

    Takes vec_id and embedding; other columns are ignored. The score is the inner product of
    floor(scale * x) of both sides, an exact integer (components must stay below 2^24 after
    scaling). Ties go to the smaller vec_id. Vectors that are null, or hold a null or
    non-finite component, and rows without vec_id take no part. Only vectors of equal length
    meet. Repeated rows are candidates each, up to the k that can be returned. A vec_id asks
    once per different vector, and the k best over these are its answer; none of its rows
    answers itself. An empty table gives an empty one.

    Queries and vectors are cut into blocks by a hash of the row, and every block of queries
    meets every block of vectors in one task of bounded size. Each passes on k rows per query.
    """
    copies = Window.partitionBy("vec_id", "_v").orderBy("_asks")
    rows = stored(vectors.select("vec_id", quantised(F.col("embedding"), scale).alias("_v"))
                  .filter(F.col("_v").isNotNull() & F.col("vec_id").isNotNull())
                  .withColumn("_asks", F.coalesce(is_query, F.lit(False)))
                  .withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= k), "vectors")
    asks = F.col("_asks") & (F.col("_copy") == 1)
    counted = rows.agg(F.count("*"), F.count_if(asks)).collect()[0]
    row_blocks, query_blocks = (max(1, math.ceil(n / size)) for n, size in zip(counted, (block_rows, block_queries)))

    def beside(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    hashed = F.xxhash64("vec_id", "_v", "_copy")
    dim = F.size("_v").alias("_dim")
    left = rows.select("vec_id", "_v", dim, F.pmod(hashed, F.lit(row_blocks)).cast("int").alias("_rb"), beside(query_blocks).alias("_qb"))
    right = rows.filter(asks).select("vec_id", "_v", dim, F.pmod(hashed, F.lit(query_blocks)).cast("int").alias("_qb"), beside(row_blocks).alias("_rb"))

    def meet(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        found = block_top_k(np.stack(block["_v"].to_list()).astype(np.int64), block["vec_id"].to_numpy(),
                            np.stack(asked["_v"].to_list()).astype(np.int64), asked["vec_id"].to_numpy(), k)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))

    keys = ["_dim", "_rb", "_qb"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
