"""Nearest vectors by cosine, and text turned into vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import dataset, fs
from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, IDF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shoreline.operators.ranking import top_k_per_group
from shoreline.session import shared_folder

QUERY_BLOCK, ROW_BLOCK, LEAST_BLOCK = 512, 4_096, 1_024
#: Pivots of a pruned search, documents of a block, most queries of a task.
PIVOTS, CLUSTER_BLOCK, QUERY_PART = 256, 4_096, 16_384


def _usable(vector: str) -> Column:
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")))
    return F.coalesce(F.col(vector).isNotNull() & ~broken, F.lit(False))


def unusable_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Rows that a search leaves out: their vector is NULL or holds a NULL or NaN."""
    return df.filter(~_usable(vector))


def _numbers(df: DataFrame, vector: str) -> Column:
    """The vector as it travels: floats stay half as long as doubles and become those in the task."""
    kind = df.schema[vector].dataType
    return F.col(vector).cast("array<float>" if isinstance(kind.elementType, T.FloatType) else "array<double>")


def _units(vectors: pd.Series) -> np.ndarray:
    """Unit rows in doubles; a zero vector stays zero."""
    return _unit_rows(np.stack(vectors.to_list()).astype(np.float64) if len(vectors) else np.zeros((0, 1)))


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix /= np.where(length == 0, 1.0, length)
    return matrix


def nearest(docs: DataFrame, queries: DataFrame, k: int, doc_id: str, vector: str, query_id: str,
            metadata: Sequence[str] = (), digits: int = 6, block: int = QUERY_BLOCK, rows: int = ROW_BLOCK) -> DataFrame:
    """The k documents nearest to each query by cosine: exact, no index.

    Queries and documents are cut into blocks by a hash of their ids. Every block of queries
    meets every block of documents in one task of bounded size, which scores them with one
    matrix product and passes on k rows per query; nothing goes through the driver but two
    counts, which read no vectors. Small tables are cut so that all cores have work. Scores are rounded before ranking and equal ones rank by document id. A zero
    vector has score 0. Vectors that are NULL or hold a NULL or NaN take no part (see
    ``unusable_vectors``), and only vectors of one length meet.
    """
    asked = queries.filter(_usable(vector)).select(F.col(query_id).alias("_q"), _numbers(queries, vector).alias("_v"))
    given = docs.filter(_usable(vector)).select(F.col(doc_id).alias("_d"), _numbers(docs, vector).alias("_v"))
    query_blocks, count = -(-queries.count() // block) or 1, docs.count()
    cores = docs.sparkSession.sparkContext.defaultParallelism
    row_blocks = max(-(-count // rows), min(-(-cores // query_blocks), -(-count // LEAST_BLOCK)), 1)

    def beside(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    size = F.size("_v").alias("_n")
    left = given.select("_d", "_v", size, F.pmod(F.xxhash64("_d"), F.lit(row_blocks)).cast("int").alias("_rows"), beside(query_blocks).alias("_block"))
    right = asked.select("_q", "_v", size, F.pmod(F.xxhash64("_q"), F.lit(query_blocks)).cast("int").alias("_block"), beside(row_blocks).alias("_rows"))
    result = T.StructType([T.StructField(query_id, queries.schema[query_id].dataType), T.StructField(doc_id, docs.schema[doc_id].dataType),
                           T.StructField("score", T.DoubleType())])

    def score(part: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        taken: list[tuple] = []
        if len(part) and len(wanted):
            names, scores = part["_d"].tolist(), np.round(_units(wanted["_v"]) @ _units(part["_v"]).T, digits)
            for query, line in zip(wanted["_q"].tolist(), scores):
                at = np.arange(len(line)) if len(line) <= k else np.flatnonzero(line >= np.partition(line, len(line) - k)[len(line) - k])
                taken += [(query, names[i], line[i]) for i in sorted(at.tolist(), key=lambda i: (-line[i], names[i]))[:k]]
        return pd.DataFrame(taken, columns=result.names)

    keys = ["_n", "_rows", "_block"]
    candidates = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, result)
    best = top_k_per_group(candidates, [query_id], [F.desc("score"), F.asc(doc_id)], k)
    return docs.select(doc_id, *metadata).join(best, doc_id) if metadata else best


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows in doubles."""
    lengths = pc.unique(pc.list_value_length(vectors)).to_pylist()
    if len(lengths) > 1:
        raise ValueError(f"vectors of lengths {lengths} meet")
    return pc.list_flatten(vectors).to_numpy().astype(np.float64).reshape(len(vectors), lengths[0] if lengths else 0)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k best of each row, of equal ones those that stand first."""
    if scores.shape[1] <= k:
        return np.ones(scores.shape, bool)
    last = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k, None]
    above, level = scores > last, scores == last
    return above | level & (np.cumsum(level, axis=1) <= k - above.sum(1, keepdims=True))


def _layout(counts: pd.DataFrame, block: int) -> dict[int, tuple[int, int]]:
    """First block and number of blocks of each cluster: large ones are cut, small ones share a block."""
    layout, free, room = {}, 0, 0
    for cluster, count in zip(counts["cluster"].tolist(), counts["count"].tolist()):
        if count <= room:
            layout[cluster], room = (free - 1, 1), room - count
        else:
            needed = -(-count // block)
            layout[cluster], free, room = (free, needed), free + needed, block - count if needed == 1 else 0
    return layout


def nearest_pruned(docs: DataFrame, queries: DataFrame, k: int, doc_id: str, vector: str, query_id: str, digits: int = 6,
                   pivots: int = PIVOTS, block: int = CLUSTER_BLOCK) -> DataFrame:
    """As ``nearest``, for many queries: clusters that cannot hold a result are skipped.

    Every document belongs to the nearest of a bounded number of pivots (documents chosen by
    hash), and each cluster knows the widest angle to its pivot. A query first searches its
    nearest clusters until they hold k documents, which gives it a k-th score. Of the other
    clusters, only those are searched whose nearest possible document, by the angle to the
    pivot less the cluster's, could score as much. The result is exact. ``looked_at`` is the
    number of documents a query was scored against.

    Ids are unique, vectors of one length; unusable vectors take no part. A zero vector has
    score 0 with everything, and its documents form a cluster that is never skipped. Large
    clusters are cut into blocks and small ones share a block. Documents and queries are each
    written once to the shared folder, by block; a task takes a part of the queries and reads
    the blocks they need from there one after another, so disk grows with the vectors and not
    with the pairs that meet. A product in floats finds the pairs that may count, and these
    are scored in doubles.
    """
    spark = docs.sparkSession
    given = docs.filter(_usable(vector)).select(F.col(doc_id).alias("_id"), _numbers(docs, vector).alias("_v"))
    asked = queries.filter(_usable(vector)).select(F.col(query_id).alias("_id"), _numbers(queries, vector).alias("_v"))
    chosen = given.filter(F.exists("_v", lambda x: x != 0)).orderBy(F.xxhash64("_id"), "_id").limit(pivots).select("_v").toPandas()
    if not len(chosen):
        chosen = pd.DataFrame({"_v": given.select("_v").limit(1).toPandas()["_v"]})
    asked = asked if len(chosen) else asked.limit(0)
    centers = _units(chosen["_v"])
    everything = np.pi
    path = shared_folder(spark, "nearest")

    def placed(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cosines = np.clip(unit @ centers.T, -1, 1)
        cluster, zero = cosines.argmax(1), ~unit.any(1)
        angle = np.arccos(cosines[np.arange(len(unit)), cluster])
        return np.where(zero, -1, cluster).astype(np.int32), np.where(zero, everything, angle)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                numbers, counts = np.unique(placed(_unit_rows(_matrix(batch["_v"])))[0], return_counts=True)
                yield pa.RecordBatch.from_pydict({"cluster": numbers, "count": counts})

    def laid_out(vectors: DataFrame, size: int, folder: str) -> DataFrame:
        """The vectors by block; how they are cut steers only cost."""
        counts = vectors.select("_v").mapInArrow(sizes, "cluster int, count long").groupBy("cluster").agg(F.sum("count").alias("count"))
        layout = _layout(counts.orderBy("cluster").toPandas(), size)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    cluster, angle = placed(_unit_rows(_matrix(batch["_v"])))
                    first, blocks = np.array([layout.get(c, (0, 1)) for c in cluster.tolist()]).T
                    at = (first + batch["_hash"].to_numpy() % blocks).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([batch["_id"], batch["_v"], *map(pa.array, (cluster, angle, at))], names=kinds.names)

        kinds = T.StructType([*vectors.schema, T.StructField("cluster", T.IntegerType()), T.StructField("angle", T.DoubleType()),
                              T.StructField("block", T.IntegerType())])
        vectors.withColumn("_hash", F.xxhash64("_id", "_v")).mapInArrow(rows, kinds).repartition("block").write.partitionBy("block").parquet(f"{path}/{folder}")
        return spark.read.schema(kinds).parquet(f"{path}/{folder}")

    cores = spark.sparkContext.defaultParallelism
    clustered = laid_out(given, block, "docs")
    first = laid_out(asked, min(max(-(-queries.count() // (4 * cores)), QUERY_BLOCK), QUERY_PART), "first")
    known = clustered.groupBy("block", "cluster").agg(F.max("angle").alias("radius"), F.count("*").alias("size")).orderBy("block", "cluster").toPandas()
    clusters = known.groupby("cluster").agg({"radius": "max", "size": "sum"}).reset_index()
    numbers, radius, size = (clusters[c].to_numpy() for c in ("cluster", "radius", "size"))
    places = np.where(numbers >= 0, numbers, 0)
    held_by = {at: np.searchsorted(numbers, own) for at, own in known.groupby("block")["cluster"].agg(list).items()}
    parts = [r["block"] for r in first.select("block").distinct().orderBy("block").collect()]

    def bounds(unit: np.ndarray) -> np.ndarray:
        """Best possible cosine of each query with each cluster; 1 for documents without direction."""
        apart = np.arccos(np.clip(unit @ centers.T, -1, 1))[:, places] - radius
        best = np.cos(np.clip(apart, 0, np.pi))
        best[:, numbers < 0] = 1.0
        best[~unit.any(1)] = 1.0
        return best

    def plan(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bounds, and the nearest clusters of each query."""
        best = bounds(unit)
        order = np.argsort(-best, axis=1, kind="stable")
        held = np.cumsum(size[order], axis=1) - size[order]
        near = np.zeros(best.shape, bool)
        np.put_along_axis(near, order, held < k, axis=1)
        return best, near

    def read(folder: str, at: int, columns: Sequence[str]) -> pa.Table:
        store, root = fs.FileSystem.from_uri(path)
        table = dataset.dataset(f"{root}/{folder}/block={at}", filesystem=store, format="parquet").to_table(columns=list(columns))
        order = [(c, "ascending") for c in columns if c != "_v"]
        return table.take(pc.sort_indices(table, sort_keys=order, null_placement="at_start"))

    def scan(unit: np.ndarray, take: np.ndarray, least: np.ndarray, of: tuple[int, int]) -> pa.Table:
        """Up to k documents (``_id``, ``score``) for each query ``q`` from the clusters to take; scores below its least one may be missing."""
        rough, least, taken, count = unit.astype(np.float32), least.copy(), [], 0
        # what rounding a score and a product in floats may hide
        slack = 10.0**-digits + (unit.shape[1] + 8) * 2.0**-23

        def cut() -> list[pa.Table]:
            found = pa.concat_tables(taken)
            found = found.take(pc.sort_indices(found, sort_keys=[("q", "ascending"), ("score", "descending"), ("_id", "ascending")], null_placement="at_start"))
            q = found["q"].to_numpy()
            place = np.arange(len(q)) - np.searchsorted(q, q)
            last = place == k - 1
            least[q[last]] = np.maximum(least[q[last]], found["score"].to_numpy()[last])
            return [found.filter(pa.array(place < k))]

        for at, inside in [*held_by.items()][of[0]::of[1]]:
            if not take[:, inside].any():
                continue
            table = read("docs", at, ("cluster", "_id", "_v"))
            own, matrix, ids = table["cluster"].to_numpy(), _unit_rows(_matrix(table["_v"])), table["_id"]
            for c in inside:
                start, end = np.searchsorted(own, numbers[c], "left"), np.searchsorted(own, numbers[c], "right")
                part, asking = matrix[start:end], np.flatnonzero(take[:, c])
                narrow = part.astype(np.float32).T
                for q in np.split(asking, range(QUERY_BLOCK, len(asking), QUERY_BLOCK)):
                    hit = rough[q] @ narrow >= (least[q] - slack).astype(np.float32)[:, None]
                    some = np.flatnonzero(hit.any(1))
                    if not len(some):
                        continue
                    hits = hit[some]
                    full = hits.sum(1) > k
                    line, d = np.nonzero(hits[~full])
                    q1 = q[some[~full]][line]
                    exact = np.round(np.einsum("ij,ij->i", unit[q1], part[d]), digits)
                    fits = exact >= least[q1]
                    q1, d, exact = q1[fits], d[fits], exact[fits]
                    if full.any():
                        whole = np.round(unit[q[some[full]]] @ part.T, digits)
                        line, d2 = np.nonzero(_best(whole, k) & (whole >= least[q[some[full]]][:, None]))
                        q1, d, exact = np.r_[q1, q[some[full]][line]], np.r_[d, d2], np.r_[exact, whole[line, d2]]
                    if len(q1):
                        taken.append(pa.table({"q": q1, "_id": ids.take(pa.array(start + d)), "score": exact}))
                        count += len(q1)
                if count > 2 * k * len(unit):
                    taken = cut()
                    count = len(taken[0])
        return cut()[0] if taken else None

    outcome = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_row", T.IntegerType()), T.StructField(query_id, queries.schema[query_id].dataType),
                            T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("score", T.DoubleType()),
                            T.StructField("_size", T.LongType()), T.StructField("_open", T.DoubleType())])

    def outcomes(part: int, row: np.ndarray, ids: pa.ChunkedArray, sized: np.ndarray, still: np.ndarray, found: pa.Table | None) -> Iterator[pa.RecordBatch]:
        """A row for each query asked, without a document, and one for each document found."""
        def batches(at, names, score, size, open_):
            columns = [pa.array(np.full(len(at), part, np.int32)), pa.array(row[at].astype(np.int32)), ids.take(pa.array(at)), names, score, size, open_]
            return pa.table(columns, names=outcome.names).combine_chunks().to_batches()

        kind = to_arrow_type(outcome[doc_id].dataType)
        yield from batches(np.arange(len(row)), pa.nulls(len(row), kind), pa.nulls(len(row), pa.float64()), pa.array(sized.astype(np.int64)), pa.array(still))
        if found is not None:
            q = found["q"].to_numpy()
            yield from batches(q, found["_id"], found["score"], pa.nulls(len(q), pa.int64()), pa.nulls(len(q), pa.float64()))

    def plans(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [plan(unit[at:at + QUERY_BLOCK]) for at in range(0, len(unit), QUERY_BLOCK)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (parts[i] for batch in batches for i in batch["id"].to_pylist()):
            table = read("first", part, ("cluster", "_id", "_v"))
            unit = _unit_rows(_matrix(table["_v"]))
            best, near = plans(unit)
            found = scan(unit, near, np.full(len(unit), -np.inf), (0, 1))
            yield from outcomes(part, np.arange(len(unit)), table["_id"], near @ size, np.where(near, -np.inf, best).max(1), found)

    def tasks(count: int) -> DataFrame:
        return spark.range(0, count, 1, max(count, 1))

    tasks(len(parts)).mapInArrow(begin, outcome).write.parquet(f"{path}/near")
    near = spark.read.schema(outcome).parquet(f"{path}/near")
    hit = F.col("score").isNotNull()
    order = [F.desc("score"), F.asc(doc_id)]
    # a rounded score may lie half a unit above the exact one
    least = (top_k_per_group(near.filter(hit).select(query_id, doc_id, "score"), [query_id], order, k)
             .groupBy(F.col(query_id).alias("_q")).agg(F.count("*").alias("_n"), (F.min("score") - 10.0**-digits).alias("_least")))
    waiting = near.filter(~hit).join(least, F.col(query_id) == F.col("_q"), "left").withColumn("_least", F.when(F.col("_n") >= k, F.col("_least")).otherwise(-2.0))
    waiting.filter(F.col("_open") >= F.col("_least")).select("_part", "_row", "_least").write.parquet(f"{path}/more")
    open_parts = [r["_part"] for r in spark.read.schema("_part int").parquet(f"{path}/more").distinct().orderBy("_part").collect()]
    # few queries and many documents: some tasks share the blocks
    slices = max(1, min(-(-cores // max(len(open_parts), 1)), len(held_by)))

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        for i in (i for batch in batches for i in batch["id"].to_pylist()):
            part, own = open_parts[i // slices], i % slices
            asked = dataset.dataset(f"{root}/more", filesystem=store, format="parquet").to_table(filter=dataset.field("_part") == part).sort_by("_row")
            row, low = asked["_row"].to_numpy(), asked["_least"].to_numpy()
            table = read("first", part, ("cluster", "_id", "_v")).take(pa.array(row))
            unit = _unit_rows(_matrix(table["_v"]))
            best, near = plans(unit)
            take = ~near & (best >= low[:, None])
            found = scan(unit, take, low, (own, slices))
            yield from outcomes(part, row, table["_id"], take @ size * (own == 0), np.full(len(unit), -np.inf), found)

    tasks(len(open_parts) * slices).mapInArrow(go_on, outcome).write.parquet(f"{path}/rest")
    rows = near.unionByName(spark.read.schema(outcome).parquet(f"{path}/rest"))
    best = top_k_per_group(rows.filter(hit).select(query_id, doc_id, "score"), [query_id], order, k)
    looked_at = rows.groupBy(query_id).agg(F.sum("_size").alias("looked_at"))
    return best.join(looked_at, query_id)


def text_vectors(fit_on: DataFrame, tables: Sequence[DataFrame], text: str, vector: str = "embedding",
                 dimensions: int = 1024) -> list[DataFrame]:
    """Hashed TF-IDF unit vectors for the text column of each table.

    The weights are fitted on one table in a single distributed pass and are as long as
    ``dimensions``, whatever the vocabulary.
    """
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dimensions),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="_unit"),
    ]
    model = Pipeline(stages=stages).fit(fit_on.filter(F.col(text).isNotNull()))
    return [model.transform(t.filter(F.col(text).isNotNull()))
            .withColumn(vector, vector_to_array("_unit", "float32"))
            .drop("_words", "_tf", "_tfidf", "_unit") for t in tables]
