"""Exact Jaccard self-join of shingle sets by universe partition, and its linked groups.

Two sets of sizes a and b whose Jaccard similarity is 3/4 or more differ in at most
(a + b) / 7 shingles. The universe of shingles is cut into segments by hash, with more
segments than that for every band of sizes, so a linked pair must agree on whole segments.
Each set indexes subsets that fall into its segments. What it spends on them is allocated by
cost: only as many subsets as can differ, plus one, are indexed, in one order that holds for
all sets and puts subsets with more uncommon shingles first. (If the first so many subsets of
two sets had none in common, more subsets would differ than can.) A set with fewer subsets
than that also indexes each subset with one shingle deleted, so that a segment that differs
by one still meets. Candidates are then verified exactly.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoreline.llm.base import Workspace, ensure_checkpoints
from shoreline.llm.shingles import mixed, run_starts, shingle_set
from shoreline.operators.joins import broadcast_if_small

WIDTH = 5
#: Similarity 3/4: linked when 4 * intersection >= 3 * union.
SMALL_SET = 64
SMALL_IDS = 2_000_000
#: Members of a key that are held until the key ends; member sets that a task remembers; pairs of one document that one task tests.
HELD_MEMBERS, REMEMBERED_SETS, PAIRS_A_TASK = 1 << 16, 1 << 20, 1_000
#: Places of the parity sketch of a set.
SKETCH_BITS = 1024
SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]
#: A shingle that tasks meet this often, counting only tasks that meet it twice, is common.
COMMON_COUNT, COMMON_BITS, COUNTED_TOKENS = 8, 24, 1 << 22


def _bands() -> list[tuple[int, int]]:
    """Size bands, each over twice as wide as a linked partner can be larger."""
    bands, low = [], 1
    while low < 1 << 40:
        high = low * 64 // 27 + 1
        bands.append((low, high))
        low = high + 1
    return bands


BANDS = _bands()
_HIGHS = np.array([high for _, high in BANDS])


def segment_keys(tokens: np.ndarray, common: np.ndarray | None = None) -> np.ndarray:
    """Index keys of one set: its own band's and, if a partner can be that large, the next one's.

    ``common`` is a bitmap over the top bits of a shingle; a set bit makes it count as common.
    Any bitmap gives the same links, as long as all sets use the same one.
    """
    size = len(tokens)
    rare = np.ones(size, np.int64)
    if common is not None:
        bit = (tokens >> np.uint64(64 - COMMON_BITS)).astype(np.int64)
        rare = 1 - ((common[bit >> 3] >> (bit & 7)) & 1).astype(np.int64)
    own = int(np.searchsorted(_HIGHS, size))
    keys = [_band_keys(tokens, rare, own)]
    if size * 4 // 3 > BANDS[own][1]:
        keys.append(_band_keys(tokens, rare, own + 1))
    return np.concatenate(keys)


def _band_keys(tokens: np.ndarray, rare: np.ndarray, band: int) -> np.ndarray:
    high, wanted = BANDS[band][1], len(tokens) // 3 + 1
    segments = 16 * high if high <= SMALL_SET else high + 16
    place = ((tokens >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    # tokens are sorted, and the place follows the high bits, so segments are runs
    heads = np.flatnonzero(run_starts(place))
    spread = mixed(tokens)
    sums, rares = np.add.reduceat(spread, heads), np.add.reduceat(rare, heads)
    salt = mixed(place[heads] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band + 1))
    full = _ordered(mixed(sums ^ salt), rares)
    if len(full) >= wanted:
        return np.partition(full, wanted - 1)[:wanted]
    counts = np.diff(np.r_[heads, len(tokens)])
    several = np.repeat(counts > 1, counts)
    rest = (np.repeat(sums, counts) - spread)[several]
    deleted = _ordered(mixed(rest ^ np.repeat(salt, counts)[several]), (np.repeat(rares, counts) - rare)[several])
    return np.unique(np.r_[full, deleted])


def _ordered(hashes: np.ndarray, rares: np.ndarray) -> np.ndarray:
    """Keys that sort by falling number of uncommon shingles, the same for the same subset."""
    rank = np.uint64(31) - np.minimum(rares, 31).astype(np.uint64)
    return (rank << np.uint64(59)) | (hashes >> np.uint64(5))


_KEYED = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("n", pa.int32())])
_GROUPED = pa.schema([("key", pa.int64()), ("center", pa.int64()), ("doc", pa.int64()), ("n", pa.int32())])


def _repeated_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that occur in several different sets among those at hand, with counts."""
    known: set[bytes] = set()
    held, size = [], 0

    def counted() -> pa.RecordBatch:
        tokens, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.record_batch([pa.array(tokens[counts > 1].view(np.int64)), pa.array(counts[counts > 1])], ["token", "n"])

    for batch in batches:
        for text in batch.column(1):
            tokens = shingle_set(text.as_py(), WIDTH)
            print_ = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
            if print_ in known:
                continue
            known.add(print_)
            held.append(tokens)
            size += len(tokens)
            if size > COUNTED_TOKENS:
                yield counted()
                held, size = [], 0
    if held:
        yield counted()


def common_tokens(given: DataFrame) -> np.ndarray:
    """Bitmap of fixed size over the top bits of shingles, set where a shingle is common.

    Counted over all documents. It only steers which subsets are indexed first; at any
    corpus size, however full it gets, the links found are the same.
    """
    bit = F.shiftrightunsigned("token", 64 - COMMON_BITS)
    frequent = given.mapInArrow(_repeated_tokens, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= COMMON_COUNT).select(F.shiftright(bit, 15).alias("part"), bit.bitwiseAND(32767).alias("bit"))
    bitmap = np.zeros(1 << (COMMON_BITS - 3), np.uint8)
    for row in frequent.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        bitmap[row["part"] * 4096:(row["part"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return bitmap


def _index_rows(common: np.ndarray):
    """Index rows (tag 0) of each set, and one row per document keyed by its set's fingerprint.

    A set that the task has met before is not indexed again.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            keys, docs, tags, sizes = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = shingle_set(text.as_py(), WIDTH)
                print_ = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
                first, second = np.frombuffer(print_, np.int64)
                own = segment_keys(tokens, common).view(np.int64) if len(tokens) and known.setdefault(print_, doc) == doc else np.empty(0, np.int64)
                keys.append(np.concatenate(([first], own)))
                docs.append(np.full(len(own) + 1, doc))
                tag = np.zeros(len(own) + 1, np.int64)
                tag[0] = second | 1
                tags.append(tag)
                sizes.append(np.full(len(own) + 1, len(tokens), np.int32))
            if keys:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in (keys, docs, tags, sizes)], schema=_KEYED)

    return rows


def _shared_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (key, tag, doc): the members of every index key with two or more, with
    the first as center; and every document row with its copies' first document (key null).

    Keys with the same members are shown once per task: in place of the key stands a hash of
    its members, so that tasks' rows for the same members are equal. At most HELD_MEMBERS rows
    wait for the end of their key; the members of longer keys are shown under the key itself.
    """
    seen: set[int] = set()
    held, center = None, None

    def shown(keys, docs, tags, sizes, first=None) -> pa.RecordBatch:
        """Whole runs; with ``first``, part of one long run that this document opened."""
        new = np.r_[True, (keys[1:] != keys[:-1]) | (tags[1:] != tags[:-1])]
        run = np.cumsum(new) - 1
        centers = docs[new][run] if first is None else np.full(len(docs), first)
        fresh = (tags == 0) & np.r_[True, ~((keys[1:] == keys[:-1]) & (docs[1:] == docs[:-1]) & (tags[1:] == tags[:-1]))]
        names = keys
        if first is None:
            members = np.bincount(run[fresh], minlength=run[-1] + 1)
            sums = np.zeros(run[-1] + 1, np.uint64)
            np.add.at(sums, run[fresh], mixed(docs[fresh]))
            named = mixed(sums + members.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
            _, at = np.unique(named, return_index=True)
            kept = np.zeros(len(named), bool)
            kept[[i for i in at if members[i] > 1 and int(named[i]) not in seen]] = True
            if len(seen) > REMEMBERED_SETS:
                seen.clear()
            seen.update(named[kept].tolist())
            fresh &= kept[run]
            names = named[run]
        out = fresh | (tags != 0)
        return pa.record_batch([pa.array(names[out], mask=tags[out] != 0), pa.array(centers[out]), pa.array(docs[out]), pa.array(sizes[out])], schema=_GROUPED)

    for batch in batches:
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            rows = [np.r_[h, r] for h, r in zip(held, rows)]
        if not len(rows[0]):
            continue
        keys, _, tags, _ = rows
        ends = np.flatnonzero((keys[1:] != keys[:-1]) | (tags[1:] != tags[:-1]))
        last = ends[-1] + 1 if len(ends) else 0
        if center is not None and len(ends):
            yield shown(*[r[:ends[0] + 1] for r in rows], first=center)
            rows, last, center = [r[ends[0] + 1:] for r in rows], last - ends[0] - 1, None
        if last:
            yield shown(*[r[:last] for r in rows])
        held = [r[last:] for r in rows]
        if len(held[0]) > HELD_MEMBERS:
            center = held[1][0] if center is None else center
            # the last row stays, to tell where the next batch goes on
            yield shown(*[h[:-1] for h in held], first=center)
            held = [h[-1:] for h in held]
    if held is not None and len(held[0]):
        yield shown(*held, first=center)


_CHECKED = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_()), ("distance", pa.float64())])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact test of texts sorted by (a, salt, doc differs from a): the sets of a are held, the others compared with them."""
    center, held = None, {}
    for batch in batches:
        out = []
        for a, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if a != center:
                center, held = a, {}
            own = shingle_set(text.as_py(), WIDTH)
            if doc == a:
                held[own.tobytes()] = own
                continue
            for other in held.values():
                both = len(np.intersect1d(own, other, assume_unique=True))
                either = len(own) + len(other) - both
                out.append((a, doc, 100 * both >= 75 * either > 0, 1 - both / max(either, 1)))
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _CHECKED)], schema=_CHECKED)


def verify(pairs: DataFrame, given: DataFrame) -> DataFrame:
    """Test candidate pairs (a, b): a, b, linked, distance (one less similarity).

    A text moves once for each a that it is compared with, and the text of a once for every
    PAIRS_A_TASK of its pairs, which are dealt to that many places.
    """
    many = pairs.groupBy("a").agg((F.count("*") / PAIRS_A_TASK).cast("int").alias("_more")).filter(F.col("_more") > 0)
    dealt = pairs.join(broadcast_if_small(many, max_rows=SMALL_IDS), "a", "left").withColumn(
        "_salt", F.pmod(F.xxhash64("b"), F.coalesce("_more", F.lit(0)) + 1))
    wanted = dealt.select("a", "_salt", F.col("b").alias("doc_id")).unionByName(dealt.select("a", "_salt", F.col("a").alias("doc_id")).distinct())
    texts = given.join(broadcast_if_small(wanted, max_rows=SMALL_IDS), "doc_id").select("a", "doc_id", "text", "_salt")
    sorted_ = texts.repartition("a", "_salt").sortWithinPartitions("a", "_salt", F.col("doc_id") != F.col("a"))
    return sorted_.select("a", "doc_id", "text").mapInArrow(_verified, "a long, b long, linked boolean, distance double")


def smallest_reachable(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node, label: the smallest node reachable by links (a, b), for the nodes that have links.

    Labels fall to the smallest of the neighbours' labels and then jump to their label's
    label, so rounds grow with the logarithm of the longest chain. Neighbours' labels are
    combined in every task before they shuffle. Each round is checkpointed.
    """
    ensure_checkpoints(links.sparkSession)
    edges = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct().checkpoint()
    labels = edges.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("label")).checkpoint()
    for _ in range(rounds):
        seen = edges.join(labels.select(F.col("node").alias("other"), "label"), "other").select("node", "label")
        lower = seen.unionByName(labels).groupBy("node").agg(F.min("label").alias("label"))
        jumped = lower.join(labels.select(F.col("node").alias("label"), F.col("label").alias("_next")), "label", "left").select(
            "node", F.least("label", F.coalesce("_next", "label")).alias("label"))
        after = jumped.join(labels.select("node", F.col("label").alias("_before")), "node").checkpoint()
        if after.filter(F.col("label") != F.col("_before")).limit(1).count() == 0:
            return after.select("node", "label")
        labels = after.select("node", "label")
    raise RuntimeError(f"labels still change after {rounds} rounds")


def linked_groups(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document row.

    Sets are the distinct 5-word shingles; documents link at similarity 3/4 or more, and
    component_id is the smallest doc_id reachable by links, the document's own included.

    Takes doc_id and text; other columns are ignored. Null, empty and blank texts have an
    empty set and are linked with nothing. Rows with a null doc_id take no part and have a
    null component. Rows that share a doc_id are one document whose rows all link. An empty
    table gives an empty one.

    Equal sets are grouped by fingerprint. Of the rest, every set is first compared with the
    smallest document of each index key it shares, so a group of near copies costs one pair
    per member. Where a key's members then still lie in different components, its remaining
    pairs across components are compared too. No link between different texts is lost.
    """
    given, work = documents.select("doc_id", "text"), Workspace(documents.sparkSession, "jaccard")
    known = given.filter(F.col("doc_id").isNotNull())
    indexed = known.mapInArrow(_index_rows(common_tokens(known)), "key long, doc long, tag long, n int")
    grouped = work.put("groups", indexed.repartition("key").sortWithinPartitions("key", "tag", "doc").mapInArrow(
        _shared_runs, "key long, center long, doc long, n int"))
    sets = work.put("sets", grouped.filter(F.col("key").isNull()).select(F.col("doc").alias("doc_id"), F.col("center").alias("copy_of"), "n"))
    index = work.put("index", grouped.filter(F.col("key").isNotNull()).distinct())
    work.drop("groups")
    copies = sets.filter((F.col("n") > 0) & (F.col("copy_of") != F.col("doc_id"))).select(
        F.col("copy_of").alias("a"), F.col("doc_id").alias("b")).distinct()

    def one_per_set(pairs: DataFrame) -> DataFrame:
        """Pairs between the first documents of their sets, smaller id first, without repeats."""
        for side in ("a", "b"):
            first = copies.select(F.col("b").alias(side), F.col("a").alias("_first"))
            pairs = pairs.join(first, side, "left").withColumn(side, F.coalesce("_first", side)).drop("_first")
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()

    star = work.put("star", one_per_set(index.filter("center <> doc").select(F.col("center").alias("a"), F.col("doc").alias("b")).distinct()))
    tested = work.put("tested", verify(star, known))
    links = work.put("links", copies.unionByName(tested.filter("linked").select("a", "b")))
    labels = smallest_reachable(links)

    rest = work.put("rest", remaining_pairs(index, labels, tested, copies, known, work))
    work.drop("index", "star", "tested", "mixed", "sketches")
    if not rest.isEmpty():
        more = work.put("more", verify(rest, known).filter("linked").select("a", "b"))
        if not more.isEmpty():
            labels = smallest_reachable(links.unionByName(more))
    named = sets.select("doc_id", "n").join(labels.select(F.col("node").alias("doc_id"), "label"), "doc_id", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("label", "doc_id").alias("component_id"))
    unnamed = given.filter(F.col("doc_id").isNull()).mapInArrow(_sizes, "n_shingles long").select(
        F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return named.unionByName(unnamed)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch([pa.array([len(shingle_set(t.as_py(), WIDTH)) for t in batch.column(1)], pa.int64())], ["n_shingles"])


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each set, whether an odd number of its shingles falls to each of SKETCH_BITS places."""
    for batch in batches:
        sketches = [np.packbits((np.bincount((shingle_set(t.as_py(), WIDTH) % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)).view(np.int64)
                    for t in batch.column(1)]
        if sketches:
            yield pa.record_batch([batch.column(0), *map(pa.array, np.ascontiguousarray(np.array(sketches).T))], ["doc", *SKETCH])


def remaining_pairs(index: DataFrame, labels: DataFrame, tested: DataFrame, copies: DataFrame, given: DataFrame, work: Workspace) -> DataFrame:
    """Pairs of documents that share an index key but neither a component nor a test so far.

    Only keys with three or more members of at least two components have any. Members meet in
    bands of set sizes, as linked sets differ in size by a third at most. Both members'
    distances to the key's center are known, and one less similarity is a metric, so distances
    that differ by more than a link's rule a pair out without a test. So do parity sketches of
    the sets: places whose parity differs are no more than the shingles that differ, of which a
    linked pair has few.
    """
    label = broadcast_if_small(labels.select(F.col("node").alias("doc"), "label"), max_rows=SMALL_IDS)
    placed = index.join(label, "doc", "left").withColumn("label", F.coalesce("label", "doc"))
    looked_at = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("members")).filter(
        "low <> high AND members > 2").select("key")
    first = broadcast_if_small(copies.select(F.col("b").alias("doc"), F.col("a").alias("_first")), max_rows=SMALL_IDS)
    inside = placed.join(looked_at, "key", "left_semi").join(first, "doc", "left").withColumn("doc", F.coalesce("_first", "doc")).drop("_first")
    inside = inside.join(first.withColumnRenamed("doc", "center"), "center", "left").withColumn("center", F.coalesce("_first", "center"))
    apart = tested.select(F.col("a").alias("center"), F.col("b").alias("doc"), "distance")
    either_way = apart.unionByName(apart.select(F.col("doc").alias("center"), F.col("center").alias("doc"), "distance"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(4 / 3)) + 1e-9).cast("int")
    both = work.put("mixed", inside.select("key", "center", "doc", "n", "label").distinct().join(either_way, ["center", "doc"]).withColumn("band", band))
    sketches = work.put("sketches", given.join(broadcast_if_small(both.select(F.col("doc").alias("doc_id")).distinct(), max_rows=SMALL_IDS), "doc_id", "left_semi").mapInArrow(
        _sketch_rows, "doc long, " + ", ".join(f"{c} long" for c in SKETCH)))
    both = both.join(sketches, "doc")
    other = both.select("key", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"), F.col("doc").alias("b"),
                        F.col("band").alias("_band"), *[F.col(c).alias(f"_{c}") for c in ("n", "label", "distance", *SKETCH)])
    differing = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"_{c}"))) for c in SKETCH), F.lit(0))
    # every pair of one band meets twice and counts where a is the smaller, a pair of two bands meets once
    pairs = both.withColumnRenamed("doc", "a").join(other, ["key", "band"]).filter(
        ((F.col("band") != F.col("_band")) | (F.col("a") < F.col("b"))) & (F.col("a") != F.col("b")) & (F.col("label") != F.col("_label"))
        & (4 * F.least("n", "_n") >= 3 * F.greatest("n", "_n"))
        & (F.abs(F.col("distance") - F.col("_distance")) < 0.25 + 1e-9)
        & (7 * differing <= F.col("n") + F.col("_n"))).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
