"""Token counts through a cache keyed by digests of content and tokenizer version.

Counts are looked up by the digest of the normalised text and the digest of the tokenizer.
Only texts that the cache does not hold are encoded, each once however many rows repeat it,
and their counts are appended to the cache for the next job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from importlib.metadata import version

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.llm.base import Workspace, bitmap_of, in_bitmap, text_or_empty

#: Bits of the map of digests that must not be encoded where they stand.
MAP_BITS = 24
#: Characters of text that are encoded in one call.
CHARS_AT_ONCE = 1 << 22
#: The character that sentencepiece models hold spaces as.
SPACE_PIECE = "▁"


@lru_cache(maxsize=2)
def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts of tokens of texts, by the library that the file is for; one per worker and file."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor
        processor = SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def tokenizer_digest(path: str) -> str:
    """Digest of the tokenizer file and of the library that reads it, so that a new version of either misses."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + f"\n{library} {version(library)}".encode()).hexdigest()[:32]


def normal_text(path: str) -> Column:
    """The text in the form that decides its count: null is empty, and sentencepiece takes its mark for a space."""
    return F.replace(text_or_empty(), F.lit(SPACE_PIECE), F.lit(" ")) if path.endswith(".model") else text_or_empty()


def content_digest(path: str) -> Column:
    return F.unhex(F.sha2(normal_text(path), 256))


def read_cache(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """digest and n_tokens known for a tokenizer. Two jobs may have appended the same digest; it counts once."""
    try:
        known = spark.read.schema("digest binary, n_tokens long").parquet(f"{cache}/tokenizer={tokenizer}")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        known = spark.createDataFrame([], "digest binary, n_tokens long")
    return known.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def _bits(digests: pa.Array) -> np.ndarray:
    """The first MAP_BITS bits of every digest."""
    rows = np.frombuffer(b"".join(digests.to_pylist()), np.uint8).reshape(len(digests), -1)[:, :4].astype(np.int64)
    return (rows @ np.array([1 << 24, 1 << 16, 1 << 8, 1])) >> (32 - MAP_BITS)


def digest_bit(digest: str = "digest") -> Column:
    """The same bits of a digest, in SQL."""
    return F.shiftright(F.conv(F.hex(F.substring(F.col(digest), 1, 4)), 16, 10).cast("long"), 32 - MAP_BITS)


_COUNTED = pa.schema([("digest", pa.binary()), ("n_tokens", pa.int64())])


def _counted(path: str, digests: list[bytes], texts: pa.Array) -> Iterator[pa.RecordBatch]:
    """Counts of texts, some megabytes at a time."""
    at, count = 0, counter(path)
    while at < len(digests):
        held, size = [], 0
        while at + len(held) < len(digests) and size < CHARS_AT_ONCE:
            held.append(texts[at + len(held)].as_py())
            size += len(held[-1])
        yield pa.record_batch([pa.array(digests[at:at + len(held)], pa.binary()), pa.array(count(held), pa.int64())], schema=_COUNTED)
        at += len(held)


def _count_in_place(path: str, elsewhere: np.ndarray):
    """Counts of the texts whose digest's bit is not set: they are missing from the cache and occur once."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = batch.filter(pa.array(~in_bitmap(elsewhere, _bits(batch.column(0)))))
                yield from _counted(path, own.column(0).to_pylist(), own.column(1))
    return rows


def _texts_marked(marked: np.ndarray):
    """Digest and text of the rows whose bit is set, once per task and digest."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            if batch.num_rows:
                new = in_bitmap(marked, _bits(batch.column(0)))
                for i in np.flatnonzero(new):
                    digest = batch.column(0)[int(i)].as_py()
                    new[i] = digest not in seen
                    seen.add(digest)
                yield batch.filter(pa.array(new))
    return rows


def _count_all(path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _counted(path, batch.column(0).to_pylist(), batch.column(1))
    return rows


def fill_cache(documents: DataFrame, path: str, cache: str) -> DataFrame:
    """Encode what the cache lacks, append it, and return digest and n_tokens of all texts in the input.

    Digests are counted first. Each text then has one line: it was known, occurs once, or was gathered. A text that is missing and occurs once is encoded where it
    stands; a bitmap of fixed size tells tasks which digests are known or repeat. Repeated
    missing texts, and the few that share a bit with a marked one, move once per task that met
    them and are encoded once. A fuller bitmap at a larger corpus moves more texts and changes
    no count.
    """
    spark, tokenizer = documents.sparkSession, tokenizer_digest(path)
    work, new = Workspace(spark, "token-counts"), []
    keyed = documents.select(content_digest(path).alias("digest"), text_or_empty().alias("text"))
    known = work.put("known", read_cache(spark, cache, tokenizer))
    seen = work.put("seen", keyed.groupBy("digest").agg(F.count("*").alias("rows")).join(known, "digest", "left"))
    marked = seen.filter("n_tokens IS NOT NULL OR rows > 1").select(digest_bit().alias("bit"))
    elsewhere = bitmap_of(marked, MAP_BITS)
    held_back = seen.filter("n_tokens IS NULL").withColumn("bit", digest_bit()).join(marked.distinct(), "bit", "left_semi").select("digest", "bit")
    parts = [keyed.mapInArrow(_count_in_place(path, elsewhere), "digest binary, n_tokens long")]
    moving = bitmap_of(held_back, MAP_BITS)
    if moving.any():
        texts = keyed.mapInArrow(_texts_marked(moving), "digest binary, text string").groupBy("digest").agg(F.min("text").alias("text"))
        wanted = texts.join(held_back.select("digest"), "digest", "left_semi").select("digest", "text")
        parts.append(wanted.mapInArrow(_count_all(path), "digest binary, n_tokens long"))
    for i, part in enumerate(parts):
        new.append(work.put(f"new-{i}", part))
        new[-1].write.mode("append").parquet(f"{cache}/tokenizer={tokenizer}")
    counts = seen.filter("n_tokens IS NOT NULL").select("digest", "n_tokens")
    for part in new:
        counts = counts.unionByName(part)
    return counts


def count_tokens(documents: DataFrame, path: str, cache: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document row.

    Takes doc_id and text; other columns are ignored. Null texts are empty and have no tokens.
    Every row gives one row: equal texts, null ids and repeated rows are allowed. Whole texts
    are counted, without begin, end or added special tokens. An empty table gives an empty one.

    ``path`` is a tokenizers (.json) or sentencepiece (.model) file that exists on every
    worker. ``cache`` is a folder all executors share; each job adds to it in one commit and
    never changes what is there, so jobs may share it and a job that dies leaves it whole.
    Counts come back to the rows by a join on the digest whose skewed parts Spark can split.
    """
    counts = fill_cache(documents, path, cache)
    rows = documents.select("doc_id", F.octet_length(text_or_empty()).cast("long").alias("n_bytes"), content_digest(path).alias("digest"))
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
