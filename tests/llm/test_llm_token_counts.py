"""Token counts against the libraries, and the cache between jobs."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shoreline.llm import token_counts as T
from shoreline.session import shared_folder

MODEL, BPE = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def library(path):
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor
        processor = SentencePieceProcessor(model_file=path)
        return lambda t: len(processor.encode(t))
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)


def compare(documents, rows, path, cache, limit=50):
    count = library(path)
    got = T.count_tokens(documents(rows), path, cache, limit).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (str(i), len((t or "").encode()), count(t or ""), count(t or "") > limit) for i, t in rows)


ODD = ["a▁b", "a b", " a b", "a  b", "</s> x <s>", "<|endoftext|>y", "\x00 \x01", "İ ŉ", "\U0001f600‍\U0001f525 z", "\t\n", "  "]


@pytest.mark.parametrize("path", [MODEL, BPE])
def test_messy_rows(spark, documents, messy_rows, path):
    rows = [r[:2] for r in messy_rows] + [(100 + i, t) for i, t in enumerate(ODD)] + [(200, ODD[0])] * 3
    compare(documents, rows, path, shared_folder(spark, "test-cache"))


def test_empty_table(spark, documents):
    assert T.count_tokens(documents([]), MODEL, shared_folder(spark, "test-cache")).collect() == []


def cached(spark, cache, path=MODEL):
    return spark.read.parquet(f"{cache}/tokenizer={T.tokenizer_digest(path)}")


def test_each_distinct_text_is_encoded_once_and_only_if_missing(spark, documents):
    cache = shared_folder(spark, "test-cache")
    first = [(i, f"text number {i % 7}") for i in range(40)] + [(90, "a▁b"), (91, "a b")]
    compare(documents, first, MODEL, cache)
    assert cached(spark, cache).count() == 8
    compare(documents, first + [(50, "a new one"), (51, "a new one"), (52, "another")], MODEL, cache)
    assert cached(spark, cache).count() == 10
    compare(documents, first, MODEL, cache)
    assert cached(spark, cache).count() == 10


def test_known_counts_are_taken_from_the_cache(spark, documents):
    cache = shared_folder(spark, "test-cache")
    compare(documents, [(1, "one two"), (2, "three")], MODEL, cache)
    path = f"{cache}/tokenizer={T.tokenizer_digest(MODEL)}"
    changed = shared_folder(spark, "test-cache")
    spark.read.parquet(path).withColumn("n_tokens", F.col("n_tokens") + 1000).write.parquet(f"{changed}/tokenizer={T.tokenizer_digest(MODEL)}")
    assert {r.n_tokens > 1000 for r in T.count_tokens(documents([(1, "one two"), (2, "three")]), MODEL, changed).collect()} == {True}


def test_tokenizers_do_not_share_counts(spark, documents):
    cache = shared_folder(spark, "test-cache")
    rows = [(1, "unbelievable words"), (2, "unbelievable words")]
    compare(documents, rows, MODEL, cache)
    compare(documents, rows, BPE, cache)


def test_two_jobs_that_appended_the_same_digest(spark, documents):
    cache = shared_folder(spark, "test-cache")
    compare(documents, [(1, "same")], MODEL, cache)
    cached(spark, cache).write.mode("append").parquet(f"{cache}/tokenizer={T.tokenizer_digest(MODEL)}")
    compare(documents, [(1, "same"), (2, "same")], MODEL, cache)


def test_a_crowded_map_moves_more_and_changes_nothing(spark, documents, monkeypatch):
    import numpy as np
    monkeypatch.setattr(T, "digest_bit", lambda digest="digest": F.shiftright(F.conv(F.hex(F.substring(F.col(digest), 1, 4)), 16, 10).cast("long"), 31))
    monkeypatch.setattr(T, "bitmap_of", lambda bits, size: np.full(1 << (size - 3), 255, np.uint8) if not bits.isEmpty() else np.zeros(1 << (size - 3), np.uint8))
    rows = [(i, f"w{i % 30} again") for i in range(60)] + [(100 + i, f"alone {i}") for i in range(20)]
    compare(documents, rows, MODEL, shared_folder(spark, "test-cache"))
