"""Encoding and decoding against the library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shoreline.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def compare(documents, rows, path=PATH):
    tokenizer = Tokenizer.from_file(path)
    got = bpe.encode_documents(documents(rows), path).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(
        (str(r[0]), *expected(tokenizer, r[1])) for r in rows)


def test_messy_rows(documents, messy_rows):
    compare(documents, messy_rows)


def test_empty_table(documents):
    assert bpe.encode_documents(documents([]), PATH).collect() == []


def test_unusual_texts(documents):
    odd = ["a<|endoftext|>b <|endoftext|> c", "é e ́x", "   x\u0085y", "'s it's   DON'T", "ΣΣ İ", "<|startoftext|>",
           "1234 \U0001f600‍\U0001f525", "\x00\x01 ﻿", "a\r\n\r\nb", "  lead and trail  "]
    rows = [(i, t) for i, t in enumerate(odd)] + [(100 + i, " ".join(odd) * 40 + t) for i, t in enumerate(odd)]
    compare(documents, rows)


def test_shared_passages_are_reused(documents, spark):
    passage = " ".join(f"word{i % 97} Thing{i % 89}" for i in range(800))
    rows = [(i, f"own{i} start " + passage + f" tail{i} " + passage) for i in range(20)]
    shared = bpe.shared_chunks(documents(rows).select("doc_id", "text"))
    assert shared.any()
    compare(documents, rows)


@pytest.mark.parametrize("cut", [1, 5, 9, 13, 17])
def test_joins_are_repaired(cut):
    coder = bpe.Codec(PATH)
    text = "unbelievable transformations everywhere again"
    parts = [(text[:cut], coder.encode([text[:cut]])[0]), (text[cut:], coder.encode([text[cut:]])[0])]
    assert np.frombuffer(coder.joined(parts), coder.dtype).tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_are_cut_before_spaces_with_and_without_zero_characters():
    for text in ("", " ", "a", " a", "a b", "a  b ", "\0", "a\0 b", " \0 a"):
        words = bpe.split_words(text)
        assert "".join(words) == text and all(words) and all(" " not in w[1:] for w in words)


def test_a_full_memory_of_words_changes_no_ids(monkeypatch):
    texts = ["one two three", "two four", "", "one  six \0 seven", "four one"]
    want = bpe.Codec(PATH).encode_whole(texts)
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 3)
    coder = bpe.Codec(PATH)
    assert [coder.encode([t])[0] for t in texts] == want and coder.encode(texts) == want
    assert len(coder.words) <= 3


def test_the_library_starts_no_threads_of_its_own(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    bpe.Codec(PATH)
    assert bpe.os.environ["TOKENIZERS_PARALLELISM"] == "false"
