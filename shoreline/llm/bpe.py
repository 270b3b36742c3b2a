"""BPE encoding and decoding that encodes text shared between documents once.

A rolling hash over the bytes cuts every text into content-defined chunks, so equal passages
give equal chunks wherever they stand. Chunks that occur more than once are encoded once for
all documents; everything else is encoded where it is. Where encoded parts meet, the join is
encoded again, over more and more text, until both sides agree with it.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline.llm.base import Workspace, bitmap_of, in_bitmap
from shoreline.llm.shingles import byte_sums, mixed

#: Bytes of the rolling window; spaces between cuts on average; bits of the map of shared chunks.
WINDOW, SPACING, SHARED_BITS = 24, 64, 24
#: Encoded words and tested joins that a worker remembers, and texts whose words it holds at a time.
REMEMBERED_WORDS, REMEMBERED_JOINS, TEXTS_AT_ONCE = 500_000, 200_000, 128
#: Words that one call of the tokenizer encodes, apart by a special token.
WORDS_A_CALL = 1024


class Codec:
    """A tokenizer file with a memory of the words it has encoded.

    Words begin with the space before them. The file's pre-tokenizer must split at spaces, as
    is checked by ``joined`` wherever encoded parts meet. Many words are encoded in one call,
    with a special token between them that the library cuts out before anything else.
    """

    def __init__(self, path: str):
        # a task has one core; threads of the library would wait for each other on it
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.words: dict[str, bytes] = {}
        self.joins: dict[tuple[str, str], bool] = {}
        added = [(i, t) for i, t in sorted(self.tokenizer.get_added_tokens_decoder().items())
                 if not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.between = (added[0][0], added[0][1].content) if added else None

    def encode_words(self, words: set[str]) -> dict[str, bytes]:
        """Packed ids of the words that the memory has no room for; it then holds all others."""
        new = list(words.difference(self.words))
        found = dict(zip(new, self.encode_apart(new)))
        if len(self.words) + len(found) > REMEMBERED_WORDS:
            return found
        self.words.update(found)
        return {}

    def encode_apart(self, texts: list[str]) -> list[bytes]:
        """Packed ids of every text, each on its own, many in one call where a special token can part them."""
        if self.between is None or any(self.between[1] in t for t in texts):
            return self.encode_whole(texts)
        number, mark = self.between
        calls = [texts[i:i + WORDS_A_CALL] for i in range(0, len(texts), WORDS_A_CALL)]
        out: list[bytes] = []
        for packed in self.encode_whole([mark.join(c) for c in calls]):
            ends = np.flatnonzero(np.frombuffer(packed, self.dtype) == number) * self.dtype.itemsize
            out += [packed[a:b] for a, b in zip([0, *(ends + self.dtype.itemsize).tolist()], [*ends.tolist(), len(packed)])]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of every text, word by word; each distinct word is encoded once."""
        split = [split_words(t) for t in texts]
        new, known = self.encode_words(set().union(*split)), self.words
        if new:
            return [b"".join([new[w] if w in new else known[w] for w in words]) for words in split]
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def decode(self, packed: bytes) -> str:
        """As the tokenizer's decode with special tokens kept; without a decoder, tokens and spaces."""
        ids = np.frombuffer(packed, self.dtype).tolist()
        if self.tokenizer.decoder is None:
            return " ".join(map(self.tokens.__getitem__, ids))
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    def joined(self, parts: list[tuple[str, bytes | None]]) -> bytes:
        """Ids of consecutive parts of one text, of which some are encoded already.

        Unencoded neighbours are encoded as one. At each join the last word before and the
        first word after it are encoded together; if that differs from what the parts hold
        there, both parts are given up and encoded together, and the joins around are tested
        in turn, until all agree.
        """
        merged: list[list] = []
        for text, ids in parts:
            if ids is None and merged and merged[-1][1] is None:
                merged[-1][0] += text
            else:
                merged.append([text, ids])
        for part, ids in zip([p for p in merged if p[1] is None], self.encode([p[0] for p in merged if p[1] is None])):
            part[1] = ids
        edges = [(last_word(a[0]), first_word(b[0])) for a, b in zip(merged, merged[1:])]
        if not all(self.agree([edge for edge in edges if edge[0] and edge[1]])):
            self.repair(merged)
        return b"".join(ids for _, ids in merged)

    def agree(self, edges: list[tuple[str, str]]) -> list[bool]:
        """Whether two words have the same ids together as apart, for each pair."""
        new = [e for e in dict.fromkeys(edges) if e not in self.joins]
        found = {}
        if new:
            apart = self.encode_apart([w for edge in new for w in edge])
            together = self.encode_apart([a + b for a, b in new])
            found = {e: apart[2 * i] + apart[2 * i + 1] == together[i] for i, e in enumerate(new)}
            if len(self.joins) + len(found) <= REMEMBERED_JOINS:
                self.joins.update(found)
        return [self.joins[e] if e in self.joins else found[e] for e in edges]

    def encode_whole(self, texts: list[str]) -> list[bytes]:
        """Packed ids of every text, encoded in one piece."""
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def repair(self, merged: list[list]) -> None:
        """Join the parts that disagree, and test the joins around them in turn."""
        at = 1
        while at < len(merged):
            (left, _), (right, _) = merged[at - 1], merged[at]
            before, after = last_word(left), first_word(right)
            if before and after and not self.agree([(before, after)])[0]:
                merged[at - 1:at + 1] = [[left + right, self.encode_whole([left + right])[0]]]
                at = max(1, at - 1)
            else:
                at += 1


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker and file."""
    return Codec(path)


def split_words(text: str) -> list[str]:
    """The text cut before every space."""
    if "\0" in text:
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + w for w in rest]
    words = text.replace(" ", "\0 ").split("\0")
    return words if words[0] else words[1:]


def last_word(text: str) -> str:
    """What follows the last space, with it."""
    return text[max(text.rfind(" "), 0):]


def first_word(text: str) -> str:
    """What precedes the first space that does not begin the text."""
    end = text.find(" ", 1)
    return text if end < 0 else text[:end]


def chunk_ends(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of a text's content-defined chunks, in bytes, and a 64-bit hash of each chunk.

    A chunk ends before a space where the hash of the bytes before it says so.
    """
    sums, inverse = byte_sums(data)
    spaces = np.flatnonzero(data[WINDOW:] == 32) + WINDOW
    rolling = mixed((sums[spaces] - sums[spaces - WINDOW]) * inverse[spaces - WINDOW])
    ends = np.append(spaces[rolling % np.uint64(SPACING) == 0], len(data)) if len(data) else np.empty(0, np.int64)
    starts = np.zeros(len(ends), np.int64)
    starts[1:] = ends[:-1]
    return ends, mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            yield batch.slice(at, TEXTS_AT_ONCE)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8")


def _chunk_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [chunk_ends(np.frombuffer(_bytes(t.as_py()), np.uint8))[1] for t in batch.column(1)]
        yield pa.record_batch([pa.array(np.concatenate(found).view(np.int64) if found else [], pa.int64())], ["hash"])


def shared_chunks(given: DataFrame) -> np.ndarray:
    """Bitmap of fixed size with the bits of chunks that occur more than once in the corpus.

    It decides only what is encoded apart; a fuller map at a larger corpus changes no result.
    """
    again = given.mapInArrow(_chunk_hashes, "hash long").groupBy("hash").count().filter("count > 1")
    return bitmap_of(again.select(F.shiftrightunsigned("hash", 64 - SHARED_BITS).alias("bit")), SHARED_BITS)


def _marked(data: bytes, shared: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Spans of a text's chunks and which of them are marked as shared."""
    ends, hashes = chunk_ends(np.frombuffer(data, np.uint8))
    return list(zip([0, *ends[:-1].tolist()], ends.tolist())), in_bitmap(shared, (hashes >> np.uint64(64 - SHARED_BITS)).astype(np.int64))


_DIGESTS = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]


def _digests(coder: Codec, packed: bytes) -> tuple[int, str, str]:
    ids = np.frombuffer(packed, coder.dtype)
    return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
            hashlib.sha256(coder.decode(packed).encode("utf-8")).hexdigest())


_FIRST = pa.schema([("doc_id", pa.int64()), ("text_key", pa.binary()), *_DIGESTS, ("place", pa.int32()), ("chunk_key", pa.binary()), ("chunk", pa.string())])


def _encode_alone(path: str, shared: np.ndarray):
    """Three kinds of rows. Documents without shared chunks: their digests. Other documents:
    the key of their text. Shared chunks: key of the text they stand in, place and key, and
    once per task the chunk itself."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, texts_seen, chunks_seen = codec(path), set(), set()
        for batch in _parts(batches):
            out: list[tuple] = []
            alone: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = _bytes(text.as_py())
                spans, marked = _marked(data, shared)
                if not marked.any():
                    alone.append((doc, data.decode("utf-8")))
                    continue
                key = hashlib.blake2b(data, digest_size=16).digest()
                out.append((doc, key, None, None, None, None, None, None))
                if key in texts_seen:
                    continue
                texts_seen.add(key)
                for place in np.flatnonzero(marked).tolist():
                    chunk = data[slice(*spans[place])]
                    chunk_key = hashlib.blake2b(chunk, digest_size=16).digest()
                    new = chunk_key not in chunks_seen
                    chunks_seen.add(chunk_key)
                    out.append((None, key, None, None, None, place, chunk_key, chunk.decode("utf-8") if new else None))
            for (doc, _), packed in zip(alone, coder.encode([t for _, t in alone])):
                out.append((doc, None, *_digests(coder, packed), None, None, None))
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _FIRST)], schema=_FIRST)
    return rows


def _shared_texts(shared: np.ndarray):
    """Texts with shared chunks and the ends of all their chunks, once per task."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            keys, texts, ends = [], [], []
            for text in batch.column(1):
                data = _bytes(text.as_py())
                spans, marked = _marked(data, shared)
                if marked.any() and (key := hashlib.blake2b(data, digest_size=16).digest()) not in seen:
                    seen.add(key)
                    keys.append(key)
                    texts.append(data.decode("utf-8"))
                    ends.append([end for _, end in spans])
            yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(texts, pa.string()), pa.array(ends, pa.list_(pa.int32()))], ["text_key", "text", "ends"])
    return rows


def _encode_chunks(path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            yield pa.record_batch([batch.column(0), pa.array(codec(path).encode(batch.column(1).to_pylist()), pa.binary())], ["chunk_key", "ids"])
    return rows


_JOINED = pa.schema([("text_key", pa.binary()), *_DIGESTS])


def _assemble(path: str):
    """Digests of texts (key, text, ends of its chunks, encoded chunks by place)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in _parts(batches):
            out = []
            for key, text, cuts, chunks in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3)):
                data, ends = _bytes(text.as_py()), cuts.as_py()
                ids = {c["place"]: c["ids"] for c in chunks.as_py()}
                parts = [(data[a:b].decode("utf-8"), ids.get(i)) for i, (a, b) in enumerate(zip([0, *ends[:-1]], ends))]
                out.append((key, *_digests(coder, coder.joined(parts))))
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _JOINED)], schema=_JOINED)
    return rows


def encode_documents(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document row.

    The ids are those of the tokenizer in ``path`` without added special tokens; strings of
    special tokens inside a text become their ids, as the library does. The decoded text is
    the library's decode of the ids with special tokens kept. ``path`` must exist on every
    worker.

    Takes doc_id and text; other columns are ignored. Null texts are empty and have no
    tokens. Every row gives one row; equal texts, null and repeated ids are allowed. An empty
    table gives an empty one.

    Texts without shared chunks never move. The others move once per task that met them, with
    the ids of their shared chunks, and equal ones are put together once; a chunk moves once per
    task that met it, to be encoded. Tasks hold one batch of texts and the keys of the chunks
    of their own input. What comes back to the rows is stored, so that a text of many rows
    meets them in a join whose large parts Spark can split.
    """
    work = Workspace(documents.sparkSession, "bpe")
    given = documents.select("doc_id", "text")
    shared = shared_chunks(given)
    digests = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    first = work.put("first", given.mapInArrow(_encode_alone(path, shared), f"doc_id long, text_key binary, {digests}, place int, chunk_key binary, chunk string"))
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    alone = first.filter("text_key IS NULL").select(*columns)
    chunks = first.filter("chunk IS NOT NULL").groupBy("chunk_key").agg(F.min("chunk").alias("chunk"))
    encoded = work.put("chunks", chunks.mapInArrow(_encode_chunks(path), "chunk_key binary, ids binary"))
    places = first.filter("chunk_key IS NOT NULL").select("text_key", "place", "chunk_key").distinct()
    gathered = places.join(encoded, "chunk_key").groupBy("text_key").agg(F.collect_list(F.struct("place", "ids")).alias("chunks"))
    texts = given.mapInArrow(_shared_texts(shared), "text_key binary, text string, ends array<int>").groupBy("text_key").agg(
        F.first("text").alias("text"), F.first("ends").alias("ends"))
    results = work.put("joined", texts.join(gathered, "text_key").select("text_key", "text", "ends", "chunks").mapInArrow(_assemble(path), f"text_key binary, {digests}"))
    work.drop("chunks")
    rest = first.filter("text_key IS NOT NULL AND place IS NULL").select("doc_id", "text_key").join(results, "text_key").select(*columns)
    return alone.unionByName(rest)
