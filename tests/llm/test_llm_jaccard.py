"""The similarity join against comparing every pair."""

import random
import re

import numpy as np
import pytest

from shoreline.llm import jaccard
from shoreline.llm.base import Workspace
from shoreline.llm.shingles import run_starts, shingle_set


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = {}
    for doc, text in rows:
        if doc is not None:
            sets.setdefault(doc, []).append(plain_set(text))
    group = {d: d for d in sets}

    def top(d):
        while group[d] != d:
            d = group[d]
        return d
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((top(a), top(b)))
                group[high] = low
    return {d: top(d) for d in ids}


def check(documents, rows):
    got = jaccard.linked_groups(documents(rows)).collect()
    assert len(got) == len(rows)
    expected = brute([r[:2] for r in rows])
    for r in got:
        assert r.component_id == (None if r.doc_id is None else expected[r.doc_id]), r
    assert sorted(r.n_shingles for r in got) == sorted(len(plain_set(r[1])) for r in rows)


def test_messy_rows(documents, messy_rows):
    check(documents, messy_rows)


def test_empty_table(documents):
    assert jaccard.linked_groups(documents([])).collect() == []


def test_random_families_against_all_pairs(documents):
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    rows, number = [], 0
    for family in range(12):
        size = rng.choice([3, 6, 9, 14, 30, 60, 150, 320])
        base = [f"f{family}x{rng.randrange(80)}" for _ in range(size)] + (passage if family % 2 else [])
        for _ in range(6):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + size // 12)):
                at = rng.randrange(len(words))
                words[at:at + rng.randrange(2)] = [f"e{rng.randrange(1000)}"]
            rows.append((number, " ".join(words)))
            number += 1
    check(documents, rows)


@pytest.mark.parametrize("common", [None, np.full(1 << 21, 255, np.uint8), np.random.default_rng(1).integers(0, 256, 1 << 21).astype(np.uint8)])
def test_linked_sets_share_an_index_key(common):
    rng = random.Random(5)
    for _ in range(1500):
        size = rng.choice([1, 2, 3, 4, 5, 7, 10, 20, 50, 65, 120, 300])
        left = {rng.getrandbits(64) for _ in range(size)}
        right = set(left)
        for _ in range(rng.randrange(0, size // 3 + 1)):
            if rng.random() < 0.5 and right:
                right.discard(rng.choice(sorted(right)))
            else:
                right.add(rng.getrandbits(64))
        if right and 100 * len(left & right) >= 75 * len(left | right):
            a, b = (np.unique(np.array(sorted(s), np.uint64)) for s in (left, right))
            assert np.intersect1d(jaccard.segment_keys(a, common), jaccard.segment_keys(b, common)).size


def test_long_text_is_hashed_like_its_blocks():
    words = " ".join(f"x{i % 50000}" for i in range(70_000))
    assert len(shingle_set(words)) == len(plain_set(words))


def test_chains_of_links_reach_their_smallest_member(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(1, 200)] + [(500, 501)], "a long, b long")
    got = {r.node: r.label for r in jaccard.smallest_reachable(chain).collect()}
    assert got == {**{i: 1 for i in range(1, 201)}, 500: 500, 501: 500}


def test_keys_with_repeated_members_are_told_apart(spark):
    center, x, y, z = 1, 2, 3, 4
    index = spark.createDataFrame([(key, center, d, 20) for key, docs in ((10, (center, x, x, y)), (20, (center, z, z, y))) for d in docs],
                                  "key long, center long, doc long, n int")
    labels = spark.createDataFrame([(d, d) for d in (center, x, y, z)], "node long, label long")
    tested = spark.createDataFrame([(center, d, 0.3) for d in (x, y, z)], "a long, b long, distance double")
    texts = spark.createDataFrame([(d, " ".join(f"w{i}" for i in range(24))) for d in (center, x, y, z)], "doc_id long, text string")
    copies = spark.createDataFrame([], "a long, b long")
    got = jaccard.remaining_pairs(index, labels, tested, copies, texts, Workspace(spark, "test-pairs")).collect()
    assert sorted((r.a, r.b) for r in got) == [(x, y), (y, z)]


@pytest.mark.parametrize("held", [1, 3, 1 << 16])
def test_runs_show_each_member_set_once(monkeypatch, held):
    import pyarrow as pa
    monkeypatch.setattr(jaccard, "HELD_MEMBERS", held)
    rng = random.Random(held)
    members = {key: sorted(rng.sample(range(9), rng.randrange(1, 7))) for key in range(60)}
    rows = sorted([(key, d, 0, 20) for key, docs in members.items() for d in docs + docs[:1]] + [(5, d, 77, 20) for d in (3, 4)], key=lambda r: (r[0], r[2], r[1]))
    for size in (1, 4, 1000):
        batches = [pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows[i:i + size]), (pa.int64(), pa.int64(), pa.int64(), pa.int32()))], ["key", "doc", "tag", "n"])
                   for i in range(0, len(rows), size)]
        got = [r for b in jaccard._shared_runs(iter(batches)) for r in b.to_pylist()]
        groups = {}
        for r in got:
            if r["key"] is not None:
                groups.setdefault(r["key"], set()).add((r["center"], r["doc"]))
        shown = {frozenset(d for _, d in g) for g in groups.values()}
        assert {frozenset(m) for m in members.values() if len(m) > 1} <= shown
        assert all({c for c, _ in g} == {min(d for _, d in g)} for g in groups.values())
        if held > 10:
            assert len(groups) == len(shown)
        assert sorted((r["center"], r["doc"]) for r in got if r["key"] is None) == [(3, 3), (3, 4)]


def test_pairs_of_a_busy_document_are_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRS_A_TASK", 3)
    base = [f"w{i}" for i in range(30)]
    texts = {i: " ".join(base if i % 2 else base[:10] + [f"x{i}"] + base[10:]) for i in range(40)}
    given = spark.createDataFrame(list(texts.items()) + [(0, "other words here in this one")], "doc_id long, text string")
    pairs = spark.createDataFrame([(0, i) for i in range(1, 40)], "a long, b long")
    got = {}
    for r in jaccard.verify(pairs, given).collect():
        got.setdefault(r.b, []).append((r.linked, round(r.distance, 9)))

    def test_of(x, y):
        both, either = len(plain_set(x) & plain_set(y)), len(plain_set(x) | plain_set(y))
        return 100 * both >= 75 * either, round(1 - both / either, 9)
    assert {b: sorted(t) for b, t in got.items()} == {b: sorted([test_of(texts[0], texts[b]), test_of("other words here in this one", texts[b])]) for b in range(1, 40)}


def test_one_key_with_many_unlinked_members(documents):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"own{i}x{j}" for j in range(30 + i % 9))) for i in range(300)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(40)]
    got = {r.doc_id: r.component_id for r in jaccard.linked_groups(documents(rows)).collect()}
    assert got == {**{i: i for i in range(300)}, **{1000 + i: i for i in range(40)}}


def test_run_starts_mark_every_first_value():
    assert run_starts(np.array([3, 3, 5, 5, 3], np.uint64)).tolist() == [True, False, True, False, True]
    assert run_starts(np.empty(0, np.uint64)).tolist() == []


def test_sets_are_sorted_without_repeats_across_blocks(monkeypatch):
    text = " ".join(f"w{i % 17}" for i in range(200)) + "\t\n x  y"
    whole = shingle_set(text)
    assert len(whole) == len(plain_set(text)) and (whole[1:] > whole[:-1]).all()
    monkeypatch.setattr("shoreline.llm.shingles._BLOCK_WORDS", 7)
    assert shingle_set(text).tolist() == whole.tolist()
