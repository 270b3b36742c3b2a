"""Collocations against counting by hand."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shoreline.llm import collocations as C
from shoreline.llm.base import Workspace


def expected(rows, top=2000):
    f, n = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for width in range(1, 5):
                for i in range(len(words) - width + 1):
                    key = (lang, tuple(words[i:i + width]))
                    f[key] = f.get(key, 0) + 1
    out = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < 30:
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = f[lang, p[:k]], f[lang, p[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        out[lang, p] = (a, left, right, score)
    kept = dict(out)
    for (lang, p), (a, *_) in out.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                inner = (lang, p[i:i + size])
                if inner in kept and 100 * a >= 80 * out[inner][0]:
                    del kept[inner]
    rows = []
    for lang in n:
        own = sorted((-s, -a, " ".join(p).encode(), a, left, right) for (x, p), (a, left, right, s) in kept.items() if x == lang)
        rows += [(lang, i + 1, p.decode(), a, left, right, n[lang], -s) for i, (s, _, p, a, left, right) in enumerate(own[:top])]
    return sorted(rows)


def corpus():
    rows = []
    for i in range(90):
        words = [f"W{(i * 7 + j * j) % 9}" for j in range(60)]
        text = " ".join(words[:20]) + f". New york city council {i}, " + "\t".join(words[20:40]) + ";new YORK city! " + " ".join(words[40:])
        rows.append((i, text, ["en", "de", None][i % 3]))
    rows += [(100, None, "en"), (101, "", "fr"), (102, " .,; ", "und"), (103, "a b\x01c a b c \x00 d " * 40, "und"),
             (104, "x x x x x x " * 40, "en"), (105, "É É Z z " * 45, "und")]
    rows += [rows[0]] * 3
    return rows


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_equals_brute_force(documents):
    rows = corpus()
    assert got(C.collocations(documents([(*r, "s") for r in rows]))) == expected(rows)


@pytest.mark.parametrize("budget", [1, 3, 40])
def test_small_budgets_extend_prefixes_and_change_nothing(documents, budget):
    rows = corpus()
    assert got(C.collocations(documents([(*r, "s") for r in rows]), budget=budget)) == expected(rows)


def test_top_is_per_language(documents):
    rows = corpus()
    assert got(C.collocations(documents([(*r, "s") for r in rows]), top=3)) == expected(rows, 3)


def test_nothing_from_nothing(documents):
    assert C.collocations(documents([])).collect() == []
    assert C.collocations(documents([(1, None), (2, "too rare to count")])).collect() == []


def test_held_bytes_change_nothing(documents, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(C, "HELD_BYTES", 500)
    assert got(C.collocations(documents([(*r, "s") for r in rows]))) == expected(rows)


def test_heavy_prefixes_are_extended_and_groups_stay_within_twice_the_budget(spark):
    leaves = spark.createDataFrame([("en", f"a{i % 3} b{i % 40} c{i} d", 1) for i in range(600)], "lang string, phrase string, n long")
    parted = C.vertical_partition(leaves, Workspace(spark, "test-groups"), 50)
    assert parted.filter("depth > 1").count() == 600
    assert max(r["count"] for r in parted.groupBy("prefix").count().collect()) <= 50
    groups = list(C.packed_groups(parted.orderBy("lang", "prefix").toArrow().to_batches(max_chunksize=70), 50))
    assert sum(len(g) for g in groups) == 600 and max(len(g) for g in groups) < 100
    assert sum(len(set(g["prefix"].to_pylist())) for g in groups) == parted.select("prefix").distinct().count()


def test_equal_suffixes_alone_may_pass_the_budget():
    import pyarrow as pa
    rows = pa.record_batch([["en"] * 30, ["a"] * 3 + ["b"] * 25 + ["c"] * 2], ["lang", "prefix"])
    assert [len(g) for g in C.packed_groups([rows], 4)] == [3, 25, 2]


def test_bits_agree_between_tasks_and_sql(spark):
    import zlib

    import numpy as np
    words = ["a", "é", "x\x00y", "long" * 50]
    rows = spark.createDataFrame([("de", a, b) for a in words for b in words], "lang string, a string, b string")
    lang = zlib.crc32(b"de")
    for r in rows.withColumn("one", C.word_bit(F.col("a"))).withColumn("two", C.pair_bit(F.col("a"), F.col("b"))).collect():
        first, second = (np.array([zlib.crc32(x.encode())]) for x in (r.a, r.b))
        assert C._word_bits(first, lang)[0] == r.one and C._pair_bits(first, second, lang)[0] == r.two
