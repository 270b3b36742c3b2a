"""Learned operators, mixing, search, archives and the pipeline on small tables."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shoreline.llm import mixing, quality, topk, toxicity, warc
from shoreline.llm.base import table
from shoreline.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int, score double"


def prose(rng, n=80):
    return " ".join(rng.choice(["the", "of", "and", "house", "garden", "tree", "water", "stone", "light"]) + rng.choice(["", "s", "."]) for _ in range(n))


def corpus(seed=1, n=240):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad, toxic = i % 6 == 0, i % 5 == 0
        words = prose(rng).split()
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["vilething", "meanie", "nasty"]))
        text = " ".join(w.upper() + "$$$ ***" for w in words) if bad else " ".join(words)
        rows.append((i, text, "en" if i % 3 else "fr", f"s{i % 4}"))
        if i % 2 == 0:
            labels.append((i, int(not bad), int(toxic), 1.0))
    return rows, labels


def test_co_training_separates_and_keeps_every_row(spark, documents, messy_rows):
    rows, labels = corpus()
    given = spark.createDataFrame(labels + [(0, 0, 1, 1.0), (None, 1, 0, 1.0), (1, 7, 7, 1.0), (3, None, None, 1.0)], LABELS)
    got = quality.classify(documents(rows + messy_rows), given, [F.col("doc_id")]).collect()
    assert len(got) == len(rows) + len(messy_rows) and all(0 <= r.score <= 1 for r in got)
    kept = {r.doc_id: r.kept for r in got if r.doc_id is not None and r.doc_id > 20}
    unlabelled = [i for i, *_ in rows if i % 2 and i > 20]
    assert np.mean([kept[i] == (i % 6 != 0) for i in unlabelled]) > 0.95


def test_co_training_without_labels_keeps_everything(spark, documents):
    rows, _ = corpus(n=10)
    got = quality.classify(documents(rows), spark.createDataFrame([], LABELS), [F.col("doc_id")]).collect()
    assert [r.score for r in got] == [0.5] * 10 and all(r.kept for r in got)
    assert quality.classify(documents([]), spark.createDataFrame([], LABELS), [F.col("doc_id")]).collect() == []


def test_toxicity_on_held_out_rows(spark, documents, messy_rows):
    rows, labels = corpus(n=600)
    given = spark.createDataFrame([(i, 1, int(i % 5 == 0), 1.0) for i in range(600)] + [(None, 1, 1, 1.0), (2, 1, 9, 1.0)], LABELS)
    got = toxicity.score_toxicity(documents(rows + [(5000 + i, t) for i, (_, t, *_) in enumerate(messy_rows)]), given).collect()
    assert len(got) == 600 + len(messy_rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(r.held_out for r in held) and len(held) > 100
    assert np.mean([r.predicted == int(r.doc_id % 5 == 0) for r in held]) > 0.97
    text = dict((r[0], r[1]) for r in rows)
    found = {text[r.doc_id].lower()[s.start:s.end] for r in held for s in r.spans}
    assert found & {"vilething", "meanie", "nasty"}


def test_labels_of_held_out_rows_are_not_learnt(spark, documents):
    rows, _ = corpus(n=200)
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    clean = [(i, 1, int(i % 5 == 0), 1.0) for i in range(200)]
    wrong = [(i, 1, 1 - t if i in held else t, 1.0) for i, _, t, _ in clean]
    scores = [{r.doc_id: r.score for r in toxicity.score_toxicity(documents(rows), spark.createDataFrame(x, LABELS)).collect()} for x in (clean, wrong)]
    assert scores[0] == scores[1]


def test_toxicity_without_labels_or_rows(spark, documents):
    none = spark.createDataFrame([], LABELS)
    assert len({r.score for r in toxicity.score_toxicity(documents([(1, "a"), (2, None)]), none).collect()}) == 1
    assert toxicity.score_toxicity(documents([]), none).collect() == []


def test_marginals_against_all_paths():
    rng = np.random.default_rng(2)
    transitions = rng.normal(size=(2, 2))
    lengths = np.array([5, 4, 4, 1])
    emissions = rng.normal(size=(4, 5)) * 2
    got = toxicity.marginals(emissions, lengths, transitions)
    for i, n in enumerate(lengths):
        total, ones = 0.0, np.zeros(n)
        for path in itertools.product((0, 1), repeat=int(n)):
            weight = math.exp(sum(emissions[i, t] * s for t, s in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:])))
            total += weight
            ones += weight * np.array(path)
        assert np.allclose(got[i, :n], ones / total)


def test_raking_meets_targets_against_plain_python(spark):
    cells = [("a", "en", "p", 100), ("a", "fr", "p", 20), ("b", "en", "p", 50), ("b", "fr", "q", 30), ("c", "en", "q", 5), ("c", "fr", "p", 0)]
    table_ = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    goal = {"source": {"a": 1.0, "b": 2.0, "c": 0.5, "zz": 9.0}, "lang": {"en": 1.0, "fr": 1.0}, "topic": {"p": 3.0, "q": 1.5}}
    targets = {m: spark.createDataFrame(list(g.items()), f"{m} string, share double") for m, g in goal.items()}
    got = {(r.source, r.lang, r.topic): r.weight for r in mixing.rake(table_, targets, rounds=4, tolerance=0).collect()}
    weight = {c[:3]: float(c[3]) for c in cells}
    for _ in range(4):
        for at, m in enumerate(("source", "lang", "topic")):
            live = {c[at] for c in cells if c[3] > 0}
            whole = sum(v for k, v in goal[m].items() if k in live)
            everything = sum(weight.values())
            sums = {v: sum(w for k, w in weight.items() if k[at] == v) for v in live}
            weight = {k: w * goal[m][k[at]] / whole * everything / sums[k[at]] if sums.get(k[at]) else w for k, w in weight.items()}
    assert all(abs(got[k] - w) < 1e-6 for k, w in weight.items())


def test_raking_of_few_and_of_many_cells_is_the_same_in_few_jobs(spark, monkeypatch):
    cells = [(f"s{i % 7}", ("en", "fr", None)[i % 3], "pq"[i % 2], 10 * (i * i % 17)) for i in range(42)]
    table_ = spark.createDataFrame(cells, CELLS)
    context = spark.sparkContext

    def raked():
        targets = {m: mixing.tempered(table_, m, 0.5) for m in mixing.MARGINS}
        context.setJobGroup(name := f"raking-{mixing.CELLS_A_TASK}", name)
        got = {tuple(r)[:4]: r.weight for r in mixing.rake(table_, targets, rounds=4, tolerance=0).collect()}
        context.setLocalProperty("spark.jobGroup.id", None)
        return got, len(context.statusTracker().getJobIdsForGroup(name))

    few, jobs = raked()
    monkeypatch.setattr(mixing, "CELLS_A_TASK", 0)
    many, _ = raked()
    assert len(few) == 28 and few == pytest.approx(many, rel=1e-9)
    assert jobs <= 40


@pytest.mark.parametrize("lang", ["en", "zz"])
def test_sampling_rates_meet_targets_of_a_rare_cell(spark, lang):
    rng = random.Random(8)
    cells = [(f"s{i}", l, t, (333_300 if i == 0 else 37_030) * (3 if l == "en" else 1) * (4 if t == "p" else 1) // 20)
             for i in range(19) for l in ("en", "fr") for t in ("p", "q")]
    cells += [("rare", lang, "p", 100), ("s0", "zz", "p", 400), ("s1", "zz", "q", 300)]
    rng.shuffle(cells)
    rated = mixing.sampling_rates(spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")).collect()
    assert len(rated) == len(cells) and max(r.probability for r in rated) == 1
    kept = sum(r.tokens * r.probability for r in rated)
    for margin, exponent in mixing.TEMPERATURES.items():
        values = {r[margin] for r in rated}
        present = {v: sum(r.tokens for r in rated if r[margin] == v) ** exponent for v in values}
        for v in values:
            share = sum(r.tokens * r.probability for r in rated if r[margin] == v) / kept
            assert share == pytest.approx(present[v] / sum(present.values()), rel=2e-3), (margin, v)


def test_mixing_keeps_rows_and_selects_alike(documents, messy_rows):
    rows = [(i, f"word{i} " * (5 + i % 7), "en" if i % 4 else "fr", f"s{0 if i % 3 else i % 5}") for i in range(400)] + messy_rows
    got = mixing.mix(documents(rows), [F.col("doc_id"), F.col("topic")]).collect()
    assert len(got) == len(rows) and all(0 < r._mix_probability <= 1 for r in got)
    expected = sum(r._mix_probability for r in got)
    assert abs(sum(r._mix_selected for r in got) - expected) < 5 * math.sqrt(expected)
    again = mixing.mix(documents(rows), [F.col("doc_id")]).collect()
    assert sorted((str(r.doc_id), r._mix_selected) for r in got) == sorted((str(r.doc_id), r._mix_selected) for r in again)
    assert mixing.mix(documents([]), [F.col("doc_id")]).collect() == []


def test_top_k_against_brute_force(spark):
    rng = random.Random(4)
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(300)]
    vectors += [(300 + i, vectors[7][1]) for i in range(20)] + [(350, [0.0] * 6), (400, [0.5] * 3), (401, [0.25] * 3), (None, [1.0] * 6)]
    broken = [(450, None), (500, [1.0, None] + [0.0] * 4), (501, [float("nan")] * 6), (550, [float("inf")] + [0.0] * 5)]
    given = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors + broken], "vec_id long, embedding array<float>, score string, rank int")
    got = topk.exact_top_k(given, F.col("vec_id") % 50 == 0, block_rows=64, block_queries=3).collect()
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in vectors if i is not None]
    expected = []
    for q, a in whole:
        if q % 50 == 0:
            near = sorted(((sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(b) == len(a)), key=lambda s: (-s[0], s[1]))[:5]
            expected += [(q, n + 1, i, s) for n, (s, i) in enumerate(near)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(expected)
    assert topk.exact_top_k(given.limit(0), F.col("vec_id") % 50 == 0).collect() == []


@pytest.mark.parametrize("size, dims, scale", [(1, 3, 5), (70, 2, 1), (200, 8, 300), (130, 5, 100000)])
def test_block_top_k(size, dims, scale):
    rng = np.random.default_rng(size)
    vectors = rng.integers(-scale, scale + 1, (size, dims))
    ids, asked = np.arange(size), np.arange(0, size, 7)
    q, r, s = topk.block_top_k(vectors, ids, vectors[asked], asked, 4)
    scores = vectors[asked] @ vectors.T
    expected = []
    for row, i in enumerate(asked):
        order = [j for j in np.lexsort((ids, -scores[row])) if j != i][:4]
        expected += [(int(i), int(j), int(scores[row][j])) for j in order]
    assert sorted(zip(q.tolist(), r.tolist(), s.tolist())) == sorted(expected)


def test_revisits_against_plain_python(spark):
    rng = random.Random(6)
    day = 86400
    rows = []
    for i in range(300):
        kind = rng.choice(["response", "revisit", "revisit", "metadata"])
        url = rng.choice(["http://a.com/x", "https://www.a.com/x/", "http://A.com:80/x#f", "http://b.com/?utm_source=1&q=2", "http://b.com/?q=2", "", None, "http://c.com/" + str(i)])
        at = rng.choice([None, 0, day, 2 * day, 5 * day, i * 1000])
        rows.append((i, kind, url, at, rng.choice([{"etag": '"1"', "date": str(i), "x": "r"}, {"etag": 'W/"1"', "date": str(i), "set-cookie": "c"}, {"last-modified": "m"}, None]),
                     rng.choice(["d1", "d2", None]), "clash"))
    rows.append(rows[-1])
    given = spark.createDataFrame(rows, "record_id long, kind string, url string, at_s long, headers map<string,string>, digest string, status string").withColumn("at", F.timestamp_seconds("at_s"))
    canon = {"http://a.com/x": "a.com/x", "https://www.a.com/x/": "a.com/x", "http://A.com:80/x#f": "a.com/x", "http://b.com/?utm_source=1&q=2": "b.com?q=2",
             "http://b.com/?q=2": "b.com?q=2", "": "", None: ""}
    got = warc.resolve_revisits(given).collect()
    expected = []
    for r in rows:
        if r[1] != "revisit":
            continue
        own = canon.get(r[2], (r[2] or "")[7:])
        earlier = [s for s in rows if s[1] == "response" and own and r[3] is not None and s[3] is not None and s[3] < r[3] and canon.get(s[2], (s[2] or "")[7:]) == own]
        best = max(earlier, key=lambda s: (s[3], s[0]), default=None)
        head = dict(r[4] or {})
        status = "missing"
        if best:
            base = best[4] or {}
            pairs = [(r[5], best[5]), *[(head.get(k, "").removeprefix("W/") or None, base.get(k, "").removeprefix("W/") or None) for k in ("etag", "last-modified")]]
            agree = next((a == b for a, b in pairs if a is not None and b is not None), None)
            status = "unchecked" if agree is None else "resolved" if agree else "mismatch"
            if agree is not False:
                head = {**base, **{k: v for k, v in head.items() if k in warc.UPDATED_BY_REVISIT}}
        expected.append((r[0], own, best[0] if best else None, status, sorted(head.items())))
    assert sorted(map(str, ((r.record_id, r.canonical, r.response_id, r.status, sorted(r.headers.items())) for r in got))) == sorted(map(str, expected))
    assert warc.resolve_revisits(given.limit(0)).collect() == []


def test_registered_revisits_return_merged_headers(spark, tmp_path):
    spark.createDataFrame([(1, "http://a.com/x", "<p>é"), (3, "http://b.com/", None)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.record_id: r for r in QUERIES["op7_warc_revisit_records"](spark, str(tmp_path)).collect()}
    etag = ['"' + hashlib.sha1(t.encode()).hexdigest()[:12] + '"' for t in ("<p>é", "")]
    assert {i: r.status for i, r in got.items()} == {4: "resolved", 5: "resolved", 10: "resolved", 11: "mismatch"}
    assert got[4].headers == f"content-length=4\ncontent-type=text/html\ndate=2020-09-13 12:28:10\netag={etag[0]}"
    assert got[5].headers == f"cache-control=max-age=60\ncontent-length=4\ncontent-type=text/html\ndate=2020-10-13 12:27:40\netag={etag[0]}"
    assert got[10].headers == f"content-length=0\ncontent-type=text/html\ndate=2020-09-13 12:30:10\netag={etag[1]}"
    assert got[11].headers == 'cache-control=max-age=60\ndate=2020-10-13 12:29:40\netag="stale"'
    assert str(got[5].at) == "2020-10-13 12:27:40"
    lines = spark.createDataFrame([({"b": "2", "a": None},), ({},)], "h map<string,string>").select(warc.header_lines(F.col("h")))
    assert [r[0] for r in lines.collect()] == ["a\nb=2", ""]


def test_pipeline_stages(spark, documents, tmp_path, monkeypatch):
    rows, labels = corpus(n=240)
    rng = random.Random(9)
    rows = [(i, f"start{i} " + prose(rng, 90) if i % 6 else t, *rest) for i, t, *rest in rows] + [(1000 + i, *rows[i][1:]) for i in (1, 2, 3)]
    rows += [(2000, None), (None, "a b c"), (2001, " ")]
    spark.createDataFrame(labels, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents(rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    given = spark.read.parquet(str(tmp_path / "documents.parquet"))
    counts = [given.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, given, str(tmp_path))
        assert sorted(after.columns) == sorted(docs.columns), name
        path = str(tmp_path / name.replace(" ", "_"))
        after.write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.select("doc_id", "text").exceptAll(given.select("doc_id", "text")).isEmpty(), name
        given = kept
        counts.append(given.count())
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > counts[4] > 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == counts[4]


def test_pipeline_of_an_empty_table(spark, documents, tmp_path):
    spark.createDataFrame([], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    documents([]).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    assert table(spark, str(tmp_path), "documents").count() == 0


CELLS = "source string, lang string, topic string, tokens long"


@pytest.mark.parametrize("keep", [0.1, 0.5, 0.9, 1.0])
def test_the_share_asked_for_is_kept_with_a_very_rare_cell(spark, keep):
    cells = [(f"s{i}", l, t, 100_000 * (i + 1)) for i in range(10) for l in ("en", "fr") for t in ("p", "q")] + [("rare", "en", "p", 30), ("s0", "zz", "q", 0)]
    rates = mixing.sampling_rates(spark.createDataFrame(cells, CELLS), keep=keep)
    rated = rates.collect()
    assert len(rated) == len(cells) and all(0 <= r.probability <= 1 for r in rated)
    assert sum(r.tokens * r.probability for r in rated) / sum(r.tokens for r in rated) == pytest.approx(keep, rel=2e-3)
    assert next(r.probability for r in rated if r.source == "rare") == 1
    report = {(r.margin, r.value): r for r in mixing.margins(rates).collect()}
    assert report["source", "rare"].expected <= report["source", "rare"].target + 1e-9
    if keep == 0.1:
        rest = [r for k, r in report.items() if k[1] not in ("rare", "zz")]
        assert all(r.expected == pytest.approx(r.target, rel=0.05) for r in rest)


def test_given_targets_are_met(spark):
    cells = [(s, l, t, 1000 * (i + 1)) for i, (s, l, t) in enumerate(itertools.product(("a", "b"), ("en", "fr"), ("p", "q")))]
    given = {"source": {"a": 3.0, "b": 1.0}, "lang": {"en": 0.5, "fr": 0.5}, "topic": {"p": 0.2, "q": 0.8}}
    rates = mixing.sampling_rates(spark.createDataFrame(cells, CELLS), targets=given)
    for r in mixing.margins(rates).collect():
        goal = given[r.margin][r.value] / sum(given[r.margin].values())
        assert r.target == pytest.approx(goal, rel=2e-3) and r.expected == pytest.approx(goal, rel=2e-3)


def test_mix_of_messy_rows_and_nothing(spark, documents, messy_rows):
    got = mixing.mix(documents(messy_rows), [F.col("doc_id")], keep=0.5).collect()
    assert len(got) == len(messy_rows) and all(0 <= r._mix_probability <= 1 for r in got)
    assert mixing.mix(documents([]), [F.col("doc_id")], keep=0.5).collect() == []
    assert mixing.mix(documents([(1, None), (2, "")]), [F.col("doc_id")], keep=0.5).count() == 2


def view_rows(count, seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(count):
        good = int(rng.random() < 0.6)
        rows.append((i, good if i % 3 == 0 else None, [float(x) for x in rng.normal(size=15) + good], [float(x) for x in rng.normal(size=43) + 0.7 * good]))
    return rows


def test_confident_guesses_against_sorting(spark):
    rows = view_rows(900)
    table_ = spark.createDataFrame([(d, v, float(sum(v)), d * 7919) for d, _, v, _ in rows], "doc_id long, _text_view array<double>, s double, _pick long").repartition(4)
    for wanted in (40, 100_000):
        found, guess = quality.confident(table_, F.col("s"), "_text_view", wanted)
        score = found.sum(1)
        ranked = sorted(sum(v) for _, _, v, _ in rows)
        high, low = [x for x in ranked if x >= quality.CONFIDENT], [x for x in ranked if x < -quality.CONFIDENT]
        if wanted > 900:
            assert sorted(score[guess == 1]) == pytest.approx(high) and sorted(score[guess == 0]) == pytest.approx(low)
        else:
            edge = ranked[-wanted]
            assert all(x >= edge - 1 / quality.BINS - 1e-9 for x in score[guess == 1]) and wanted / 2 <= (guess == 1).sum() <= 2 * wanted
            above = [x for x in ranked if x > edge + 1 / quality.BINS]
            assert sum(x > edge + 1 / quality.BINS for x in score[guess == 1]) == len(above)


def test_co_training_against_plain_python(spark):
    """The whole of co-training again in numpy, with one guess batch that takes every confident row."""
    rows = view_rows(600)
    table_ = spark.createDataFrame(rows, "doc_id long, _label int, _text_view array<double>, _meta_view array<double>").repartition(3)
    model = quality.co_train(table_)
    keyed = table_.select("doc_id", F.shiftrightunsigned(F.xxhash64("doc_id", *quality.VIEWS), 1).alias("p"), F.shiftrightunsigned(F.xxhash64("doc_id"), 1).alias("o")).collect()
    pick, order = {r.doc_id: r.p for r in keyed}, {r.doc_id: r.o for r in keyed}
    labelled = [r for r in rows if r[1] is not None]
    held = np.array([(order[r[0]] >> 7) % quality.HELD_OUT == 0 for r in labelled])
    y = np.array([r[1] for r in labelled], float)
    x = {v: np.array([r[2 + i] for r in labelled]) for i, v in enumerate(quality.VIEWS)}
    added = {v: [] for v in quality.VIEWS}

    def fit(v):
        own = [(a, b) for a, b in added[v]]
        features = np.r_[x[v][~held], np.array([a for a, _ in own]).reshape(-1, x[v].shape[1])]
        return quality.fit_logistic(features, np.r_[y[~held], [b for _, b in own]], np.r_[np.ones((~held).sum()), np.full(len(own), quality.GUESS_WEIGHT)])
    for i in range(quality.ROUNDS):
        pool = [r for r in rows if r[1] is None and pick[r[0]] % quality.ROUNDS == i]
        for giver, taker in ((0, 1), (1, 0)):
            names = tuple(quality.VIEWS)
            logits = fit(names[giver]).logits(np.array([r[2 + giver] for r in pool]))
            added[names[taker]] += [(r[2 + taker], float(z > 0)) for r, z in zip(pool, logits) if z >= 2 or z < -2]
    for v in quality.VIEWS:
        mine, got = fit(v), model.views[v][0]
        assert np.allclose(mine.weights, got.weights, atol=1e-6) and abs(mine.intercept - got.intercept) < 1e-6
    scored = table_.select("doc_id", model.score().alias("score")).collect()
    right = np.mean([(r.score > 0.5) == (np.mean(rows[r.doc_id][2]) > 0.5) for r in scored])
    assert right > 0.9


def test_top_k_takes_repeated_rows_one_by_one(spark):
    rows = [(50, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0]), (2, [0.25, 0.0])] + [(3, [0.1, 0.0])] * 9 + [(50, [1.0, 0.0])]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.exact_top_k(given, F.col("vec_id") % 50 == 0, block_rows=2).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [
        (50, 1, 1, 65536), (50, 2, 1, 65536), (50, 3, 2, 32768), (50, 4, 2, 16384), (50, 5, 3, 25 * 256)]


def test_no_long_text_takes_all_training_windows(monkeypatch):
    monkeypatch.setattr(toxicity, "TRAINING_WINDOWS", 60)
    long = (1, ["w"] * 50_000, [1] * 50_000)
    short = [(i, ["w"] * 40, [int(i % 2)] * 40) for i in range(2, 102)]
    chosen = toxicity.training_windows([long, *short])
    assert {k: len(v) for k, v in chosen.items()} == {True: 60, False: 60}
    assert sum(i == 0 for i, _ in chosen[True]) <= 2
    assert len({i for i, _ in chosen[False]}) == 50
    again = toxicity.training_windows([long, *short])
    assert chosen == again


def test_long_training_texts_send_a_sample_of_their_windows():
    import pyarrow as pa
    batch = pa.record_batch([[1, 2, 3], [1, 0, 1], [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(40_000)), "", "One two"]], ["doc_id", "toxic", "text"])
    long, empty, short = [b.to_pylist()[0] for b in toxicity._sampled(iter([batch]))]
    assert len(long["words"]) == toxicity.DOCUMENT_WINDOWS * toxicity.WINDOW and empty["words"] == [] and short["words"] == ["one", "two"]


def test_a_clean_and_a_toxic_text_with_one_beginning_are_both_learnt_from(spark):
    rng = random.Random(6)
    bases = [" ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(14)) for _ in range(100)]
    rows = [(i, bases[i // 2] + (" vilething" if i % 2 else " calm")) for i in range(200)]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    field = toxicity.train(given.withColumn("held_out", F.lit(False)), marks)
    scores = [toxicity.strength(p) for p in toxicity.tag(field, [["calm", "vilething"], ["calm", "words"]], {})]
    assert scores[0] > 0 > scores[1]
