"""Sources and sinks: round trips, versions, upserts, layouts, governance."""

import hashlib
import os
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from queries import sources
from shoreline.operators.governance import metadata_report, set_column_comments, set_table_comment, set_tags, table_comment, tag_report
from shoreline.operators.quality import artifact_report, column_report
from shoreline.session import checkpoint_root, shared_folder
from shoreline.sinks.tables import (append_rows, create_table_if_absent, insert_overwrite, overwrite_table, register_missing,
                                    write_bucketed, write_clustered, write_csv, write_zordered)
from shoreline.sinks.versions import ConcurrentChange, VersionedTable
from shoreline.sources import files
from shoreline.sources.files import (file_inventory, read_corpus, read_csv, read_json_array, read_ndjson, rows_per_file,
                                     write_corpus)
from shoreline.sources.generate import Choice, DoubleRange, IntRange, RiskFlag, generate_table


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def name_for(path):
    return "t_" + path[-12:]


def test_shared_folder_follows_the_session_setting(spark):
    assert shared_folder(spark, "x").startswith(checkpoint_root(spark))
    assert shared_folder(spark, "x") != shared_folder(spark, "x")
    program = """
from shoreline.session import build_session, shared_folder
spark = build_session("named", "local[1]", spark__checkpoint__dir="NAMED")
print(shared_folder(spark, "x"), spark.sparkContext.getCheckpointDir())
"""
    folder = tempfile.mkdtemp(prefix="named-")
    out = subprocess.run([sys.executable, "-c", program.replace("NAMED", folder)], capture_output=True, text=True, timeout=120,
                         cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path, checkpoints = out.stdout.split()
    assert path.startswith(folder + "/x-") and folder in checkpoints


def test_ndjson_inferred_and_typed(spark):
    path = shared_folder(spark, "nd")
    spark.createDataFrame([(1, "2024-01-01T00:00:00Z", None), (2, "x", 5)], "id int, at string, age int").write.json(path)
    inferred = read_ndjson(spark, path)
    assert dict(inferred.dtypes) == {"id": "bigint", "at": "string", "age": "bigint"}
    typed = read_ndjson(spark, path, "id int, age int")
    assert rows_of(typed, "id", "age") == [(1, None), (2, 5)]
    assert rows_per_file(typed).agg(F.sum("rows")).collect()[0][0] == 2


def test_csv_header_and_types(spark):
    path = shared_folder(spark, "csv")
    write_csv(spark.createDataFrame([(1, 2.5, "a,b"), (2, None, 'say "x"')], "id int, v double, t string"), path)
    assert read_csv(spark, path).dtypes == [("id", "int"), ("v", "double"), ("t", "string")]
    assert rows_of(read_csv(spark, path), "id", "v") == [(1, 2.5), (2, None)]


def test_json_array_ids(spark):
    path = shared_folder(spark, "array")
    os.makedirs(path)
    for i, text in enumerate(['[{"p": "b", "d": 1}, {"p": "a", "d": 2}]', '[]', '[\n{"p": "a", "d": 1}\n]']):
        with open(f"{path}/{i}.json", "w") as f:
            f.write(text)
    got = read_json_array(spark, path, "p string, d int", "note_id", ["p", "d"])
    assert rows_of(got, "note_id", "p", "d") == [("NOTE_001", "a", 1), ("NOTE_002", "a", 2), ("NOTE_003", "b", 1)]
    with pytest.raises(ValueError):
        read_json_array(spark, path, "p string, d int", "note_id")
    assert read_json_array(spark, path, "p string, note_id string", "note_id").columns == ["p", "note_id"]


def test_corpus_and_inventory(spark):
    path = shared_folder(spark, "corpus")
    os.makedirs(path)
    for name, text in (("a.txt", "one\ntwo\n"), ("b.txt", "")):
        with open(f"{path}/{name}", "w") as f:
            f.write(text)
    assert ("a.txt", "one\ntwo\n") in rows_of(read_corpus(spark, path), "file_name", "text")
    sizes = {os.path.basename(r["path"]): r["bytes"] for r in file_inventory(spark, path, "*.txt").collect()}
    assert sizes == {"a.txt": 8}


def files_below(path):
    return sorted(os.path.join(at, name) for at, _, names in os.walk(path) for name in names)


def test_document_corpus_makes_a_file_but_no_folder_per_document(spark, tmp_path, monkeypatch):
    texts = {**{i: f"text {i}" for i in range(60)}, 60: "", 61: "\u00e9\r\n\n", -62: "\n"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    corpus = f"{tmp_path}/corpus"
    monkeypatch.setattr(sources, "shared_folder", lambda *_: corpus)
    got = sources.document_corpus(spark, str(tmp_path))
    assert {r["doc_id"]: (r["n_chars"], r["digest"]) for r in got.collect()} == {
        i: (len(x), hashlib.md5(x.encode()).hexdigest()) for i, x in texts.items()}
    written = [x for x in files_below(corpus) if x.endswith(".txt")]
    assert len(written) == 63
    assert len({os.path.dirname(x) for x in written}) <= 4


def test_corpus_is_written_by_name_in_folders_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(files, "CORPUS_FOLDER", 2)
    rows = [("c", "3"), ("a", "1"), ("b", None), ("a", "2"), (None, "none")]
    path = shared_folder(spark, "corpus")
    assert write_corpus(spark.createDataFrame(rows, "id string, text string").coalesce(1), path, "id") == 4
    assert [os.path.relpath(x, path) for x in files_below(path)] == [
        "part=00000-00000/a.txt", "part=00000-00000/null.txt", "part=00000-00001/b.txt", "part=00000-00001/c.txt"]
    back = read_corpus(spark, path, 1)
    assert back.rdd.getNumPartitions() == 1
    assert rows_of(back, "file_name", "text") == [
        ("a.txt", "1\n2\n"), ("b.txt", "\n"), ("c.txt", "3\n"), ("null.txt", "none\n")]
    empty = shared_folder(spark, "corpus")
    assert write_corpus(spark.createDataFrame([], "id string, text string"), empty, "id") == 0


def test_many_small_files_are_listed_and_read_by_the_tasks(spark, monkeypatch):
    monkeypatch.setattr(files, "CORPUS_FOLDER", 3)
    monkeypatch.setattr(files, "CORPUS_BATCH", 10)
    rows = [(i, f"text {i}\r\n" + "\u00e9" * i) for i in range(20)]
    path = shared_folder(spark, "corpus")
    assert write_corpus(spark.createDataFrame(rows, "id int, text string").coalesce(1), path, "id") == 20
    for name, body in ((".hidden.txt", b"no"), ("part=00000-00000/bytes.txt", b"\xff\xfe a"), ("part=00000-00000/empty.txt", b""),
                       ("part=00000-00000/_begun", b"no")):
        with open(f"{path}/{name}", "wb") as f:
            f.write(body)
    all_files, back = read_corpus(spark, path), read_corpus(spark, path, 4)
    assert back.rdd.getNumPartitions() == 4 and back.inputFiles() == [] != all_files.inputFiles()
    as_bytes = [F.col("file_name"), F.col("text").cast("binary").alias("body")]
    got = {r["file_name"]: bytes(r["body"]) for r in back.select(*as_bytes).collect()}
    assert got == {r["file_name"]: bytes(r["body"]) for r in all_files.select(*as_bytes).collect()}
    assert got == {f"{i}.txt": f"{x}\n".encode() for i, x in rows} | {"bytes.txt": b"\xff\xfe a"}
    assert read_corpus(spark, path, 100).rdd.getNumPartitions() == 7
    flat = read_corpus(spark, f"{path}/part=00000-00001", 2)
    assert rows_of(flat, "file_name") == rows_of(read_corpus(spark, f"{path}/part=00000-00001"), "file_name") and flat.count() == 3


def test_generated_table_is_the_same_on_any_partitioning(spark):
    spec = {"age": IntRange(29, 78), "x": DoubleRange(0, 6.2), "kind": Choice(["a", "b"], [9, 1]),
            "risk": RiskFlag({"age": (50, 0.5), "x": (3.0, 0.3)})}
    made = generate_table(spark, 2000, spec)
    again = generate_table(spark, 2000, spec).repartition(9)
    assert rows_of(made, *made.columns) == rows_of(again, *made.columns)
    s = made.agg(F.min("age"), F.max("age"), F.min("x"), F.max("x"), F.avg((F.col("kind") == "a").cast("int")), F.avg("risk")).collect()[0]
    assert s[0] == 29 and s[1] == 77 and s[2] >= 0 and s[3] <= 6.2 and 0.86 < s[4] < 0.94 and 0.2 < s[5] < 0.9
    assert rows_of(generate_table(spark, 2000, spec, seed=1), "age") != rows_of(made, "age")


def test_table_writes(spark):
    path = shared_folder(spark, "t")
    name = name_for(path)
    create_table_if_absent(spark, name, {"k": "long", "v": "string"}, path)
    append_rows(spark.createDataFrame([("a", 1, 0)], "v string, k long, extra int"), name)
    register_missing(spark.createDataFrame([(1, "z"), (2, "b"), (2, "b")], "k long, v string"), name, ["k"])
    assert rows_of(spark.table(name), "k", "v") == [(1, "a"), (2, "b")]
    insert_overwrite(spark.table(name).filter("k > 1"), name)
    assert rows_of(spark.table(name), "k") == [(2,)]
    overwrite_table(spark.range(3), name, path)
    assert spark.table(name).columns == ["id"] and spark.table(name).count() == 3


def test_two_writers_get_two_versions_and_restore_copies_nothing(spark):
    root = shared_folder(spark, "versions")
    first, second = VersionedTable(spark, root), VersionedTable(spark, root)
    assert first.write(spark.range(3)) == 0
    seen = iter([-1, -1])  # the second writer looked before the first had committed
    second._last = lambda: next(seen)
    assert second.write(spark.range(5)) == 1
    assert (first.read(0).count(), first.read(1).count(), first.restore(0)) == (3, 5, 2)
    paths = {r["version"]: [p["path"] for p in r["parts"]] for r in first.history().collect()}
    assert paths[2] == paths[0] and first.read().count() == 3


def keyed_table(spark, rows=200, buckets=8):
    table = VersionedTable(spark, shared_folder(spark, "versions"), ["k"], buckets)
    table.write(spark.range(rows).select(F.col("id").alias("k"), F.lit(0).alias("x")))
    return table


def parts_of(table, version):
    return {p["bucket"]: p["path"] for p in table._commit_of(version)["parts"]}


def test_a_change_writes_only_the_buckets_it_touches(spark):
    table = keyed_table(spark)
    assert len(parts_of(table, 0)) == 8
    table.upsert(spark.createDataFrame([(3, 7)], "k int, x int"), ["k"])
    table.delete(F.col("k") == 5)
    table.update(F.col("k") == 9, {"x": F.lit(1)})
    table.delete(F.col("k") > 1000)
    for version in (1, 2, 3):
        before, after = parts_of(table, version - 1), parts_of(table, version)
        assert sum(before.get(b) != after.get(b) for b in range(8)) == 1
    assert parts_of(table, 4) == parts_of(table, 3)
    assert rows_of(table.read().filter("x > 0"), "k", "x") == [(3, 7), (9, 1)] and table.read().count() == 199
    assert table.history().filter("version = 4").collect()[0]["rows"] == 199


@pytest.mark.parametrize("second_key", [1, 2, 3, 4, 5])
def test_no_upsert_from_one_base_is_lost(spark, second_key):
    table = keyed_table(spark, 20, 4)
    other = VersionedTable(spark, table.root)
    tries = []
    store = table._store

    def overtaken(*args):
        parts = store(*args)
        if not tries:
            other.upsert(spark.createDataFrame([(second_key, 9)], "k long, x int"), ["k"])
        tries.append(1)
        return parts
    table._store = overtaken
    assert table.upsert(spark.createDataFrame([(1, 5)], "k long, x int"), ["k"]) == 2
    expected = [(1, 5)] if second_key == 1 else [(1, 5), (second_key, 9)]
    assert rows_of(table.read().filter("x > 0"), "k", "x") == expected
    same = spark.range(1, 2).select(F.pmod(F.xxhash64(F.lit(1).cast("long")), F.lit(4)) == F.pmod(F.xxhash64(F.lit(second_key).cast("long")), F.lit(4))).collect()[0][0]
    assert len(tries) == (2 if same else 1)


def test_a_delete_sees_rows_that_came_in_between_or_gives_up(spark):
    table = keyed_table(spark, 20, 4)
    other = VersionedTable(spark, table.root)
    store, tries = table._store, []

    def overtaken(*args):
        parts = store(*args)
        tries.append(1)
        if len(tries) <= limit:
            other.upsert(spark.createDataFrame([(100 + len(tries), 0)], "k long, x int"), ["k"])
        return parts
    table._store, limit = overtaken, 1
    table.delete(F.col("x") == 0)
    assert table.read().count() == 0
    table.write(spark.createDataFrame([(1, 0)], "k long, x int"))
    tries.clear()
    limit = 99
    with pytest.raises(ConcurrentChange):
        table.delete(F.col("x") == 0, attempts=2)


def test_half_made_commits_block_nobody(spark):
    table = keyed_table(spark, 10, 2)
    open(f"{table._log.removeprefix('file:')}/_0123456789abcdef", "w").close()
    assert table.upsert(spark.createDataFrame([(1, 5)], "k long, x int"), ["k"]) == 1
    assert table.history().count() == 2 and table.read().filter("x = 5").count() == 1


def test_moving_a_key_and_emptying_a_table(spark):
    table = keyed_table(spark, 10, 4)
    table.update(F.lit(True), {"k": F.col("k") + 100})
    assert rows_of(table.read(), "k") == [(100 + i,) for i in range(10)]
    table.upsert(spark.createDataFrame([(100, 1)], "k long, x int"), ["k"])
    assert table.read().count() == 10 and table.read().filter("x = 1").count() == 1
    table.delete(F.lit(True))
    assert table.read().count() == 0 and table.read().columns == ["k", "x"]
    table.upsert(spark.createDataFrame([(None, 1)], "k long, x int"), ["k"])
    table.upsert(spark.createDataFrame([(None, 2)], "k long, x int"), ["k"])
    assert rows_of(table.read(), "k", "x") == [(None, 1), (None, 2)]


def test_versions(spark):
    table = VersionedTable(spark, shared_folder(spark, "versions"))
    assert table.history().count() == 0
    with pytest.raises(ValueError):
        table.read()
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    assert table.write(base) == 0
    source = spark.createDataFrame([(2, "B"), (4, "d")], "k int, v string")
    assert table.upsert(source, ["k"]) == 1
    assert rows_of(table.read(), "k", "v") == [(1, "a"), (2, "B"), (3, None), (4, "d")]
    assert table.delete(F.col("v") == "a") == 2
    assert rows_of(table.read(), "k") == [(2,), (3,), (4,)]
    assert table.update(F.col("v").isNull(), {"v": F.lit("n")}) == 3
    assert table.restore(0) == 4
    assert rows_of(table.read(), "k", "v") == rows_of(base, "k", "v")
    assert rows_of(table.read(1), "k") == [(1,), (2,), (3,), (4,)]
    assert [tuple(r) for r in table.history().orderBy("version").select("version", "operation", "rows").collect()] == [
        (0, "WRITE", 3), (1, "MERGE", 4), (2, "DELETE", 3), (3, "UPDATE", 3), (4, "RESTORE 0", 3)]
    with pytest.raises(ValueError, match="not unique"):
        table.upsert(source.union(source), ["k"])
    with pytest.raises(ValueError):
        table.read(17)


def test_clustered_files_do_not_overlap(spark):
    path = shared_folder(spark, "clustered")
    write_clustered(spark.range(1000).select((F.col("id") * 7 % 100).alias("a"), "id"), path, ["a", "id"], files=4)
    ranges = sorted(tuple(r) for r in spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
        F.min("a").alias("lo"), F.max("a").alias("hi")).select("lo", "hi").collect())
    assert len(ranges) == 4 and all(x[1] <= y[0] for x, y in zip(ranges, ranges[1:]))


def test_z_order_skips_files_for_every_column(spark):
    path = shared_folder(spark, "z")
    rows = spark.range(4096).select((F.col("id") % 64).alias("a"), F.concat(F.lit("k"), F.lpad((F.col("id") / 64).cast("int").cast("string"), 3, "0")).alias("b"),
                                    F.when(F.col("id") % 7 > 0, F.col("id")).alias("c"))
    write_zordered(rows, path, ["a", "b"], files=16)
    ranges = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(*[f(c).alias(f"{n}_{c}") for c in "ab" for n, f in (("lo", F.min), ("hi", F.max))]).collect()
    assert len(ranges) == 16
    for c, value in (("a", 5), ("b", "k005")):
        assert sum(r[f"lo_{c}"] <= value <= r[f"hi_{c}"] for r in ranges) <= 8
    write_zordered(rows, path, ["c", "a"], file_bytes=2_000, packing=1)
    assert spark.read.parquet(path).count() == 4096 and len(spark.read.parquet(path).inputFiles()) > 16
    write_zordered(rows.limit(0), path, ["a", "b"])
    assert spark.read.parquet(path).count() == 0


def test_insert_overwrite_switches_folders_and_keeps_the_old_on_failure(spark):
    path = shared_folder(spark, "swap")
    name = name_for(path)
    create_table_if_absent(spark, name, {"k": "long", "v": "string"}, path)
    append_rows(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), name)
    with pytest.raises(Exception):
        insert_overwrite(spark.table(name).withColumn("k", F.raise_error(F.lit("no")).cast("long")), name)
    assert rows_of(spark.table(name), "k") == [(1,), (2,)]
    insert_overwrite(spark.createDataFrame([("c", 3)], "v string, k int"), name)
    assert rows_of(spark.table(name), "k", "v") == [(3, "c")] and not os.path.exists(path.removeprefix("file:"))
    insert_overwrite(spark.table(name).filter("k > 5"), name)
    assert spark.table(name).count() == 0


def test_bucketed_join_needs_no_shuffle(spark):
    names = []
    for i in range(2):
        path = shared_folder(spark, "bucket")
        write_bucketed(spark.range(1000).withColumn(f"v{i}", F.col("id") * i), name_for(path), 4, ["id"], path)
        names.append(name_for(path))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(names[0]).join(spark.table(names[1]), "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_governance(spark):
    path = shared_folder(spark, "gov")
    name = name_for(path)
    overwrite_table(spark.range(2).withColumn("v", F.lit("x")), name, path)
    set_table_comment(spark, name, "It's a 'quoted' comment")
    assert table_comment(spark, name) == "It's a 'quoted' comment"
    skipped = set_column_comments(spark, {name: {"id": "the key", "v": "no", "none": "y"}, "absent_table": {"a": "b"}})
    assert skipped == [f"{name}.none", "absent_table.a"]
    set_tags(spark, name, {"layer": "silver"})
    assert rows_of(tag_report(spark, [name]), "tag", "value") == [("layer", "silver")]
    assert rows_of(metadata_report(spark, [name]), "has_comment", "columns", "commented_columns") == [(True, 2, 1)]


def test_reports_on_missing_things(spark):
    spark.range(9).createOrReplaceTempView("nine")
    assert rows_of(artifact_report(spark, {"nine": 10, "gone": 1}), "table_name", "rows", "status") == [("gone", 0, "MISSING"), ("nine", 9, "OK")]
    assert rows_of(artifact_report(spark, {"nine": 11}), "status") == [("LOW",)]
    assert rows_of(column_report({"nine": spark.range(9)}, {"nine": ["id", "a"]}), "missing", "verdict") == [("a", "TOLERATED")]


def test_z_order_counts_reached_cuts_in_compiled_comparisons(spark):
    from shoreline.sinks import tables
    df = spark.createDataFrame([(None,), (float("nan"),), (-5.0,), (0.0,), (1.0,), (2.5,), (9.0,)], "x double")
    cuts, at = [0.0, 1.0, 1.0, 2.0, 3.0, 4.0, 5.0], [1, 3, 5]
    reached = F.coalesce(F.size(F.filter(F.lit(cuts), lambda c: c <= F.col("x"))), F.lit(0))
    moved = sum((F.shiftleft(F.shiftright(reached, b).bitwiseAND(1).cast("long"), p) for b, p in enumerate(at)), F.lit(0).cast("long"))
    assert df.filter(tables._spread_range(F.col("x"), cuts, at) != moved).count() == 0
    assert "lambda" not in str(tables.z_order(df.na.fill(0), ["x"]))
