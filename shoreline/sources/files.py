"""File scans. Schemas may be given; inference costs an extra pass over the input."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.operators.ranking import global_rank

#: Files in a folder of a corpus; Spark lists folders in parallel, the files of one in a row.
CORPUS_FOLDER = 1000
#: Bytes of text a task reads from a corpus before it passes them on.
CORPUS_BATCH = 4 << 20


def read_ndjson(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """All JSON-lines files under the path or glob as one table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header row; types are inferred unless a schema is given."""
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                    id_column: str | None = None, order: Sequence[Column | str] = (),
                    id_format: str = "NOTE_%03d") -> DataFrame:
    """Files that each hold one JSON array of records.

    Such a file cannot be split, so parallelism comes from the number of files. With
    ``id_column`` set and absent from the data, ids are numbered in ``order`` (file order
    is no property of a table, so the order has to be named).
    """
    reader = spark.read.option("multiLine", True)
    reader = reader if schema is None else reader.schema(schema)
    records = reader.json(path)
    if id_column is None or id_column in records.columns:
        return records
    if not order:
        raise ValueError("name the columns that order the synthesised ids")
    numbered = global_rank(records, list(order), name="_number")
    return numbered.withColumn(id_column, F.format_string(id_format, F.col("_number"))).drop("_number")


def write_corpus(documents: DataFrame, path: str, name: str, text: str = "text") -> int:
    """One text file ``<name>.txt`` per document, for ``read_corpus``; returns the number of files.

    A text ends with a newline, and rows of one name follow one another in a task's file. The
    tasks write through Arrow, as Hadoop's local file system starts a process for each file and
    folder it makes. A file gets its name when it is whole, so a task may be tried again.
    """
    def write(batches):
        task, (store, root) = TaskContext.get(), fs.FileSystem.from_uri(path)
        files, last, out, hidden, final = 0, None, None, None, None
        for batch in batches:
            for key, body in zip(batch["name"].to_pylist(), batch["body"].to_pylist(), strict=True):
                if key != last:
                    if out is not None:
                        out.close()
                        store.move(hidden, final)
                    folder = f"{root}/part={task.partitionId():05d}-{files // CORPUS_FOLDER:05d}"
                    if files % CORPUS_FOLDER == 0:
                        store.create_dir(folder)
                    hidden, final = f"{folder}/.{key}.{task.taskAttemptId()}", f"{folder}/{key}.txt"
                    out, last, files = store.open_output_stream(hidden), key, files + 1
                out.write((body or b"") + b"\n")
        if out is not None:
            out.close()
            store.move(hidden, final)
        yield pa.RecordBatch.from_pydict({"files": [files]})

    store, root = fs.FileSystem.from_uri(path)
    store.create_dir(root)
    rows = documents.sortWithinPartitions(name).select(
        F.coalesce(F.col(name).cast("string"), F.lit("null")).alias("name"), F.col(text).cast("binary").alias("body"))
    return rows.mapInArrow(write, "files long").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]


def read_corpus(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """One row per text file: its name and its whole content.

    Spark counts a file as 4 MB at least, so a task reads few of them, and the driver lists them
    all; ``tasks`` is for many small files in folders, as ``write_corpus`` leaves them. At most so
    many tasks list folders of their own, with all below, and read the files through Arrow; the
    driver lists what lies in the path itself. Empty files and hidden ones are left out, as Spark does.
    """
    if tasks is None:
        return (spark.read.text(path, wholetext=True)
                .withColumn("file_name", F.col("_metadata.file_name"))
                .withColumnRenamed("value", "text"))
    store, root = fs.FileSystem.from_uri(path)
    found = sorted(x.base_name + "/" * (x.type == fs.FileType.Directory) for x in store.get_file_info(fs.FileSelector(root))
                   if not x.base_name.startswith((".", "_")))
    tasks = max(min(tasks, len(found)), 1)

    def listed(store, at):
        if not at.endswith("/"):
            return [store.get_file_info(at)]
        inside = store.get_file_info(fs.FileSelector(at[:-1], recursive=True))
        shown = (x for x in inside if not any(step.startswith((".", "_")) for step in x.path[len(at):].split("/")))
        return sorted((x for x in shown if x.type == fs.FileType.File), key=lambda x: x.path)

    def read(batches):
        store, root = fs.FileSystem.from_uri(path)
        texts, names, held = [], [], 0
        for info in (x for batch in batches for i in batch["id"].to_pylist() for at in found[i::tasks] for x in listed(store, f"{root}/{at}")):
            if info.size == 0:
                continue
            with store.open_input_stream(info.path) as stream:
                texts.append(stream.read())
            names.append(info.base_name)
            held += len(texts[-1])
            if held >= CORPUS_BATCH:
                yield pa.RecordBatch.from_pydict({"text": texts, "file_name": names})
                texts, names, held = [], [], 0
        if names:
            yield pa.RecordBatch.from_pydict({"text": texts, "file_name": names})

    files = spark.range(0, tasks, 1, tasks).mapInArrow(read, "text binary, file_name string")
    return files.withColumn("text", F.col("text").cast("string"))


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of the files under a landing folder; contents are not read.

    Only the listing columns of the binary scan are selected, so no file body is loaded.
    Empty files hold no records, and Spark leaves them out.
    """
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", True).load(path)
            .select("path", F.col("length").alias("bytes"), "modificationTime"))


def rows_per_file(records: DataFrame) -> DataFrame:
    """Row count per source file of a file scan."""
    return records.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("rows"))
