"""Versioned tables on plain parquet, with checked commits and partial rewrites.

A table is cut into hash buckets of its key. A version is one small commit file: for each
bucket the folder that holds its rows. A change computes the buckets it touches, writes these
to new folders and commits a list in which only they differ. The commit file is written aside
and then renamed to the name of its version, which must be free: a job that dies leaves
folders no reader looks at, and of two changes made from one version the second sees that the
first was there. It goes on if they touched different buckets, else it is computed again.
"""

from __future__ import annotations

import datetime
import json
import os
import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.operators.joins import require_unique
from shoreline.session import read_json_log, shared_folder
from shoreline.sinks.commits import commit_file

COMMIT_SCHEMA = ("version int, committed_at timestamp, operation string, rows long, key array<string>, buckets int, schema string, "
                 "parts array<struct<bucket: int, path: string, rows: long>>")
BUCKET = "_bucket"


class ConcurrentChange(RuntimeError):
    """Other writers kept changing the buckets that a change was computed from."""


class VersionedTable:
    """A table whose every version stays readable.

    ``key`` and ``buckets`` hold for tables that do not exist yet; later openers find them in
    the newest commit. Without a key the table is one bucket, and every change rewrites it.
    """

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str] = (), buckets: int = 16):
        self.spark, self.root = spark, root
        self._key, self._buckets = list(key), buckets if key else 1
        self._log = os.path.join(root, "commits")

    def history(self) -> DataFrame:
        """All commits: version, time, operation, rows, and the layout."""
        return read_json_log(self.spark, self._log, COMMIT_SCHEMA)

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or the one asked for."""
        return self._rows(self._commit_of(version))

    def write(self, df: DataFrame, operation: str = "WRITE") -> int:
        """Store the rows as the next version, whatever the versions before hold."""
        last = self._last()
        key, buckets = (self._key, self._buckets) if last < 0 else (lambda c: (c["key"], c["buckets"]))(self._commit_of(last))
        line = {"operation": operation, "key": key, "buckets": buckets, "schema": df.schema.json(), "parts": self._store(df, key, buckets)}
        return self._append(line)

    def restore(self, version: int) -> int:
        """Make an old version the newest again, as a version of its own; nothing is copied."""
        return self._append({**self._commit_of(version), "operation": f"RESTORE {version}"})

    def upsert(self, source: DataFrame, key: Sequence[str], attempts: int = 10) -> int:
        """Replace rows with a matching key and insert the others; a repeated source key is an error, as in MERGE.

        The source is computed once, into the shared folder, and checked there. If the table is
        cut by this key, only the buckets of the source's keys are read and written.
        """
        path = shared_folder(self.spark, "upsert")
        kinds = self.read().schema
        source.select([F.col(f"`{f.name}`").cast(f.dataType) for f in kinds]).write.parquet(path)
        rows = self.spark.read.schema(kinds).parquet(path)
        require_unique(rows, key, "upsert source")

        def touched(base: dict) -> list[int] | None:
            return _listed(rows, base) if base["key"] == list(key) else None

        return self._change("MERGE", touched, lambda target: upserted(target, rows, key), attempts, by_key=True)

    def update(self, where: Column, values: Mapping[str, Column], attempts: int = 10) -> int:
        """Set columns where the predicate holds; only buckets with such rows are written."""
        moves = bool(set(values) & set(self._commit_of(None)["key"]))
        return self._change("UPDATE", None if moves else lambda base: _listed(self._rows(base).filter(where), base),
                            lambda target: updated(target, where, values), attempts)

    def delete(self, where: Column, attempts: int = 10) -> int:
        """Remove the rows where the predicate holds; only buckets with such rows are written."""
        return self._change("DELETE", lambda base: _listed(self._rows(base).filter(where), base), lambda target: deleted(target, where), attempts)

    def _change(self, operation: str, touched: Callable[[dict], list[int] | None] | None, change: Callable[[DataFrame], DataFrame],
                attempts: int, by_key: bool = False) -> int:
        """Compute a change from the newest version and commit it on top of that version.

        If another commit came first, a change by key that touched other buckets is committed
        on top of it as it is. Everything else is computed again from the newer version.
        """
        for _ in range(attempts):
            base = self._commit_of(None)
            found = touched(base) if touched else None
            buckets = range(base["buckets"]) if found is None else found
            old = [p for p in base["parts"] if p["bucket"] in set(buckets)]
            new = self._store(change(self._rows({**base, "parts": old})), base["key"], base["buckets"]) if len(buckets) else []
            while True:
                kept = [p for p in base["parts"] if p["bucket"] not in set(buckets)]
                version = base["version"] + 1
                if self._create({**base, "version": version, "operation": operation, "parts": kept + new}):
                    return version
                newer = self._commit_of(version)
                same = {(p["bucket"], p["path"]) for p in newer["parts"]}
                alike = all(newer[k] == base[k] for k in ("key", "buckets", "schema"))
                untouched = {(p["bucket"], p["path"]) for p in old} == {x for x in same if x[0] in set(buckets)}
                if not (by_key and alike and untouched):
                    break
                base = newer
        raise ConcurrentChange(f"{operation} of {self.root} was overtaken {attempts} times")

    def _rows(self, commit: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(commit["schema"]))
        paths = [p["path"] for p in commit["parts"]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _store(self, df: DataFrame, key: Sequence[str], buckets: int) -> list[dict]:
        """Rows written once by bucket; large buckets take several files."""
        path = os.path.join(self.root, f"data-{uuid.uuid4().hex}")
        placed = df.withColumn(BUCKET, bucket_of(key, buckets))
        (placed.hint("rebalance", BUCKET) if buckets > 1 else placed).write.partitionBy(BUCKET).parquet(path)
        stored = self.spark.read.schema(f"{BUCKET} int").parquet(path).groupBy(BUCKET).count().collect()
        return [{"bucket": r[0], "path": f"{path}/{BUCKET}={r[0]}", "rows": r[1]} for r in sorted(stored)]

    def _append(self, line: dict) -> int:
        """Commit as the next free version."""
        version = self._last() + 1
        while not self._create({**line, "version": version}):
            version += 1
        return version

    def _create(self, line: dict) -> bool:
        """Write a commit file aside and give it the name of its version; False if the name is taken."""
        now = datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="milliseconds")
        full = {**line, "committed_at": now, "rows": sum(p["rows"] for p in line["parts"])}
        return commit_file(self.spark, os.path.join(self._log, f"{line['version']:010d}.json"), json.dumps(full) + "\n")

    def _commit_of(self, version: int | None) -> dict:
        version = self._last() if version is None else version
        found = self.history().filter(F.col("version") == version).collect() if version >= 0 else []
        if not found:
            raise ValueError(f"no version {version} in {self.root}")
        return found[0].asDict(recursive=True)

    def _last(self) -> int:
        """The newest version, by file names alone."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self._log)
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
        return max((int(n[:10]) for n in names if re.fullmatch(r"\d{10}\.json", n)), default=-1)


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    """The bucket of a row: a hash of its key."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in key]), F.lit(buckets)).cast("int") if key and buckets > 1 else F.lit(0)


def _listed(rows: DataFrame, commit: dict) -> list[int]:
    """The buckets that rows fall into; as many as the table has at most."""
    return sorted(r[0] for r in rows.select(bucket_of(commit["key"], commit["buckets"]).alias("b")).distinct().collect())


def upserted(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target with the source merged in; source keys are unique."""
    return source.unionByName(target.join(source.select(*key), list(key), "left_anti"))


def updated(df: DataFrame, where: Column, values: Mapping[str, Column]) -> DataFrame:
    """Rows with the given columns replaced where the predicate holds; NULL does not hold."""
    return df.withColumns({c: F.when(where, v.cast(df.schema[c].dataType)).otherwise(F.col(c))
                           for c, v in values.items()})


def deleted(df: DataFrame, where: Column) -> DataFrame:
    """Rows without those where the predicate holds; NULL does not hold."""
    return df.filter(~F.coalesce(where, F.lit(False)))
