"""The earliest row per key of a stream, as changes.

For every key the state holds the earliest row seen so far. A row that comes later but is
earlier in event time takes its place, and the change table says so: the old row with sign -1
and the new one with sign +1. Whatever is mergeable can be kept up to date from these changes
alone. With a delay, a key is forgotten once the watermark has passed its last row by as much.

Calling Python once per key costs milliseconds a key, so keys share states by hash: a state is
the packed table of its keys, and a micro-batch reads and writes each one it touches once.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shoreline.operators.quality import Rule, apply_rules
from shoreline.streaming.ingest import start
from shoreline.streaming.silver import BATCH

SIGN = "change_sign"
_ROW, _KEY, _AT, _BUCKET = "_row", "_key", "_at", "_bucket"
#: States that the keys of a stream share by hash.
BUCKETS = 1_024
#: Timestamps inside packed rows keep their microseconds.
_PACKED = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _ordered(column: str, kind: T.DataType) -> list[tuple[Column, str]]:
    """Two columns that sort as the column does, NULL first and NaN last, and hold neither; with their types."""
    c = F.col(f"`{column}`")
    rank = F.when(c.isNull(), 0).otherwise(1)
    if isinstance(kind, T.TimestampType):
        value, name, empty = F.unix_micros(c), "long", 0
    elif isinstance(kind, T.TimestampNTZType):
        value, name, empty = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"), "string", ""
    elif isinstance(kind, (T.StringType, T.DateType)):
        value, name, empty = c.cast("string"), "string", ""
    elif isinstance(kind, (T.IntegralType, T.BooleanType)):
        value, name, empty = c.cast("long"), "long", 0
    elif isinstance(kind, T.FractionalType):
        number = c.cast("double")
        rank, value, name, empty = rank + F.coalesce(F.isnan(number), F.lit(False)).cast("int"), F.nanvl(number, F.lit(0.0)), "double", 0.0
    else:
        raise TypeError(f"rows cannot be ordered by {column}: {kind.simpleString()}")
    return [(rank, "int"), (F.coalesce(value, F.lit(empty)), name)]


def earliest_changes(stream: DataFrame, key: Sequence[str], time: str, tie_break: Sequence[str] = (), delay: str | None = None,
                     buckets: int = BUCKETS) -> DataFrame:
    """Rows of the stream with ``change_sign``: +1 where a row became its key's earliest, -1 where it ceased to be.

    Times sort as in the batch operator, NULL first, then the tie-break, then the row itself.
    Each key's changes of a micro-batch come at once, at most one of each sign. Without
    ``delay`` keys are kept for ever. With it, ``time`` must be a timestamp; rows behind the
    watermark are dropped and counted by ``late_rows``, and a key goes from its state when
    the watermark is ``delay`` past its last row. So the result is exact while repeats of a key
    come within ``delay`` of one another. Keys are spread over ``buckets`` states.
    """
    schema = stream.schema
    parts = [c for name in (time, *tie_break) for c in _ordered(name, schema[name].dataType)]
    names = [f"_o{i}" for i in range(len(parts))] + [_ROW]
    kept = int(stream.sparkSession.sql(f"SELECT unix_millis(timestamp_millis(0) + INTERVAL {delay})").collect()[0][0]) if delay else 0
    seen = stream.withWatermark(time, delay) if delay else stream
    event = [F.col(f"`{time}`").alias("_event")] if delay else []
    packed = seen.select(
        *event, F.to_json(F.struct(*[F.col(f"`{c}`") for c in key]), {**_PACKED, "ignoreNullFields": "false"}).alias(_KEY),
        *[c.alias(n) for (c, _), n in zip(parts, names)], F.to_json(F.struct("*"), _PACKED).alias(_ROW),
        (F.coalesce(F.unix_millis(F.col(f"`{time}`")), F.lit(0)) if delay else F.lit(0).cast("long")).alias(_AT))

    def changed(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # key: its earliest row, the time of its last row and the watermark it is forgotten behind
        held = json.loads(zlib.decompress(state.get[0])) if state.exists else {}
        watermark = state.getCurrentWatermarkMs() if kept else 0
        touched: dict[str, tuple] = {}
        if not state.hasTimedOut:
            for frame in frames:
                for name, at, *row in zip(*[frame[c].tolist() for c in (_KEY, _AT, *names)]):
                    best, last = touched.get(name) or (None, 0)
                    touched[name] = (row if best is None or row < best else best, max(last, at))
        signs = []
        for name, (best, last) in touched.items():
            before, earlier, _ = held.get(name, (None, 0, 0))
            last = max(last, earlier)
            if before is None or best < before:
                if before is None or best[-1] != before[-1]:
                    signs += [(1, best[-1])] + ([(-1, before[-1])] if before is not None else [])
            else:
                best = before
            held[name] = (best, last, max(last + kept, watermark + 1) if kept else 0)
        if kept:
            held = {name: entry for name, entry in held.items() if name in touched or entry[2] >= watermark}
        if held:
            state.update((zlib.compress(json.dumps(held).encode(), 1),))
            if kept:
                state.setTimeoutTimestamp(max(min(entry[2] for entry in held.values()), watermark + 1))
        else:
            state.remove()
        if signs:
            yield pd.DataFrame(signs, columns=[SIGN, _ROW])

    changes = packed.withColumn(_BUCKET, F.pmod(F.xxhash64(_KEY), F.lit(buckets))).groupBy(_BUCKET).applyInPandasWithState(
        changed, f"{SIGN} int, {_ROW} string", "held binary", "append",
        GroupStateTimeout.EventTimeTimeout if kept else GroupStateTimeout.NoTimeout)
    return changes.select(F.from_json(_ROW, schema, _PACKED).alias("r"), SIGN).select("r.*", SIGN)


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark and were left out."""
    return sum(operator["numRowsDroppedByWatermark"] for p in query.recentProgress for operator in p["stateOperators"])


def log_changes(changes: DataFrame, path: str, checkpoint: str, drain: bool = True, state_partitions: int | None = None) -> StreamingQuery:
    """Append each micro-batch's changes to a folder of its own."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(path, f"{BATCH}={batch_id}"))

    writer = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return start(changes.sparkSession, writer, drain, state_partitions=state_partitions)


def read_net(spark: SparkSession, path: str, key: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """The clean table that the changes add up to: per key the row that is left, if it satisfies the rules.

    Rows whose signs cancel go away in every task before anything shuffles.
    """
    changes = spark.read.parquet(path).drop(BATCH)
    columns = [c for c in changes.columns if c != SIGN]
    left = changes.groupBy(*columns).agg(F.sum(SIGN).alias(SIGN)).filter(F.col(SIGN) > 0).drop(SIGN)
    return apply_rules(left, rules)
