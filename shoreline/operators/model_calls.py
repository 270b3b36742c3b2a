"""Batched model calls over a table column, with an offline rule client."""

from __future__ import annotations

import math
import re
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.functions.risk import RiskLimits
from shoreline.session import checkpoint_root, shared_folder

Client = Callable[[list[str]], list[str]]


def score_rows(df: DataFrame, prompt: str, client: Client, output: str = "response",
               error: str | None = None, batch: int = 64, attempts: int = 3, pause: float = 0.0,
               tasks: int | None = None, strict: bool = False) -> DataFrame:
    """Add the model's answer to every row.

    The model sees each distinct prompt once, in batches. Prompts are known by two 64-bit
    hashes, so the answers join back without their texts; they are checkpointed, so a lost
    executor does not pay for finished calls again. Prompts are dealt over ``tasks`` tasks
    (the session's shuffle partitions unless given), whatever their bytes.

    ``client`` maps a list of prompts to a list of answers and must be picklable. A batch that
    keeps failing is halved until single prompts fail: those alone have a NULL answer, and
    their reason in the column ``error``, if one is named. ``strict`` raises instead.
    """
    checkpoint_root(df.sparkSession)
    hashes = {"_h1": F.xxhash64(prompt), "_h2": F.xxhash64(F.lit(1), F.col(prompt))}
    count = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = df.filter(F.col(prompt).isNotNull()).select(F.col(prompt).alias("_asked"), *[h.alias(n) for n, h in hashes.items()])
    # repeats go away in every task before prompts move, so a prompt of many rows moves once per task
    asked = asked.dropDuplicates(list(hashes)).repartition(count, *hashes)

    def call(texts: list[str]) -> list[tuple[str | None, str | None]]:
        failure = ""
        for attempt in range(attempts):
            try:
                answers = list(client(texts))
                if len(answers) == len(texts):
                    return [(a, None) for a in answers]
                failure = f"{len(answers)} answers to {len(texts)} prompts"
            except Exception as problem:
                failure = f"{type(problem).__name__}: {problem}"
            time.sleep(pause * 2**attempt)
        if len(texts) > 1:
            middle = len(texts) // 2
            return call(texts[:middle]) + call(texts[middle:])
        if strict:
            raise RuntimeError(f"no answer to a prompt: {failure}")
        return [(None, failure)]

    def answer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["_asked"].tolist()
            given = [x for start in range(0, len(texts), batch) for x in call(texts[start:start + batch])]
            yield pd.DataFrame({"_h1": frame["_h1"], "_h2": frame["_h2"], "_answer": [a for a, _ in given], "_error": [e for _, e in given]})

    answered = asked.select("_h1", "_h2", "_asked").mapInPandas(answer, "_h1 long, _h2 long, _answer string, _error string").checkpoint()
    keyed = df.withColumns({n: F.when(F.col(prompt).isNotNull(), h) for n, h in hashes.items()})
    joined = keyed.join(answered, list(hashes), "left").withColumn(output, F.col("_answer"))
    if error is not None:
        joined = joined.withColumn(error, F.col("_error"))
    return joined.drop("_answer", "_error", *hashes)


def rule_client(limits: RiskLimits = RiskLimits()) -> Client:
    """Client that needs no network: reads the measures out of a risk prompt, applies the rule."""
    pattern = r"\b(age|chol|bp|pulse)=(-?[0-9.]+)"
    high, medium = (limits.high_age, limits.high_chol, limits.high_bp), (
        limits.medium_age_from, limits.medium_age_to, limits.medium_chol, limits.medium_bp,
        limits.medium_hr, limits.medium_markers)

    def one(prompt: str) -> str:
        seen = {name: float(value) for name, value in re.findall(pattern, prompt)}
        low = float("-inf")
        age, chol = seen.get("age", low), seen.get("chol", low)
        bp, hr = seen.get("bp", low), seen.get("pulse", low)
        if age > high[0] and (chol > high[1] or bp > high[2]):
            return "HIGH"
        markers = (chol > medium[2]) + (bp > medium[3]) + (hr > medium[4])
        return "MEDIUM" if medium[0] <= age <= medium[1] and markers >= medium[5] else "LOW"

    def client(prompts: list[str]) -> list[str]:
        return [one(p) for p in prompts]

    return client


def choose_prompt(examples: DataFrame, candidates: dict[str, Column], label: str,
                  client: Client) -> DataFrame:
    """Accuracy of each candidate prompt on labelled examples, best first.

    ``candidates`` maps a name to the prompt column it builds. Each example carries its
    candidates as an array, so no candidate table is joined. Labels are compared trimmed
    and upper-cased. Calls that failed count in ``failed`` and not in the accuracy.
    """
    prompts = F.array(*[F.struct(F.lit(n).alias("candidate"), c.alias("_prompt"))
                        for n, c in candidates.items()])
    asked = examples.select(F.col(label).alias("_label"), F.inline(prompts))
    scored = score_rows(asked, "_prompt", client, output="_reply", error="_failure")
    return accuracies(scored, "_reply", "_label", "_failure").orderBy(F.desc_nulls_last("accuracy"), F.asc("candidate"))


def accuracies(scored: DataFrame, reply: str, label: str, failure: str) -> DataFrame:
    """(candidate, examples, failed, accuracy); failed calls and missing prompts are no answers."""
    right = F.coalesce(F.upper(F.trim(reply)) == F.upper(F.trim(label)), F.lit(False))
    answered = F.col(failure).isNull()
    return scored.groupBy("candidate").agg(
        F.count("*").alias("examples"), F.count_if(~answered).alias("failed"), F.avg(F.when(answered, right.cast("double"))).alias("accuracy"))


def choose_demonstrations(examples: DataFrame, question: str, label: str, key: str, prompt: Callable[[Sequence[tuple[str, str]]], Column],
                          client: Client, candidates: int = 6, shots: int = 3, seed: int = 42, steps: int = 4, confidence: float = 0.05) -> DataFrame:
    """Few-shot prompts from examples that the model gets right, scored on the others, best first.

    Without demonstrations, every example is asked once; those answered rightly are what
    demonstrations are drawn from: up to ``shots`` for each of ``candidates`` sets, by a hash of
    the key, and set 0 is empty. ``prompt`` builds the prompt column from a set's (question,
    label) pairs. The sets are scored on the examples that stand in none of them, in
    ``steps`` growing parts; after each part a set is stopped whose upper confidence bound (Hoeffding,
    at ``confidence`` over all sets and steps) lies below another's lower bound.

    Returns candidate, shots, keys (of the demonstrations), examples, failed, accuracy and
    stopped. Only the drawn demonstrations, at most ``candidates`` times ``shots``, and the
    counts pass through the driver. Ties go to the smaller set number.
    """
    spark = examples.sparkSession
    asked = examples.select(F.col(key).alias("_key"), F.col(question).alias(question), F.col(label).alias("_label"))
    path = shared_folder(spark, "bootstrap")
    score_rows(asked.withColumn("_prompt", prompt([])), "_prompt", client, output="_reply").drop("_prompt").write.parquet(path)
    first = spark.read.parquet(path)
    right = first.filter(F.upper(F.trim("_reply")) == F.upper(F.trim("_label")))
    drawn = right.orderBy(F.xxhash64("_key", F.lit(seed)), "_key").select("_key", question, "_label").limit(candidates * shots).collect()
    sets = [[]] + [part for i in range(candidates - 1) if (part := drawn[i * shots:(i + 1) * shots])]
    used = [r["_key"] for part in sets for r in part]
    left = asked.filter(~F.col("_key").isin(used)) if used else asked
    left = left.withColumn("_part", F.pmod(F.xxhash64("_key", F.lit(seed + 1)), F.lit(steps)))
    live, seen, stopped = list(range(len(sets))), {i: [0, 0, 0.0] for i in range(len(sets))}, set()
    for step in range(steps):
        prompts = F.array(*[F.struct(F.lit(i).alias("candidate"), prompt([(r[question], r["_label"]) for r in sets[i]]).alias("_prompt")) for i in live])
        scored = score_rows(left.filter(F.col("_part") == step).select("_label", F.inline(prompts)), "_prompt", client, output="_reply", error="_failure")
        for r in accuracies(scored, "_reply", "_label", "_failure").collect():
            counts = seen[r["candidate"]]
            counts[0] += r["examples"]
            counts[1] += r["failed"]
            counts[2] += (r["accuracy"] or 0.0) * (r["examples"] - r["failed"])
        answered = {i: max(1, seen[i][0] - seen[i][1]) for i in live}
        slack = {i: math.sqrt(math.log(2 * len(sets) * steps / confidence) / (2 * answered[i])) for i in live}
        floor = max(seen[i][2] / answered[i] - slack[i] for i in live)
        stopped |= {i for i in live if seen[i][2] / answered[i] + slack[i] < floor}
        live = [i for i in live if i not in stopped]
    lines = [(i, len(part), [str(r["_key"]) for r in part], seen[i][0], seen[i][1],
              seen[i][2] / (seen[i][0] - seen[i][1]) if seen[i][0] > seen[i][1] else None, i in stopped) for i, part in enumerate(sets)]
    result = spark.createDataFrame(lines, "candidate int, shots int, keys array<string>, examples long, failed long, accuracy double, stopped boolean")
    return result.orderBy("stopped", F.desc_nulls_last("accuracy"), "candidate")
