"""Mixing of sources to target weights by iterative proportional fitting.

Token weights of the cells (source, language, topic) are raked until their margins meet the
target shares of sources, languages and topics. The ratio of raked to present weight times one
factor for all, at most one, is each document's probability of being kept. The factor follows
from the share of tokens that is asked for.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoreline.llm.base import Workspace, stored, text_or_empty
from shoreline.operators.joins import broadcast_if_small

MARGINS = ("source", "lang", "topic")
#: Exponents that flatten the present shares into targets.
TEMPERATURES = {"source": 0.7, "lang": 0.7, "topic": 0.8}
#: Cells that one task rakes; more are raked by as many tasks as Spark makes.
CELLS_A_TASK = 200_000


def token_count(text: Column) -> Column:
    """Words between white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def form_topic(text: Column) -> Column:
    """A coarse topic by form: tables, symbols, capitals, contacts, numbers or prose."""
    size = F.greatest(F.length(text), F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / size
    return (F.when(share(r"\|") > 0.03, "tables").when(share(r"[#*$%&]") > 0.05, "symbols").when(share(r"\p{Lu}") > 0.3, "capitals")
            .when(text.rlike(r"@\w|https?://"), "contacts").when(share(r"[0-9]") > 0.03, "numbers").otherwise("prose"))


def tempered(cells: DataFrame, margin: str, exponent: float) -> DataFrame:
    """Target shares of a margin: present shares to a power below one, so small values gain."""
    totals = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("_t"))
    return totals.select(margin, F.pow("_t", F.lit(exponent)).alias("share"))


def given_shares(cells: DataFrame, margin: str, shares: Mapping[str, float]) -> DataFrame:
    """Target shares of a margin that the caller names."""
    return cells.sparkSession.createDataFrame([(k, float(v)) for k, v in shares.items()], f"`{margin}` string, share double")


def packed(cells: DataFrame, count: int) -> DataFrame:
    """Few cells in one task, where grouping and joining them needs no shuffle."""
    return cells.coalesce(1) if count <= CELLS_A_TASK else cells


def scaled(weighted: DataFrame, margin: str, alone: bool) -> DataFrame:
    """Cells whose weights of a margin's every value sum to ``_want_<margin>``; ``_moved`` notes the furthest factor.

    The sums come from a window where all cells lie in one task, else from a join, which no frequent value slows down.
    """
    if alone:
        summed = weighted.withColumn("_now", F.sum("weight").over(Window.partitionBy(margin)))
    else:
        summed = weighted.join(weighted.groupBy(margin).agg(F.sum("weight").alias("_now")), margin)
    factor = F.when(F.col("_now") > 0, F.col(f"_want_{margin}") / F.col("_now")).otherwise(1.0)
    return summed.withColumns({"weight": F.col("weight") * factor, "_moved": F.greatest("_moved", F.abs(factor - 1))}).select(*weighted.columns)


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = 12, tolerance: float = 1e-3) -> DataFrame:
    """Cells (the margins' columns, tokens) with ``weight``, whose margins meet the targets.

    ``targets`` gives for each margin its values and shares (of any sum); values without a
    target keep no weight, values without tokens are passed over, cells with a null value are
    left out. The cells are written beside what their margins shall have; few are raked in one
    task and written once a round, many once a margin. Rounds end when no factor is further
    from one than ``tolerance``, or after ``rounds``: targets that no weights can meet then
    remain nearly met.
    """
    work = Workspace(cells.sparkSession, "raking")
    total, count = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast("double"), F.count("*")).collect()[0]
    weighted = cells.dropna(subset=list(targets)).withColumn("weight", F.col("tokens").cast("double")).withColumn("_moved", F.lit(0.0))
    for margin, shares in targets.items():
        kept = shares.join(cells.filter("tokens > 0").select(margin).distinct(), margin)
        whole = kept.agg(F.sum("share").alias("_sum"))
        wanted = work.put(f"target-{margin}", kept.select(margin, (F.col("share") / whole.scalar() * total).alias(f"_want_{margin}")).coalesce(1))
        weighted = weighted.join(wanted, margin, "left").fillna(0.0, [f"_want_{margin}"])
    before, alone = "start", count <= CELLS_A_TASK
    weighted = packed(work.put(before, packed(weighted, count)), count)
    for i in range(rounds):
        weighted = weighted.withColumn("_moved", F.lit(0.0))
        for margin in targets:
            weighted = scaled(weighted, margin, alone)
            if alone and margin != list(targets)[-1]:
                continue
            weighted = packed(work.put(f"{margin}-{i}", weighted), count)
            work.drop(before)
            before = f"{margin}-{i}"
        furthest = weighted.agg(F.max("_moved")).collect()[0][0]
        if furthest is None or furthest < tolerance:
            break
    return weighted.select(*cells.columns, "weight")


def factor_for(rated: DataFrame, keep: float, grid: int = 32, rounds: int = 4) -> float:
    """The factor c for which sum(tokens * least(1, c * ratio)) is ``keep`` of all tokens.

    That sum rises with c. Each round tries a grid of factors in one aggregate and goes on
    between the two that enclose what is wanted. Where even keeping whole all that may be kept is too little, that is it.
    The grid enters the plan as one array literal, so that all rounds compile to the same code.
    """
    low, high, total, mean, count = rated.agg(
        F.try_divide(F.lit(1.0), F.max("_ratio")), 1 / F.min(F.when(F.col("_ratio") > 0, F.col("_ratio"))), F.sum("tokens"),
        F.try_divide(F.sum(F.col("tokens") * F.col("_ratio")), F.sum("tokens")), F.count("*")).collect()[0]
    if not total:
        return 1.0
    low = min(low, keep / mean)
    for _ in range(rounds):
        tried = [low * (high / low) ** (i / (grid - 1)) for i in range(grid)]
        each = packed(rated, count).select("tokens", "_ratio", F.posexplode(F.lit(tried)).alias("_place", "_c"))
        sums = each.groupBy("_place").agg(F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("_ratio") * F.col("_c")))).collect()
        above = min((place for place, kept in sums if kept >= keep * total), default=grid - 1)
        low, high = tried[max(0, above - 1)], tried[above]
    return high


def sampling_rates(cells: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, keep: float | None = None,
                   temperatures: Mapping[str, float] = TEMPERATURES) -> DataFrame:
    """Cells with ``weight`` (raked tokens) and ``probability`` of keeping a document.

    A margin's targets are those given, else its present shares flattened by its temperature.
    Without ``keep``, the cell that must gain most is kept whole and the expected margins are
    those that raking met; a very rare cell then makes the sample small. With ``keep``, that
    share of all tokens is kept: cells that would need more than all their documents are kept
    whole, and ``margins`` reports what their targets miss.
    """
    given = targets or {}
    raked = rake(cells, {m: given_shares(cells, m, given[m]) if m in given else tempered(cells, m, t) for m, t in temperatures.items()})
    mean = raked.agg(F.coalesce(F.try_divide(F.sum("weight"), F.sum("tokens")), F.lit(1.0))).scalar()
    rated = stored(raked.withColumn("_ratio", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(mean)), "rated")
    if keep is None:
        return rated.withColumn("probability", F.col("_ratio") / rated.agg(F.max("_ratio")).scalar()).drop("_ratio")
    return rated.withColumn("probability", F.least(F.lit(1.0), F.col("_ratio") * factor_for(rated, keep))).drop("_ratio")


def margins(rates: DataFrame) -> DataFrame:
    """Per margin and value: present share of tokens, raked share, and expected share of the sample."""
    parts = [rates.select(F.lit(m).alias("margin"), F.col(m).alias("value"), "tokens", "weight", "probability") for m in MARGINS]
    listed = parts[0].unionAll(parts[1]).unionAll(parts[2])
    sums = listed.groupBy("margin", "value").agg(F.sum("tokens").alias("_t"), F.sum("weight").alias("_w"), F.sum(F.col("tokens") * F.col("probability")).alias("_p"))
    totals = listed.groupBy("margin").agg(F.sum("tokens").alias("_ts"), F.sum("weight").alias("_ws"), F.sum(F.col("tokens") * F.col("probability")).alias("_ps"))
    return sums.join(F.broadcast(totals), "margin").select(
        "margin", "value", (F.col("_t") / F.col("_ts")).alias("present"), (F.col("_w") / F.col("_ws")).alias("target"), (F.col("_p") / F.col("_ps")).alias("expected"))


def mix(documents: DataFrame, carry: list[Column], targets: Mapping[str, Mapping[str, float]] | None = None, keep: float | None = None,
        seed: int = 7) -> DataFrame:
    """The carried columns, source, lang, topic, tokens, probability and selected of every row.

    ``targets`` (shares by margin and value) and ``keep`` (share of tokens to keep) are those of
    ``sampling_rates``. Takes doc_id, text, source and lang; other columns are ignored. Null
    sources and languages are the value '' (empty), null texts are empty. A document is selected
    when a hash of its id, text and the seed, as a number in [0, 1), is below its probability:
    equal rows are selected together, and a rerun selects the same. An empty table gives an
    empty one.

    The documents are reduced to cells before anything moves, and read again to meet the
    cells' rates: by a broadcast if these are few, else by a join whose skewed parts are split.
    No text is written.
    """
    text = text_or_empty()
    cell = [F.coalesce("source", F.lit("")).alias("_mix_source"), F.coalesce("lang", F.lit("")).alias("_mix_lang"), form_topic(text).alias("_mix_topic"),
            token_count(text).alias("_mix_tokens")]
    drawn = F.shiftrightunsigned(F.xxhash64("doc_id", text, F.lit(seed)), 11) / F.lit(float(1 << 53))
    work = Workspace(documents.sparkSession, "mix")
    counted = documents.select(*cell).groupBy(*[F.col(f"_mix_{m}").alias(m) for m in MARGINS]).agg(F.sum("_mix_tokens").alias("tokens"))
    rates = sampling_rates(work.put("cells", counted), targets, keep)
    rates = work.put("rates", rates.select(*[F.col(m).alias(f"_mix_{m}") for m in MARGINS], F.col("probability").alias("_mix_probability")))
    rows = documents.select(*carry, *cell, drawn.alias("_mix_drawn"))
    rated = rows.join(broadcast_if_small(rates), [f"_mix_{m}" for m in MARGINS])
    return rated.select(*[F.col(f"`{c}`") for c in rows.columns[:len(carry)]], *[F.col(f"_mix_{c}") for c in (*MARGINS, "tokens", "probability")],
                        (F.col("_mix_drawn") < F.col("_mix_probability")).alias("_mix_selected"))
