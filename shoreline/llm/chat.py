"""Chat formatting by prefix-target expansion, in SQL functions only.

Every assistant turn becomes one example: all earlier turns are its context and only that
reply is trainable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
TURN = r"(?s)<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>\n"


def escape(text: Column) -> Column:
    """The text without any ``<|``: backslashes are doubled, then ``<|`` gets one between."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """Undo ``escape``: a backslash stands for the character after it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def expand_prefixes(conversations: DataFrame) -> DataFrame:
    """One example per assistant turn, with the span that may be trained on.

    Takes conv_id, turn, role, text; other columns are ignored. Returns conv_id, target_turn
    (number of the reply in its conversation, from 0), formatted (context and reply),
    loss_start and loss_end (code points from 0; the reply's escaped text alone).
    Turns after the last reply come as one further row without target and span, so that the
    output holds every turn; a conversation without a reply has that row only.

    Null roles and texts are empty. Turns are ordered by turn (null first), then role and
    text, so ties and repeated rows keep a fixed order; every row counts as a turn. Rows with
    a null conv_id form one conversation. An empty table gives an empty one.

    A conversation's transcript is built once, and each example is a prefix of it, so nothing
    is sorted or shuffled twice and the shuffle carries every turn once.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turns = (conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
             .withColumn("_head", F.concat(F.lit(START), escape(F.col("role")), F.lit(SEPARATOR)))
             .withColumn("_body", escape(F.col("text")))
             .withColumn("_size", (F.length("_head") + F.length("_body") + F.lit(len(END))).cast("long"))
             .withColumn("_no", F.row_number().over(order) - 1)
             .withColumn("_from", before + F.length("_head")))
    span = F.when(F.col("role") == "assistant", F.struct(
        F.col("_no").cast("long").alias("target_turn"), F.col("_from").alias("loss_start"),
        (F.col("_from") + F.length("_body")).alias("loss_end")))
    gathered = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("_no", F.concat("_head", "_body", F.lit(END)).alias("_part")))).alias("_parts"),
        F.collect_list(span).alias("_spans"), F.max_by("role", "_no").alias("_last"))
    none = F.struct(F.lit(None).cast("long").alias("target_turn"), F.lit(None).cast("long").alias("loss_start"),
                    F.lit(None).cast("long").alias("loss_end"))
    rest = F.when(F.col("_last") != "assistant", F.array(none)).otherwise(F.array().cast("array<struct<target_turn:bigint,loss_start:bigint,loss_end:bigint>>"))
    transcript = F.array_join(F.transform("_parts", lambda p: p["_part"]), "")
    return (gathered.select("conv_id", transcript.alias("_all"), F.inline(F.concat("_spans", rest)))
            .select("conv_id", "target_turn",
                    F.when(F.col("loss_end").isNull(), F.col("_all"))
                    .otherwise(F.substring("_all", F.lit(1), (F.col("loss_end") + len(END)).cast("int"))).alias("formatted"),
                    "loss_start", "loss_end"))


def read_back(examples: DataFrame) -> DataFrame:
    """Turns and trainable texts of each conversation, parsed from its formatted examples.

    Returns conv_id, roles and texts (arrays by turn), replies (the unescaped text under each
    example's span, in order) and formatted_chars (code points of all its examples).
    """
    under = F.expr("substring(formatted, cast(loss_start as int) + 1, cast(loss_end - loss_start as int))")
    whole = F.max_by("formatted", F.length("formatted"))
    gathered = examples.groupBy("conv_id").agg(
        whole.alias("_all"), F.sum(F.length("formatted").cast("long")).alias("formatted_chars"),
        F.sort_array(F.collect_list(F.when(F.col("target_turn").isNotNull(), F.struct(
            F.col("target_turn"), unescape(under).alias("reply"))))).alias("_replies"))
    return gathered.select(
        "conv_id", F.transform(F.regexp_extract_all("_all", F.lit(TURN), F.lit(1)), unescape).alias("roles"),
        F.transform(F.regexp_extract_all("_all", F.lit(TURN), F.lit(2)), unescape).alias("texts"),
        F.transform("_replies", lambda r: r["reply"]).alias("replies"), "formatted_chars")


def conversation_digests(examples: DataFrame) -> DataFrame:
    """Digest columns per conversation, computed from what the examples hold."""
    parsed = read_back(examples)
    turns = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n"))), "")
    replies = F.array_join("replies", "")
    return parsed.select(
        "conv_id", F.size("roles").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length(replies).cast("long").alias("loss_chars"), F.sha2(replies, 256).alias("loss_sha256"), "formatted_chars")
