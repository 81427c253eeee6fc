"""Chat formatting by multi-party perspective rotation (operator 6).

Each participant of a conversation in turn is the assistant: their turns carry the loss,
all others speak as named users. A dialogue is rendered in parts of bounded length, so
that a conversation of any number of turns is spread over tasks; the parts, put one
after the other, are the whole dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import materialise, text_or_empty

PART_CHARS = 32_768
#: What a turn counts beside its text, so that parts of empty turns are bounded too.
TURN_CHARS = 32
CONTEXT_ROLES = ("system",)
BLOCK_TURNS = 4096


def _header(role: Column, name: Column) -> Column:
    """``<|assistant|>``, ``<|system|>`` or ``<|user name=NAME|>``, and a line end."""
    named = F.concat(F.lit("<|user name="), name, F.lit("|>\n"))
    return F.when(role == "user", named).otherwise(F.concat(F.lit("<|"), role, F.lit("|>\n")))


def _starts(turns: DataFrame) -> DataFrame:
    """Adds ``start``, the characters of a conversation before each turn.

    Block sums come first: a block holds the turns of one number range, and repeated turn
    numbers are told apart by content, so one conversation is summed up in many tasks.
    """
    turns = turns.withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS))
    blocks = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_last())
    sums = turns.groupBy("conv_id", "block").agg(F.sum("chars").alias("sum"))
    before = sums.withColumn("before", F.sum("sum").over(blocks) - F.col("sum")).drop("sum")
    inside = (
        Window.partitionBy("conv_id", "block")
        .orderBy(F.col("turn").asc_nulls_last(), "role", "hash", "text")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    a, b = turns.alias("a"), before.alias("b")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & F.col("a.block").eqNullSafe(F.col("b.block"))
    return a.join(b, same).select("a.*", "b.before").withColumns(
        {
            "start": F.col("before") + F.sum("chars").over(inside) - F.col("chars"),
            "tie": F.row_number().over(inside),
        }
    )


def rotate_perspectives(
    turns: DataFrame,
    context_roles: tuple[str, ...] = CONTEXT_ROLES,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """One row per conversation, participant and part.

    Columns: conv_id, assistant (the participant), part (from 0), n_turns, text (the
    rendered part), loss_spans (array of start and end of what carries the loss, in
    characters of ``text``) and loss_chars. A turn is a header line, its text, and
    ``<|end|>``; the loss is on the text and the end mark of the assistant's turns.

    Turns are ordered by ``turn`` (null last), then role, then text; repeated turns are
    rendered as often as they occur. A null role is the participant "unknown", a null
    text is empty. Turns of ``context_roles`` are rendered under their own role and are
    not participants; a conversation without participants gives no rows. A null conv_id
    is one conversation. Further columns are ignored; an empty table gives no rows.
    """
    said = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        text_or_empty("text").alias("text"),
    ).withColumns(
        {"chars": F.char_length("text") + TURN_CHARS, "hash": F.xxhash64("text")}
    )
    is_context = F.col("role").isin(list(context_roles)) if context_roles else F.lit(False)
    placed = materialise(
        _starts(said).withColumn("part", F.floor(F.col("start") / part_chars)).drop("start", "before", "hash", "chars")
    )
    parties = said.where(~is_context).select(F.col("conv_id").alias("__conv"), F.col("role").alias("assistant")).distinct()
    views = placed.join(parties, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")

    speaker = F.when(is_context, F.col("role")).when(F.col("role") == F.col("assistant"), "assistant").otherwise("user")
    end = F.lit("<|end|>\n")
    views = views.select(
        "conv_id",
        "assistant",
        "part",
        F.struct(F.col("turn").isNull().alias("untimed"), "turn", "block", "tie").alias("at"),
        _header(speaker, F.col("role")).alias("header"),
        F.concat("text", end).alias("body"),
        (speaker == "assistant").alias("loss"),
    )
    order = Window.partitionBy("conv_id", "assistant", "part").orderBy("at")
    length = F.char_length("header") + F.char_length("body")
    views = views.withColumn("stop", F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    span = F.when(
        F.col("loss"),
        F.struct((F.col("stop") - F.char_length("body")).alias("start"), F.col("stop").alias("stop")),
    )
    return (
        views.groupBy("conv_id", "assistant", "part")
        .agg(
            F.count(F.lit(1)).alias("n_turns"),
            F.sort_array(F.collect_list(F.struct("at", F.concat("header", "body").alias("said")))).alias("all"),
            F.sort_array(F.collect_list(span)).alias("loss_spans"),
            F.coalesce(F.sum(F.when(F.col("loss"), F.char_length("body"))), F.lit(0)).cast("long").alias("loss_chars"),
        )
        .select("conv_id", "assistant", "part", "n_turns", F.array_join("all.said", "").alias("text"), "loss_spans", "loss_chars")
    )
