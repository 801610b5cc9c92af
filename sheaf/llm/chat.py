"""Chat formatting: a dialogue once from the view of each of its speakers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheaf.llm.common import col
from sheaf.session import settle

# The marks around a message.
ASSISTANT, SYSTEM, USER, END = "<|assistant|>\n", "<|system|>\n", "<|user:{}|>\n", "<|end|>\n"


def perspectives(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text", system: str = "system", per_block: int = 64
) -> DataFrame:
    """Every dialogue once for each of its speakers, who is the assistant there; the others are named users.

    One row per message and perspective: conversation, ``perspective``, ``position`` from 0, ``speaker``, ``segment``
    (the message as rendered), ``start`` and ``end`` of the segment in the rendered dialogue in code points, and
    ``mask_start``, ``mask_end``: the part that is learned, which is the assistant's text and its end mark, null in other
    messages. The segments of a perspective in order of position are its rendered text; a long dialogue is never
    gathered into one row.

    Messages are ordered by turn, speaker and text, nulls first. ``system`` messages are rendered as such and are
    no speaker's; a dialogue of these alone has no perspective and gives no rows. A null speaker is the speaker ``""``, a
    null text is empty, null conversations are one dialogue. Repeated rows are repeated messages. Other columns are
    ignored. Positions and offsets are running sums in blocks of ``per_block`` turns and of the blocks, so that a dialogue
    of very many turns is spread over tasks.
    """
    plain = turns.select(
        col(conversation).alias("conv"),
        col(turn).cast("long").alias("turn"),
        F.coalesce(col(speaker).cast("string"), F.lit("")).alias("speaker"),
        F.coalesce(col(text), F.lit("")).alias("text"),
    ).withColumn("block", F.coalesce(F.floor(F.col("turn") / per_block), F.lit(-(1 << 62))))
    speakers = settle(plain.where(F.col("speaker") != system).select(F.col("conv").alias("_conv"), F.col("speaker").alias("perspective")).distinct())
    seen = plain.join(speakers, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv")
    mine, parts = F.col("speaker") == F.col("perspective"), USER.split("{}")
    head = F.when(mine, F.lit(ASSISTANT)).when(F.col("speaker") == system, F.lit(SYSTEM)).otherwise(F.concat(F.lit(parts[0]), "speaker", F.lit(parts[1])))
    made = seen.withColumn("head", F.length(head)).withColumn("segment", F.concat(head, "text", F.lit(END))).withColumn("size", F.length("segment").cast("long"))
    view = ["conv", "perspective"]
    blocks = made.groupBy(*view, "block").agg(F.count("*").alias("n"), F.sum("size").alias("chars"))
    earlier = Window.partitionBy(*view).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}")
    starts = settle(blocks.select(F.col("conv").alias("_conv"), F.col("perspective").alias("_perspective"), F.col("block").alias("_block"), before("n"), before("chars")))
    inside = Window.partitionBy(*view, "block").orderBy("turn", "speaker", "text")
    run = made.withColumn("position", F.row_number().over(inside) - 1).withColumn("end", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("perspective") == F.col("_perspective")) & (F.col("block") == F.col("_block"))
    out = run.join(starts, same)
    end = F.col("end") + F.col("_chars")
    start = end - F.col("size")
    return out.select(
        F.col("conv").alias(conversation),
        "perspective",
        (F.col("position") + F.col("_n")).alias("position"),
        "speaker",
        "segment",
        start.alias("start"),
        end.alias("end"),
        F.when(mine, start + F.col("head")).alias("mask_start"),
        F.when(mine, end - 1).alias("mask_end"),
    )
