"""Operator 9, chat formatting: multi-party perspective rotation (native).

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and all others as named users; system turns stay
system turns.  The mask covers what the model learns to say: the text and
end mark of the assistant's own turns.

A dialogue is rendered whole.  Only a conversation of over ``PIECE_CHARS``
characters (names and texts, measured before anything is rendered) is split,
so that no row outgrows a cell: into pieces of consecutive turns, by the
characters that come before a turn.  Offsets go on through the pieces: a mask
span counts from the beginning of the dialogue, and ``offset`` is where a
piece begins in it.  Repeated rows are one turn and are merged before
anything is sized.  DataFrame functions only.

Defined cases: a null or empty role is the speaker ``unknown``; null text is
empty text; rows with a null conversation are one conversation; null turns
come first; turns with the same number are ordered by speaker and text; a
row that repeats in all four columns is one turn (``n_rows`` counts the
rows); a single turn longer than a piece is a piece of its own; a
conversation of system turns alone has no participant and no rows; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bellwether.llm.common import materialize

PIECE_CHARS = 16_000_000     # characters of a conversation that is rendered whole
SYSTEM = "system"
UNKNOWN = "unknown"
END = "<|end|>\n"


def _header(turn: Column, speaker: Column) -> Column:
    """Opening mark of a turn, seen from ``speaker``."""
    name = turn.getField("speaker")
    return (F.when(name == F.lit(SYSTEM), F.lit("<|system|>\n"))
            .when(name == speaker, F.lit("<|assistant|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), name, F.lit("|>\n"))))


def _pieces(turns: DataFrame, most: int) -> DataFrame:
    """``turns`` with ``piece``: the characters before a turn, in turn order, in units of ``most``.

    Conversations of up to ``most`` characters are the piece 0.
    """
    group, order = ["conv_id"], ["turn", "speaker", "text"]
    sized = turns.withColumn("size", (F.length("speaker") + F.length("text")).cast("long"))
    large = sized.groupBy(*group).agg(F.sum("size").alias("n")).where(F.col("n") > F.lit(most)).select(
        F.col("conv_id").alias("__conv"))
    same = F.col("conv_id").eqNullSafe(F.col("__conv"))
    whole = sized.join(large, same, "left_anti").withColumn("piece", F.lit(0).cast("long"))
    # large conversations are sorted over many tasks; a task's turns go on where the tasks before it end
    slices = sized.join(large, same, "left_semi").repartitionByRange(*group, *order).withColumn(
        "slice", F.spark_partition_id())
    slices = materialize(slices, "slices")
    before = slices.groupBy(*group, "slice").agg(F.sum("size").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(
            Window.partitionBy(*group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = before.select(F.col("conv_id").alias("__conv"), F.col("slice").alias("__slice"), "before")
    inside = F.sum("size").over(Window.partitionBy(*group, "slice").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0))
    split = slices.withColumn("upto", inside).join(before, same & (F.col("slice") == F.col("__slice"))).withColumn(
        "piece", F.floor((F.col("before") + F.col("upto") - F.col("size")) / F.lit(most)).cast("long"))
    columns = [*turns.columns, "piece"]
    return whole.select(*columns).unionByName(split.select(*columns))


def rotate(conversations: DataFrame, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """One row per conversation, participant and piece.

    ``conv_id, perspective, piece, offset, n_turns, n_rows, text, mask``
    (array of character spans of the whole dialogue).
    """
    turns = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(F.coalesce(F.col("role"), F.lit("")) == "", F.lit(UNKNOWN)).otherwise(F.col("role")).alias("speaker"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # a repeated row is one turn: copies are counted before they are shuffled
    turns = turns.groupBy("conv_id", "turn", "speaker", "text").agg(F.count(F.lit(1)).alias("copies"))
    speakers = (turns.where(F.col("speaker") != SYSTEM).select("conv_id", "speaker").distinct()
                .select(F.col("conv_id").alias("__conv"), F.col("speaker").alias("perspective")))
    plan = speakers.groupBy("__conv").agg(F.collect_set("perspective").alias("perspectives"))
    seen = _pieces(turns, piece_chars).join(plan, F.col("conv_id").eqNullSafe(F.col("__conv")))
    rows = seen.select("conv_id", "piece", "copies", F.struct("turn", "speaker", "text").alias("row"),
                       F.explode("perspectives").alias("perspective"))
    group = ["conv_id", "perspective", "piece"]
    head = _header(F.col("row"), F.col("perspective"))
    body = F.concat(F.col("row").getField("text"), F.lit(END))
    upto = F.sum(F.length("head") + F.length("body")).over(
        Window.partitionBy(*group).orderBy("row").rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumn("head", head).withColumn("body", body).withColumn("end", upto.cast("long"))
    segment = F.struct("end", (F.col("end") - F.length("body")).alias("start"), F.concat("head", "body").alias("text"),
                       (F.col("row").getField("speaker") == F.col("perspective")).alias("own"))
    dialogues = placed.groupBy(*group).agg(
        F.sort_array(F.collect_list(segment)).alias("segments"), F.sum("copies").alias("n_rows"), F.max("end").alias("size"))
    earlier = F.sum("size").over(Window.partitionBy("conv_id", "perspective").orderBy("piece").rowsBetween(
        Window.unboundedPreceding, -1))                                 # over the pieces of a dialogue
    dialogues = dialogues.withColumn("offset", F.coalesce(earlier, F.lit(0)).cast("long"))
    spans = F.transform(F.filter("segments", lambda s: s.getField("own")),
                        lambda s: F.struct((F.col("offset") + s.getField("start")).alias("start"),
                                           (F.col("offset") + s.getField("end")).alias("end")))
    text = F.array_join(F.transform("segments", lambda s: s.getField("text")), "")
    return dialogues.select(*group, "offset", F.size("segments").cast("long").alias("n_turns"), "n_rows",
                            text.alias("text"), spans.alias("mask"))


def query(conversations: DataFrame) -> DataFrame:
    """Every dialogue of every perspective; the mask as text ``start-end`` pairs."""
    spans = F.array_join(F.transform("mask", lambda s: F.concat(
        s.getField("start").cast("string"), F.lit("-"), s.getField("end").cast("string"))), ",")
    n = F.aggregate("mask", F.lit(0).cast("long"), lambda a, s: a + s.getField("end") - s.getField("start"))
    return rotate(conversations).select("conv_id", "perspective", "piece", "offset", "n_turns", "n_rows", "text",
                                        spans.alias("mask"), n.alias("n_trained"))
