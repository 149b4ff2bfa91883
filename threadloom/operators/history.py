"""Rolling dialogue history."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.constants import CLOSING_WORDS, HISTORY_LINES
from threadloom.functions.text import strip_ws

TURNS_PER_BLOCK = 10_000
# Stands for a closing message; no line holds this character.
SESSION_END = "\0"


def dialogue_line(role: Column, text: Column) -> Column:
    speaker = F.when(role == "user", "Customer: ").otherwise("Support: ")
    return F.concat(speaker, F.coalesce(text, F.lit("")))


def _line(role: Column, text: Column) -> Column:
    closing = (role == "user") & F.lower(strip_ws(F.coalesce(text, F.lit("")))).isin(*CLOSING_WORDS)
    return F.when(closing, F.lit(SESSION_END)).otherwise(
        F.replace(dialogue_line(role, text), F.lit(SESSION_END), F.lit(""))
    )


def _since_end(lines: Column) -> Column:
    """The lines after the last closing message, joined."""
    return F.regexp_replace(F.substring_index(F.array_join(lines, "\n"), SESSION_END, -1), r"\A\n", "")


def history_window(
    turns: DataFrame,
    lines: int = HISTORY_LINES,
    block: int = TURNS_PER_BLOCK,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
) -> DataFrame:
    """Last ``lines`` dialogue lines up to each customer turn.

    A closing word of the customer ends the session: it has no history itself, and what follows
    sees no line before it.

    A conversation is cut into blocks of ``block`` turn numbers that are windowed
    independently, so one conversation holding a third of all turns spreads over
    many tasks. Conversations of more than one block carry the last lines of the
    preceding blocks into each block; the others never take that second path.
    """
    talk = turns.where(F.col("role").isin("user", "assistant"))
    lined = talk.select(
        conv_col,
        turn_col,
        F.floor(F.col(turn_col) / block).alias("_block"),
        "role",
        "text",
        _line(F.col("role"), F.col("text")).alias("_line"),
    )
    before = lines - 1
    in_block = Window.partitionBy(conv_col, "_block").orderBy(turn_col)
    local = lined.withColumn(
        "_recent", F.collect_list("_line").over(in_block.rowsBetween(-before, 0))
    )
    recent = F.concat(F.coalesce("_carry", F.array().cast("array<string>")), F.col("_recent"))
    return (
        local.where(F.col("role") == "user")
        .join(_carried(lined, talk, before, block, conv_col, turn_col), [conv_col, "_block"], "left")
        .withColumn("_both", recent)
        .select(
            conv_col,
            turn_col,
            F.col("text").alias("message"),
            _since_end(
                F.slice("_both", F.greatest(F.size("_both") - before, F.lit(1)), F.lit(lines))
            ).alias("history"),
        )
    )


def _carried(
    lined: DataFrame, talk: DataFrame, before: int, block: int, conv_col: str, turn_col: str
) -> DataFrame:
    """``conv, _block, _carry``: the lines that precede each block of a long conversation.

    A conversation of several blocks has a turn outside block 0, a filter the scan
    can answer from its statistics. Of each block only the last lines are kept,
    cut on the map side before they are shuffled.
    """
    outside = (F.col(turn_col) < 0) | (F.col(turn_col) >= block)
    long_ones = talk.where(outside).select(conv_col).distinct()
    latest = Window.partitionBy(conv_col, "_block").orderBy(F.desc(turn_col))
    tails = (
        lined.join(long_ones, conv_col, "left_semi")
        .withColumn("_age", F.row_number().over(latest))
        .where(F.col("_age") <= before)
        .groupBy(conv_col, "_block")
        .agg(F.sort_array(F.collect_list(F.struct(turn_col, "_line"))).alias("_tail"))
    )
    earlier = Window.partitionBy(conv_col).orderBy("_block").rowsBetween(-before, -1)
    gathered = F.flatten(F.collect_list("_tail").over(earlier))
    return tails.select(
        conv_col, "_block", F.transform(gathered, lambda t: t["_line"]).alias("_carry")
    )
