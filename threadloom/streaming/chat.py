"""The chat loop as a stream with keyed dialogue state."""

from collections import deque

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from threadloom.constants import CLOSING_WORDS, HISTORY_LINES
from threadloom.functions.context import build_prompt, context_relevance

OUTPUT = "conv_id long, turn long, message string, history string, closed boolean"
OUTPUT_COLUMNS = [c.split()[0] for c in OUTPUT.split(", ")]
STATE = "lines array<string>, latest_ms long"
# A conversation without a turn for so long in event time is over, with or without a closing word.
IDLE = "1 day"
ROWS_PER_FRAME = 10_000


def _advance(idle_ms: int | None):
    """Replay one conversation's new turns in order and keep its last lines."""

    def advance(key, batches, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        lines, latest = state.get if state.exists else ((), 0)
        lines = deque(lines, HISTORY_LINES)
        # Arrival order inside a trigger is arbitrary. What is held here are this trigger's texts of
        # one conversation; results leave in frames of bounded size.
        turns = [turn for batch in batches for turn in zip(batch["turn"], batch["role"], batch["text"], batch["ms"], strict=True)]
        turns.sort(key=lambda t: t[0])
        out = []
        for turn, role, text, ms in turns:
            text = text or ""
            latest = max(latest, int(ms))
            if role != "user":
                lines.append(f"Support: {text}")
                continue
            closed = text.strip().lower() in CLOSING_WORDS
            if closed:
                lines.clear()
            else:
                lines.append(f"Customer: {text}")
            out.append((key[0], turn, text, "\n".join(lines), closed))
            if len(out) == ROWS_PER_FRAME:
                yield pd.DataFrame(out, columns=OUTPUT_COLUMNS)
                out = []
        if lines:
            state.update((list(lines), latest))
            if idle_ms is not None:
                state.setTimeoutTimestamp(max(latest + idle_ms, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=OUTPUT_COLUMNS)

    return advance


def stream_chat_turns(turns: DataFrame, retrieve=None, event_time: str | None = None, idle: str = IDLE) -> DataFrame:
    """History and prompt per customer message of an unbounded turn stream.

    The state of a conversation is its last lines; a closing word ends the session and frees it.
    With ``event_time``, a timestamp column, a session also ends once the watermark, ``idle`` behind the
    latest turn of all, is ``idle`` past the session's last turn; without it sessions wait for their closing word.
    ``retrieve`` maps the message stream to one with a ``contexts`` column (for example
    ``stream_contexts``). A worker holds the texts that one conversation brings in one trigger, so
    the source's trigger size (``maxBytesPerTrigger``) bounds its memory.
    """
    ms, idle_ms, timeout = F.lit(0).cast("long"), None, GroupStateTimeout.NoTimeout
    if event_time is not None:
        turns = turns.withWatermark(event_time, idle)
        ms = F.unix_millis(event_time)
        idle_ms = round(pd.Timedelta(idle).total_seconds() * 1000)
        timeout = GroupStateTimeout.EventTimeTimeout
    carried = [] if event_time is None else [event_time]
    talk = turns.where(F.col("role").isin("user", "assistant")).select(
        "conv_id", "turn", "role", "text", F.coalesce(ms, F.lit(0)).alias("ms"), *carried
    )
    messages = talk.groupBy("conv_id").applyInPandasWithState(_advance(idle_ms), OUTPUT, STATE, "append", timeout)
    if retrieve is None:
        messages = messages.withColumn("contexts", F.array().cast("array<string>"))
    else:
        messages = retrieve(messages)
    prompt = build_prompt(
        F.col("message"),
        F.col("contexts"),
        context_relevance(F.col("contexts")),
        F.col("history"),
    )
    return messages.withColumn("prompt", F.when(~F.col("closed"), prompt))


def stream_contexts(found: DataFrame, key: str = "conv_id"):
    """A ``retrieve`` for ``stream_chat_turns``: joins the messages with a table of contexts per ``key``.

    ``found`` is a static side, read anew by each trigger and so as fresh as its files; messages without a row have no contexts.
    """

    def retrieve(messages: DataFrame) -> DataFrame:
        none = F.array().cast("array<string>")
        joined = messages.join(found.select(key, F.col("contexts").alias("_found")), key, "left")
        return joined.withColumn("contexts", F.coalesce("_found", none)).drop("_found")

    return retrieve
