"""The chat loop as one keyed Structured Streaming job.

Conversation turns arrive as files. Per ``conv_id`` the state holds how many
questions were answered and whether the user closed the session with 'exit'
(the rule of ``operators.conversations``). Each non-empty user turn before the first exit is answered (by the caller's
``answer_fn``, e.g. a model client; the default only acknowledges), and one
output row is appended per answered turn. Turns are expected in order within a
conversation, as a chat produces them.

A session opens with the assistant's greeting, if there is one, and may end by being idle.

State is small and bounded per key (two numbers), the history itself is the
append-only output, so the state store does not grow with conversation length;
with ``idle`` the keys of sessions long over leave it too.
Exactly-once: file source + checkpointed state + file sink.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from nimbus.session import scratch_path

TURN_SCHEMA = "conv_id long, turn long, role string, text string"
OUTPUT_SCHEMA = "conv_id long, turn long, question string, n_answered long, answer string"
STATE_SCHEMA = "n_answered long, closed boolean"
EXIT_WORD = "exit"


def default_answer(question: str) -> str:
    """Placeholder answer; callers pass their own ``answer_fn``."""
    return f"received {len(question.split())} words"


def _make_step(answer_fn: Callable[[str], str], greeting: str | None, idle: str | None):
    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        columns = ["conv_id", "turn", "question", "n_answered", "answer"]
        if state.hasTimedOut:
            # nothing came for a while: the session is over, its state goes
            state.remove()
            return
        rows = []
        if not state.exists and greeting is not None:
            rows.append((key[0], None, None, 0, greeting))
        n_answered, closed = state.get if state.exists else (0, False)
        pdf = pd.concat(list(batches), ignore_index=True).sort_values("turn")
        for turn, role, text in zip(pdf["turn"], pdf["role"], pdf["text"]):
            if closed:
                break
            if role != "user":
                continue
            t = "" if text is None else str(text)
            if t.lower() == EXIT_WORD:
                closed = True
                break
            if not t:
                continue
            n_answered += 1
            rows.append((key[0], int(turn), t, n_answered, answer_fn(t)))
        state.update((n_answered, closed))
        if idle is not None:
            state.setTimeoutDuration(idle)
        if rows:
            out = pd.DataFrame(rows, columns=columns)
            out["turn"] = out["turn"].astype("Int64")
            yield out

    return step


def chat_stream(turns: DataFrame, answer_fn: Callable[[str], str] = default_answer, greeting: str | None = None,
                idle: str | None = None) -> DataFrame:
    """The streaming transformation (no sink): answered turns, append mode.

    ``greeting`` is the assistant's first row of a session (turn and question null, nothing answered),
    sent when its key is first seen. ``idle`` ('2 hours') ends a session nothing arrived for
    (processing time) and drops its state; a turn after that opens a new one, with its greeting.
    """
    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle is not None else GroupStateTimeout.NoTimeout
    return turns.groupBy("conv_id").applyInPandasWithState(
        _make_step(answer_fn, greeting, idle), OUTPUT_SCHEMA, STATE_SCHEMA, "append", timeout
    )


def run_chat_stream(
    spark: SparkSession,
    source: str,
    answer_fn: Callable[[str], str] = default_answer,
    sink: str | None = None,
    checkpoint: str | None = None,
    fmt: str = "parquet",
    greeting: str | None = None,
    idle: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Run the chat stream over every file available at ``source`` (a path or
    glob) with an ``availableNow`` trigger, then return the sink as a batch
    frame. Sink and checkpoint default to fresh folders under the session's
    checkpoint root; pass the same ones again to continue a stream. ``max_files``
    bounds the files of one micro-batch, so a backlog goes through in many."""
    sink = sink or scratch_path(spark, "chat-sink")
    checkpoint = checkpoint or scratch_path(spark, "chat-checkpoint")
    reader = spark.readStream.schema(TURN_SCHEMA).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        chat_stream(reader.load(source), answer_fn, greeting, idle)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(OUTPUT_SCHEMA).parquet(sink)
