"""Conversation state over a stream of turns: carried id, recent turns, end and answer flags."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from reviewloom import constants as K
from reviewloom.plans.chat import CONV, TEXT, TURN, parse_turns

OUT = (
    "conv_id bigint, turn bigint, query string, id string, answered boolean, "
    "shown array<struct<user: string, bot: string>>"
)
STATE = (
    "id string, ended boolean, answered boolean, users array<string>, bots array<string>, "
    "held array<string>, latest bigint"
)


def read_turns(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 64
) -> DataFrame:
    """Turns arriving as Parquet files. The number of files per trigger bounds a micro-batch, and
    with it what one conversation can bring into one task at a time."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )


def conversation_state(
    turns: DataFrame,
    bot: Column,
    full: Column,
    marker: str = K.ID_MARKER,
    exit_words: tuple[str, ...] = K.EXIT_WORDS,
    keep: int = 10,
    show: int = 5,
    time: str | None = None,
    idle: str = "1 hour",
    late: str = "10 minutes",
) -> DataFrame:
    """One row per live turn with the state after it.

    ``bot`` is the answer text of a turn, ``full`` whether it is a full generic answer. Parsing is
    done before the shuffle; the state of a conversation is its last id, two flags, at most
    ``keep`` turns, and the turns that wait.

    With ``time``, a timestamp column, a turn waits until the stream is ``late`` past it, so turns
    that arrive out of order by less than that, in any micro-batch, are taken in ``turn`` order;
    later ones are dropped. A conversation is forgotten once the stream is ``idle`` past its last
    turn. Without ``time``, turns are taken in order within a micro-batch, and states are kept.
    """
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    if time:
        turns = turns.withWatermark(time, late)
    ready = parse_turns(turns, marker).select(
        F.col(CONV).cast("bigint").alias(CONV),
        F.col(TURN).cast("bigint").alias(TURN),
        F.col(TEXT),
        "query",
        "parsed_id",
        bot.alias("bot"),
        F.coalesce(full, F.lit(False)).alias("full"),
        F.lower(TEXT).isin(*exit_words).alias("is_exit"),
        (F.unix_millis(F.col(time)) if time else F.lit(0)).cast("bigint").alias("at_ms"),
        *([F.col(time)] if time else []),  # carries the watermark
    )
    turn_text = F.to_json(F.struct(*[c for c in ready.columns if c not in (CONV, time)]))
    ready = ready.select(CONV, "at_ms", turn_text.alias("turn_text"), *([time] if time else []))

    names = T.StructType.fromDDL(OUT).fieldNames()

    def advance(
        key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        new = ("", False, False, [], [], [], 0)
        last, ended, answered, users, bots, held, latest = state.get if state.exists else new
        users, bots, waiting = list(users), list(bots), [json.loads(t) for t in held]
        if not state.hasTimedOut:
            arrived = pd.concat(list(chunks))
            waiting += [json.loads(t) for t in arrived["turn_text"]]
            latest = max(latest, int(arrived["at_ms"].max()))
        passed = state.getCurrentWatermarkMs() if time else latest
        due = sorted((t for t in waiting if t["at_ms"] <= passed), key=lambda t: t["turn"])
        waiting = [t for t in waiting if t["at_ms"] > passed]
        rows = []
        for t in due:
            ended = ended or t.get("is_exit", False)
            if ended:
                break
            last = t.get("parsed_id", last)
            users, bots = [*users, t.get("text")][-keep:], [*bots, t.get("bot")][-keep:]
            shown = [{"user": u, "bot": b} for u, b in zip(users[-show:], bots[-show:], strict=True)]
            rows.append((key[0], t["turn"], t.get("query"), last or None, bool(answered), shown))
            answered = answered or t["full"]
        if time and not waiting and latest + idle_ms <= passed:
            state.remove()
        else:
            texts = [] if ended else [json.dumps(t) for t in waiting]
            state.update((last, bool(ended), bool(answered), users, bots, texts, latest))
            if time:
                first = min((t["at_ms"] for t in waiting if not ended), default=latest + idle_ms)
                state.setTimeoutTimestamp(max(first, passed + 1))
        if rows:
            yield pd.DataFrame(rows, columns=names)

    timeout = GroupStateTimeout.EventTimeTimeout if time else GroupStateTimeout.NoTimeout
    return ready.groupBy(CONV).applyInPandasWithState(advance, OUT, STATE, "append", timeout)


def write_turns(states: DataFrame, path: str, checkpoint: str):
    """Start a query that handles all files present, writes Parquet and stops."""
    return (
        states.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
