"""Conversation state with timers: turns wait in a list of their own until the stream has passed them.

The state of `conversation` is one value, written anew whenever turns arrive. Here turns are appended
to a list in the state store and read once, when a timer fires, so a conversation with a flood of
turns costs each trigger its new ones only, and what waits does not have to fit into one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from reviewloom import constants as K
from reviewloom.plans.chat import CONV, TEXT, TURN, parse_turns
from reviewloom.streaming.conversation import OUT

NOW = (
    "id string, ended boolean, answered boolean, users array<string>, bots array<string>, "
    "latest bigint, wakes bigint"
)
WAITING = (
    "turn bigint, text string, query string, parsed_id string, bot string, full boolean, "
    "is_exit boolean, at_ms bigint"
)
WAITS = "turn text query parsed_id bot full is_exit at_ms".split()
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Conversation(StatefulProcessor):
    """State of one conversation: what holds now, and the turns that wait for the stream to pass them.

    A turn is appended to the list of those that wait and looked at once, when the timer of the
    earliest one fires; turns that came before are not written again.
    """

    def __init__(self, keep: int, show: int, idle_ms: int) -> None:
        self.keep, self.show, self.idle_ms = keep, show, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.now = handle.getValueState("now", NOW)
        self.waiting = handle.getListState("waiting", WAITING)

    def _now(self) -> list:
        return list(self.now.get()) if self.now.exists() else ["", False, False, [], [], 0, 0]

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        new = [tuple(r[c] for c in WAITS) for r in rows]
        now = self._now()
        first, now[5] = min(t[-1] for t in new), max(now[5], *(t[-1] for t in new))
        if not now[1]:  # nothing follows the end
            self.waiting.appendList(new)
        else:
            first = now[5] + self.idle_ms
        passed = timerValues.getCurrentWatermarkInMs()
        self._wake(now, max(first, passed + 1))
        self.now.update(tuple(now))
        return iter(())

    def handleExpiredTimer(
        self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[Row]:
        passed, now = timerValues.getCurrentWatermarkInMs(), self._now()
        now[6] = 0
        waits = [tuple(t) for t in self.waiting.get()]
        yield from self._take(key, now, [t for t in waits if t[-1] <= passed])
        rest = [] if now[1] else [t for t in waits if t[-1] > passed]
        if not rest and now[5] + self.idle_ms <= passed:
            self.now.clear()
            self.waiting.clear()
            return
        if len(rest) < len(waits):
            self.waiting.put(rest) if rest else self.waiting.clear()
        self._wake(now, max(min((t[-1] for t in rest), default=now[5] + self.idle_ms), passed + 1))
        self.now.update(tuple(now))

    def _wake(self, now: list, at: int) -> None:
        """One timer a conversation, for the earliest of the turns that wait, or for its end."""
        if not now[6] or at < now[6]:
            if now[6]:
                self.handle.deleteTimer(now[6])
            self.handle.registerTimer(at)
            now[6] = at

    def _take(self, key: tuple, now: list, turns: list[tuple]) -> Iterator[Row]:
        """Goes on from the state with some turns in order, and changes it."""
        for turn, text, query, parsed_id, bot, full, is_exit, _ in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0)):
            now[1] = now[1] or bool(is_exit)
            if now[1]:
                return
            now[0] = now[0] if parsed_id is None else parsed_id
            now[3], now[4] = [*now[3], text][-self.keep :], [*now[4], bot][-self.keep :]
            recent = zip(now[3][-self.show :], now[4][-self.show :], strict=True)
            shown = [Row(user=u, bot=b) for u, b in recent]
            yield Row(
                conv_id=key[0], turn=turn, query=query, id=now[0] or None, answered=now[2], shown=shown
            )
            now[2] = now[2] or full


def timed_conversations(
    turns: DataFrame,
    bot: Column,
    full: Column,
    time: str,
    marker: str = K.ID_MARKER,
    exit_words: tuple[str, ...] = K.EXIT_WORDS,
    keep: int = 10,
    show: int = 5,
    idle: str = "1 hour",
    late: str = "10 minutes",
) -> DataFrame:
    """As ``conversation_state`` with ``time``: one row per live turn with the state after it.

    A turn waits until the stream is ``late`` past it, so turns that arrive out of order by less
    than that are taken in ``turn`` order; later ones are dropped. A conversation is forgotten once
    the stream is ``idle`` past its last turn. States are kept in RocksDB, which the session is told
    to use unless it names another store; a checkpoint of another store cannot be gone on with. Turns
    without a number come before the others of their time, turns without a time count as the oldest.
    """
    conf = turns.sparkSession.conf
    if conf.get("spark.sql.streaming.stateStore.providerClass", None) is None:
        conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    ready = parse_turns(turns.withWatermark(time, late), marker).select(
        F.col(CONV).cast("bigint").alias(CONV),
        F.col(TURN).cast("bigint").alias("turn"),
        F.col(TEXT).alias("text"),
        "query",
        "parsed_id",
        bot.alias("bot"),
        F.coalesce(full, F.lit(False)).alias("full"),
        F.coalesce(F.lower(TEXT).isin(*exit_words), F.lit(False)).alias("is_exit"),
        F.coalesce(F.unix_millis(F.col(time)), F.lit(0)).alias("at_ms"),
        F.col(time),  # carries the watermark
    )
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    return ready.groupBy(CONV).transformWithState(
        Conversation(keep, show, idle_ms), OUT, "Append", "EventTime"
    )
