"""The stream with timers against the batch operators, late turns, and what a flood of turns writes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import text as X
from reviewloom.plans import chat
from reviewloom.streaming import timers
from reviewloom.streaming.conversation import read_turns, write_turns

STORE = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture(autouse=True)
def store_as_before(spark):
    yield
    spark.conf.unset(STORE)


def test_timers_equal_the_batch(spark, tmp_path):
    talk = [(1, i, t) for i, t in enumerate(["hello", "asin:a1", "review x", "best", "more"])]
    talk += [(2, i, t) for i, t in enumerate(["asin:q", "hi", "asin:", "quit", "x"])]
    talk += [(3, i, f"turn {i} e") for i in range(40)]
    turns = spark.createDataFrame(talk, "conv_id long, turn long, text string")
    turns = turns.withColumn("at", F.timestamp_seconds(F.col("turn") + 1_000_000))
    source = str(tmp_path / "in")
    later = spark.createDataFrame([(9, 1, "x", dt.datetime(2024, 1, 1))], turns.schema)
    early = spark.createDataFrame([(1, 9, "too late", dt.datetime(1970, 1, 2))], turns.schema)
    for part in (turns.filter("turn >= 3"), turns.filter("turn < 1"), turns.filter("turn between 1 and 2"), later, early):
        part.coalesce(1).write.mode("append").parquet(source)
    bot, full = X.intent(F.col("query")), F.col("query").contains("e")
    states = timers.timed_conversations(read_turns(spark, source, turns.schema, 1), bot, full, "at", keep=3, show=2)
    write_turns(states, str(tmp_path / "out"), str(tmp_path / "marks")).awaitTermination()
    got = {
        (r.conv_id, r.turn): (r.query, r.id, r.answered, [tuple(h) for h in r.shown])
        for r in spark.read.parquet(str(tmp_path / "out")).collect()
    }
    parsed = chat.carry_id(chat.parse_turns(chat.until_exit(turns))).withColumn("bot", bot)
    batch = chat.history(chat.answered_before(parsed, full), "text", "bot", keep=3, show=2)
    want = {(r.conv_id, r.turn): (r.query, r.id, r.answered, [tuple(h) for h in r.shown]) for r in batch.collect()}
    assert got == want and len(got) == 48


class Value:
    def __init__(self):
        self.held, self.written = None, 0

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None

    def appendList(self, new):
        self.held = (self.held or []) + new
        self.written += len(new)

    def put(self, new):
        self.held = list(new)
        self.written += len(new)


class Handle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def getValueState(self, name, schema):
        return self.states.setdefault(name, Value())

    getListState = getValueState

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Passed:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at


def test_a_flood_of_turns_is_written_once():
    made, handle = timers.Conversation(10, 5, 1000), Handle()
    made.init(handle)
    waiting = handle.states["waiting"]
    turn = lambda i, **more: dict(zip(timers.WAITS, [i, "t", "q", None, "b", False, False, 10_000 + (i or 0)])) | more
    for trigger in range(20):  # no turn is due yet
        assert not list(made.handleInputRows((1,), iter([turn(50 * trigger + i) for i in range(50)]), Passed(0)))
    assert waiting.written == len(waiting.held) == 1000 and handle.timers == {10_000}
    handle.timers.clear()
    out = list(made.handleExpiredTimer((1,), Passed(10_499), None))
    assert [r.turn for r in out] == list(range(500)) and len(out[-1].shown) == 5
    assert len(waiting.held) == 500 and handle.timers == {10_500} and len(handle.states["now"].held[3]) == 10
    handle.timers.clear()
    assert len(list(made.handleExpiredTimer((1,), Passed(20_000), None))) == 500
    assert waiting.held is None and handle.states["now"].held is None  # idle, and so forgotten
    list(made.handleInputRows((1,), iter([turn(1, is_exit=True), turn(2), turn(None, text="first")]), Passed(20_000)))
    assert [r.turn for r in made.handleExpiredTimer((1,), Passed(20_001), None)] == [None]
