"""A state machine over a stream: one state a key, steps that aren't allowed as rows, idle keys forgotten by timers."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_OUT = "key string, event_id long, at_us long, from_state string, to_state string, outcome string"
_STATE = "at_us long, event_id long, state string"


def use_state_store(spark: SparkSession) -> None:
    """The state store that such operators need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Steps(StatefulProcessor):
    """Keeps the last (time, event, state) of a key. Rows of a batch are taken in the order of time, then event_id.

    A row emits `rejected` if the step from the state before isn't allowed, and `late` if it is before the key's last row, whose state it leaves. The state
    moves to each row's, allowed or not, unless `strict`. A key that had no row for `idle_ms` before a row starts anew; its timer forgets it
    when the watermark passes that time. So what comes out doesn't depend on how the rows are cut into batches, as long as none is late.
    """

    def __init__(self, allowed: set[tuple[str, str]], idle_ms: int | None, strict: bool):
        self.allowed, self.idle_ms, self.strict = allowed, idle_ms, strict

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.last.get() if self.last.exists() else None
        first = known
        for at_us, event_id, state in sorted((r["at_us"], r["event_id"], r["state"]) for r in rows):
            said = lambda outcome: Row(key=key[0], event_id=event_id, at_us=at_us, from_state=known[2], to_state=state, outcome=outcome)  # noqa: B023, E731
            if known is not None and (at_us, event_id) < (known[0], known[1]):
                yield said("late")
                continue
            gone = known is None or (self.idle_ms is not None and at_us - known[0] > self.idle_ms * 1000)
            wrong = not gone and (known[2], state) not in self.allowed
            if wrong:
                yield said("rejected")
            known = (at_us, event_id, known[2] if wrong and self.strict else state)
        if known is not first:
            self.last.update(known)
            if self.idle_ms is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(known[0] // 1000 + self.idle_ms + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def rejected_steps(events: DataFrame, key: str, at: str, event_id: str, state: str, allowed: list[tuple[str, str]], late: str = "0 seconds", idle_ms: int | None = None, strict: bool = False) -> DataFrame:
    """A stream of (key, event_id, at, from_state, to_state, outcome): the steps of each key that aren't allowed, and rows that came too late. Events without key, time or state are left out.

    With `strict` a rejected row doesn't move the state. State is a row a key; with `idle_ms` it is bounded by the keys seen in that time.
    """
    use_state_store(events.sparkSession)
    named = events.select(F.col(key).cast("string").alias("key"), F.col(at).cast("timestamp").alias("at"), F.col(event_id).cast("long").alias("event_id"), F.col(state).cast("string").alias("state"))
    marked = named.where("key is not null and at is not null and state is not null").withColumn("at_us", F.unix_micros("at")).withWatermark("at", late)
    mode = "EventTime" if idle_ms is not None else "None"
    out = marked.groupBy("key").transformWithState(Steps(set(allowed), idle_ms, strict), _OUT, "Append", mode)
    return out.select("key", "event_id", F.timestamp_micros("at_us").alias("at"), "from_state", "to_state", "outcome")


def rejected_in_batch(events: DataFrame, key: str, at: str, event_id: str, state: str, allowed: Column, idle_ms: int | None = None) -> DataFrame:
    """The same rows of a table that is all there: the step from the row before isn't `allowed` (a condition on from_state and to_state)."""
    w = Window.partitionBy("key").orderBy("at", "event_id")
    named = events.select(F.col(key).cast("string").alias("key"), F.col(at).cast("timestamp").alias("at"), F.col(event_id).cast("long").alias("event_id"), F.col(state).cast("string").alias("to_state"))
    steps = named.where("key is not null and at is not null and to_state is not null").withColumns({"from_state": F.lag("to_state").over(w), "before": F.lag("at").over(w)})
    near = F.lit(True) if idle_ms is None else F.unix_micros("at") - F.unix_micros("before") <= idle_ms * 1000
    return steps.where(F.col("from_state").isNotNull() & near & ~allowed).select("key", "event_id", "at", "from_state", "to_state", F.lit("rejected").alias("outcome"))
