"""Absence on a stream: silence of a source raises an alert, by timers of event time.

Ticks are multiples of `step`, as in `telemetry.absent`: a tick is absent for a key when no wanted event lies in the range before it. A key's state is the
number of the last tick that was judged and the steps that had a wanted event since, at most (range + watermark's delay) / step of them,
however many events come. Its one timer stands at its next absent tick; wanted events move it on. It fires when the watermark has passed the tick, so late events within
the delay still count, each tick is judged once, and a restart goes on from the checkpoint.

All events, wanted or not, and of any key, move the watermark. Where a whole stream may fall silent, `beats` keep time: any stream with a column ts, such as the
rate source. A key is watched from its first wanted event, or from the start that `watched` gives it. Null times count for nothing; null keys are a key.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def next_absent(done: int, steps: list[int], range_: int) -> int:
    """The first tick after `done` that has none of the steps, which are in order, in the range_ steps before it."""
    tick = done + 1
    for s in steps:
        if s >= tick:  # an event from the tick on says nothing of it
            break
        tick = max(tick, s + range_ + 1)
    return tick


class Absence(StatefulProcessor):
    """Steps with wanted events to absent ticks. step: milliseconds; range_: steps; each: every absent tick, or the first of a silence alone."""

    def __init__(self, key: str, step: int, range_: int, each: bool):
        self.key, self.step, self.range_, self.each = key, step, range_, each

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("ticks", "state string")

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        # What came before the start isn't known, so the first tick that is judged has its whole range behind the start.
        self.keep({"done": int(initialState["start"].iloc[0]) + self.range_ - 1, "steps": [], "told": False, "timer": None})

    def keep(self, state: dict) -> None:
        due = next_absent(state["done"], state["steps"], self.range_) * self.step
        if state["timer"] != due:
            if state["timer"] is not None:
                self.handle.deleteTimer(state["timer"])
            self.handle.registerTimer(due)
            state["timer"] = due
        self.value.update((json.dumps(state),))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = {int(s) for frame in rows for s in frame.loc[frame["wanted"], "at_step"].unique()}
        if self.value.exists():
            state = json.loads(self.value.get()[0])
        elif new:
            state = {"done": min(new), "steps": [], "told": False, "timer": None}
        else:
            return
        # A step before the last judged tick's range concerns no tick to come.
        state["steps"] = sorted(s for s in {*state["steps"], *new} if s + self.range_ > state["done"])
        self.keep(state)
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        state, found = json.loads(self.value.get()[0]), []
        # The watermark may have passed many ticks at once.
        last = timerValues.getCurrentWatermarkInMs() // self.step
        state["timer"] = None
        while (tick := next_absent(state["done"], state["steps"], self.range_)) <= last:
            # A silence goes on from one tick to the next.
            first = tick > state["done"] + 1 or not state["told"]
            if first or self.each:
                found.append((key[0], tick * self.step, first))
            state["done"], state["told"] = tick, True
        state["steps"] = [s for s in state["steps"] if s + self.range_ > state["done"]]
        self.keep(state)
        if found:
            yield pd.DataFrame(found, columns=[self.key, "tick_ms", "first"])

    def close(self) -> None:
        pass


def _millis(spark: Any, interval: str) -> int:
    return spark.sql(f"SELECT CAST(1000 * unix_seconds(timestamp_seconds(0) + INTERVAL {interval}) AS BIGINT)").first()[0]


def absent(events: DataFrame, wanted: Column, key: str, range_: str, step: str, late: str = "10 minutes", each: bool = True, beats: DataFrame | None = None, watched: DataFrame | None = None) -> DataFrame:
    """key, tick, first: the absent ticks of each key of a stream of events (ts), and whether the tick begins a silence. each=False gives those alone.

    late: the watermark's delay. watched: (key, ts), the keys that are to speak and since when. The range must be a multiple of the step. The state
    store must be RocksDB's (`keyed.STORE`)."""
    spark, kind = events.sparkSession, dict(events.dtypes)[key]
    step_ms, range_ms = _millis(spark, step), _millis(spark, range_)
    if step_ms <= 0 or range_ms <= 0 or range_ms % step_ms:
        raise ValueError(f"the range {range_} is no multiple of the step {step}")
    at_step = F.floor(F.unix_millis("ts") / F.lit(step_ms)).alias("at_step")
    rows = events.select(F.col("ts").cast("timestamp").alias("ts"), F.col(key), F.coalesce(wanted, F.lit(False)).alias("wanted")).where("ts IS NOT NULL")
    if beats is not None:
        rows = rows.unionByName(beats.select(F.col("ts").cast("timestamp").alias("ts"), F.lit(None).cast(kind).alias(key), F.lit(False).alias("wanted")))
    rows = rows.withWatermark("ts", late).select("ts", key, "wanted", at_step)
    start = None
    if watched is not None:
        # A start within a step is the next one's.
        since = F.ceil(F.unix_millis(F.col("ts").cast("timestamp")) / F.lit(step_ms)).cast("long")
        start = watched.select(key, since.alias("start")).groupBy(key)
    found = rows.groupBy(key).transformWithStateInPandas(Absence(key, step_ms, range_ms // step_ms, each), f"`{key}` {kind}, tick_ms long, first boolean", "Append", "EventTime", initialState=start)
    return found.select(key, F.timestamp_millis("tick_ms").alias("tick"), "first")
