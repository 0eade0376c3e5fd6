"""Sliding windows over structured log events: rates, values, ratios, absence and alerts.

The functions that take windows work on batch and streaming frames alike; a stream needs withWatermark first.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

LINE = r"^[^{]*(\{.*\})\s*$"


def parsed(lines: DataFrame, schema: str) -> DataFrame:
    """lines: value. Events out of log lines with any prefix."""
    return lines.select(F.from_json(F.regexp_extract("value", LINE, 1), schema).alias("e")).where("e IS NOT NULL").select("e.*")


def windows(events: DataFrame, range_: str, step: str, ts: str = "ts") -> Column:
    at = F.col(ts)  # a cast would lose a stream's watermark
    return F.window(at if dict(events.dtypes)[ts] == "timestamp" else at.cast("timestamp"), range_, step)


def rate(events: DataFrame, range_: str, step: str, by: list[str] | None = None) -> DataFrame:
    """Events of each sliding window."""
    rows = events.groupBy(windows(events, range_, step).alias("w"), *(by or [])).agg(F.count("*").alias("n"))
    return rows.select(F.col("w.end").alias("tick"), *(by or []), "n")


def over_time(events: DataFrame, range_: str, step: str, by: list[str] | None = None, value: str = "value") -> DataFrame:
    """Mean, maximum, sum and last value of each sliding window."""
    v = F.col(value)
    rows = events.groupBy(windows(events, range_, step).alias("w"), *(by or [])).agg(F.avg(v).alias("avg_value"), F.max(v).alias("max_value"), F.sum(v).alias("sum_value"), F.max_by(v, F.struct("ts", "event_id")).alias("last_value"))
    return rows.select(F.col("w.end").alias("tick"), *(by or []), "avg_value", "max_value", "sum_value", "last_value")


def ratio(events: DataFrame, accepted: Column, total: Column, range_: str, step: str, below: float, scale: float = 1.0) -> DataFrame:
    """Windows in which the accepted events' values, in units of `scale`, are less than a share of all."""
    rows = events.groupBy(windows(events, range_, step).alias("w")).agg(F.sum(F.when(accepted, F.col("value"))).alias("a"), F.sum(F.when(total, F.col("value"))).alias("b"))
    share = F.coalesce(F.col("a"), F.lit(0.0)) / F.nullif(F.col("b"), F.lit(0)) * scale
    return rows.select(F.col("w.end").alias("tick"), share.alias("ratio")).where(F.col("ratio") < below)


def absent(events: DataFrame, wanted: Column, range_: str, step: str, start: str, end: str) -> DataFrame:
    """Ticks between start and end before which, within the range, no wanted event came."""
    spark = events.sparkSession
    ticks = spark.range(1).select(F.explode(F.expr(f"sequence(timestamp'{start}', timestamp'{end}', interval {step})")).alias("tick"))
    seen = events.where(wanted).select(windows(events, range_, step).alias("w")).select(F.col("w.end").alias("tick")).distinct()
    return ticks.join(seen, "tick", "left_anti")


def alerts_by(events: DataFrame, key: str, first: Column, second: Column, range_: str, step: str, least: int = 1) -> DataFrame:
    """Windows and keys with events of either condition."""
    rows = events.groupBy(windows(events, range_, step).alias("w"), key).agg(F.count_if(first).alias("n_first"), F.count_if(second).alias("n_second"))
    return rows.where((F.col("n_first") >= least) | (F.col("n_second") >= least)).select(F.col("w.end").alias("tick"), key, "n_first", "n_second")


def threshold(events: DataFrame, range_: str, step: str, above: float, by: list[str] | None = None) -> DataFrame:
    """Windows whose maximum is above a threshold."""
    return over_time(events, range_, step, by).where(F.col("max_value") > above)


def listing(events: DataFrame, names: list[str], pattern: str | None = None, column: str = "event_type") -> DataFrame:
    """Events of a set, newest first."""
    rows = events.where(F.col(column).isin(*names))
    rows = rows if pattern is None else rows.where(F.col(column).rlike(pattern))
    return rows.orderBy(F.desc("ts"), F.desc("event_id"))


def phase_rows(progress: list[dict]) -> list[tuple[str, str, float]]:
    """(batch, phase, seconds) out of StreamingQueryProgress dictionaries."""
    return [(str(p["batchId"]), phase, ms / 1000) for p in progress for phase, ms in sorted(p.get("durationMs", {}).items())]


PHASES = "execution string, phase string, seconds double, status string"


class Phases:
    """The phases of a run, one after another: `with phases(name)` times one. Those that aren't reached are skipped."""

    def __init__(self, names: list[str]):
        self.told = dict.fromkeys(names, (0.0, "skipped"))
        self.failed: str | None = None

    @contextmanager
    def __call__(self, name: str) -> Iterator[None]:
        began, status = time.monotonic(), "failed"
        try:
            yield
            status = "ok"
        finally:
            self.told[name] = time.monotonic() - began, status
            self.failed = name if status == "failed" else self.failed

    def rows(self, execution: str) -> list[tuple[str, str, float, str]]:
        return [(execution, phase, seconds, status) for phase, (seconds, status) in self.told.items()]


class PhaseListener(StreamingQueryListener):
    """Gives `sink` rows of PHASES for the phases of each batch of the session's streams, and one when a query breaks."""

    def __init__(self, sink: Callable[[list[tuple[str, str, float, str]]], None]):
        self.sink = sink

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        progress = json.loads(event.progress.json)
        self.sink([(f"{progress['id']}-{batch}", phase, seconds, "ok") for batch, phase, seconds in phase_rows([progress])])

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        if event.exception:
            self.sink([(str(event.id), "query", 0.0, "failed")])
