"""Trips of a stream by keyed state: for each (line, vehicle) what the rules of `trajectory` must remember, and nothing of the past besides.

A series' last two rows, whether candidates for spikes run up to them, the last row near a terminal with what lies behind it, and the anchor are one value of
state. A row is judged when its successor is known, so trips are those of a batch run over the same rows, however they are batched; the cost follows
the batch. With `idle` a timer judges the last row of a vehicle that has fallen silent without its successor, and after `forget` more its state goes;
a vehicle that comes back then begins a new series. `initial_state` makes the state, and the trips so far, of a history.

Rows that are not after the last one of their series are late and are left out. A group that fails later doesn't withdraw the trips that it gave before.
Places that are NaN count as missing. The state store must be RocksDB's (`STORE`).
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from typing import Any, NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.columns import EARTH_M
from ..operators.trajectory import GROUP, materialised_rows

STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
ROW = ["ts", "ext", "lat", "long", "way", "f", "l", "meters", "circular"]
TRIP = "start_us long, end_us long, direction int, discrepancy boolean, is_circular boolean, distance_meters double, failed boolean"


class Row(NamedTuple):
    """A position: times in microseconds, whether it is near either terminal."""

    ts: int | None
    ext: int | None
    lat: float | None
    long: float | None
    way: int | None
    f: bool
    l: bool
    meters: float | None
    circular: bool

    @property
    def near(self) -> bool:
        return self.f or self.l

    @property
    def order(self) -> tuple:
        return tuple((x is not None, x or 0) for x in self[:4])


def metres(a: Row, b: Row) -> float | None:
    if None in (a.lat, a.long, b.lat, b.long):
        return None
    y, x = math.sin(math.radians(b.lat - a.lat) / 2), math.sin(math.radians(b.long - a.long) / 2)
    h = y * y + math.cos(math.radians(a.lat)) * math.cos(math.radians(b.lat)) * x * x
    return 2 * EARTH_M * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h)))


def kmh(a: Row, b: Row) -> float | None:
    far = metres(a, b)
    if far is None or a.ts is None or b.ts is None or b.ts <= a.ts:
        return None
    return far / ((b.ts - a.ts) / 1e6) * 3.6


@dataclass
class Series:
    """The state of one series. `last` is judged when its successor comes, or was judged without (`judged`)."""

    last: Row | None = None
    before: Row | None = None
    run: int = 0
    judged: bool = False
    circular: bool | None = None
    gate: bool = False
    trips: int = 0
    failed: bool = False
    late: int = 0
    timer: int | None = None
    # Between terminals: the last row near one, its zone (1: first stop, 0: last stop), the rows since, and their directions' number, sum and squares.
    near: Row | None = None
    zone: int | None = None
    rows: int = 0
    n: int = 0
    s: int = 0
    q: int = 0
    # Round trips: the row where the trip began, and the last one.
    anchor: Row | None = None
    prior: Row | None = None

    @classmethod
    def of(cls, text: str) -> Series:
        held = json.loads(text)
        return cls(**held | {k: Row(*held[k]) for k in ("last", "before", "near", "anchor", "prior") if held[k] is not None})

    def text(self) -> str:
        return json.dumps(asdict(self))

    def feed(self, row: Row, limit: float) -> Iterator[tuple]:
        """The trips that a row brings to light, which are those that end before it."""
        if self.last is not None and row.order <= self.last.order:
            self.late += 1
            return
        if self.last is not None:
            if not self.judged:
                speeds = [kmh(*x) for x in ((self.before, self.last), (self.last, row), (self.before, row))] if self.before else [None]
                jumps = None not in speeds and speeds[0] > limit and speeds[1] > limit and speeds[2] <= limit
                # Of candidates in a row every other one is a spike, from the first.
                self.run = self.run + 1 if jumps else 0
                if self.run % 2 == 0:
                    yield from self.accept(self.last)
            else:
                self.run = 0
            self.before = self.last
        self.last, self.judged = row, False

    def close(self) -> Iterator[tuple]:
        """The trips that end on the last row, should it have no successor."""
        if self.last is not None and not self.judged:
            self.judged = True
            yield from self.accept(self.last)

    def accept(self, row: Row) -> Iterator[tuple]:
        if self.circular is None:
            self.circular, self.gate = row.circular, row.near
        found = self.round_trip(row) if self.circular else self.one_way(row)
        if found:
            yield (*found, self.failed)

    def one_way(self, row: Row) -> tuple | None:
        if not row.near:
            self.rows += 1
            if row.way is not None:
                self.n, self.s, self.q = self.n + 1, self.s + row.way, self.q + row.way * row.way
            return None
        gap, zone, found = self.near is not None and self.rows > 0, self.zone, None
        if row.f != row.l:
            zone = int(row.f)
        elif gap and zone is not None:
            zone = 1 - zone
        if gap and None not in (zone, self.zone) and zone != self.zone:
            self.trips += 1
            way = 1 if self.zone == 1 else 2
            if self.gate or self.trips > 1:
                alike = self.n > 0 and self.n * self.q == self.s * self.s and self.s != way * self.n
                self.failed |= not self.near.meters
                found = self.near.ts, row.ts, way, alike, False, self.near.meters
        self.near, self.zone, self.rows, self.n, self.s, self.q = row, zone, 0, 0, 0, 0
        return found

    def round_trip(self, row: Row) -> tuple | None:
        if self.anchor is None:
            if row.near:
                self.anchor = self.prior = row
            return None
        prior, turned, found = self.prior, row.way != self.prior.way, None
        if not prior.near and (turned or row.near):
            end = prior if turned else row
            found = self.anchor.ts, end.ts, prior.way if turned else row.way, False, True, metres(self.anchor, end)
        if row.near or turned:
            self.anchor = row
        self.prior = row
        return found


def rows_of(frame: pd.DataFrame) -> list[Row]:
    """Rows of a batch in the order of their series."""
    plain = frame[ROW].astype(object).where(frame[ROW].notna(), None)
    rows = [Row(*(None if x[k] is None else int(x[k]) for k in (0, 1)), *x[2:4], None if x[4] is None else int(x[4]), bool(x[5]), bool(x[6]), x[7], bool(x[8])) for x in plain.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: r.order)


class Trips(StatefulProcessor):
    """Rows of a series to its trips. limit: km/h; idle, forget: milliseconds of event time, or None for no timers."""

    def __init__(self, limit: float = 120.0, idle: int | None = None, forget: int = 86_400_000):
        self.limit, self.idle, self.forget = limit, idle, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("series", "state string")

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        series = Series.of(initialState["state"].iloc[0])
        self.wait(series)
        self.value.update((series.text(),))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        series = Series.of(self.value.get()[0]) if self.value.exists() else Series()
        found = [t for r in rows_of(pd.concat(list(rows), ignore_index=True)) for t in series.feed(r, self.limit)]
        self.wait(series)
        self.value.update((series.text(),))
        yield from framed(key, found)

    def wait(self, series: Series) -> None:
        """One timer for each series, after its last row: `idle` until that is judged, then `forget`."""
        if self.idle is None or series.last is None or series.last.ts is None:
            return
        due = series.last.ts // 1000 + self.idle + (self.forget if series.judged else 0)
        if series.timer != due:
            if series.timer is not None:
                self.handle.deleteTimer(series.timer)
            self.handle.registerTimer(due)
            series.timer = due

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if not self.value.exists():
            return
        series = Series.of(self.value.get()[0])
        series.timer = None
        if series.judged:
            self.value.clear()
            return
        found = list(series.close())
        self.wait(series)
        self.value.update((series.text(),))
        yield from framed(key, found)

    def close(self) -> None:
        pass


NAMES = [*GROUP, *(c.split()[0] for c in TRIP.split(", "))]


def framed(key: tuple, found: list[tuple]) -> Iterator[pd.DataFrame]:
    if found:
        yield pd.DataFrame([(*key, *t) for t in found], columns=NAMES).astype({"direction": "Int32", "distance_meters": "float64"})


def _inputs(positions: DataFrame, radius: float) -> list[Column]:
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    near = [F.coalesce(F.col(c) < radius, F.lit(False)) for c in ("distance_to_first_stop", "distance_to_last_stop")]
    values = [micros("veiculo_ts"), micros("extracao_ts"), F.col("veiculo_lat"), F.col("veiculo_long"), F.col("linha_sentido"), *near, F.col("trip_linear_distance"), F.coalesce("is_circular", F.lit(False))]
    return [*GROUP, *(v.alias(n) for v, n in zip(values, ROW, strict=True))]


def _schema(positions: DataFrame, rest: str) -> str:
    kinds = dict(positions.dtypes)
    return ", ".join([*(f"{c} {kinds[c]}" for c in GROUP), rest])


def _timed(trips: DataFrame, kind: str) -> DataFrame:
    """Trips with times of the positions' own type."""
    times = [F.timestamp_micros(f"{c}_us").cast(kind).alias(f"{c}_ts") for c in ("start", "end")]
    return trips.select(*GROUP, *times, "direction", "discrepancy", "is_circular", "distance_meters", "failed")


def detected(positions: DataFrame, radius: float = 100.0, limit: float = 120.0, late: str = "10 minutes", idle: int | None = None, forget: int = 86_400_000, initial: DataFrame | None = None) -> DataFrame:
    """A stream of flat positions to trips as of trajectory.detected, and whether their group has failed so far.

    initial: linha_lt, veiculo_id, state, as of `initial_state`. With `idle` (milliseconds) time is that of the rows, with `late` as the watermark."""
    kind, rows = dict(positions.dtypes)["veiculo_ts"], positions.select(*_inputs(positions, radius))
    if idle is not None:
        rows = rows.withColumn("at", F.timestamp_micros("ts")).withWatermark("at", late)
    start = initial.groupBy(*GROUP) if initial is not None else None
    found = rows.groupBy(*GROUP).transformWithStateInPandas(Trips(limit, idle, forget), _schema(positions, TRIP), "Append", "None" if idle is None else "EventTime", initialState=start)
    return _timed(found, kind)


def finished_trips(positions: DataFrame, **how: Any) -> DataFrame:
    """A stream of positions to the trips that count, as of trajectory.finished_trips."""
    found = detected(positions, **how)
    return materialised_rows(found, F.col("failed")).where("left_out IS NULL").drop("left_out")


def initial_state(positions: DataFrame, radius: float = 100.0, limit: float = 120.0, segment_rows: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """(state, trips) of a history: what `detected` begins with, and the trips that it will not give again, as of trajectory.detected.

    Series pass one row after another in their order, so a long one takes no more memory than a short one."""
    kind, schema = dict(positions.dtypes)["veiculo_ts"], _schema(positions, f"{TRIP}, state string")
    rows = positions.select(*_inputs(positions, radius)).repartition(*GROUP).sortWithinPartitions(*GROUP, "ts", "ext", "lat", "long")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, series, out = None, Series(), []

        def put() -> Iterator[pd.DataFrame]:
            yield pd.DataFrame(out, columns=[*NAMES, "state"]).astype({"start_us": "Int64", "end_us": "Int64", "direction": "Int32", "distance_meters": "float64"})
            out.clear()

        blank = (None,) * (len(NAMES) - len(GROUP))
        for frame in batches:
            keys = [tuple(None if pd.isna(x) else x for x in k) for k in frame[GROUP].astype(object).itertuples(index=False, name=None)]
            edges = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for a, b in zip(edges, edges[1:], strict=False):
                if keys[a] != key:
                    if key is not None:
                        out.append((*key, *blank, series.text()))
                    key, series = keys[a], Series()
                out += [(*key, *t, None) for r in rows_of(frame.iloc[a:b]) for t in series.feed(r, limit)]
            if len(out) > segment_rows:
                yield from put()
        if key is not None:
            out.append((*key, *blank, series.text()))
            yield from put()

    made = rows.mapInPandas(run, schema)
    return made.where("state IS NOT NULL").select(*GROUP, "state"), _timed(made.where("state IS NULL"), kind)
