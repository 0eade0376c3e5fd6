"""Detectors and sanitizer on scenarios, and against a sequential model on random series."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from busmill.operators import trajectory

SCHEMA = "linha_lt string, veiculo_id long, veiculo_ts timestamp, extracao_ts timestamp, linha_sentido int, is_circular boolean, veiculo_lat double, veiculo_long double, distance_to_first_stop double, distance_to_last_stop double, trip_linear_distance double"
T0 = datetime(2024, 1, 1)


def series(spark, zones: str, directions: str | None = None, circular: bool = False, vehicle: int = 1, step: int = 600, linear: float | None = 5000.0):
    """zones: f, l, b (both) or - (between), a row every `step` seconds."""
    rows = []
    for i, z in enumerate(zones):
        at = T0 + timedelta(seconds=step * i)
        rows.append(("10", vehicle, at, at, int(directions[i]) if directions else 1, circular, -23.5, -46.6 + i * 1e-4, 50.0 if z in "fb" else 900.0, 50.0 if z in "lb" else 900.0, linear))
    return spark.createDataFrame(rows, SCHEMA)


def index(rows, step=600):
    place = lambda t: int((t - T0).total_seconds()) // step
    return sorted((place(r.start_ts), place(r.end_ts), r.direction) for r in rows)


@pytest.mark.parametrize(
    "zones, trips",
    [
        ("fff", []),  # never leaves
        ("ff--", []),  # leaves only
        ("--l--f", []),  # begins on the way: the first trip doesn't count
        ("--l--f--l", [(5, 8, 1)]),
        ("f--l--f", [(0, 3, 1), (3, 6, 2)]),
        ("ff-ll-f", [(1, 3, 1), (4, 6, 2)]),  # dwelling is left out
        ("fl", []),  # from stop to stop without a row between
        ("f--f-l", [(3, 5, 1)]),  # turned back
        ("f-b-l", [(0, 2, 1)]),  # a row in both radii counts as the other end after a gap
    ],
)
def test_non_circular(spark, zones, trips):
    found = index(trajectory.non_circular(series(spark, zones)).collect())
    assert found == trips == model_non_circular(zones)


def test_discrepancy(spark):
    rows = trajectory.non_circular(series(spark, "f--l", "1221")).collect()
    assert [r.discrepancy for r in rows] == [True]
    assert [r.discrepancy for r in trajectory.non_circular(series(spark, "f--l", "1211")).collect()] == [False]


@pytest.mark.parametrize("zones, directions, trips", [("f--f", "1111", [(0, 3, 1)]), ("-f-f", "1111", [(1, 3, 1)]), ("ff-f", "1111", [(1, 3, 1)]), ("f-----f", "1112222", [(0, 2, 1), (3, 6, 2)])])
def test_circular(spark, zones, directions, trips):
    assert index(trajectory.circular(series(spark, zones, directions, circular=True)).collect()) == trips


def model_non_circular(zones: str) -> list[tuple[int, int, int]]:
    """One row at a time."""
    out, zone, last, gap = [], None, None, False
    for i, z in enumerate(zones):
        if z == "-":
            gap = True
            continue
        if zone is None:
            if z == "b":
                gap = False
                last = i
                continue
            zone = z
        else:
            now = z if z != "b" else ("l" if zone == "f" else "f") if gap else zone
            if gap and now != zone:
                out.append((last, i, 1 if zone == "f" else 2))
            zone = now
        last, gap = i, False
    return out if zones[:1] in ("f", "l", "b") else out[1:]


def model_circular(zones: str, directions: str) -> list[tuple[int, int, int]]:
    out, start = [], None
    for i, (z, s) in enumerate(zip(zones, directions, strict=True)):
        at = z != "-"
        if start is None:
            start = i if at else None
            continue
        turned = s != directions[i - 1]
        if zones[i - 1] == "-":
            if turned:
                out.append((start, i - 1, int(directions[i - 1])))
            elif at:
                out.append((start, i, int(s)))
        if at or turned:
            start = i
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.sampled_from("flb--"), st.sampled_from("12")), min_size=1, max_size=14), min_size=8, max_size=12))
def test_against_model(spark, many):
    for circular in (False, True):
        frames = None
        for v, rows in enumerate(many):
            df = series(spark, "".join(z for z, _ in rows), "".join(s for _, s in rows), circular, v)
            frames = df if frames is None else frames.unionByName(df)
        detect = trajectory.circular if circular else trajectory.non_circular
        found = detect(frames).collect()
        for v, rows in enumerate(many):
            zones, directions = "".join(z for z, _ in rows), "".join(s for _, s in rows)
            expected = model_circular(zones, directions) if circular else model_non_circular(zones)
            assert index([r for r in found if r.veiculo_id == v]) == sorted(expected), (circular, zones, directions)


def places(spark, lats, seconds=10):
    rows = [("10", 1, T0 + timedelta(seconds=seconds * i), T0, 1, False, lat, -46.6, 900.0, 900.0, 1.0) for i, lat in enumerate(lats)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("lats, spikes", [([0.0, 1.0], 0), ([0.0, 1.0, 0.0], 1), ([0.0, 0.0001, 0.0002], 0), ([0.0, 1.0, 2.0, 0.0], 0), ([0.0, 1.0, 0.0, 1.0, 0.0], 2), ([0.0, None, 0.0], 0)])
def test_sanitizer(spark, lats, spikes):
    assert trajectory.with_spikes(places(spark, lats)).where("spike").count() == spikes


def test_no_time_no_spike(spark):
    assert trajectory.with_spikes(places(spark, [0.0, 1.0, 0.0], seconds=0)).where("spike").count() == 0


def test_materialised(spark):
    trips = trajectory.materialised(trajectory.non_circular(series(spark, "f--l"))).collect()
    assert [(t.trip_id, t.duration_seconds, t.distance_meters, round(t.avg_speed_kmh, 3), t.left_out) for t in trips] == [("10-0", 1800, 5000.0, 10.0, None)]
    assert [t.left_out for t in trajectory.materialised(trajectory.non_circular(series(spark, "f--l", linear=None))).collect()] == ["group_failed"]
    assert [t.left_out for t in trajectory.materialised(trajectory.non_circular(series(spark, "f--l", linear=40_001.0))).collect()] == ["too_fast"]
    assert [t.left_out for t in trajectory.materialised(trajectory.non_circular(series(spark, "f--l", linear=40_000.0))).collect()] == [None]


def test_one_exchange(spark, tmp_path):
    path = str(tmp_path / "p")
    series(spark, "f--l").write.parquet(path)
    plan = trajectory.non_circular(trajectory.sanitize(spark.read.parquet(path)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_both_kinds_in_one_sort(spark, tmp_path):
    path = str(tmp_path / "p")
    series(spark, "f--l").unionByName(series(spark, "f--f", circular=True, vehicle=2)).write.parquet(path)
    trips = trajectory.finished_trips(spark.read.parquet(path))
    plan = trips._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1 and plan.count("FileScan") == 1
    assert sorted((t.vehicle_id, t.is_circular) for t in trips.collect()) == [(1, False), (2, True)]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.sampled_from("flb--"), st.sampled_from("12")), min_size=1, max_size=14), min_size=8, max_size=12))
def test_both_kinds_against_models(spark, many):
    frames = None
    for v, rows in enumerate(many):
        df = series(spark, "".join(z for z, _ in rows), "".join(s for _, s in rows), v % 2 == 0, v)
        frames = df if frames is None else frames.unionByName(df)
    found = trajectory.detected(frames).collect()
    for v, rows in enumerate(many):
        zones, directions = "".join(z for z, _ in rows), "".join(s for _, s in rows)
        expected = model_circular(zones, directions) if v % 2 == 0 else model_non_circular(zones)
        mine = [r for r in found if r.veiculo_id == v]
        assert index(mine) == sorted(expected), (zones, directions)
        for r in mine if v % 2 else []:
            a, b, way = index([r])[0]
            told = {s for z, s in zip(zones[a + 1 : b], directions[a + 1 : b], strict=True) if z == "-"}
            assert r.discrepancy == (len(told) == 1 and told != {str(way)})


def test_metrics_of_nothing(spark):
    row = trajectory.extraction_metrics(series(spark, "f").limit(0)).first()
    assert row.positions == 0 and row.trips_total == 0
