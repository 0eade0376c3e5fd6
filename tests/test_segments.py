"""The segmented scan against the whole one, on random series cut anywhere, and its plan."""

import random
from datetime import datetime, timedelta

import pytest

from busmill.operators import segments, trajectory
from busmill.plans import fixtures
from conftest import DATA
from test_trajectory import SCHEMA

T0 = datetime(2024, 1, 1)
COLUMNS = ["linha_lt", "veiculo_id", "start_ts", "end_ts", "direction", "discrepancy", "is_circular", "distance_meters"]


def random_series(rng, vehicle):
    """Dwelling, gaps, rows near both ends, jumps, missing places; a few days of a few rows."""
    at, lat, out = T0 + timedelta(hours=rng.randrange(30)), 0.0, []
    circular, density = rng.random() < 0.4, rng.random()
    for _ in range(rng.randrange(1, 26)):
        at += timedelta(seconds=rng.choice([0, 5, 10, 10, 10, 3600, 40_000, 90_000]))
        lat += rng.choice([0.0, 1e-4, 1e-4, 1.0, -1.0])
        z = rng.choice("flb") if rng.random() < density else "-"
        place = None if rng.random() < 0.03 else lat
        out.append(("10", vehicle, at, at, rng.choice([1, 2, 2, None]), circular, place, -46.6 + len(out) * 1e-7, 50.0 if z in "fb" else 900.0, 50.0 if z in "lb" else None, 5000.0))
    return out


def told(df):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("segment", [segments.DAY, "date_trunc('hour', veiculo_ts)", "veiculo_ts", "year(veiculo_ts)"])
def test_wherever_series_are_cut(spark, tmp_path, segment):
    rng = random.Random(9)
    rows = [r for v in range(3000) for r in random_series(rng, v)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/p")
    positions = spark.read.parquet(f"{tmp_path}/p")
    assert sorted(r.veiculo_id for r in segments.with_spikes(segments.cut(positions, segment)).where("spike").collect()) == sorted(r.veiculo_id for r in trajectory.with_spikes(positions).where("spike").collect())
    whole = told(trajectory.detected(trajectory.sanitize(positions)))
    assert told(segments.trips(positions, segment)) == whole and len(whole) > 2000


@pytest.mark.parametrize("most", [3, 12])
def test_long_series_alone_are_cut(spark, tmp_path, most):
    """Series around the bound, some without a time; segments hold whole days and are about as few as the rows ask for."""
    rng = random.Random(most)
    rows = [r for v in range(800) for r in random_series(rng, v)]
    rows += [(r[0], None if r[1] % 50 == 0 else r[1], None if i % 200 == 0 else r[2], *r[3:]) for i, r in enumerate(r for v in range(800, 900) for r in random_series(rng, v))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/p")
    positions = spark.read.parquet(f"{tmp_path}/p")
    assert told(segments.trips_by_size(positions, most=most)) == told(trajectory.detected(trajectory.sanitize(positions)))
    short, long = segments.by_size(positions, most)
    sizes = {}
    for r in rows:
        sizes[r[:2]] = sizes.get(r[:2], 0) + 1
    assert short.count() == sum(n for n in sizes.values() if n <= most) and short.count() + long.count() == len(rows)
    cuts = long.groupBy(segments.KEY).count().collect()
    assert len(cuts) <= sum(n // most + 3 for n in sizes.values() if n > most)


def test_short_series_are_no_segments(spark):
    """A segment a day made almost as many summaries as rows."""
    rows = fixtures.positions(spark, DATA)
    assert segments.by_size(rows)[1].count() == 0
    before = segments.cut(rows).select(segments.KEY).distinct().count()
    assert before * 5 > rows.count()


def test_tables_and_missing_keys(spark):
    rows = fixtures.positions(spark, DATA, near=True)
    assert told(segments.trips(rows)) == told(trajectory.detected(trajectory.sanitize(rows)))
    none = rows.selectExpr("* EXCEPT (linha_lt, veiculo_ts)", "CAST(NULL AS string) AS linha_lt", "if(event_id % 50 = 0, NULL, veiculo_ts) AS veiculo_ts")
    assert told(segments.trips(none)) == told(trajectory.detected(trajectory.sanitize(none)))
    assert told(segments.trips(rows.limit(0))) == []


def test_rows_are_sorted_by_segment(spark, tmp_path):
    """No task sorts rows of more than one day of a series, and rows are shuffled once: what is sorted by series are summaries."""
    spark.createDataFrame(random_series(random.Random(1), 1), SCHEMA).write.parquet(f"{tmp_path}/p")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = segments.trips(spark.read.parquet(f"{tmp_path}/p"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Python" not in plan
    by_row = [x for x in plan.splitlines() if "Exchange hashpartitioning(_key#" in x]
    assert by_row and not [x for x in plan.splitlines() if "Exchange hashpartitioning(linha_lt" in x or "Exchange hashpartitioning(veiculo_id" in x]
