"""Trips by keyed state: any batching gives the trips of one batch run; restarts, backfills, idle vehicles."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from busmill.operators import trajectory
from busmill.streaming import keyed
from test_segments import T0, random_series, told
from test_trajectory import SCHEMA, series


@pytest.fixture
def store(spark):
    for k, v in keyed.STORE.items():
        spark.conf.set(k, v)
    yield
    for k in keyed.STORE:
        spark.conf.unset(k)


def landed(spark, path, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/{name}")


def stream_of(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path)


def ran(df, target, checkpoint):
    df.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def cut_anywhere(rng, rows):
    """Rows of many series, dealt to batches so that each series keeps its order."""
    parts = [[] for _ in range(3)]
    for v in {r[1] for r in rows}:
        own = sorted({(r[2], r[3], r[6] is not None, r[6] or 0, r[7]): r for r in rows if r[1] == v}.items())
        ends = [0, *sorted(rng.choices(range(len(own) + 1), k=2)), len(own)]
        for p, a, b in zip(parts, ends, ends[1:], strict=False):
            p += [r for _, r in own[a:b]]
    for p in parts:
        rng.shuffle(p)
    return parts


def closing(rows, vehicles):
    """A row far behind each series, so that the last one has a successor."""
    end = max(r[2] for r in rows) + timedelta(days=400)
    return [("10", v, end, end, 9, False, None, -46.6, None, None, 5000.0) for v in vehicles]


def test_any_batching_is_one_batch(spark, store, tmp_path):
    rng = random.Random(4)
    rows = [r for v in range(250) for r in random_series(rng, v)]
    parts = cut_anywhere(rng, rows)
    kept = [r for p in parts for r in p]
    for k, p in enumerate(parts):
        landed(spark, f"{tmp_path}/in", p, f"part={k}")
    found = keyed.detected(stream_of(spark, f"{tmp_path}/in"))
    ran(found, f"{tmp_path}/out", f"{tmp_path}/ck")
    # A restart goes on from the checkpoint.
    landed(spark, f"{tmp_path}/in", closing(kept, {r[1] for r in kept}), "part=9")
    ran(keyed.detected(stream_of(spark, f"{tmp_path}/in")), f"{tmp_path}/out", f"{tmp_path}/ck")
    batch = trajectory.detected(trajectory.sanitize(spark.createDataFrame(kept, SCHEMA)))
    expected = told(batch)
    assert told(spark.read.parquet(f"{tmp_path}/out")) == expected and len(expected) > 150


def test_a_backfill_is_the_initial_state(spark, store, tmp_path):
    rng = random.Random(5)
    rows = [r for v in range(150) for r in random_series(rng, v)]
    first, second, third = cut_anywhere(rng, rows)
    history = spark.createDataFrame(first, SCHEMA)
    state, before = keyed.initial_state(history)
    state.write.parquet(f"{tmp_path}/state")
    assert spark.read.parquet(f"{tmp_path}/state").count() == len({r[1] for r in first})
    kept = first + second + third
    for k, p in enumerate((second, third, closing(kept, {r[1] for r in kept}))):
        landed(spark, f"{tmp_path}/in", p, f"part={k}")
    ran(keyed.detected(stream_of(spark, f"{tmp_path}/in"), initial=spark.read.parquet(f"{tmp_path}/state")), f"{tmp_path}/out", f"{tmp_path}/ck")
    expected = told(trajectory.detected(trajectory.sanitize(spark.createDataFrame(kept, SCHEMA))))
    assert sorted(told(before) + told(spark.read.parquet(f"{tmp_path}/out")), key=repr) == expected


def test_idle_vehicles(spark, store, tmp_path):
    """A silent vehicle's last row is judged without a successor, once; later its state goes, and it begins anew."""
    silent = series(spark, "f--l")
    other = lambda day: series(spark, "-", vehicle=2).withColumns({c: F.lit(T0 + timedelta(days=day)) for c in ("veiculo_ts", "extracao_ts")})
    back = series(spark, "-f--l").withColumns({c: F.col(c) + F.expr("interval 5 days") for c in ("veiculo_ts", "extracao_ts")})
    for k, df in enumerate((silent, other(1), other(2), other(3), back, other(8), other(9))):
        df.coalesce(1).write.parquet(f"{tmp_path}/in/part={k}")
        ran(keyed.finished_trips(stream_of(spark, f"{tmp_path}/in"), idle=3_600_000, forget=3_600_000), f"{tmp_path}/out", f"{tmp_path}/ck")
    found = spark.read.parquet(f"{tmp_path}/out").collect()
    # The series that came back begins on the way, so its first trip doesn't count.
    assert [(r.vehicle_id, str(r.trip_end_time), r.direction) for r in found] == [(1, str(T0 + timedelta(seconds=1800)), 1)]


def test_late_rows_are_left_out():
    row = lambda t: keyed.Row(t, t, 0.0, 0.0, 1, True, False, 1.0, False)
    one = keyed.Series()
    for t in (5, 3, 5, 7):
        list(one.feed(row(t), 120.0))
    assert (one.late, one.last.ts, one.before.ts) == (2, 7, 5)
    again = keyed.Series.of(one.text())
    assert again == one
