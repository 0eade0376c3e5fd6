"""The live table against its batch form: late rows, idle vehicles, replays, restarts, readers on one bucket, files that don't pile up."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from busmill.plans import fixtures
from busmill.streaming import live
from conftest import DATA

T0 = datetime(2024, 1, 1)
SCHEMA = "veiculo_id long, veiculo_ts timestamp_ntz, extracao_ts timestamp_ntz, veiculo_lat double, veiculo_long double, linha_lt string, linha_sentido int"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def batches(rng, n, size):
    """Rows in the order of extraction; some late by hours, some at one time, some without a time or a vehicle."""
    for k in range(n):
        yield [
            (
                rng.choice([None, *range(12)]), None if rng.random() < 0.05 else at(30 * k + rng.randrange(30) - rng.choice([0, 0, 0, 90, 400])), at(30 * k + 30), rng.choice([None, -23.5, -23.6]), -46.6,
                rng.choice(["10-10", "20-10", None]), rng.choice([1, 2]),
            )
            for _ in range(rng.randrange(size))
        ]


def by_hand(rows, keep):
    """The live rows, one at a time."""
    rank = lambda v: (v is not None, v if v is not None else 0)
    best = {}
    for r in rows:
        if r[1] is not None and (r[0] not in best or [rank(v) for v in r[1:]] > [rank(v) for v in best[r[0]][1:]]):
            best[r[0]] = r
    clock = max((r[2] for r in rows), default=T0)
    return {r for r in best.values() if r[1] >= clock - timedelta(minutes=keep)}


def names(path, column):
    return sorted(int(p.name.partition("=")[2]) for p in Path(path).iterdir() if p.name.startswith(f"{column}="))


def test_every_batch_and_replays(spark, tmp_path):
    rng, target, so_far = random.Random(3), f"{tmp_path}/live", []
    schema = spark.createDataFrame([], SCHEMA).schema
    for k, rows in enumerate(batches(rng, 9, 14)):
        so_far += rows
        frame = spark.createDataFrame(rows, SCHEMA)
        for _ in range(1 + k % 2):  # every other batch comes twice
            live.upsert(frame, k, target, "60 minutes", 4, every=3)
        found = [tuple(r) for r in live.live(spark, target, schema, "60 minutes").collect()]
        assert set(found) == by_hand(so_far, 60) and len(found) == len(set(r[0] for r in found))
        assert set(found) == {tuple(r) for r in live.standing(spark.createDataFrame(so_far, SCHEMA), "60 minutes").collect()}
    # Versions 2, 5 and 8 were written; the one before the last is left for readers.
    assert names(target, "version") == [5, 8] and names(f"{target}.changes", "batch") == [6, 7, 8] and names(f"{target}.lines", "batch") == [5, 6, 7, 8]
    # A batch long done, as after a lost checkpoint's last entry.
    live.upsert(spark.createDataFrame([(1, at(10_000), at(10_000), 0.0, 0.0, "x", 1)], SCHEMA), 8, target, "60 minutes", 4, every=3)
    assert {tuple(r) for r in live.live(spark, target, schema, "60 minutes").collect()} == by_hand(so_far, 60)


def test_a_batch_that_breaks_is_not_seen(spark, tmp_path, monkeypatch):
    target, schema = f"{tmp_path}/live", spark.createDataFrame([], SCHEMA).schema
    row = lambda m, lat: (1, at(m), at(m), lat, 0.0, "10-10", 1)
    live.upsert(spark.createDataFrame([row(0, 1.0)], SCHEMA), 0, target, every=1)
    real = live.loads.replace_batch

    def broken(rows, path, *more, **named):
        if path.endswith(".lines"):
            raise OSError("lost")
        real(rows, path, *more, **named)

    monkeypatch.setattr(live.loads, "replace_batch", broken)
    with pytest.raises(OSError, match="lost"):
        live.upsert(spark.createDataFrame([row(5, 2.0), (2, at(5), at(5), 0.0, 0.0, "10-10", 1)], SCHEMA), 1, target, every=1)
    assert [(r.veiculo_id, r.veiculo_lat) for r in live.live(spark, target, schema).collect()] == [(1, 1.0)]
    monkeypatch.undo()
    # Run again with fewer rows, as a source may give them after a restart: nothing of the first try is left.
    live.upsert(spark.createDataFrame([row(5, 3.0)], SCHEMA), 1, target, every=1)
    assert [(r.veiculo_id, r.veiculo_lat) for r in live.live(spark, target, schema).collect()] == [(1, 3.0)]


def test_nothing_yet_and_empty_batches(spark, tmp_path):
    target, empty = f"{tmp_path}/live", spark.createDataFrame([], SCHEMA)
    assert live.live(spark, target, empty.schema).count() == 0
    for k in range(3):
        live.upsert(empty, k, target, every=2)
    assert live.live(spark, target, empty.schema).count() == 0 and live.last_line(spark, target).batch == 2
    live.upsert(spark.createDataFrame([(7, at(0), None, 0.0, 0.0, "a", 1)], SCHEMA), 3, target, every=2)  # no clock: nobody leaves
    assert live.live(spark, target, empty.schema).count() == 1


def test_one_vehicle_reads_one_bucket(spark, tmp_path):
    target, schema = f"{tmp_path}/live", spark.createDataFrame([], SCHEMA).schema
    for k in range(3):
        live.upsert(spark.createDataFrame([(v, at(k), at(k), float(v), 0.0, "a", 1) for v in range(40)], SCHEMA), k, target, buckets=8, every=2)
    one = live.live(spark, target, schema, vehicle=5, buckets=8)
    assert [(r.veiculo_id, r.veiculo_ts) for r in one.collect()] == [(5, at(2))]
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = [part.split("]")[0] for part in plan.split("PartitionFilters: ")[1:]]
    assert len(filters) >= 2 and all("isnotnull(bucket#" in f for f in filters)  # of the version and of the changes; follows from the literal


def test_stream_with_a_restart(spark, tmp_path):
    rows = fixtures.positions(spark, DATA)
    parts = [rows.where(F.col("event_id") % 3 == k) for k in range(3)]  # any order of time
    for k, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{tmp_path}/in/part={k}")
        source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
        live.live_table(source, f"{tmp_path}/live", f"{tmp_path}/ck", "2 days", 4, every=2).trigger(availableNow=True).start().awaitTermination()
    found = {tuple(r) for r in live.live(spark, f"{tmp_path}/live", rows.schema, "2 days", buckets=4).collect()}
    assert found == {tuple(r) for r in live.standing(rows, "2 days").collect()} and found
