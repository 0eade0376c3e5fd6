"""Absence on a stream against the batch form: any order within the delay, several batches, restarts, sources that never speak."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from busmill.operators import telemetry
from busmill.streaming import absence
from test_keyed import ran, store  # noqa: F401

T0 = datetime(2024, 1, 1)
SCHEMA = "ts timestamp, source string, kind string"


def landed(spark, path, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/{name}")


def stream_of(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def test_next_absent_by_hand():
    rng = random.Random(1)
    for _ in range(3000):
        done, range_ = rng.randrange(20), rng.randrange(1, 6)
        steps = sorted({rng.randrange(40) for _ in range(rng.randrange(12))})
        expected = next(t for t in range(done + 1, 200) if not any(t - range_ <= s < t for s in steps))
        assert absence.next_absent(done, steps, range_) == expected


def test_any_batching_gives_the_batch_form(spark, store, tmp_path):  # noqa: F811
    rng = random.Random(2)
    # Two sources with gaps, out of order by less than the delay; others' events move the watermark.
    rows = [(at(m), s, rng.choice(["done", "done", "error"])) for s in ("a", "b") for m in sorted(rng.sample(range(600), 45))]
    rows = sorted(rows, key=lambda r: r[0] + timedelta(minutes=rng.randrange(8)))
    cuts = [0, 20, 45, 60, len(rows)]
    for k, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
        landed(spark, f"{tmp_path}/in", rows[x:y], f"part={k}")
        ran(absence.absent(stream_of(spark, f"{tmp_path}/in"), F.col("kind") == "done", "source", "20 minutes", "5 minutes"), f"{tmp_path}/out", f"{tmp_path}/ck")
    for k, m in ((8, 1210), (9, 1220)):
        landed(spark, f"{tmp_path}/in", [(at(m), "clock", "tick")], f"part={k}")
        ran(absence.absent(stream_of(spark, f"{tmp_path}/in"), F.col("kind") == "done", "source", "20 minutes", "5 minutes"), f"{tmp_path}/out", f"{tmp_path}/ck")
    out = spark.read.parquet(f"{tmp_path}/out").collect()
    found = sorted((r.source, r.tick) for r in out)
    # The watermark ends at 1220 - 10 minutes.
    all_rows, expected = spark.createDataFrame(rows, SCHEMA), []
    for s in ("a", "b"):
        own = all_rows.where(F.col("source") == s)
        first = own.where("kind = 'done'").agg(F.min("ts")).first()[0]
        expected += [(s, r.tick) for r in telemetry.absent(own, F.col("kind") == "done", "20 minutes", "5 minutes", str(T0), str(at(1210))).collect() if r.tick > first]
    assert found == sorted(expected) and len(found) > 200
    assert all(r.first == ((r.source, r.tick - timedelta(minutes=5)) not in found) for r in out)


@pytest.mark.parametrize("each", [True, False])
def test_a_source_that_never_speaks(spark, store, tmp_path, each):  # noqa: F811
    watched = spark.createDataFrame([(at(1), "silent"), (at(0), "lively")], "ts timestamp, source string")
    for k, m in enumerate((0, 9, 18, 27, 36, 45)):
        landed(spark, f"{tmp_path}/in", [(at(m), "lively", "done")], f"part={k}")
    source = stream_of(spark, f"{tmp_path}/in")
    ran(absence.absent(source, F.col("kind") == "done", "source", "10 minutes", "5 minutes", "1 minute", each, watched=watched), f"{tmp_path}/out", f"{tmp_path}/ck")
    found = sorted((r.source, r.tick, r.first) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    ticks = [15, 20, 25, 30, 35, 40] if each else [15]
    assert found == [("silent", at(m), m == 15) for m in ticks]


def test_a_range_is_a_multiple_of_the_step(spark, tmp_path):
    landed(spark, f"{tmp_path}/in", [(at(0), "a", "done")], "part=0")
    with pytest.raises(ValueError, match="multiple"):
        absence.absent(stream_of(spark, f"{tmp_path}/in"), F.lit(True), "source", "10 minutes", "3 minutes")
