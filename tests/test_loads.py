"""Loads and batches that are replayed, the kept high-water mark, failure reports, phases, hourly retention."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from busmill.operators import facts, telemetry
from busmill.plans import fixtures
from busmill.schemas import FINISHED_KEY
from busmill.sources import files, loads
from busmill.streaming import ingest
from conftest import DATA
from test_operators import details, gated, land

BY = {"by": "trip_start_time", "hourly": True, "end": "trip_end_time"}


def trips(spark, *spans):
    """vehicle, start and end, in hours of one day."""
    rows = [("10-0", v, datetime(2024, 1, 10, a), datetime(2024, 1, 10, b), "x") for v, a, b in spans]
    return spark.createDataFrame(rows, "trip_id string, vehicle_id long, trip_start_time timestamp_ntz, trip_end_time timestamp_ntz, note string")


def saved(spark, path):
    return sorted((r.vehicle_id, r.trip_end_time.hour) for r in spark.read.parquet(path).collect())


def test_a_replay_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    first = fixtures.finished_trips(spark, DATA).where("trip_start_time < '2024-01-15'")
    assert loads.append_batch(first, path, FINISHED_KEY, 0, **BY) == (first.count(), first.count())
    before = sorted(tuple(r) for r in spark.read.parquet(path).select(*FINISHED_KEY, "batch").collect())
    for rows in (first, first.limit(3)):  # complete batches aren't written again, whatever they bring
        assert loads.append_batch(rows, path, FINISHED_KEY, 0, **BY).inserted == first.count()
    assert sorted(tuple(r) for r in spark.read.parquet(path).select(*FINISHED_KEY, "batch").collect()) == before
    again = loads.append_batch(first, path, FINISHED_KEY, 1, **BY)
    assert (again.inserted, again.skipped) == (0, first.count())


def test_a_batch_that_broke_off_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = trips(spark, (1, 1, 2), (2, 1, 3))
    half = rows.withColumns({"date": F.to_date("trip_start_time"), "hour": F.hour("trip_start_time"), "batch": F.lit("5")}).where("vehicle_id = 1")
    half.write.partitionBy("date", "hour", "batch").parquet(path)
    assert loads.append_batch(rows, path, FINISHED_KEY, 5, **BY) == (2, 2)
    assert saved(spark, path) == [(1, 2), (2, 3)]


def test_high_water_mark(spark, tmp_path):
    """Rows that end by the mark are late and dropped, unless the key alone is to count; the mark is kept beside the table."""
    path = str(tmp_path / "t")
    add = lambda batch, late, *spans: loads.append_batch(trips(spark, *spans), path, FINISHED_KEY, batch, late=late, **BY)
    assert add(0, "drop", (1, 1, 4), (1, 1, 4), (2, 2, 6)) == (3, 2)
    assert add(1, "drop", (3, 3, 5), (4, 3, 6), (2, 2, 6), (5, 3, 7)) == (4, 1)
    assert saved(spark, path) == [(1, 4), (2, 6), (5, 7)]
    assert add(2, "keep", (3, 3, 5), (2, 2, 6)) == (2, 1)
    assert add(3, "drop").inserted == 0 and add(4, "drop", (6, 6, 7)).inserted == 0
    assert loads.loads(spark, path).agg(F.max("greatest_end"), F.sum("inserted"), F.count("*")).first()[1:] == (4, 5)
    # The mark alone tells: the target isn't read.
    files_ = [str(p) for p in (tmp_path / "t").rglob("*.parquet")]
    for f in files_:
        open(f, "w").close()
    assert add(5, "drop", (7, 7, 9), (8, 6, 7)) == (2, 1)


def test_writers_at_the_same_time(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in ("a", "b"):  # neither saw the other
        rows = trips(spark, (1, 1, 2)).withColumns({"date": F.to_date("trip_start_time"), "hour": F.lit(1), "batch": F.lit(batch)})
        rows.write.mode("append").partitionBy("date", "hour", "batch").parquet(path)
    assert [r.batch for r in loads.once(spark.read.parquet(path), FINISHED_KEY).collect()] == ["a"]


def test_batches_are_replayed(spark, tmp_path):
    """The same documents with the same number leave one report, the same rejected documents, positions and phases."""
    land(tmp_path / "raw")
    (tmp_path / "raw/b.json").write_text('{"metadata": {}, "payload": {"l": []}}')
    gate = ingest.Gate(f"{tmp_path}/good", f"{tmp_path}/bad", phases=f"{tmp_path}/phases", **gated(spark, tmp_path))
    docs = files.read_documents(spark, f"{tmp_path}/raw")
    for _ in range(2):
        ingest.transform_batch(docs, details(spark), gate, 3)
    count = lambda name: spark.read.json(f"{tmp_path}/{name}").count()
    assert (count("reports"), count("rejected"), count("phases")) == (1, 1, 3)
    ingest.transform_batch(docs, details(spark), gate, 4)
    # Positions are kept by snapshot, so these replace themselves under any number.
    assert (count("reports"), count("rejected")) == (2, 2) and spark.read.parquet(gate.quarantine).count() == 1


@pytest.mark.parametrize("broken", ["positions", "after-1"])
def test_a_broken_batch_leaves_its_report(spark, tmp_path, broken):
    land(tmp_path / "raw")
    gate = ingest.Gate(f"{tmp_path}/good", f"{tmp_path}/bad", phases=f"{tmp_path}/phases", reports=f"{tmp_path}/reports")

    def fails(rows, number):
        raise ValueError("no disk\nleft")

    wrong = details(spark).drop("first_stop_lat") if broken == "positions" else details(spark)
    with pytest.raises(Exception):  # noqa: B017
        ingest.transform_batch(files.read_documents(spark, f"{tmp_path}/raw"), wrong, gate, 7, [lambda rows, n: None, fails, fails])
    report = spark.read.json(gate.reports).first().summary
    assert (report.status, report.failure_phase, report.execution_id) == ("FAIL", broken, "batch-7") and (broken == "positions" or report.failure_message == "no disk")
    told = {r.phase: r.status for r in spark.read.json(gate.phases).collect()}
    order = ["documents", "positions", "report", "after-0", "after-1", "after-2"]
    at = order.index(broken)
    assert [told[p] for p in order] == ["ok"] * at + ["failed"] + ["skipped"] * (len(order) - at - 1)
    events = spark.read.json(gate.phases).select(F.col("ts").cast("timestamp").alias("ts"), F.monotonically_increasing_id().alias("event_id"), F.col("status").alias("event_type"), F.col("seconds").alias("value"))
    assert telemetry.rate(events.where("event_type = 'failed'"), "5 minutes", "5 minutes").first().n == 1


def test_listener(spark, tmp_path):
    land(tmp_path / "raw")
    told = []
    listener = telemetry.PhaseListener(told.extend)
    spark.streams.addListener(listener)
    try:
        query = ingest.snapshot_stream(spark, f"{tmp_path}/raw").writeStream.foreachBatch(lambda rows, n: rows.count()).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
        query.awaitTermination()
        query = ingest.snapshot_stream(spark, f"{tmp_path}/raw").writeStream.foreachBatch(lambda rows, n: json.loads("no")).option("checkpointLocation", f"{tmp_path}/ck2").trigger(availableNow=True).start()
        with pytest.raises(Exception):  # noqa: B017
            query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert {"addBatch", "triggerExecution"} <= {p for _, p, _, status in told if status == "ok"} and [p for _, p, _, status in told if status == "failed"] == ["query"]


def test_hourly_retention(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = trips(spark, *((h, h, h + 1) for h in range(0, 12, 2))).unionByName(trips(spark, (50, 1, 2)).withColumn("trip_start_time", F.expr("trip_start_time - interval 1 day")))
    loads.append_batch(rows, path, FINISHED_KEY, 0, by="trip_start_time", hourly=True)
    assert facts.drop_expired_hours(spark, path, datetime(2024, 1, 11, 5), 24) == ["2024-01-09/1", "2024-01-10/0", "2024-01-10/2", "2024-01-10/4"]
    assert sorted(r.vehicle_id for r in spark.read.parquet(path).collect()) == [6, 8, 10] and not (tmp_path / "t/date=2024-01-09").exists()
