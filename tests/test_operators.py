"""Positions, GTFS, facts, rules, checks, lineage, sources and streams on small inputs."""

import json
from datetime import UTC, datetime

import pytest
import zstandard
from pyspark.sql import functions as F

from busmill.functions import columns
from busmill.operators import checks, facts, gtfs, lineage, positions, rules, telemetry, trajectory
from busmill.plans import fixtures
from busmill.schemas import EVENT, FINISHED_KEY, POSITION_COLUMNS, RAW
from busmill.sources import files
from busmill.streaming import ingest
from conftest import DATA

DOC = {"metadata": {"extracted_at": "2026-05-20T02:30:00", "source": "api", "total_vehicles": 2}, "payload": {"hr": "23:30", "l": [{"c": "10", "cl": 1, "sl": 1, "lt0": "a", "lt1": "b", "qv": 2, "vs": [{"p": 7, "a": True, "ta": "2026-05-20T02:29:00", "py": -23.5, "px": -46.6, "sv": None, "is": None}, {"p": 8, "a": True, "ta": "bad", "py": None, "px": -46.6, "sv": None, "is": None}]}, {"c": "11", "cl": 2, "sl": 3, "lt0": None, "lt1": None, "qv": 0, "vs": []}]}}


def details(spark):
    return spark.createDataFrame([("10-0", 1, "A", -23.5, -46.6, 2, "B", -23.4, -46.6, 100.0, False)], "trip_id string, first_stop_id int, first_stop_name string, first_stop_lat double, first_stop_lon double, last_stop_id int, last_stop_name string, last_stop_lat double, last_stop_lon double, trip_linear_distance double, is_circular boolean")


def land(folder, name="posicoes_onibus-202605192330.json"):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text(json.dumps(DOC))
    return str(folder)


def test_snapshot_to_positions(spark, tmp_path):
    raw = files.read_snapshots(spark, land(tmp_path / "raw"))
    assert str(raw.first().logical_date) == "2026-05-20 02:30:00"
    flat = positions.normalise(positions.flatten(raw))
    assert [(r.veiculo_id, r.veiculo_ts is None) for r in flat.orderBy("veiculo_id").collect()] == [(7, False), (8, True)]
    out = positions.enriched(flat, details(spark))
    assert [r.invalid_reason for r in out.orderBy("veiculo_id").collect()] == [None, positions.NO_DISTANCE]
    assert positions.valid(out).first().distance_to_first_stop == 0.0
    row = positions.reconciliation(raw).first()
    assert (row.lines, row.announced, row.listed) == (2, 2, 2)
    assert positions.metrics(out).first().quality_score == 50.0


def test_document_errors(spark, tmp_path):
    folder = land(tmp_path / "raw")
    (tmp_path / "raw/bad.json").write_text("{")
    broken = json.loads(json.dumps(DOC))
    broken["payload"]["l"][0]["vs"] = "none"
    (tmp_path / "raw/shape.json").write_text(json.dumps(broken))
    found = {r.file: r.errors for r in files.document_errors(spark, folder).collect()}
    assert found["posicoes_onibus-202605192330.json"] == [] and "not_json" in found["bad.json"] and found["shape.json"] == ["payload.l[].vs:array_required"]


def test_keys(spark):
    row = spark.createDataFrame([("2026-05-20 02:30:00",)], "t string").select(columns.hour_key(F.col("t").cast("timestamp")).alias("k"), columns.clean_message(F.lit("<b>a &amp;  b</b>")).alias("m")).first()
    assert row.k == 2026051923 and row.m == "a & b"
    assert files.snapshot_path(datetime(2026, 5, 20, 2, 30, tzinfo=UTC)) == ("year=2026/month=05/day=19", "posicoes_onibus-202605192330.json")


def test_second_direction(spark):
    stops = spark.createDataFrame([(1, "A", 0.0, 0.0), (2, "B", 0.0, 1.0), (3, "C", 0.0, 2.0)], "stop_id int, stop_name string, stop_lat double, stop_lon double")
    times = spark.createDataFrame([("x-0", 1, 1), ("x-0", 2, 2), ("x-1", 1, 3), ("x-1", 2, 1), ("y-0", 1, 1), ("y-0", 2, 1), ("z-1", 1, 3), ("z-1", 2, 2)], "trip_id string, stop_sequence int, stop_id int")
    out = {r.trip_id: (r.first_stop_name, r.last_stop_name, r.is_circular) for r in gtfs.trip_details(times, stops).collect()}
    assert out == {"x-0": ("A", "B", False), "x-1": ("A", "B", False), "y-0": ("A", "A", True), "y-1": ("A", "A", True), "z-1": ("C", "B", False)}
    shown = {r.trip_id: (r.first_stop_name, r.last_stop_name, r.last_stop_id) for r in gtfs.refined(gtfs.trip_details(times, stops)).collect()}
    assert shown["y-0"] == ("A", gtfs.INTERMEDIATE, None) and shown["y-1"][0] == gtfs.INTERMEDIATE and shown["x-0"] == ("A", "B", 2)


def test_gtfs_files(spark, tmp_path):
    (tmp_path / "stops.txt").write_text("stop_id,stop_name,stop_desc,stop_lat,stop_lon\n1,A,,0,0\n")
    (tmp_path / "trips.txt").write_text("route_id\n")
    assert files.read_gtfs(spark, str(tmp_path), "stops").count() == 1
    assert [tuple(r) for r in gtfs.file_errors(files.gtfs_lines(spark, str(tmp_path))).collect()] == [("trips.txt", "too_few_lines")]
    rows = spark.range(2)
    assert gtfs.staged({"a": (rows, rows.limit(0))}, f"{tmp_path}/t", f"{tmp_path}/q") == {"a": f"{tmp_path}/t/a"}
    assert gtfs.staged({"a": (rows, rows.limit(0)), "b": (rows, rows)}, f"{tmp_path}/t", f"{tmp_path}/q")["a"] == f"{tmp_path}/q/a"


def test_rules(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "z")], "x int, y string")
    suite = [{"type": "expect_column_values_to_not_be_null", "kwargs": {"column": "x"}}, {"type": "expect_column_values_to_be_unique", "kwargs": {"column": "x"}}, {"type": "expect_column_values_to_be_in_set", "kwargs": {"column": "y", "value_set": ["a", "b", "z"]}}, {"type": "expect_table_columns_to_match_set", "kwargs": {"column_set": ["x"]}}]
    out = rules.validate(df, suite, F.lit(0))
    assert out.valid.count() == 0 and out.invalid.count() == 3
    row = out.summary.first()
    assert (row.expectations_with_violations, row.rows_failed, row.schema_violations) == (3, 3, ["expect_table_columns_to_match_set"])


def test_checks(spark):
    none = fixtures.positions(spark, DATA).limit(0)
    assert checks.freshness(none, F.lit("2024-01-01").cast("timestamp")).first().status == "FAIL"
    assert checks.recent_gaps(none, F.lit("2024-01-01").cast("timestamp")).first().status == "FAIL"
    row = spark.range(1).select(checks.worst(F.lit("PASS"), F.lit("WARN")).alias("w"), checks.worst(F.lit("FAIL"), F.lit("WARN")).alias("f")).first()
    assert (row.w, row.f) == ("WARN", "FAIL")
    assert checks.acceptance(spark.createDataFrame([(100, 1, 0)], "total_rows long, rows_failed long, expectations_with_violations long")).first().status == "WARN"


def test_report_sink(spark, tmp_path):
    rows = checks.freshness(fixtures.positions(spark, DATA), F.lit("2024-02-01").cast("timestamp"))
    files.write_reports(checks.report(rows, "trips", F.lit("e1"), F.lit("2026-05-20 02:30:00").cast("timestamp")), str(tmp_path / "r"))
    back = spark.read.json(str(tmp_path / "r")).first()
    assert (back.summary.status, back.pipeline, back.hour) == ("FAIL", "trips", 23)


def test_loads_twice_the_same(spark, tmp_path):
    trips = fixtures.finished_trips(spark, DATA)
    path = str(tmp_path / "t")
    assert files.append_absent(trips, path, FINISHED_KEY) == trips.count()
    assert files.append_absent(trips, path, FINISHED_KEY) == 0
    assert facts.provision(trips, facts.provision(trips)).count() == 0
    assert facts.rejected_facts(facts.trip_facts(trips)).count() == 0


def test_replace_and_retention(spark, tmp_path):
    path = str(tmp_path / "t")
    files.replace_table(spark.range(3), path, "v1")
    files.replace_table(spark.range(5), path, "v2")
    assert files.current_table(spark, path).count() == 5
    spark.createDataFrame([("2024-01-01", 1), ("2024-03-01", 2)], "day string, x int").write.partitionBy("day").parquet(f"{path}/p")
    assert facts.drop_expired(spark, f"{path}/p", "day", datetime(2024, 3, 2), 30) == ["2024-01-01"]


def test_positions_by_hour(spark, tmp_path):
    rows = fixtures.positions(spark, DATA).withColumn("extracao_ts", F.col("extracao_ts").cast("timestamp"))
    path = str(tmp_path / "p")
    files.write_positions(rows, path)
    files.write_positions(rows, path)
    assert spark.read.parquet(path).count() == rows.count()
    read = files.recent_positions(spark, path, datetime(2024, 1, 10, 15, tzinfo=UTC))
    assert read.where("extracao_ts < '2024-01-10 12:00:00' OR extracao_ts >= '2024-01-10 16:00:00'").count() == 0 and read.count() > 0
    assert "PartitionFilters: [isnotnull" in read._jdf.queryExecution().executedPlan().toString() or "PartitionFilters" in read._jdf.queryExecution().executedPlan().toString()
    assert files.newest_batch(rows).select("extracao_ts").distinct().count() == 1


def test_ledger(spark):
    ledger = spark.createDataFrame([("a", "2024-01-01", False), ("b", "2024-01-02", False)], "filename string, logical_date string, processed boolean")
    done = facts.marked(ledger, spark.createDataFrame([("a",)], "filename string"))
    requests = ledger.select("filename", F.col("logical_date").alias("created_at"))
    assert [r.filename for r in facts.pending(requests, done).collect()] == ["b"]


def test_lineage(spark):
    raw = spark.createDataFrame([], RAW).schema
    assert lineage.raw_paths(raw)["p"] == "payload.l[i].vs[j].p"
    assert {c.name for c in lineage.position_lineage(raw)} >= {"veiculo_id", "trip_id", "distance_to_last_stop"}
    rows = facts.trip_facts(fixtures.finished_trips(spark, DATA))
    assert lineage.drift(lineage.TRIP_FACTS, rows, with_types=True).count() == 0
    changed = rows.drop("route_id").withColumn("new", F.lit(1)).withColumn("direction", F.lit("x"))
    assert {r.column: r.change for r in lineage.drift(lineage.TRIP_FACTS, changed, with_types=True).collect()} == {"route_id": "removed", "new": "added", "direction": "type_changed"}


def test_log_lines(spark):
    lines = spark.createDataFrame([('[2024] {x} INFO - {"event": "started", "level": "INFO"}',), ("nothing",)], "value string")
    assert telemetry.parsed(lines.limit(0), EVENT).count() == 0
    lines = spark.createDataFrame([('[2024] INFO - {"event": "started", "level": "INFO"}',), ("nothing",)], "value string")
    assert [r.event for r in telemetry.parsed(lines, EVENT).collect()] == ["started"]


def test_stream_of_snapshots(spark, tmp_path):
    source = land(tmp_path / "raw")
    done = []
    stream = ingest.to_positions(ingest.snapshot_stream(spark, source), lambda: details(spark), f"{tmp_path}/good", f"{tmp_path}/bad", f"{tmp_path}/ck", lambda rows, n: done.append(rows.count()))
    for _ in range(2):  # a second run finds nothing new
        stream.trigger(availableNow=True).start().awaitTermination()
    assert done == [1] and spark.read.parquet(f"{tmp_path}/good").count() == 1 and spark.read.parquet(f"{tmp_path}/bad").count() == 1


def test_stream_of_trips_equals_batch(spark, tmp_path):
    """Rows come in time order; nothing is written that a batch run wouldn't give, and nothing is lost once the series are closed."""
    rows = fixtures.positions(spark, DATA)
    for k, (first, last) in enumerate((("2024-01-01", "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", "2024-03-01"))):
        rows.where(f"veiculo_ts >= '{first}' AND veiculo_ts < '{last}'").coalesce(1).write.parquet(f"{tmp_path}/in/part={k}")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    ingest.trips_stream(stream, f"{tmp_path}/trips", f"{tmp_path}/ck", f"{tmp_path}/h").trigger(availableNow=True).start().awaitTermination()
    expected = trajectory.finished_trips(rows).select(*FINISHED_KEY)
    assert spark.read.parquet(f"{tmp_path}/trips").select(*FINISHED_KEY).exceptAll(expected).count() == 0
    assert ingest.close_trips(spark, rows.schema, f"{tmp_path}/trips", f"{tmp_path}/h") > 0
    found = spark.read.parquet(f"{tmp_path}/trips").select(*FINISHED_KEY)
    assert expected.exceptAll(found).count() == 0 and found.exceptAll(expected).count() == 0


SUITE = {"positions": {"evaluation_parameters": {"least": -23.45}, "expectations": [{"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "veiculo_lat", "max_value": {"$PARAMETER": "least"}}}, {"expectation_type": "expect_column_values_to_be_of_type", "kwargs": {"column": "veiculo_id", "type_": "int"}}, {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "nowhere"}}]}}


def gated(spark, tmp_path):
    suite, parameters = rules.load_suite(SUITE)
    return {"suite": suite, "parameters": parameters, "reports": f"{tmp_path}/reports", "rejected": f"{tmp_path}/rejected"}


def test_stream_with_gates(spark, tmp_path):
    doc = json.loads(json.dumps(DOC))
    doc["payload"]["l"][0]["vs"].append({"p": 9, "a": True, "ta": "2026-05-20T02:29:30", "py": -23.4, "px": -46.6, "sv": None, "is": None})
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.json").write_text(json.dumps(doc))
    (tmp_path / "raw/b.json").write_text('{"metadata": {}, "payload": {"l": []}}')
    seen = []
    steps = [lambda rows, n: seen.append(("first", rows.count())), lambda rows, n: seen.append(("second", n))]
    docs = ingest.document_stream(spark, str(tmp_path / "raw"))
    ingest.to_positions(docs, lambda: details(spark), f"{tmp_path}/good", f"{tmp_path}/bad", f"{tmp_path}/ck", steps, **gated(spark, tmp_path)).trigger(availableNow=True).start().awaitTermination()
    assert seen == [("first", 1), ("second", 0)]
    good, bad = spark.read.parquet(f"{tmp_path}/good"), spark.read.parquet(f"{tmp_path}/bad")
    parts = ["year", "month", "day", "hour", "batch"]
    assert good.columns == [*POSITION_COLUMNS, *parts] and bad.columns == [*POSITION_COLUMNS, "invalid_reason", "validation_failed_at", *parts]
    assert {r.veiculo_id: r.invalid_reason for r in bad.collect()} == {8: positions.NO_DISTANCE, 9: "expect_column_values_to_be_between:veiculo_lat"}
    report = spark.read.json(f"{tmp_path}/reports").first()
    told = json.loads(report.details)
    assert (report.summary.status, report.summary.items_failed, told["documents_rejected"], told["expected_vehicles"], told["expectations_failed_due_to_exceptions"]) == ("FAIL", 3, 1, 2, 1)
    assert "metadata.extracted_at:string_required" in spark.read.json(f"{tmp_path}/rejected").first().errors


def test_backfill_and_latest(spark, tmp_path):
    for minute in (30, 31, 32):
        doc = json.loads(json.dumps(DOC))
        doc["metadata"]["extracted_at"] = f"2026-05-20T02:{minute}:00"
        folder = tmp_path / "raw/year=2026/month=05/day=19"
        folder.mkdir(exist_ok=True, parents=True)
        (folder / f"posicoes_onibus-2026051923{minute}.json").write_text(json.dumps(doc))
    at = datetime(2026, 5, 20, 2, 30, tzinfo=UTC)
    gate = ingest.Gate(f"{tmp_path}/good", f"{tmp_path}/bad")
    ingest.backfill(spark, f"{tmp_path}/raw", details(spark), gate, at, at.replace(minute=40))
    assert sorted(str(r.extracao_ts) for r in spark.read.parquet(gate.trusted).collect()) == ["2026-05-20 02:30:00", "2026-05-20 02:32:00"]
    latest = files.latest_snapshot(spark, gate.trusted, at.replace(hour=3, minute=5))
    assert [str(r.extracao_ts) for r in latest.collect()] == ["2026-05-20 02:32:00"]
    assert files.latest_snapshot(spark, gate.trusted, at.replace(hour=5)) is None


def test_steps_after_positions(spark, tmp_path):
    """Trips of the last hours, then their facts and hours, each by date; a second run adds nothing."""
    on_one_day = lambda c: F.to_timestamp(F.concat(F.lit("2024-01-10 "), F.date_format(c, "HH:mm:ss.SSSSSS")))
    rows = fixtures.positions(spark, DATA).withColumns({"veiculo_ts": on_one_day("veiculo_ts"), "extracao_ts": on_one_day("extracao_ts"), "veiculo_id": F.col("veiculo_id") % 20})
    files.write_positions(rows, f"{tmp_path}/p")
    last = rows.where("extracao_ts <= '2024-01-10 15:00:00'")
    steps = [ingest.recompute_trips(spark, f"{tmp_path}/p", f"{tmp_path}/trips", hours=8), ingest.load_facts(spark, f"{tmp_path}/trips", f"{tmp_path}/facts", f"{tmp_path}/dim")]
    for _ in range(2):
        for step in steps:
            step(last, 0)
    trips, made = spark.read.parquet(f"{tmp_path}/trips"), spark.read.parquet(f"{tmp_path}/facts")
    recent = files.recent_positions(spark, f"{tmp_path}/p", datetime(2024, 1, 10, 15, tzinfo=UTC), 8)
    assert trips.count() == trajectory.finished_trips(recent).count() > 0 and {"date", "hour"} <= set(trips.columns)
    assert made.count() == trips.count() and "date" in made.columns
    assert spark.read.parquet(f"{tmp_path}/dim").count() == 24
    assert facts.load_counts(5, 3) == {"derived": 5, "inserted": 3, "skipped": 2}


def test_append_reads_the_dates_of_the_batch(spark, tmp_path):
    trips, path = fixtures.finished_trips(spark, DATA), str(tmp_path / "t")
    first = trips.where("trip_start_time < '2024-01-15'")
    assert files.append_absent(first, path, FINISHED_KEY, by="trip_start_time", hourly=True) == first.count()
    assert files.append_absent(trips, path, FINISHED_KEY, by="trip_start_time", hourly=True) == trips.count() - first.count()
    assert files.append_absent(trips, path, FINISHED_KEY, by="trip_start_time", hourly=True) == 0
    assert len(facts.drop_expired(spark, path, "date", datetime(2024, 2, 10), 20)) > 0


def test_sinks_and_listings(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    files.write_jdbc(spark.range(5), url, "numbers", replace=True)
    files.write_jdbc(spark.range(5, 7), url, "numbers")
    assert files.read_jdbc(spark, url, "numbers").count() == 7
    files.write_jdbc(spark.range(2), url, "numbers", replace=True)
    assert files.read_jdbc(spark, url, "numbers").count() == 2
    raw = files.read_snapshots(spark, land(tmp_path / "raw"))
    files.write_snapshots(raw.select("metadata", "payload"), f"{tmp_path}/kept")
    assert [r.path.endswith(".json.gz") for r in files.listing(spark, f"{tmp_path}/kept", "part-*").collect()] == [True]
    (tmp_path / "z").mkdir()
    (tmp_path / "z/a.json.zst").write_bytes(zstandard.compress(json.dumps(DOC).encode()))
    (tmp_path / "z/b.json.zst").write_bytes(b"no")
    docs = files.with_errors(files.read_zstd_documents(spark, f"{tmp_path}/z"))
    assert {r.file: r.errors[:1] for r in docs.collect()} == {"a.json.zst": [], "b.json.zst": ["not_json"]}
    assert files.parsed_documents(docs.where("value IS NOT NULL")).first().metadata.total_vehicles == 2
    back = spark.read.schema(RAW).json(f"{tmp_path}/kept").first()
    assert back.metadata.total_vehicles == 2 and (tmp_path / "kept/year=2026/month=05/day=19").exists()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS saved LOCATION '{tmp_path}/saved'")
    files.save_table(spark.range(3), "saved.numbers")
    files.save_table(spark.range(4), "saved.numbers")
    assert spark.table("saved.numbers").count() == 4
    spark.sql("DROP DATABASE saved CASCADE")


def test_staging(spark, tmp_path):
    (tmp_path / "stops.txt").write_text("stop_id,stop_name,stop_desc,stop_lat,stop_lon\n1,A,,0,0\n")
    (tmp_path / "trips.txt").write_text("route_id,service_id,trip_id,trip_headsign,direction_id,shape_id\na,b,c,d,not a number,e\n")
    staged, errors = files.stage_gtfs(spark, str(tmp_path), f"{tmp_path}/staging", ["stops", "trips"])
    assert set(staged) == {"stops"} and set(errors) == {"trips"}
    moved, lost = files.relocate(spark, staged | {"routes": f"{tmp_path}/staging/none"}, f"{tmp_path}/trusted")
    assert set(moved) == {"stops"} and set(lost) == {"routes"} and spark.read.parquet(moved["stops"]).count() == 1
    (tmp_path / "bad.txt").write_bytes(b"route_id\n\xff\n")
    (tmp_path / "good.txt").write_text("route_id\n\ufffd\n")
    assert {r.file: r.error for r in gtfs.file_errors(files.gtfs_lines(spark, str(tmp_path))).collect()} == {"bad.txt": "not_utf8"}


def test_suites(spark):
    suite, parameters = rules.load_suite(SUITE)
    assert len(suite) == 3 and parameters == {"least": -23.45}
    assert rules.is_type("bigint", "int64") and rules.is_type("double", "float") and rules.is_type("timestamp", "datetime64[ns]") and not rules.is_type("string", "int") and not rules.is_type("int", "bigint")
    df = spark.createDataFrame([(1, -23.0), (2, -24.0)], "veiculo_id long, veiculo_lat double")
    row = rules.validate(df, suite, F.lit(0), parameters).summary.first()
    assert (row.total_checks, row.expectations_successful, row.expectations_with_violations, row.expectations_failed_due_to_exceptions, row.exception_reasons) == (3, 1, 1, 1, ["expect_column_values_to_not_be_null:no column nowhere"])


def test_failure_report(spark, tmp_path):
    rows = checks.report(checks.failure(spark, "transform", "no details"), "positions", F.lit("e1"), F.lit("2026-05-20 02:30:00").cast("timestamp"))
    row = rows.first().summary
    assert (row.status, row.failure_phase, row.failure_message, row.items_failed, row.acceptance_rate) == ("FAIL", "transform", "no details", 0, None)


def test_declared_lineage(spark):
    rows = gtfs.trip_details(fixtures.stop_times(spark, DATA), fixtures.stops(spark, DATA))
    assert lineage.drift(lineage.TRIP_DETAILS, rows.drop("first_stop_name")).first().change == "removed"
    entry = lineage.column_map(lineage.TRIP_DETAILS, rows).first()["columns"]["first_stop_lat"]
    assert (entry.type, entry.transformation, entry.inputs[-1]) == ("float", "join", "stops.stop_lat")
    assert lineage.as_table(spark, "trip_details", lineage.TRIP_DETAILS).count() == len(rows.columns)


def test_phases():
    assert telemetry.phase_rows([{"batchId": 3, "durationMs": {"addBatch": 1500}}]) == [("3", "addBatch", 1.5)]


def test_order_by_deviation(spark):
    """Panels in order: greatest deviation first, none last."""
    from busmill.plans import queries

    found = [r.deviation_pct for r in queries.today_vs_baseline(spark, DATA).collect()]
    known = [x for x in found if x is not None]
    assert known == sorted(known, reverse=True) and found == known + [None] * (len(found) - len(known))


def test_rate_stream(spark, tmp_path):
    fixtures.events(spark, DATA).write.parquet(f"{tmp_path}/e")
    stream = spark.readStream.schema("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, k long").parquet(f"{tmp_path}/e")
    q = ingest.rate_stream(stream, "1 hour", "15 minutes", "1 day").writeStream.format("memory").queryName("rates").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("SELECT * FROM rates").columns == ["tick", "n"]
    once = ingest.deduplicated(stream.select("event_id", "ts"), ["event_id"], "40 days").writeStream.format("memory").queryName("once").outputMode("append").trigger(availableNow=True).start()
    once.awaitTermination()
    assert spark.sql("SELECT * FROM once").count() == fixtures.events(spark, DATA).count()


@pytest.mark.parametrize("name", ["latest"])
def test_latest_stream(spark, tmp_path, name):
    rows = fixtures.positions(spark, DATA)
    rows.write.parquet(f"{tmp_path}/in")
    stream = ingest.latest_stream(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"))
    stream.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert spark.sql(f"SELECT * FROM {name}").count() == rows.select("veiculo_id").distinct().count()
