"""Structured Streaming: snapshots to trusted and quarantined positions, trips by sliding re-computation, live snapshot, telemetry."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from ..operators import checks, facts, positions, rules, telemetry, trajectory
from ..schemas import FACT_KEY, FINISHED_KEY, RAW
from ..sources import files, loads


def snapshot_stream(spark: SparkSession, path: str, per_batch: int = 30) -> DataFrame:
    """Landed snapshot files, oldest first, each exactly once by the checkpoint."""
    return spark.readStream.schema(RAW).option("multiLine", True).option("maxFilesPerTrigger", per_batch).option("latestFirst", False).json(path)


def document_stream(spark: SparkSession, path: str, per_batch: int = 30) -> DataFrame:
    """file, value: landed documents as text, so that each can be checked before it's parsed."""
    rows = spark.readStream.option("wholetext", True).option("maxFilesPerTrigger", per_batch).option("latestFirst", False).text(path)
    return rows.select(F.col("_metadata.file_name").alias("file"), "value")


@dataclass
class Gate:
    """What a batch is judged by and where its parts go. suite, parameters: as of rules.load_suite; without a suite the transform alone rejects rows.
    reports, rejected, phases: folders for the report of each batch, for documents without the declared structure and for the seconds and status of each phase;
    what is None isn't written. A batch that is replayed replaces its own rows there. One that breaks leaves a report that tells phase and message."""

    trusted: str
    quarantine: str
    suite: list[rules.Rule] = field(default_factory=list)
    parameters: dict[str, Any] = field(default_factory=dict)
    reports: str | None = None
    rejected: str | None = None
    phases: str | None = None


Step = Callable[[DataFrame, int | str], None]


def transform_batch(raw: DataFrame, details: DataFrame, gate: Gate, number: int | str, after: Sequence[Step] = ()) -> None:
    """One batch of documents (file, value) or of parsed snapshots: checked, flattened, enriched, validated and written, and reported.

    Rows that the transform and those that the suite rejects go to the quarantine together. The steps of `after` get the trusted rows in order, as downstream
    runs are triggered: trips, then facts, or the live snapshot. number names the batch; the same one again leaves what is written as it is."""
    spark, now, execution = raw.sparkSession, F.current_timestamp(), f"batch-{number}"
    phases = telemetry.Phases(["documents", "positions", "report", *(f"after-{k}" for k in range(len(after)))])
    held: list[DataFrame] = []
    try:
        with phases("documents"):
            bad_documents = 0
            if "value" in raw.columns:
                judged = files.with_errors(raw).persist()
                held.append(judged)
                bad = judged.where(F.size("errors") > 0)
                bad_documents = bad.count()
                if gate.rejected and bad_documents:
                    loads.replace_batch(bad.withColumn("rejected_at", now), gate.rejected, number)
                raw = files.parsed_documents(judged.where(F.size("errors") == 0))
        with phases("positions"):
            out = positions.enriched(positions.normalise(positions.flatten(raw)), details).persist()
            held.append(out)
            judged_rows = rules.validate(positions.trusted(positions.valid(out)), gate.suite, now, gate.parameters)
            good = judged_rows.valid.persist()
            held.append(good)
            files.write_positions(good, gate.trusted)
            files.write_positions(positions.united_invalid(positions.invalid(out, now), judged_rows.invalid), gate.quarantine)
        with phases("report"):
            if gate.reports:
                counts = out.agg(F.count("*").alias("total_rows"), F.count_if(F.col("invalid_reason").isNotNull()).alias("_transform")).crossJoin(positions.expected(raw)).crossJoin(judged_rows.summary.drop("total_rows").withColumnRenamed("rows_failed", "_rules"))  # one row each
                counts = counts.withColumn("rows_failed", F.col("_transform") + F.col("_rules")).withColumn("items_failed", F.col("rows_failed") + bad_documents).withColumn("documents_rejected", F.lit(bad_documents))
                judged_batch = checks.acceptance(counts.drop("_transform", "_rules")).withColumn("quality_report_path", F.lit(gate.reports))
                _report(judged_batch, execution, gate.reports, number)
        for k, step in enumerate(after):
            with phases(f"after-{k}"):
                step(good, number)
    except Exception as error:
        if gate.reports:
            _report(checks.failure(spark, phases.failed, str(error).splitlines()[0] if str(error) else type(error).__name__), execution, gate.reports, number)
        raise
    finally:
        if gate.phases:
            rows = spark.createDataFrame(phases.rows(execution), telemetry.PHASES)
            loads.replace_batch(rows.withColumn("ts", now), gate.phases, number)
        for rows in held[::-1]:
            rows.unpersist()


def _report(rows: DataFrame, execution: str, path: str, number: int | str) -> None:
    loads.replace_batch(checks.report(rows, "positions", F.lit(execution), F.current_timestamp()), path, number, ["pipeline", "year", "month", "day", "hour"])


def to_positions(raw: DataFrame, details: Callable[[], DataFrame], trusted: str, quarantine: str, checkpoint: str, after: Step | Sequence[Step] | None = None, **gate: Any) -> DataStreamWriter:
    """raw: a stream of documents or snapshots. details gives the newest trip details for each batch; after: the steps that follow, in order; gate: the rest of a Gate."""
    steps = [after] if callable(after) else after or ()
    whole = Gate(trusted, quarantine, **gate)
    return raw.writeStream.foreachBatch(lambda rows, number: transform_batch(rows, details(), whole, number, steps)).option("checkpointLocation", checkpoint)


def backfill(spark: SparkSession, path: str, details: DataFrame, gate: Gate, start: datetime, end: datetime, step_minutes: int = 2, after: Sequence[Step] = ()) -> None:
    """All snapshots of a range of logical times, as one batch, which is named by the range."""
    name = f"{start:%Y%m%d%H%M}-{end:%Y%m%d%H%M}"
    transform_batch(files.snapshots_between(spark, path, start, end, step_minutes).select("metadata", "payload"), details, gate, name, after)


def recompute_trips(spark: SparkSession, trusted: str, target: str, hours: int = 3, radius: float = 100.0, late_trips: str = "drop") -> Step:
    """An `after` step: trips of the last hours before the batch's newest time. Those that end after everything saved are added; late_trips="keep" goes by
    the key alone. The start gate applies at each window's opening."""

    def step(batch: DataFrame, number: int | str) -> None:
        newest: datetime | None = batch.agg(F.max("extracao_ts")).first()[0]
        if newest is not None:
            rows = files.recent_positions(spark, trusted, newest.astimezone(), hours)
            trips = trajectory.finished_trips(rows, radius).withColumn("logic_date", F.lit(newest).cast("timestamp_ntz"))
            loads.append_batch(trips, target, FINISHED_KEY, number, by="trip_start_time", hourly=True, end="trip_end_time", late=late_trips)

    return step


def load_facts(spark: SparkSession, trips: str, target: str, dim: str) -> Step:
    """An `after` step that follows one for trips: the facts of the trips of this batch, by date, and the hours that the dimension lacks."""

    def step(batch: DataFrame, number: int | str) -> None:
        try:
            found = spark.read.parquet(trips)
        except AnalysisException as error:
            if error.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):  # no trip so far
                return
            raise
        # The batch is a partition, so time doesn't grow with what was saved before.
        found = found.where(F.col("batch") == str(number)).drop("date", "hour", "batch")
        made = facts.trip_facts(found).drop("duration").where("direction IS NOT NULL")
        loads.append_batch(made, target, FACT_KEY, number, by="started_at")
        files.append_absent(facts.provision(found), dim, ["time_key"])

    return step


def trips_stream(rows: DataFrame, target: str, checkpoint: str, history: str, radius: float = 100.0) -> DataStreamWriter:
    """Flat positions, in time order for each vehicle, to trips. The whole series so far is recomputed for the vehicles of the batch.

    Whether a vehicle's last row is a spike is known with the next one, so that row is held back, and trips that end on it come with the batch that
    brings its successor, or by `close_trips`. So nothing is written that a batch run over the same rows wouldn't give."""

    def batch(new: DataFrame, number: int) -> None:
        spark = new.sparkSession
        new.write.mode("overwrite").parquet(f"{history}/batch={number}")
        touched = new.select(*trajectory.GROUP).distinct()
        series = spark.read.schema(new.schema).parquet(history).join(touched, trajectory.GROUP, "left_semi")
        files.append_absent(trajectory.finished_trips(series, radius, hold_last=True), target, FINISHED_KEY, by="trip_start_time")

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)


def close_trips(spark: SparkSession, schema: StructType, target: str, history: str, radius: float = 100.0) -> int:
    """The trips that end on the last row of a vehicle, once no more rows come; schema: that of the positions."""
    return files.append_absent(trajectory.finished_trips(spark.read.schema(schema).parquet(history), radius), target, FINISHED_KEY, by="trip_start_time")


def latest_stream(rows: DataFrame) -> DataFrame:
    """The newest place of each vehicle, for update mode; of several at one time the greatest."""
    place = F.struct("veiculo_lat", "veiculo_long", "linha_lt", "linha_sentido")
    return rows.groupBy("veiculo_id").agg(F.max("veiculo_ts").alias("veiculo_ts"), F.max_by(place, F.struct("veiculo_ts", place)).alias("p")).select("veiculo_id", "veiculo_ts", "p.*")


def _watched(events: DataFrame, late: str) -> DataFrame:
    if dict(events.dtypes)["ts"] != "timestamp":
        events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return events.withWatermark("ts", late)


def rate_stream(events: DataFrame, range_: str = "5 minutes", step: str = "1 minute", late: str = "10 minutes", by: list[str] | None = None) -> DataFrame:
    """Windowed counts of late-tolerant events."""
    return telemetry.rate(_watched(events, late), range_, step, by)


def deduplicated(events: DataFrame, key: list[str], late: str = "10 minutes") -> DataFrame:
    """Events once each, while the watermark remembers them."""
    return _watched(events, late).dropDuplicatesWithinWatermark(key)
