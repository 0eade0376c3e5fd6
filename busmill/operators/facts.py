"""Hour dimension, trip facts, incremental loads, retention and the work ledger."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import direction_of, hour_key, local, route_of
from ..schemas import FACT_KEY, FINISHED_KEY


def dim_time(dates: DataFrame) -> DataFrame:
    """dates: date_actual. 24 rows for each distinct date."""
    rows = dates.select("date_actual").distinct().withColumn("hour_of_day", F.explode(F.sequence(F.lit(0), F.lit(23))))
    weekday = F.weekday("date_actual") + 1
    key = F.date_format("date_actual", "yyyyMMdd").cast("int") * 100 + F.col("hour_of_day")
    return rows.select(key.alias("time_key"), "date_actual", F.month("date_actual").alias("month"), F.day("date_actual").alias("day"), "hour_of_day", weekday.alias("weekday"), (weekday >= 6).alias("is_weekend"))


def dates_of(trips: DataFrame, start: str = "trip_start_time", end: str = "trip_end_time") -> DataFrame:
    """Every local date from the first start to the last end, without gaps."""
    span = trips.agg(F.to_date(local(F.min(start))).alias("a"), F.to_date(local(F.max(end))).alias("b")).where("a IS NOT NULL")
    return span.select(F.explode(F.sequence("a", "b")).alias("date_actual"))


def provision(trips: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Rows that the dimension lacks for a batch of trips."""
    rows = dim_time(dates_of(trips))
    return rows if existing is None else rows.join(existing.select("time_key"), "time_key", "left_anti")


def trip_facts(trips: DataFrame) -> DataFrame:
    return trips.select(
        "trip_id", "vehicle_id", route_of(F.col("trip_id")).alias("route_id"), direction_of(F.col("trip_id")).alias("direction"), F.col("trip_start_time").alias("started_at"), F.col("trip_end_time").alias("ended_at"), "duration_seconds",
        F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("duration_seconds").cast("decimal(18,6)")).alias("duration"), "is_circular", "distance_meters", "avg_speed_kmh",
        hour_key(F.col("trip_start_time")).alias("started_at_time_dim_key"), hour_key(F.col("trip_end_time")).alias("ended_at_time_dim_key"), "logic_date",
    )


def rejected_facts(facts: DataFrame) -> DataFrame:
    """Facts whose trip id names no direction."""
    return facts.where("direction IS NULL")


def insert_if_absent(rows: DataFrame, existing: DataFrame, key: list[str], tie: list[str] | None = None) -> DataFrame:
    """Rows to append: one for each key, the first by all columns, that doesn't exist yet."""
    order = Window.partitionBy(*key).orderBy(*[c for c in (tie or rows.columns) if c not in key])
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n").join(existing.select(*key).distinct(), key, "left_anti")


def new_finished_trips(trips: DataFrame, existing: DataFrame, late_trips: str = "drop") -> DataFrame:
    """Trips that end after everything saved, by the global high-water mark, and aren't saved; late_trips="keep" uses the key alone."""
    if late_trips == "drop":
        mark = existing.agg(F.max("trip_end_time").alias("mark"))
        trips = trips.crossJoin(F.broadcast(mark)).where("mark IS NULL OR trip_end_time > mark").drop("mark")  # one row
    return insert_if_absent(trips, existing, FINISHED_KEY)


def new_facts(trips: DataFrame, existing: DataFrame, logic_date: Column) -> DataFrame:
    return insert_if_absent(trip_facts(trips.where(F.col("logic_date") == logic_date)).where("direction IS NOT NULL"), existing, FACT_KEY, ["duration_seconds", "distance_meters"])


def uncovered(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """Facts whose start or end hour the dimension lacks."""
    keys = dim.select("time_key")
    start = keys.select(F.col("time_key").alias("started_at_time_dim_key"), F.lit(True).alias("has_start"))
    end = keys.select(F.col("time_key").alias("ended_at_time_dim_key"), F.lit(True).alias("has_end"))
    return facts.join(start, "started_at_time_dim_key", "left").join(end, "ended_at_time_dim_key", "left").where("has_start IS NULL OR has_end IS NULL").drop("has_start", "has_end")


def measured(facts: DataFrame, fastest: float = 80.0) -> DataFrame:
    """Counts of facts and of values outside their domain."""
    return facts.agg(
        F.count("*").alias("persisted_facts"), F.count_if(F.expr("duration_seconds < 0")).alias("negative_duration"), F.count_if(F.expr("distance_meters < 0")).alias("negative_distance"), F.count_if(F.expr("started_at > ended_at")).alias("time_incoherent"),
        F.count_if(~F.col("avg_speed_kmh").between(0, fastest)).alias("implausible_speed"),
    )


def retained(rows: DataFrame, column: str, as_of: str, keep: str) -> DataFrame:
    """Rows within `keep` before as_of, as the partitions that a retention run leaves."""
    return rows.where(F.expr(f"{column} >= timestamp_ntz'{as_of}' - interval {keep}"))


def drop_expired(spark, path: str, column: str, as_of: datetime, keep_days: int) -> list[str]:
    """Deletes the date partitions column=yyyy-MM-dd below path that are older than keep_days."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in fs.listStatus(folder):
        name, _, value = status.getPath().getName().partition("=")
        if name == column and (as_of - datetime.fromisoformat(value)).days > keep_days:
            fs.delete(status.getPath(), True)
            gone.append(value)
    return sorted(gone)


def drop_expired_hours(spark, path: str, as_of: datetime, keep_hours: int) -> list[str]:
    """Deletes the partitions date=yyyy-MM-dd/hour=h below path whose last moment is keep_hours or more before as_of, which is a time of the partitions' own
    zone, and dates that are left empty. Gives them as yyyy-MM-dd/h."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    named = lambda of, column: [(s.getPath(), s.getPath().getName().partition("=")[2]) for s in fs.listStatus(of) if s.getPath().getName().startswith(f"{column}=")]
    gone = []
    for day, date in named(folder, "date"):
        hours = named(day, "hour")
        old = [(p, h) for p, h in hours if h.isdigit() and datetime.fromisoformat(date) + timedelta(hours=int(h) + 1 + keep_hours) <= as_of]
        for place, hour in old:
            fs.delete(place, True)
            gone.append((date, int(hour)))
        if old and len(old) == len(hours):
            fs.delete(day, True)
    return [f"{date}/{hour}" for date, hour in sorted(gone)]


def pending(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Requests that no processed ledger row has, oldest first."""
    return files.join(ledger.where("processed").select("filename").distinct(), "filename", "left_anti").orderBy("created_at", "filename")


def marked(ledger: DataFrame, done: DataFrame, by: str = "filename") -> DataFrame:
    """The ledger with the rows of `done`, by file name or by logical date, as processed."""
    seen = done.select(by).distinct().withColumn("_done", F.lit(True))
    return ledger.join(seen, by, "left").withColumn("processed", F.col("processed") | F.coalesce("_done", F.lit(False))).drop("_done").select(*ledger.columns)


def load_counts(derived: int, inserted: int) -> dict[str, int]:
    """What a load reports: rows derived from its batch, new ones, and those that were there."""
    return {"derived": derived, "inserted": inserted, "skipped": derived - inserted}


def queue_metrics(requests: DataFrame, runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row: pending requests and logical dates, how many of the dates' runs are in each state (no_run where a date has none), and of the triggers in
    each outcome. requests: logical_date; runs: logical_date, state; outcomes: outcome."""
    dates = requests.where("logical_date IS NOT NULL").select("logical_date").distinct()
    state = F.when(F.col("state").isNull(), "no_run").when(F.col("state").isin("queued", "running", "success", "failed"), F.col("state")).otherwise("other")
    states = dates.join(runs.withColumn("_run", F.lit(True)), "logical_date", "left").select(F.when(F.col("_run"), F.coalesce(state, F.lit("other"))).otherwise("no_run").alias("state"))
    states = states.agg(*[F.count_if(F.col("state") == s).alias(f"state_{s}") for s in ("no_run", "queued", "running", "success", "failed", "other")])
    done = outcomes.agg(*[F.count_if(F.col("outcome") == s).alias(f"outcome_{s}") for s in ("triggered", "skipped_running", "skipped_existing", "failed")])
    pending = requests.agg(F.count("*").alias("pending_requests_total"), F.count_distinct("logical_date").alias("pending_logical_dates_total"))
    return pending.crossJoin(F.broadcast(states)).crossJoin(F.broadcast(done))  # one row each


def queue_summary(requests: DataFrame) -> DataFrame:
    """Counts of requests and logical dates by state."""
    return requests.groupBy("state").agg(F.count("*").alias("requests"), F.count_distinct("logical_date").alias("logical_dates"))
