"""The operational questions over trip facts, the hour dimension, trip details and live positions."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Filters:
    """Optional panel filters; dates are on the local date of the start."""

    date_from: str | None = None
    date_to: str | None = None
    route: str | None = None
    direction: int | None = None
    is_weekend: bool | None = None
    is_circular: bool | None = None

    def predicate(self) -> Column:
        out = F.lit(True)
        for value, column in ((self.route, "route_id"), (self.direction, "direction"), (self.is_weekend, "is_weekend"), (self.is_circular, "is_circular")):
            if value is not None:
                out = out & (F.col(column) == F.lit(value))
        if self.date_from is not None:
            out = out & (F.col("date_actual") >= F.lit(self.date_from).cast("date"))
        if self.date_to is not None:
            out = out & (F.col("date_actual") <= F.lit(self.date_to).cast("date"))
        return out

    def bound(self, facts: DataFrame) -> DataFrame:
        """The facts that can lie within the dates, by literals on the facts themselves."""
        return within(facts, self.date_from, self.date_to)


def within(facts: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """Facts that start on the local dates first to last, so that a scan reads no others: a key of the hour says so for its row groups, and where the facts
    are parted by the date of their start, which is of UTC, that date with a day of slack for the zone says so for partitions."""
    key, parted = F.col("started_at_time_dim_key"), "date" in facts.columns
    for day, slack in ((first, -1), (last, 1)):
        if day is None:
            continue
        at = date.fromisoformat(day)
        lit, hour = F.lit(str(at + timedelta(days=slack))).cast("date"), int(at.strftime("%Y%m%d")) * 100
        facts = facts.where(key >= hour if slack < 0 else key <= hour + 23)
        if parted:
            facts = facts.where(F.col("date") >= lit if slack < 0 else F.col("date") <= lit)
    return facts


def one_decimal(value: Column) -> Column:
    """Rounded as a decimal, halves away from zero."""
    return F.round(value.cast("decimal(18,6)"), 1).cast("double")


def percentile(column: str, p: float, exact: bool = True) -> Column:
    return F.percentile(column, F.lit(p)) if exact else F.percentile_approx(column, F.lit(p), F.lit(10_000))


def started(facts: DataFrame, dim: DataFrame, filters: Filters | None = None) -> DataFrame:
    """Facts with the hour of their start."""
    facts = filters.bound(facts) if filters else facts
    rows = facts.join(dim, F.col("started_at_time_dim_key") == F.col("time_key"))
    return rows.where(filters.predicate()) if filters else rows


def kpis(facts: DataFrame, dim: DataFrame, today: str) -> DataFrame:
    # A trip may have started on any day before, so only the key of its end bounds the scan.
    hour = int(date.fromisoformat(today).strftime("%Y%m%d")) * 100
    rows = facts.where(F.col("ended_at_time_dim_key").between(hour, hour + 23))
    rows = rows.join(dim, F.col("ended_at_time_dim_key") == F.col("time_key")).where(F.col("date_actual") == F.lit(today).cast("date"))
    return rows.agg(F.count("*").alias("trips_completed_today"), F.count_distinct("route_id").alias("active_routes_today"), F.count_distinct("vehicle_id").alias("active_vehicles_today"))


def latest_batch(facts: DataFrame) -> DataFrame:
    """Newest batch and its trips, in one pass."""
    return facts.groupBy("logic_date").agg(F.count("*").alias("n")).agg(F.max("logic_date").alias("latest_batch_ts"), F.max_by("n", "logic_date").alias("latest_batch_trip_count"))


def frequency(facts: DataFrame, dim: DataFrame, filters: Filters | None = None) -> DataFrame:
    return started(facts, dim, filters).groupBy("route_id", "direction", "hour_of_day", "is_circular").agg(F.count("*").alias("trip_count"))


def median_and_p95(facts: DataFrame, dim: DataFrame, filters: Filters | None = None, min_trips: int = 5, exact: bool = True) -> DataFrame:
    rows = started(facts, dim, filters).groupBy("route_id").agg(
        one_decimal(percentile("duration_seconds", 0.5, exact) / 60).alias("median_duration_minutes"), one_decimal(percentile("duration_seconds", 0.95, exact) / 60).alias("p95_duration_minutes"), F.count("*").alias("trip_count")
    )
    return rows.where(F.col("trip_count") >= min_trips)


def percentiles_by_direction(facts: DataFrame) -> DataFrame:
    return facts.groupBy("route_id", "direction", "is_circular").agg(percentile("duration_seconds", 0.5).alias("median_duration_seconds"), percentile("duration_seconds", 0.95).alias("p95_duration_seconds"), F.count("*").alias("trip_count"))


def _four_weeks(facts: DataFrame, dim: DataFrame, today: str, filters: Filters | None = None) -> DataFrame:
    """Facts of today and of the four same weekdays before, in one scan of these four weeks."""
    day = F.lit(today).cast("date")
    first = str(date.fromisoformat(today) - timedelta(days=28))
    rows = started(within(facts, first, today), dim, filters)
    return rows.where((F.col("weekday") == F.weekday(day) + 1) & F.col("date_actual").between(F.date_sub(day, 28), day))


def deviation(daily: DataFrame, today: str) -> DataFrame:
    """Today's median against the mean of the medians of the four same weekdays before. daily: route_id, date_actual, daily_median, of any dates."""
    day = F.lit(today).cast("date")
    same = (F.weekday("date_actual") == F.weekday(day)) & F.col("date_actual").between(F.date_sub(day, 28), day)
    now = F.col("date_actual") == day
    out = daily.where(same).groupBy("route_id").agg(F.count_if(now).alias("n"), F.max(F.when(now, F.col("daily_median"))).alias("today_median"), F.avg(F.when(~now, F.col("daily_median"))).alias("baseline_median"))
    change = (F.col("today_median") - F.col("baseline_median")) / F.nullif(F.col("baseline_median"), F.lit(0)) * 100
    out = out.where("n > 0")
    return out.select("route_id", one_decimal(F.col("today_median") / 60).alias("today_median_minutes"), one_decimal(F.col("baseline_median") / 60).alias("baseline_median_minutes"), F.round(change.cast("decimal(18,6)"), 2).cast("double").alias("deviation_pct")).orderBy(F.desc_nulls_last("deviation_pct"), "route_id")


def today_vs_baseline(facts: DataFrame, dim: DataFrame, today: str, filters: Filters | None = None) -> DataFrame:
    """Today's median against the mean of the daily medians of the four same weekdays before."""
    rows = _four_weeks(facts, dim, today, filters)
    return deviation(rows.groupBy("route_id", "date_actual").agg(percentile("duration_seconds", 0.5).alias("daily_median")), today)


def today_vs_pooled(facts: DataFrame, dim: DataFrame, today: str) -> DataFrame:
    """Today's median against the pooled median of four weeks' same weekdays; they meet by the route alone, so kinds of a route meet each other's history."""
    now = F.col("date_actual") == F.lit(today).cast("date")
    median = lambda when: F.percentile(F.when(when, F.col("duration_seconds")), F.lit(0.5))
    kinds = _four_weeks(facts, dim, today).groupBy("route_id", "is_circular").agg(F.count_if(now).alias("n_now"), F.count_if(~now).alias("n_past"), median(now).alias("today_median_seconds"), median(~now).alias("past"))
    # A route has three kinds at most, so its kinds are one short list. A null route meets no history.
    routes = kinds.groupBy("route_id").agg(F.collect_list(F.struct("*")).alias("_kinds"))
    past = F.filter("_kinds", lambda k: (k["n_past"] > 0) & k["route_id"].isNotNull())
    pairs = routes.select("route_id", F.explode(F.filter("_kinds", lambda k: k["n_now"] > 0)).alias("k"), past.alias("_past")).select("route_id", "k", F.explode_outer("_past").alias("p"))
    rows = pairs.select("route_id", "k.is_circular", "k.today_median_seconds", F.col("p.past").alias("historical_median_seconds"))
    change = (F.col("today_median_seconds") - F.col("historical_median_seconds")) / F.nullif(F.col("historical_median_seconds"), F.lit(0)) * 100
    return rows.withColumn("deviation_pct", F.round(change.cast("decimal(18,6)"), 2).cast("double"))


def duration_by_hour(facts: DataFrame, dim: DataFrame, filters: Filters | None = None) -> DataFrame:
    return started(facts, dim, filters).groupBy("hour_of_day").agg(one_decimal(F.avg("duration_seconds") / 60).alias("avg_duration_minutes"), F.count("*").alias("trip_count"))


def speed_by_hour(facts: DataFrame, dim: DataFrame, filters: Filters | None = None) -> DataFrame:
    return started(facts, dim, filters).groupBy("hour_of_day").agg(F.round(F.avg("avg_speed_kmh"), 6).alias("avg_speed_kmh"), F.count("*").alias("trip_count"))


def speed_by_route_hour(facts: DataFrame, dim: DataFrame) -> DataFrame:
    return started(facts, dim).groupBy("route_id", "hour_of_day", "is_circular").agg(F.round(F.avg("avg_speed_kmh"), 6).alias("avg_speed_kmh"), F.count("*").alias("trip_count"))


def reliability(facts: DataFrame) -> DataFrame:
    index = F.round(F.stddev_samp("duration_seconds") / F.nullif(F.avg("duration_seconds"), F.lit(0)), 6)
    return facts.groupBy("route_id", "is_circular").agg(index.alias("reliability_index"), F.count("*").alias("trip_count")).orderBy(F.asc_nulls_last("reliability_index"))


def route_summary(facts: DataFrame, details: DataFrame, dim: DataFrame, route: str, filters: Filters | None = None) -> DataFrame:
    """A route, which is required, with the names of its terminals."""
    names = details.select("trip_id", "first_stop_name", "last_stop_name", F.col("is_circular").alias("loop"))
    rows = started(facts, dim, filters).where(F.col("route_id") == route).join(names, "trip_id")
    return rows.groupBy("route_id", "first_stop_name", "last_stop_name", F.col("loop").alias("is_circular")).agg(
        F.count("*").alias("total_trips"), one_decimal(percentile("duration_seconds", 0.5) / 60).alias("median_duration_minutes"), F.round(F.avg("avg_speed_kmh"), 6).alias("avg_speed_kmh"),
        F.round(F.stddev_samp("duration_seconds") / F.nullif(F.avg("duration_seconds"), F.lit(0)), 6).alias("duration_consistency"),
    )


def of_line(latest: DataFrame, line: str | None = None, direction: int | None = None) -> DataFrame:
    """The live panels' optional filters."""
    rows = latest if line is None else latest.where(F.col("linha_lt") == line)
    return rows if direction is None else rows.where(F.col("linha_sentido") == direction)


def live_fleet(latest: DataFrame, details: DataFrame, line: str | None = None, direction: int | None = None) -> DataFrame:
    """One marker per vehicle with its terminals; latest: as of positions.latest_by_vehicle."""
    names = details.select("trip_id", "first_stop_name", "last_stop_name", "is_circular")
    return of_line(latest, line, direction).drop("is_circular").join(names, "trip_id", "left").select("veiculo_id", "linha_lt", "linha_sentido", "veiculo_lat", "veiculo_long", "veiculo_ts", "first_stop_name", "last_stop_name", "is_circular")


def live_freshness(latest: DataFrame, as_of: Column, line: str | None = None, direction: int | None = None) -> DataFrame:
    newest = of_line(latest, line, direction).groupBy("veiculo_id").agg(F.max("veiculo_ts").alias("ts")).agg(F.count("*").alias("active_vehicle_count"), F.max("ts").alias("latest_snapshot_ts"))
    age = F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(F.col("latest_snapshot_ts").cast("timestamp"))
    return newest.withColumn("snapshot_age_seconds", age)


def trip_monitor(facts: DataFrame, dim: DataFrame, since: str) -> DataFrame:
    """Mean duration of recent trips by line and period of the day."""
    hour = F.col("hour_of_day")
    period = F.when(hour < 6, "night").when(hour < 12, "morning").when(hour < 18, "afternoon").otherwise("evening")
    facts = facts.where(F.col("date") >= F.to_date(F.lit(since))) if "date" in facts.columns else facts  # the same clock as started_at's
    rows = started(facts, dim).where(F.expr(f"started_at >= timestamp_ntz'{since}'")).withColumn("period", period)
    return rows.groupBy("route_id", "period").agg(F.count("*").alias("trips"), F.min("started_at").alias("first_start"), F.max("ended_at").alias("last_end"), F.round(F.avg("duration_seconds"), 6).alias("avg_duration_seconds"))
