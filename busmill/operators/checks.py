"""Batch checks with PASS, WARN or FAIL, reports, and the decision to notify."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANK = {"PASS": 0, "WARN": 1, "FAIL": 2}


def status(fail: Column, warn: Column) -> Column:
    return F.when(fail, "FAIL").when(warn, "WARN").otherwise("PASS")


def worst(*statuses: Column) -> Column:
    out = F.lit("PASS")
    for name in ("WARN", "FAIL"):
        found = F.lit(False)
        for s in statuses:
            found = found | (s == name)
        out = F.when(found, name).otherwise(out)
    return out


def minutes(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 60e6


def freshness(positions: DataFrame, reference: Column, warn: float = 10, fail: float = 30) -> DataFrame:
    """Lag of the newest position; no positions fail."""
    lag = F.round(minutes(F.max("veiculo_ts"), reference), 2)
    rows = positions.agg(lag.alias("observed_lag_minutes"))
    late = F.col("observed_lag_minutes")
    return rows.withColumn("status", status(late.isNull() | (late > fail), late > warn))


def recent_gaps(positions: DataFrame, reference: Column, warn: float = 5, fail: float = 15, window: int = 60) -> DataFrame:
    """Largest gap between distinct extraction times of the last minutes; fewer than two fail."""
    # Bounds on the column itself, so that they reach the scan; what is later than the reference is no part of the window.
    recent = positions.where((F.col("extracao_ts") >= reference - F.expr(f"INTERVAL {window} MINUTES")) & (F.col("extracao_ts") <= reference)).select("extracao_ts").distinct()
    # Distinct minutes of one window: few, whatever the number of positions.
    gap = minutes(F.lag("extracao_ts").over(Window.orderBy("extracao_ts")), F.col("extracao_ts"))
    rows = recent.withColumn("gap", gap).agg(F.count("*").alias("distinct_extracao_ts"), F.round(F.max("gap"), 2).alias("max_gap_minutes"))
    gap = F.col("max_gap_minutes")
    return rows.withColumn("status", status((F.col("distinct_extracao_ts") < 2) | (gap > fail), gap > warn))


def trips_quality(metrics: DataFrame, positions: DataFrame, window_threshold: float = 60, fewest: int = 5, most_failed: float = 0.05) -> DataFrame:
    """metrics: as of trajectory.extraction_metrics. Zero and few trips in a long window, and failed groups, warn."""
    window = positions.agg(F.round(minutes(F.min("extracao_ts"), F.max("extracao_ts")), 2).alias("effective_window_minutes"))
    rows = metrics.crossJoin(F.broadcast(window))  # one row each
    long = F.col("effective_window_minutes") > window_threshold
    rate = F.coalesce(F.round(F.col("groups_failed") / F.nullif(F.col("groups_total"), F.lit(0)), 4), F.lit(0.0))
    none, few = long & (F.col("trips_total") == 0), long & (F.col("trips_total") < fewest)
    rows = rows.select("effective_window_minutes", "trips_total", rate.alias("group_failure_rate"), status(F.lit(False), none).alias("zero_trips"), status(F.lit(False), few).alias("low_trip_count"))
    rows = rows.withColumn("group_failures", status(F.lit(False), F.col("group_failure_rate") > most_failed))
    return rows.withColumn("status", worst(*(F.col(c) for c in ("zero_trips", "low_trip_count", "group_failures"))))


def facts_quality(measured: DataFrame, read: DataFrame, uncovered: DataFrame, warn: float = 0.01, fail: float = 0.05) -> DataFrame:
    """measured: as of facts.measured; read: trips of the batch; uncovered: facts without an hour."""
    counts = measured.crossJoin(F.broadcast(read.agg(F.count("*").alias("finished_trips_read")))).crossJoin(F.broadcast(uncovered.agg(F.count("*").alias("uncovered_dim_keys"))))  # one row each
    loss = F.coalesce((F.col("finished_trips_read") - F.col("persisted_facts")) / F.nullif(F.col("finished_trips_read"), F.lit(0)), F.lit(0.0))
    rows = counts.withColumn("loss_rate", loss)
    bad = (F.col("negative_duration") + F.col("negative_distance") + F.col("time_incoherent") + F.col("implausible_speed")) > 0
    rows = rows.withColumns({"completeness": status(F.col("loss_rate") > fail, F.col("loss_rate") > warn), "coverage": status(F.col("uncovered_dim_keys") > 0, F.lit(False)), "value_domain": status(bad, F.lit(False))})
    return rows.withColumn("status", worst(F.col("completeness"), F.col("coverage"), F.col("value_domain")))


def acceptance(counts: DataFrame, passing: float = 1.0, warning: float = 0.98) -> DataFrame:
    """counts: total_rows, rows_failed, expectations_with_violations."""
    rate = F.coalesce((F.col("total_rows") - F.col("rows_failed")) / F.nullif(F.col("total_rows"), F.lit(0)), F.lit(0.0))
    rows = counts.withColumn("acceptance_rate", rate)
    clean = (F.col("acceptance_rate") >= passing) & (F.col("expectations_with_violations") == 0)
    return rows.withColumn("status", F.when(clean, "PASS").when(F.col("acceptance_rate") >= warning, "WARN").otherwise("FAIL"))


#: What a report's summary has besides what every one has; a check row may have them as columns.
OPTIONAL = {"failure_phase": "string", "failure_message": "string", "items_failed": "long", "acceptance_rate": "double", "quality_report_path": "string"}


def report(rows: DataFrame, pipeline: str, execution_id: Column, generated_at: Column, version: str = "v1") -> DataFrame:
    """Check rows as report rows: summary and details, with the partition of local time. OPTIONAL columns go to the summary, null where rows lack them."""
    details = [c for c in rows.columns if c != "status" and c not in OPTIONAL]
    rows = rows.withColumns({c: F.lit(None).cast(kind) for c, kind in OPTIONAL.items() if c not in rows.columns})
    at = F.from_utc_timestamp(generated_at, "America/Sao_Paulo")
    parts = [F.date_format(at, f).alias(n) for f, n in (("yyyy", "year"), ("MM", "month"), ("dd", "day"), ("HH", "hour"))]
    summary = F.struct(F.lit(version).alias("contract_version"), F.lit(pipeline).alias("pipeline"), execution_id.alias("execution_id"), F.col("status"), *[F.col(c).cast(kind).alias(c) for c, kind in OPTIONAL.items()], generated_at.alias("generated_at_utc"))
    return rows.select(summary.alias("summary"), F.to_json(F.struct(*details)).alias("details"), F.lit(pipeline).alias("pipeline"), *parts)


def failure(spark: SparkSession, phase: str, message: str) -> DataFrame:
    """The check row of a run that broke off in a phase."""
    return spark.createDataFrame([("FAIL", phase, message, 0)], "status string, failure_phase string, failure_message string, items_failed long")


def correlation_ids(rows: DataFrame, by: str, column: str, most: int = 50) -> DataFrame:
    """Per group the first distinct values in order, how many there are, and whether some were cut off; a report's limit."""
    known = rows.select(by, F.col(column).cast("string").alias("_id")).distinct()
    totals = known.groupBy(by).agg(F.count("_id").alias("_total"))
    # The rank keeps `most` values a group before they are shuffled.
    first = known.where("_id IS NOT NULL").withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy("_id"))).where(F.col("_n") <= most)
    ids = first.groupBy(by).agg(F.array_sort(F.collect_list("_id")).alias("ids")).withColumnRenamed(by, "_by")
    out = totals.join(ids, F.col(by).eqNullSafe(F.col("_by")), "left")
    return out.select(by, F.coalesce("ids", F.array().cast("array<string>")).alias("ids"), F.col("_total").cast("int").alias("total"), (F.col("_total") > most).alias("truncated"))


def cumulative(summaries: DataFrame, items: int, ratio: float, run: int, last: int | None = None, since: Column | None = None) -> DataFrame:
    """Per pipeline, over its newest `last` summaries or those since a time: failed items, mean failed ratio (a missing rate
    counts as all failed), the run of WARN at the head, and whether one of them reaches its threshold."""
    newest = Window.partitionBy("pipeline").orderBy(F.desc("received_at"), F.desc("seq"))
    rows = summaries if since is None else summaries.where(F.col("received_at") >= since)
    rows = rows.withColumn("_n", F.row_number().over(newest))
    rows = rows if last is None else rows.where(F.col("_n") <= last)
    # The run ends with the first summary that isn't WARN.
    first_other = F.min(F.when(F.col("status") != "WARN", F.col("_n")))
    out = rows.groupBy("pipeline").agg(
        F.sum(F.coalesce("items_failed", F.lit(0))).alias("items_failed"), F.avg(1 - F.coalesce("acceptance_rate", F.lit(0.0))).alias("avg_failed_ratio"), (F.coalesce(first_other, F.count("*") + 1) - 1).alias("consecutive_warn")
    )
    fires = (F.col("items_failed") >= items) | (F.col("avg_failed_ratio") >= ratio) | (F.col("consecutive_warn") >= run)
    return out.withColumn("cumulative_warn", fires)


def marks(summaries: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """pipeline, run: how many summaries each pipeline has had since its last one that isn't WARN, by sums on the map side. before: the marks at the
    first of these summaries, so that marks go on from batch to batch without a pipeline's past."""
    at = F.struct("received_at", "seq")
    last = summaries.groupBy(F.col("pipeline").alias("_p")).agg(F.max(F.when(F.col("status") != "WARN", at)).alias("_last"))
    rows = summaries.join(F.broadcast(last), F.col("pipeline").eqNullSafe(F.col("_p")))  # one row a pipeline, so that no task reads a pipeline whole
    out = rows.groupBy("pipeline").agg(F.count_if(F.col("_last").isNull() | (at > F.col("_last"))).alias("run"), F.first(F.col("_last").isNull()).alias("_open"))
    if before is None:
        return out.drop("_open")
    old = before.select(F.col("pipeline").alias("_old"), F.col("run").alias("_run"))
    both = out.join(old, F.col("pipeline").eqNullSafe(F.col("_old")), "full")
    run = F.coalesce("run", F.lit(0)) + F.when(F.coalesce("_open", F.lit(True)), F.coalesce("_run", F.lit(0))).otherwise(0)
    return both.select(F.coalesce("pipeline", "_old").alias("pipeline"), run.alias("run"))


def _within_parts(rows: DataFrame) -> DataFrame:
    """rows with their number in their part and that of the last one up to them that isn't WARN."""
    order = Window.partitionBy("_key").orderBy("received_at", "seq")
    rows = rows.withColumn("_n", F.row_number().over(order))
    return rows.withColumn("_other", F.max(F.when(F.col("status") != "WARN", F.col("_n"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def _open_runs(rows: DataFrame, before: DataFrame | None) -> DataFrame:
    """_open for each part: how many summaries its pipeline has had before it since the last one that isn't WARN. What is scanned by pipeline is a row a part."""
    parts = _within_parts(rows).groupBy("_key").agg(F.max("_n").alias("_rows"), F.max("_other").alias("_last"))
    carried = F.lit(0)
    if before is not None:
        marks = before.select(F.col("pipeline").alias("_p"), F.col("run").alias("_carried"))
        parts = parts.join(F.broadcast(marks), F.col("_key.pipeline") == F.col("_p"), "left")  # one row a pipeline
        carried = F.coalesce("_carried", F.lit(0))
    earlier = Window.partitionBy("_key.pipeline").orderBy("_key._part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_so_far", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    return parts.select("_key", (F.col("_so_far") - F.coalesce(F.max(F.col("_so_far") + F.col("_last")).over(earlier), -carried)).alias("_open"))


def _in_window(rows: DataFrame, seconds: int) -> DataFrame:
    """For each second of a part the summaries, failed items and mean failed ratio of the `seconds` up to it. Summaries are added up by second on the map side, and
    each second goes to its own part and the next, in which alone it can be in a window."""
    sums = rows.groupBy("_key", "_at").agg(F.count("*").alias("_c"), F.sum(F.coalesce("items_failed", F.lit(0))).alias("_i"), F.sum(1 - F.coalesce("acceptance_rate", F.lit(0.0))).alias("_f"))
    sums = sums.withColumn("_for", F.explode(F.expr("if(_at IS NULL, array(_key._part), array(_key._part, _key._part + 1))")))
    window = Window.partitionBy("_key.pipeline", "_for").orderBy("_at").rangeBetween(-seconds, 0)
    sums = sums.withColumns({"_count": F.sum("_c").over(window), "_items": F.sum("_i").over(window), "_ratio": F.sum("_f").over(window) / F.sum("_c").over(window)})
    return sums.where("_for <=> _key._part").select("_key", "_at", "_count", "_items", "_ratio")


def decisions(summaries: DataFrame, thresholds: DataFrame, hours: int = 24, since: str | None = None, before: DataFrame | None = None) -> DataFrame:
    """What to do with each summary: sent, stored or ignored, and why.

    thresholds: pipeline, max_failed_items, max_failed_ratio, max_consecutive_warn, notify_on_fail, notify_on_warn. A WARN is
    judged on its pipeline's summaries of the hours up to its own.

    since, before: decides on summaries from a time on alone, and then reads only the hours before it and the marks of each pipeline at that time (as of
    `marks`), however long its past. Without marks no run goes back beyond `since`.

    No task holds a pipeline: rows are numbered a part of a pipeline at a time, a day or the hours if they are more, and read what they carry in from a row a part."""
    at = F.unix_seconds(F.col("received_at").cast("timestamp"))
    new = F.lit(True)
    if since is not None:
        # Windows go by whole seconds, so a row in the second that is `hours` before belongs to it.
        start = F.lit(since).cast("timestamp")
        new = F.col("received_at").cast("timestamp") >= start
        summaries = summaries.where(F.col("received_at") >= F.date_trunc("second", start - F.expr(f"INTERVAL {int(hours)} HOURS")).cast(summaries.schema["received_at"].dataType))
    # Parts of a pipeline, of the window's length or more: a window reaches back into the part before at most. Rows without a time are a part before all others.
    width = max(hours, 24) * 3600
    rows = summaries.withColumn("_at", at).withColumn("_new", new).withColumn("_part", F.floor(F.col("_at") / width)).withColumn("_key", F.struct("pipeline", "_part"))
    told = _in_window(rows, hours * 3600).join(_open_runs(rows.where("_new"), before), "_key").select(F.struct("_key", "_at").alias("_second"), "_count", "_items", "_ratio", "_open")
    own = _within_parts(rows.where("_new")).withColumn("_second", F.struct("_key", "_at")).join(told, "_second")
    # WARNs since the last summary that isn't one, within the window.
    rows = own.withColumn("_run", F.least(F.col("_n") - F.coalesce("_other", -F.col("_open")), "_count")).join(F.broadcast(thresholds), "pipeline", "left")  # a table of settings
    known = F.col("max_failed_items").isNotNull()
    fires = (F.col("_items") >= F.col("max_failed_items")) | (F.col("_ratio") >= F.col("max_failed_ratio")) | (F.col("_run") >= F.col("max_consecutive_warn"))
    valid = F.col("status").isin(*RANK)
    outcome = (
        F.when(~valid | F.col("status").isNull(), "ignored:unknown_status")
        .when(F.col("status") == "PASS", "stored:pass_status")
        .when(~known, "ignored:unknown_pipeline")
        .when((F.col("status") == "FAIL") & F.col("notify_on_fail"), "sent:fail")
        .when((F.col("status") == "WARN") & F.col("notify_on_warn") & fires, "sent:cumulative_warn")
        .otherwise("stored")
    )
    return rows.select("pipeline", "seq", "status", outcome.alias("decision"))
