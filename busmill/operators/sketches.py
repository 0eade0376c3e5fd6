"""Percentiles that add up: a quantile sketch for each group and local date, kept as a table and merged for any range of dates.

The sketches are KLL's. Merged ones are as good as one over all rows: the share of values at or below the answer differs from the one asked for by less than
`rank_error(k)`, with 99 % confidence, and a merged group of at most k values is exact. The answer is a value of the group, as percentile_disc's, not one between two.
A panel over 90 days reads 90 rows a group instead of the facts. Null values count as trips but have no place in a sketch; a group without values has no percentile.

`exact` has no such error: sketches only place the cuts around each rank, counts between cuts tell the part that the rank falls into, and the values of that part alone are counted one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import local
from ..plans import dashboards

K = 4096


def rank_error(k: int = K) -> float:
    """The bound on the error of a rank, as the sketch's authors fitted it: 99 % of answers lie within."""
    return 2.296 / k**0.9021


def daily(facts: DataFrame, by: tuple[str, ...] = ("route_id",), column: str = "duration_seconds", k: int = K) -> DataFrame:
    """A row for each group and local date of the start: trips, values, their sum, a sketch of them. Sketches are made on the map side and merged."""
    value = F.col(column).cast("double")
    return facts.groupBy(*by, F.to_date(local(F.col("started_at"))).alias("date_actual")).agg(
        F.count("*").alias("trip_count"), F.count(value).alias("value_count"), F.sum(value).alias("total"), F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch")
    )


def save(facts: DataFrame, path: str, by: tuple[str, ...] = ("route_id",), column: str = "duration_seconds", k: int = K) -> None:
    """Writes the dates that the facts span; a date written again replaces itself and no other, so the facts must hold these dates whole."""
    rows = daily(facts, by, column, k)
    rows.repartition("date_actual").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date_actual").parquet(path)


def read(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The rows of the local dates first to last; other dates aren't read."""
    rows = spark.read.parquet(path)
    rows = rows if first is None else rows.where(F.col("date_actual") >= F.lit(first).cast("date"))
    return rows if last is None else rows.where(F.col("date_actual") <= F.lit(last).cast("date"))


def merged(rows: DataFrame, by: tuple[str, ...] = ("route_id",)) -> DataFrame:
    """One row for each group, of all dates."""
    sums = [F.sum(c).alias(c) for c in ("trip_count", "value_count", "total")]
    return rows.groupBy(*by).agg(*sums, F.kll_merge_agg_double("sketch").alias("sketch"))


def quantile(p: float) -> Column:
    """The least value that p of the group's values don't pass."""
    return F.when(F.col("value_count") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p)))


def exact(facts: DataFrame, ps: tuple[str, ...], by: tuple[str, ...] = ("route_id",), column: str = "duration_seconds", k: int = K) -> DataFrame:
    """For each group its trip_count, value_count and, for each p of ps (as decimals, in text), the least value that p of its values don't pass, as the array `quantiles`.

    A sketch that errs makes the part that is counted larger, but changes no result. A part's rows are summed by value on the map side, and no task holds a group."""
    near = [F.lit(min(max(float(p) + d, 0.0), 1.0)) for p in sorted(ps, key=float) for d in (-rank_error(k), rank_error(k))]
    cuts = F.when(F.col("value_count") > 0, F.kll_sketch_get_quantile_double("sketch", F.array(*near)))
    groups = merged(daily(facts, by, column, k), by).select(F.struct(*by).alias("_key"), "trip_count", "value_count", cuts.alias("_cuts"))
    values = facts.select(F.struct(*by).alias("_key"), F.col(column).cast("double").alias("_value")).where("_value IS NOT NULL")
    # The part of a value is the number of cuts below it.
    values = values.join(F.broadcast(groups.select("_key", "_cuts")), "_key").selectExpr("_key", "size(filter(_cuts, c -> c < _value)) AS _part", "_value")  # one row a group
    parts = values.groupBy("_key", "_part").agg(F.count("*").alias("_n")).selectExpr("*", "sum(_n) OVER (PARTITION BY _key ORDER BY _part) - _n AS _before")
    ranks = groups.selectExpr("_key AS _group", f"posexplode(array({', '.join(f'CAST(ceil(value_count * {p}BD) AS long)' for p in ps)})) AS (_p, _rank)").withColumn("_rank", F.greatest("_rank", F.lit(1)))
    wanted = parts.join(ranks, (F.col("_key") == F.col("_group")) & (F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_n")))
    wanted = wanted.groupBy("_key", "_part").agg(F.collect_list(F.expr("struct(_p, _rank - _before AS _rank)")).alias("_wanted"))
    counts = values.join(F.broadcast(wanted), ["_key", "_part"]).groupBy("_key", "_part", "_value").agg(F.count("*").alias("_n"), F.first("_wanted").alias("_wanted"))  # a row a group and p
    counts = counts.selectExpr("*", "sum(_n) OVER (PARTITION BY _key, _part ORDER BY _value) AS _upto")
    found = counts.selectExpr("_key", "_value", "explode(filter(_wanted, w -> w._rank > _upto - _n AND w._rank <= _upto)) AS _w").groupBy("_key").agg(*[F.max(F.when(F.col("_w._p") == i, F.col("_value"))).alias(f"_{i}") for i in range(len(ps))])
    out = groups.drop("_cuts").join(found, "_key", "left")
    return out.select(*[F.col(f"_key.{c}").alias(c) for c in by], "trip_count", "value_count", F.array(*[f"_{i}" for i in range(len(ps))]).alias("quantiles"))


def exact_median_and_p95(facts: DataFrame, min_trips: int = 5) -> DataFrame:
    """The panel of `median_and_p95` without its error, over all dates of the facts."""
    minutes = lambda i: dashboards.one_decimal(F.col("quantiles")[i] / 60)
    out = exact(facts, ("0.5", "0.95")).select("route_id", minutes(0).alias("median_duration_minutes"), minutes(1).alias("p95_duration_minutes"), "trip_count")
    return out.where(F.col("trip_count") >= min_trips)


def median_and_p95(rows: DataFrame, min_trips: int = 5) -> DataFrame:
    """The panel of dashboards.median_and_p95 over the sketches' dates."""
    minutes = lambda p: dashboards.one_decimal(quantile(p) / 60)
    out = merged(rows).select("route_id", minutes(0.5).alias("median_duration_minutes"), minutes(0.95).alias("p95_duration_minutes"), "trip_count")
    return out.where(F.col("trip_count") >= min_trips)


def today_vs_baseline(rows: DataFrame, today: str) -> DataFrame:
    """The panel of dashboards.today_vs_baseline, by the medians of the sketches: five rows a route."""
    days = merged(rows, ("route_id", "date_actual")).select("route_id", "date_actual", quantile(0.5).alias("daily_median"))
    return dashboards.deviation(days, today)
