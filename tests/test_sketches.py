"""Percentiles by merged sketches: ranks within the bound, exact in small groups, dates that replace themselves; panels that read their dates alone."""

import bisect
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from busmill.operators import facts as facts_
from busmill.operators import sketches
from busmill.plans import dashboards, fixtures
from conftest import DATA


@pytest.fixture(scope="module")
def facts(spark):
    return facts_.trip_facts(fixtures.finished_trips(spark, DATA)).drop("duration").persist()


@pytest.fixture(scope="module")
def dim(spark):
    rows = facts_.provision(fixtures.finished_trips(spark, DATA))
    return spark.createDataFrame(rows.collect(), rows.schema)  # so that plans show no scan but the facts'


def off(values, answer, p):
    """How far p lies outside the ranks that the answer's copies take up."""
    low, high = bisect.bisect_left(values, answer) / len(values), bisect.bisect_right(values, answer) / len(values)
    return max(0.0, low - p, p - high)


@pytest.mark.parametrize("k", [64, 200])
def test_ranks_of_many_merged_days(spark, k):
    # One route holds most rows, of a long tail; another all one value.
    rows = spark.range(60_000).selectExpr("CASE WHEN id % 20 = 0 THEN 'b' ELSE 'a' END AS route_id", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 90 AS int)) AS started_at", "CASE WHEN id % 20 = 0 THEN 300 ELSE cast(pow(1.0002, id) AS int) END AS duration_seconds")
    found = sketches.merged(sketches.daily(rows, k=k)).select("route_id", "trip_count", *[sketches.quantile(p / 100).alias(f"p{p}") for p in (1, 25, 50, 75, 95, 99)]).collect()
    assert {r.route_id: r.trip_count for r in found} == {"a": 57_000, "b": 3_000}
    values = {"a": [], "b": []}
    for r in rows.select("route_id", "duration_seconds").orderBy("duration_seconds").collect():
        values[r.route_id].append(r.duration_seconds)
    for r in found:
        for p in (1, 25, 50, 75, 95, 99):
            # A bound of 99 %, so twice of it is safe for a test of chance.
            assert off(values[r.route_id], r[f"p{p}"], p / 100) <= 2 * sketches.rank_error(k)
    assert sketches.rank_error(200) < 0.02 < sketches.rank_error(64)


def test_approximate_panel_keeps_its_ranks(spark):
    rows = spark.range(50_000).selectExpr("'a' AS route_id", "id * id AS duration_seconds", "2024010100 AS started_at_time_dim_key")
    dim = spark.createDataFrame([(2024010100,)], "time_key int")
    r = dashboards.median_and_p95(rows, dim, exact=False).first()
    values = [i * i / 60 for i in range(50_000)]
    for p, answer in ((0.5, r.median_duration_minutes), (0.95, r.p95_duration_minutes)):
        assert abs(bisect.bisect_right(values, answer) / len(values) - p) <= 1 / 10_000 + 1 / 50_000


def test_small_groups_are_exact_and_odd_ones_have_a_result(spark):
    t = datetime(2024, 1, 1, 12)
    rows = [("a", t + timedelta(days=i % 9), (i * 37) % 101) for i in range(100)] + [("none", t, None), ("none", t, None), (None, t, 60), ("one", t, 7)]
    facts = spark.createDataFrame(rows, "route_id string, started_at timestamp_ntz, duration_seconds int")
    found = {r.route_id: r for r in sketches.merged(sketches.daily(facts)).withColumns({"p50": sketches.quantile(0.5), "p95": sketches.quantile(0.95)}).collect()}
    values = sorted(r[2] for r in rows[:100])
    assert (found["a"].p50, found["a"].p95) == (values[49], values[94]) and found["a"].total == sum(values)
    assert (found["none"].trip_count, found["none"].value_count, found["none"].p50) == (2, 0, None)
    assert found[None].p50 == 60 and found["one"].p95 == 7
    assert sketches.merged(sketches.daily(facts.limit(0))).count() == 0


@pytest.mark.parametrize("k", [8, 4096])
def test_exact_ranks_whatever_the_sketch(spark, k):
    """Groups of more than k values, ties, one value, nulls; the ranks are the smallest that p of the values reach."""
    rows = spark.range(20_000).selectExpr("CASE WHEN id % 9 = 0 THEN 'b' WHEN id % 9 = 1 THEN NULL ELSE 'a' END AS route_id", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 5 AS int)) AS started_at", "CASE id % 9 WHEN 0 THEN 300 WHEN 1 THEN cast(id % 40 AS int) ELSE cast(pow(1.0005, id) AS int) END AS duration_seconds")
    rows = rows.unionByName(spark.createDataFrame([("none", datetime(2024, 1, 1), None)] * 5 + [("one", datetime(2024, 1, 1), 7)], "route_id string, started_at timestamp_ntz, duration_seconds int"))
    ps = ("0.5", "0.95", "0", "1", "0.3")
    groups = {}
    for r in rows.collect():
        groups.setdefault(r.route_id, []).append(r.duration_seconds)
    found = {r.route_id: r for r in sketches.exact(rows, ps, k=k).collect()}
    assert found.keys() == groups.keys() == {"a", "b", None, "none", "one"}
    for route, r in found.items():
        values = sorted(v for v in groups[route] if v is not None)
        rank = [max(0, -(-len(values) * int(float(p) * 100) // 100) - 1) for p in ps]
        assert r.quantiles == ([values[i] for i in rank] if values else [None] * len(ps)), route
        assert (r.trip_count, r.value_count) == (len(groups[route]), len(values))
    assert sketches.exact(rows.limit(0), ps).count() == 0


def test_panel_of_many_trips_is_exact(spark):
    """10,000 trips a route, more than a sketch holds, with few distinct durations."""
    rows = spark.range(100_000).selectExpr("concat('r', id % 10) AS route_id", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 30 AS int)) AS started_at", "cast(60 + 30 * (xxhash64(id) & 127) AS int) AS duration_seconds")
    disc = lambda p: F.expr(f"round(cast(percentile_disc({p}) WITHIN GROUP (ORDER BY duration_seconds) / 60 AS decimal(18, 6)), 1)").cast("double")
    plain = rows.groupBy("route_id").agg(disc(0.5), disc(0.95), F.count("*"))
    assert {tuple(r) for r in sketches.exact_median_and_p95(rows).collect()} == {tuple(r) for r in plain.collect()}


def test_a_date_written_again_replaces_itself(spark, facts, dim, tmp_path):
    path = f"{tmp_path}/s"
    sketches.save(facts, path)
    whole = sketches.median_and_p95(sketches.read(spark, path), 1).orderBy("route_id").collect()
    of_day = facts.where(F.col("started_at_time_dim_key").between(2024011000, 2024011023))
    sketches.save(of_day, path)
    assert sketches.median_and_p95(sketches.read(spark, path), 1).orderBy("route_id").collect() == whole
    chosen = sketches.read(spark, path, "2024-01-05", "2024-01-12")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "date_actual" in plan.split("PartitionFilters: ")[1].split("]")[0]
    # Groups here are smaller than k, so the panel is that of exact discrete percentiles over the same dates.
    rows = dashboards.started(facts, dim, dashboards.Filters(date_from="2024-01-05", date_to="2024-01-12"))
    disc = lambda p: F.expr(f"round(cast(percentile_disc({p}) WITHIN GROUP (ORDER BY duration_seconds) / 60 AS decimal(18, 6)), 1)").cast("double")
    exact = rows.groupBy("route_id").agg(disc(0.5).alias("a"), disc(0.95).alias("b"), F.count("*").alias("n")).where("n >= 5")
    assert {tuple(r) for r in sketches.median_and_p95(chosen).collect()} == {tuple(r) for r in exact.collect()}


def stored(spark, facts, path):
    facts.withColumn("date", F.to_date("started_at")).write.partitionBy("date").parquet(path)
    return spark.read.parquet(path)


def test_panels_read_their_dates(spark, facts, dim, tmp_path):
    table = stored(spark, facts, f"{tmp_path}/f")
    some = dashboards.Filters(date_from="2024-01-10", date_to="2024-01-20")
    day = "2024-01-29"
    panels = {
        "baseline": (lambda f: dashboards.today_vs_baseline(f, dim, day), 1), "pooled": (lambda f: dashboards.today_vs_pooled(f, dim, day), 1), "frequency": (lambda f: dashboards.frequency(f, dim, some), 1),
        "p95": (lambda f: dashboards.median_and_p95(f, dim, some), 1), "hours": (lambda f: dashboards.duration_by_hour(f, dim, some), 1), "monitor": (lambda f: dashboards.trip_monitor(f, dim, "2024-01-20 00:00:00"), 1),
    }
    for name, (panel, scans) in panels.items():
        out = panel(table)
        plan = out._jdf.queryExecution().executedPlan().toString()
        filters = [p.split("]")[0] for p in plan.split("PartitionFilters: ")[1:]]
        assert len(filters) == scans and all("date#" in f for f in filters), name  # one scan, of its dates
        assert sorted(map(str, out.collect())) == sorted(map(str, panel(facts).collect())), name
    plan = dashboards.kpis(table, dim, day)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ended_at_time_dim_key,2024012900)" in plan


def test_bounds_keep_every_local_date(spark, facts, dim, tmp_path):
    """Trips around local and UTC midnight are of the panel's day by the dimension, whatever the partition."""
    at = [datetime(2024, 1, 10, h, m) for h in (0, 2, 3, 23) for m in (0, 59)] + [datetime(2024, 1, 11, h, 30) for h in (0, 2, 3)] + [datetime(2024, 1, 9, 23, 30)]
    trips = spark.createDataFrame([("1-10-0", i, t, t + timedelta(minutes=9), 540, False, 1.0, 1.0, t) for i, t in enumerate(at)], "trip_id string, vehicle_id long, trip_start_time timestamp_ntz, trip_end_time timestamp_ntz, duration_seconds int, is_circular boolean, distance_meters double, avg_speed_kmh double, logic_date timestamp_ntz")
    own, hours = facts_.trip_facts(trips).drop("duration"), facts_.provision(trips)
    one = dashboards.Filters(date_from="2024-01-10", date_to="2024-01-10")
    plain = own.join(hours, F.col("started_at_time_dim_key") == F.col("time_key")).where(one.predicate())
    bound = dashboards.started(stored(spark, own, f"{tmp_path}/g"), hours, one)
    assert sorted(r.vehicle_id for r in bound.collect()) == sorted(r.vehicle_id for r in plain.collect()) == [i for i, t in enumerate(at) if (t - timedelta(hours=3)).date() == datetime(2024, 1, 10).date()]
