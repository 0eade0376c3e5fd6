"""Views over the given tables that stand for the platform's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-29"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id", "ts", "user_id", "event_type", "value", "cast(get_json_object(props, '$.k') as bigint) AS k")


def positions(spark: SparkSession, sf_dir: str, near: bool = False) -> DataFrame:
    """near: some rows lie within the radius of both terminals."""
    last = "cast(abs(k - 30) * 5 AS double)" if near else "cast((99 - k) * 5 AS double)"
    return events(spark, sf_dir).selectExpr(
        "concat(cast(user_id % 10 AS string), '-10') AS linha_lt", "user_id AS veiculo_id", "cast(CASE WHEN k % 4 = 0 THEN 2 ELSE 1 END AS int) AS linha_sentido", "user_id % 5 = 0 AS is_circular", "ts AS veiculo_ts",
        "cast(date_trunc('minute', ts) AS timestamp_ntz) AS extracao_ts", "cast(-23.55 + (k - 50) * 0.4 AS double) AS veiculo_lat", "cast(-46.63 + ((k * 7) % 100 - 50) * 0.4 AS double) AS veiculo_long",
        "cast(k * 5 AS double) AS distance_to_first_stop", f"{last} AS distance_to_last_stop", "cast(CASE WHEN user_id % 37 = 0 THEN 0 ELSE 1000 + 10 * (user_id % 50) END AS double) AS trip_linear_distance", "event_id",
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS stop_id", "s_name AS stop_name", "cast(-23.9 + (s_suppkey % 70) * 0.01 AS double) AS stop_lat", "cast(-46.9 + (s_suppkey % 60) * 0.01 AS double) AS stop_lon")


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        # Every supplier is a stop; an order in five goes round to the stop where it began.
        .agg(F.min(F.expr("CASE WHEN l_orderkey % 10 < 2 THEN 1 + l_orderkey % 7 ELSE l_suppkey END")).alias("stop_id"))
        .selectExpr("concat(cast(l_orderkey div 2 AS string), '-10-', cast(l_orderkey % 2 AS string)) AS trip_id", "l_linenumber AS stop_sequence", "stop_id")
    )


def finished_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).selectExpr(
        "concat(cast(user_id % 10 AS string), '-10-', cast(k % 2 AS string)) AS trip_id", "user_id AS vehicle_id", "ts AS trip_start_time", "cast(60 + k * 30 AS int) AS duration_seconds", "user_id % 5 = 0 AS is_circular",
        "cast(500 + k * 100 + value AS double) AS distance_meters", "cast(date_trunc('day', ts) AS timestamp_ntz) AS logic_date",
    )
    return rows.withColumns({"trip_end_time": F.expr("cast(trip_start_time + make_dt_interval(0, 0, 0, duration_seconds) AS timestamp_ntz)"), "avg_speed_kmh": F.expr("distance_meters / duration_seconds * 3.6")})


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderpriority AS pipeline", "CASE o_orderstatus WHEN 'F' THEN 'FAIL' WHEN 'P' THEN 'WARN' ELSE 'PASS' END AS status", "cast(o_custkey % 20 AS bigint) AS items_failed",
        "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 1 - (o_orderkey % 50) / 1000 END AS acceptance_rate", "o_orderdate AS received_at", "o_orderkey AS seq",
    )
