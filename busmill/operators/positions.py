"""From raw snapshots to trusted and quarantined positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import terminal_distance_m, trip_id
from ..schemas import POSITION_COLUMNS, QUARANTINE_COLUMNS

#: API code, domain name.
RENAMED = [("c", "linha_lt"), ("cl", "linha_code"), ("sl", "linha_sentido"), ("lt0", "lt_destino"), ("lt1", "lt_origem"), ("p", "veiculo_id"), ("a", "veiculo_acessivel"), ("ta", "veiculo_ts"), ("py", "veiculo_lat"), ("px", "veiculo_long")]
JOIN_MISS, NO_DISTANCE = "transform_error:trip_details_missing", "transform_error:distance_calculation"


def flatten(raw: DataFrame) -> DataFrame:
    """One row per vehicle, with its line; lines without vehicles vanish."""
    lines = raw.select(F.col("metadata.extracted_at").alias("extracted_at"), F.explode("payload.l").alias("l"))
    rows = lines.select("extracted_at", "l.*").select("*", F.explode("vs").alias("v")).drop("vs")
    return rows.select("extracted_at", "qv", "c", "cl", "sl", "lt0", "lt1", "v.*")


def normalise(flat: DataFrame) -> DataFrame:
    """Domain names and types: ids must be whole numbers; bad times and coordinates become null."""
    kinds: dict[str, Column] = {"linha_code": F.col("cl").cast("int"), "linha_sentido": F.col("sl").cast("int"), "veiculo_id": F.col("p").cast("long"), "veiculo_ts": F.try_to_timestamp("ta"), "veiculo_lat": F.expr("try_cast(py AS double)"), "veiculo_long": F.expr("try_cast(px AS double)")}
    return flat.select(F.try_to_timestamp("extracted_at").alias("extracao_ts"), *[kinds.get(name, F.col(code)).alias(name) for code, name in RENAMED])


def enriched(positions: DataFrame, details: DataFrame) -> DataFrame:
    """Positions with their trip's details and distances to both terminals, and invalid_reason where either fails."""
    known = details.select(F.col("trip_id").alias("known_id"), *[c for c in details.columns if c != "trip_id" and c not in positions.columns])
    rows = positions.withColumn("trip_id", trip_id(F.col("linha_lt"), F.col("linha_sentido"))).join(known, F.col("trip_id") == F.col("known_id"), "left")
    for side in ("first", "last"):
        distance = terminal_distance_m(F.col("veiculo_lat"), F.col("veiculo_long"), F.col(f"{side}_stop_lat"), F.col(f"{side}_stop_lon"))
        rows = rows.withColumn(f"distance_to_{side}_stop", distance)
    failed = (F.col("distance_to_first_stop") == -1) | (F.col("distance_to_last_stop") == -1)
    return rows.withColumn("invalid_reason", F.when(F.col("known_id").isNull(), JOIN_MISS).when(failed, NO_DISTANCE)).drop("known_id")


def valid(rows: DataFrame) -> DataFrame:
    return rows.where("invalid_reason IS NULL").drop("invalid_reason")


def invalid(rows: DataFrame, failed_at: Column) -> DataFrame:
    return rows.where("invalid_reason IS NOT NULL").withColumn("validation_failed_at", failed_at)


def trusted(rows: DataFrame) -> DataFrame:
    """The columns of the trusted table alone."""
    return rows.select(*POSITION_COLUMNS)


def united_invalid(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All that is rejected, by the transform and by the rules, with the columns of the quarantine; a column that a frame lacks is null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first.select(*QUARANTINE_COLUMNS)


def issues(rows: DataFrame) -> DataFrame:
    """kind, value, n: the vehicles and the trips of an enriched batch that are invalid, one row each."""
    bad = rows.where("invalid_reason IS NOT NULL")
    named = F.explode(F.array(F.struct(F.lit("invalid_vehicle").alias("kind"), F.col("veiculo_id").cast("string").alias("value")), F.struct(F.lit("invalid_trip").alias("kind"), F.col("trip_id").alias("value"))))
    return bad.select(named.alias("x")).where("x.value IS NOT NULL").groupBy("x.kind", "x.value").agg(F.count("*").alias("n"))


def expected(raw: DataFrame) -> DataFrame:
    """One row: the vehicles that the snapshots say they hold, and their lines."""
    return raw.agg(F.coalesce(F.sum("metadata.total_vehicles"), F.lit(0)).alias("expected_vehicles"), F.coalesce(F.sum(F.greatest(F.size("payload.l"), F.lit(0))), F.lit(0)).alias("total_lines_processed"))


def reconciliation(raw: DataFrame) -> DataFrame:
    """Per snapshot: lines, the vehicles that they announce, and those that they list."""
    lines = F.coalesce("payload.l", F.array().cast(raw.schema["payload"].dataType["l"].dataType))
    announced = F.aggregate(lines, F.lit(0), lambda n, x: n + F.coalesce(x["qv"], F.lit(0)))
    listed = F.aggregate(lines, F.lit(0), lambda n, x: n + F.greatest(F.size(x["vs"]), F.lit(0)))
    return raw.select(F.col("metadata.extracted_at").alias("extracted_at"), F.size(lines).alias("lines"), announced.alias("announced"), listed.alias("listed"))


def metrics(rows: DataFrame) -> DataFrame:
    """One row for an enriched batch: counts, quality score, and what is wrong with it."""
    bad = F.col("invalid_reason").isNotNull()
    total, good = F.count("*"), F.count_if(~bad)
    return rows.agg(
        total.alias("total_vehicles"), good.alias("valid_vehicles"), F.count_if(bad).alias("invalid_vehicles"), F.count_distinct("linha_lt").alias("total_lines"),
        F.coalesce(F.round(good / F.nullif(total, F.lit(0)) * 100, 2), F.lit(0.0)).alias("quality_score"), F.count_distinct(F.when(bad, F.col("trip_id"))).alias("invalid_trips"),
        F.count(F.when(bad, F.col("veiculo_id"))).alias("invalid_vehicle_ids"), F.count_distinct(F.when(bad, F.col("linha_lt"))).alias("lines_with_invalid"), F.count_if(F.col("invalid_reason") == NO_DISTANCE).alias("distance_errors"),
    )


def latest_by_vehicle(positions: DataFrame) -> DataFrame:
    """The newest row of each vehicle."""
    newest = Window.partitionBy("veiculo_id").orderBy(F.desc("veiculo_ts"), F.desc("extracao_ts"), "linha_lt", "linha_sentido")
    return positions.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def vehicle_inventory(positions: DataFrame, line: str | None = None) -> DataFrame:
    """Rows, times and directions of each vehicle of a line."""
    rows = positions if line is None else positions.where(F.col("linha_lt") == line)
    return rows.groupBy("linha_lt", "veiculo_id").agg(
        F.count("*").alias("n"), F.min("veiculo_ts").alias("first_ts"), F.max("veiculo_ts").alias("last_ts"), F.min("linha_sentido").alias("min_sentido"), F.max("linha_sentido").alias("max_sentido")
    )


def explore(positions: DataFrame, line: str, vehicle: int | None = None, first_hour: int = 0, last_hour: int = 23, most: int | None = None) -> DataFrame:
    """Rows of a line, and a vehicle of it, between two hours of the day, in order; most is a report's limit."""
    rows = positions.where((F.col("linha_lt") == line) & F.hour("veiculo_ts").between(first_hour, last_hour))
    rows = rows if vehicle is None else rows.where(F.col("veiculo_id") == vehicle)
    rows = rows.orderBy("veiculo_id", "veiculo_ts")
    return rows if most is None else rows.limit(most)
