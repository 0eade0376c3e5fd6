"""The trip-details dimension from GTFS stops and stop times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import planar_m

ENDS = [f"{side}_stop_{part}" for side in ("first", "last") for part in ("id", "name", "lat", "lon")]
COLUMNS = ["trip_id", *ENDS, "trip_linear_distance", "is_circular"]
INTERMEDIATE = "Parada intermediaria"


def _flat(trip: str, first: str, last: str) -> list[Column]:
    stops = [F.col(f"{struct}.{part}").alias(f"{side}_stop_{part}") for side, struct in (("first", first), ("last", last)) for part in ("id", "name", "lat", "lon")]
    distance = planar_m(*(F.col(f"{struct}.{part}") for struct in (first, last) for part in ("lat", "lon")))
    return [F.col(trip).alias("trip_id"), *stops, distance.alias("trip_linear_distance"), (F.col(f"{first}.id") == F.col(f"{last}.id")).alias("is_circular")]


def trip_details(stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """One row per trip and direction, with its first and last stop, the planar distance between them and whether they are one: the second
    direction takes the first one's attributes, and is inferred where it's missing.

    Both directions of a trip are one group, of its id without the direction; so nothing is joined to itself."""
    second, suffixed = F.col("trip_id").like("%-1"), F.col("trip_id").like("%-0") | F.col("trip_id").like("%-1")
    stop = F.struct(F.col("stop_id").alias("id"), F.col("stop_name").alias("name"), F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon"))
    order = F.struct("stop_sequence", "stop_id")
    ends = (
        stop_times.join(stops, "stop_id")
        .withColumns({"_base": F.expr("CASE WHEN trip_id LIKE '%-0' OR trip_id LIKE '%-1' THEN left(trip_id, length(trip_id) - 2) ELSE trip_id END"), "_suffixed": suffixed, "_second": second, "_stop": stop, "_order": order})
        .groupBy("_base", "_suffixed")
        .agg(*[F.expr(f"{f}_by(_stop, _order) FILTER (WHERE {which} _second)").alias(name) for f, which, name in (("min", "NOT", "f0"), ("max", "NOT", "l0"), ("min", "", "f1"), ("max", "", "l1"))])
    )
    own = F.when(~F.col("_suffixed"), F.col("_base")).when(F.col("f0").isNotNull(), F.concat("_base", F.lit("-0")))
    other = F.when(F.col("_suffixed"), F.concat("_base", F.lit("-1")))
    both = ends.select("*", F.posexplode(F.array(own, other)).alias("_n", "_trip")).where("_trip IS NOT NULL")
    # What the first direction lacks is the second's own.
    mixed = lambda a, b: F.struct(*[F.coalesce(F.col(f"{a}.{part}"), F.col(f"{b}.{part}")).alias(part) for part in ("id", "name", "lat", "lon")])
    return both.withColumns({"_first": F.when(F.col("_n") == 0, F.col("f0")).otherwise(mixed("f0", "f1")), "_last": F.when(F.col("_n") == 0, F.col("l0")).otherwise(mixed("l0", "l1"))}).select(*_flat("_trip", "_first", "_last"))


def refined(details: DataFrame) -> DataFrame:
    """For display: a circular trip's far end is an intermediate stop without a place."""
    loop = F.coalesce("is_circular", F.lit(False))
    out = details
    for side, suffix in (("last", "-0"), ("first", "-1")):
        blank = loop & F.col("trip_id").endswith(suffix)
        for part in ("id", "lat", "lon"):
            out = out.withColumn(f"{side}_stop_{part}", F.when(~blank, F.col(f"{side}_stop_{part}")))
        out = out.withColumn(f"{side}_stop_name", F.when(blank, INTERMEDIATE).otherwise(F.col(f"{side}_stop_name")))
    return out


def staged(tables: dict[str, tuple[DataFrame, DataFrame]], target: str, quarantine: str) -> dict[str, str]:
    """All-or-nothing gate: tables maps names to (rows, their violations); one violation sends every table to quarantine."""
    bad = any(not violations.isEmpty() for _, violations in tables.values())
    out = {}
    for name, (rows, _) in tables.items():
        out[name] = f"{quarantine if bad else target}/{name}"
        rows.write.mode("overwrite").parquet(out[name], compression="snappy")
    return out


def file_errors(lines: DataFrame, least: int = 2) -> DataFrame:
    """lines: file, value (one row a line). One row per file that can't be a table: too few lines, or bytes that aren't UTF-8."""
    broken = ~F.is_valid_utf8("value")
    by = lines.groupBy("file").agg(F.count_if(F.trim("value") != "").alias("n"), F.bool_or(broken).alias("broken"))
    error = F.when(F.col("broken"), "not_utf8").when(F.col("n") < least, "too_few_lines")
    return by.select("file", error.alias("error")).where("error IS NOT NULL")
