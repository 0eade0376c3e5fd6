"""Trips out of vehicle positions: spike sanitizer, terminal-to-terminal and circular detectors, materialisation.

Everything is a window over one partitioning, (line, vehicle), and one order, that of time: what would need an order of its own, such as
the rows of one leg, is told from running sums. So a plan has one exchange and one sort, whatever kinds of trip are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions.columns import elapsed_s, haversine_m, speed_kmh, trip_id

GROUP = ["linha_lt", "veiculo_id"]
ORDER = ["veiculo_ts", "extracao_ts", "veiculo_lat", "veiculo_long"]
SERIES = f"(PARTITION BY {', '.join(GROUP)} ORDER BY {', '.join(ORDER)})"
SO_FAR = SERIES[:-1] + " ROWS UNBOUNDED PRECEDING)"


def _whole() -> WindowSpec:
    return Window.partitionBy(*GROUP)


def _shifted(function: str, prefix: str, *columns: str) -> list[str]:
    return [f"{function}({c}) OVER {SERIES} AS {prefix}{c}" for c in columns]


def _speed(a: str, b: str) -> Column:
    """Speed between two rows, given by the prefixes of their columns."""
    places = [F.col(f"{p}{c}") for p in (a, b) for c in ("veiculo_lat", "veiculo_long")]
    return speed_kmh(haversine_m(*places), elapsed_s(F.col(f"{a}veiculo_ts"), F.col(f"{b}veiculo_ts")))


def with_spikes(positions: DataFrame, limit: float = 120.0) -> DataFrame:
    """Adds speed_in, speed_out, speed_across and spike.

    A row is a candidate if it can only be reached and left faster than the limit while its neighbours lie within it. Of consecutive
    candidates every other one is a spike, from the first: after a drop the next row isn't examined."""
    place = ["veiculo_ts", "veiculo_lat", "veiculo_long"]
    rows = positions.selectExpr("*", f"row_number() OVER {SERIES} AS _at", *_shifted("lag", "_before_", *place), *_shifted("lead", "_after_", *place))
    rows = rows.withColumns({"speed_in": _speed("_before_", ""), "speed_out": _speed("", "_after_"), "speed_across": _speed("_before_", "_after_")})
    rows = rows.selectExpr(*positions.columns, "speed_in", "speed_out", "speed_across", "_at", f"coalesce(speed_in > {limit} AND speed_out > {limit} AND speed_across <= {limit}, false) AS _candidate")
    # How many candidates in a row end here; a first row is never one.
    spike = f"_candidate AND (_at - max(CASE WHEN NOT _candidate THEN _at END) OVER {SO_FAR}) % 2 = 1 AS spike"
    return rows.selectExpr(*positions.columns, "speed_in", "speed_out", "speed_across", spike)


def sanitize(positions: DataFrame, limit: float = 120.0) -> DataFrame:
    return with_spikes(positions, limit).where(~F.col("spike")).drop("spike", "speed_in", "speed_out", "speed_across")


def _trips(positions: DataFrame, radius: float, circular: str) -> DataFrame:
    """circular: SQL that tells, alike for all rows of a group, which kind of trip is looked for.

    A terminal-to-terminal trip ends at the first row near a terminal (_a) after rows between terminals, if it is the other one. A row near both counts
    as the other end after a gap: the zone is that of the last clear row, turned by each such row since. A circular trip begins at the anchor
    or where the direction changes, and ends likewise."""
    near = [F.coalesce(F.col(c) < radius, F.lit(False)) for c in ("distance_to_first_stop", "distance_to_last_stop")]
    marked = positions.select("*", near[0].alias("_f"), near[1].alias("_l"), (near[0] | near[1]).alias("_a"))
    # Of the directions between terminals: how many, their sum and that of their squares; they are all equal where n * squares = sum * sum.
    between = "CASE WHEN NOT _a THEN cast(linha_sentido AS long) END"
    rows = marked.selectExpr(
        "*", f"{circular} AS _circular", f"row_number() OVER {SERIES} AS _i", f"first_value(_a) OVER {SERIES} AS _gate", f"max(_a) OVER {SO_FAR} AS _synced",
        f"count({between}) OVER {SO_FAR} AS _n", f"coalesce(sum({between}) OVER {SO_FAR}, 0) AS _s", f"coalesce(sum({between} * {between}) OVER {SO_FAR}, 0) AS _q",
    ).where("CASE WHEN _circular THEN _synced ELSE _a END")
    rows = rows.selectExpr("*", *_shifted("lag", "_p", "_i", "_n", "_s", "_q", "_a", "linha_sentido", "veiculo_ts", "veiculo_lat", "veiculo_long", "trip_linear_distance"))
    rows = rows.selectExpr(
        "*", "coalesce(_i - _p_i > 1, false) AS _gap", "NOT linha_sentido <=> _plinha_sentido AS _turned", "named_struct('ts', veiculo_ts, 'lat', veiculo_lat, 'long', veiculo_long) AS _here"
    )
    rows = rows.selectExpr("*", f"sum(CASE WHEN _gap AND _f AND _l THEN 1 ELSE 0 END) OVER {SO_FAR} AS _flips", f"last(CASE WHEN _p_a IS NULL OR _a OR _turned THEN _here END, true) OVER {SO_FAR} AS _start")
    clear = f"last(CASE WHEN _f <> _l THEN cast(_f AS int) - _flips END, true) OVER {SO_FAR}"
    rows = rows.selectExpr("*", f"pmod({clear} + _flips, 2) AS _zone")
    rows = rows.selectExpr("*", *_shifted("lag", "_p", "_zone", "_start")).where("CASE WHEN _circular THEN NOT _p_a AND (_turned OR _a) ELSE _gap AND _zone <> _p_zone END")
    rows = rows.selectExpr("*", f"row_number() OVER {SERIES} AS _trip").where("_circular OR _gate OR _trip > 1")
    ends = F.col("_p_start.lat"), F.col("_p_start.long"), F.expr("CASE WHEN _turned THEN _pveiculo_lat ELSE veiculo_lat END"), F.expr("CASE WHEN _turned THEN _pveiculo_long ELSE veiculo_long END")
    rows = rows.withColumn("_loop_meters", haversine_m(*ends)).withColumn("_direction", F.expr("CASE WHEN NOT _circular THEN if(_p_zone = 1, 1, 2) WHEN _turned THEN _plinha_sentido ELSE linha_sentido END"))
    return rows.selectExpr(
        *GROUP, "CASE WHEN _circular THEN _p_start.ts ELSE _pveiculo_ts END AS start_ts", "CASE WHEN _circular AND _turned THEN _pveiculo_ts ELSE veiculo_ts END AS end_ts", "cast(_direction AS int) AS direction",
        "NOT _circular AND _n > _p_n AND (_n - _p_n) * (_q - _p_q) = (_s - _p_s) * (_s - _p_s) AND _s - _p_s <> _direction * (_n - _p_n) AS discrepancy", "_circular AS is_circular",
        "CASE WHEN _circular THEN _loop_meters ELSE _ptrip_linear_distance END AS distance_meters",
    )


def non_circular(positions: DataFrame, radius: float = 100.0) -> DataFrame:
    """One row per trip: start and end, direction, and whether the reported direction differs throughout."""
    return _trips(positions, radius, "false")


def circular(positions: DataFrame, radius: float = 100.0) -> DataFrame:
    """One row per trip that leaves its anchor and comes back, or ends where the direction changes on the way."""
    return _trips(positions, radius, "true")


def detected(positions: DataFrame, radius: float = 100.0) -> DataFrame:
    """Trips of every group, of the kind that the group's first row asks for, in one pass."""
    return _trips(positions, radius, f"coalesce(first_value(is_circular) OVER {SERIES}, false)")


def materialised(trips: DataFrame, most_kmh: float = 80.0) -> DataFrame:
    """Detected trips with duration, distance and speed, and why one is left out, if it is: its group has a non-circular trip without
    a distance (group_failed), or it is too fast (too_fast)."""
    bad = ~F.col("is_circular") & F.coalesce(F.col("distance_meters") == 0, F.lit(True))
    return materialised_rows(trips, F.max(bad).over(_whole()), most_kmh)


def materialised_rows(trips: DataFrame, failed: Column, most_kmh: float = 80.0) -> DataFrame:
    """As `materialised`, where `failed` tells whether a trip's group has failed."""
    seconds = F.floor(elapsed_s(F.col("start_ts"), F.col("end_ts"))).cast("int")
    speed = F.when(F.col("duration_seconds") > 0, F.col("distance_meters") / F.col("duration_seconds") * 3.6).otherwise(0.0)
    rows = trips.withColumn("duration_seconds", seconds).withColumn("_failed", failed).withColumn("avg_speed_kmh", speed)
    reason = F.when(F.col("_failed"), "group_failed").when(F.col("avg_speed_kmh") > most_kmh, "too_fast")
    return rows.select(
        trip_id(F.col("linha_lt"), F.col("direction")).alias("trip_id"), "linha_lt", F.col("veiculo_id").alias("vehicle_id"), F.col("start_ts").alias("trip_start_time"), F.col("end_ts").alias("trip_end_time"),
        "duration_seconds", "is_circular", "direction", "discrepancy", "distance_meters", "avg_speed_kmh", reason.alias("left_out"),
    )


def finished_trips(positions: DataFrame, radius: float = 100.0, hold_last: bool = False) -> DataFrame:
    """Sanitized positions to the trips that count. hold_last: without the last row of each series, which a later row may make a spike."""
    rows = with_spikes(positions)
    if hold_last:
        rows = rows.selectExpr("*", f"lead(true) OVER {SERIES} AS _followed").where("_followed").drop("_followed")
    rows = rows.where(~F.col("spike")).select(*positions.columns)
    return materialised(detected(rows, radius)).where("left_out IS NULL").drop("left_out")


def extraction_metrics(positions: DataFrame, radius: float = 100.0) -> DataFrame:
    """One row of counts for a run: input, spikes, groups, trips of either kind, discrepancies and what was left out."""
    spikes = with_spikes(positions).agg(F.count("*").alias("positions"), F.count_if("spike").alias("spikes"), F.count_distinct(*GROUP).alias("groups_total"))
    trips = materialised(detected(sanitize(positions), radius))
    kept = F.col("left_out").isNull()
    counts = trips.agg(
        F.count("*").alias("trips_detected"), F.count_if(kept).alias("trips_total"), F.count_if(kept & F.col("is_circular")).alias("trips_circular"), F.count_if(kept & ~F.col("is_circular")).alias("trips_non_circular"),
        F.count_if((F.col("left_out") == "too_fast")).alias("trips_too_fast"), F.count_if(F.coalesce(F.col("left_out") != "group_failed", F.lit(True)) & F.col("discrepancy")).alias("discrepancies"),
        F.count_distinct(F.when(F.col("left_out") == "group_failed", F.struct("linha_lt", "vehicle_id"))).alias("groups_failed"),
    )
    return spikes.crossJoin(F.broadcast(counts))  # one row each
