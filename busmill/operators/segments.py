"""Trips out of long series: the rules of `trajectory` as a segmented scan.

A series is cut into segments, of a day or more, that are sorted by tasks of their own. What a segment must know of those before it is small: a neighbour at
its edge, a running count, the last row near a terminal. So the scan takes three rounds, and in each a segment is summed up to one row, the rows of a
series are scanned in order, and each segment reads what it carries in:

1. the rows at both edges and the number of rows so far, by which candidates for spikes are told;
2. the last row that is no candidate, by whose distance every other candidate is a spike;
3. the last row near a terminal with the counts up to it, the zone there, the anchor and the last row of all, from which trips are told.

`trips_by_size` is for tables that have both: a series of at most `MOST` rows is one segment, into which nothing is carried, so `trajectory` reads it in one scan; a
longer one is cut into runs of whole days of about that many rows. So summaries stay few beside rows, where a segment a day may have two or three rows.
All rounds share the rows' one exchange and sort by segment; only summaries are shuffled again. The trips are those of `trajectory.detected` on the
sanitized rows, wherever the series is cut. Rows without a time are a segment before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import elapsed_s, haversine_m, speed_kmh
from . import trajectory
from .trajectory import GROUP, ORDER

DAY = "coalesce(to_date(veiculo_ts), date'0001-01-01')"
#: Rows of a series that a segment should have; a day is never cut.
MOST = 100_000
KEY = "_key"
SEGMENT = f"(PARTITION BY {KEY} ORDER BY {', '.join(ORDER)})"
SO_FAR, BEFORE = (f"{SEGMENT[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND {end})" for end in ("CURRENT ROW", "1 PRECEDING"))
#: Over the summaries of a series.
SERIES = f"(PARTITION BY {', '.join(f'{KEY}.{c}' for c in GROUP)} ORDER BY {KEY}.segment)"
EARLIER = SERIES[:-1] + " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
PLACE = "named_struct('ts', veiculo_ts, 'lat', veiculo_lat, 'long', veiculo_long)"


def cut(positions: DataFrame, segment: str = DAY) -> DataFrame:
    """positions with the key of their series and segment, as one value that is never null. segment: SQL that never falls along a series."""
    return positions.withColumn(KEY, F.struct(*GROUP, F.expr(segment).alias("segment")))


def by_size(positions: DataFrame, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """The rows of series of at most `most` rows, as they are, and the others as of `cut`, by segments of about `most` rows, each of whole days."""
    sizes = positions.groupBy(F.struct(*GROUP).alias("_series")).agg(F.count("*").alias("_rows"), *[f(F.to_date("veiculo_ts")).alias(n) for f, n in ((F.min, "_first"), (F.max, "_last"))]).where(F.col("_rows") > most)
    days = f"greatest(1, cast(ceil((datediff(_last, _first) + 1) / ceil(_rows / {int(most)})) AS int)) AS _days"
    long = F.broadcast(sizes.selectExpr("_series", "_first", days))  # one for `most` rows at the utmost
    rows = positions.withColumn("_series", F.struct(*GROUP))
    run = "date_add(_first, cast(floor(datediff(to_date(veiculo_ts), _first) / _days) AS int) * _days)"
    return rows.join(long, "_series", "left_anti").drop("_series"), cut(rows.join(long, "_series"), f"coalesce({run}, date'0001-01-01')").drop("_series", "_first", "_days")


def carried(rows: DataFrame, sums: list[str], *scans: list[str], take: list[str]) -> DataFrame:
    """rows with the columns `take` of their segment's summary: `sums` by segment, then `scans` over the summaries of the series, one after another."""
    order = f"struct({', '.join(ORDER)})"
    told = rows.groupBy(KEY).agg(*[F.expr(s.replace("$order", order)) for s in sums])
    for scan in scans:
        told = told.selectExpr("*", *scan)
    return rows.join(told.select(KEY, *take), KEY)


def _speed(a: str, b: str) -> Column:
    ends = [F.col(f"{p}.{c}") for p in (a, b) for c in ("lat", "long")]
    return speed_kmh(haversine_m(*ends), elapsed_s(F.col(f"{a}.ts"), F.col(f"{b}.ts")))


def with_spikes(rows: DataFrame, limit: float = 120.0) -> DataFrame:
    """rows, as of `cut`, with spike."""
    own = rows.columns
    rows = rows.selectExpr("*", f"{PLACE} AS _here", f"row_number() OVER {SEGMENT} AS _at")
    sums = ["count(*) AS _rows", "min_by(_here, $order) AS _head", "max_by(_here, $order) AS _tail"]
    scan = [f"lag(_tail) OVER {SERIES} AS _prior", f"lead(_head) OVER {SERIES} AS _next", f"coalesce(sum(_rows) OVER {EARLIER}, 0) AS _offset"]
    rows = carried(rows, sums, scan, take=["_prior", "_next", "_offset"])
    rows = rows.selectExpr(*own, "_here", "_at + _offset AS _at", f"coalesce(lag(_here) OVER {SEGMENT}, _prior) AS _before", f"coalesce(lead(_here) OVER {SEGMENT}, _next) AS _after")
    candidate = F.coalesce((_speed("_before", "_here") > limit) & (_speed("_here", "_after") > limit) & (_speed("_before", "_after") <= limit), F.lit(False))
    rows = rows.withColumn("_candidate", candidate).drop("_here", "_before", "_after")
    rows = carried(rows, ["max(_at) FILTER (WHERE NOT _candidate) AS _calm"], [f"max(_calm) OVER {EARLIER} AS _calm_before"], take=["_calm_before"])
    calm = f"coalesce(max(CASE WHEN NOT _candidate THEN _at END) OVER {SO_FAR}, _calm_before)"
    return rows.selectExpr(*own, f"_candidate AND (_at - {calm}) % 2 = 1 AS spike")


def _carry(rows: DataFrame) -> DataFrame:
    """The third round: what is known at the edge of each segment."""
    near = "named_struct('at', _at, 'n', _n, 's', _s, 'q', _q, 'ts', veiculo_ts, 'meters', trip_linear_distance, 'both', _f AND _l)"
    row = "named_struct('a', _a, 'way', linha_sentido, 'here', _here, 'circular', is_circular)"
    sums = [
        "count(*) AS _rows", "max(_n) AS _all_n", f"max_by(_s, $order) AS _all_s", f"max_by(_q, $order) AS _all_q", "sum(CASE WHEN _flip THEN 1 ELSE 0 END) AS _all_flips",
        f"min_by({near}, $order) FILTER (WHERE _a) AS _first_near", f"max_by({near}, $order) FILTER (WHERE _a) AS _last_near", f"min_by({row}, $order) AS _head", f"max_by({row}, $order) AS _tail",
        "max_by(named_struct('v', cast(_f AS int) - _flips), $order) FILTER (WHERE _f <> _l) AS _clear", "max_by(_here, $order) FILTER (WHERE _a OR _turned) AS _begun",
    ]
    offsets = [f"coalesce(sum({c}) OVER {EARLIER}, 0) AS {name}" for c, name in (("_rows", "_at0"), ("_all_n", "_n0"), ("_all_s", "_s0"), ("_all_q", "_q0"))]
    offsets += [f"lag(_tail) OVER {SERIES} AS _prior", f"first_value(_head) OVER {SERIES} AS _opening"]
    shifted = "named_struct('at', _last_near.at + _at0, 'n', _last_near.n + _n0, 's', _last_near.s + _s0, 'q', _last_near.q + _q0, 'ts', _last_near.ts, 'meters', _last_near.meters)"
    nears = [f"last(CASE WHEN _last_near IS NOT NULL THEN {shifted} END, true) OVER {EARLIER} AS _near"]
    edge = ["coalesce(_first_near.both AND _first_near.at + _at0 - _near.at > 1, false) AS _edge_flip", "_prior IS NOT NULL AND NOT _prior.way <=> _head.way AS _edge_turn"]
    flips = [f"coalesce(sum(_all_flips + if(_edge_flip, 1, 0)) OVER {EARLIER}, 0) AS _flips0", f"last(coalesce(_begun, CASE WHEN _edge_turn THEN _head.here END), true) OVER {EARLIER} AS _start0"]
    zones = [f"last(_clear.v - _flips0 - if(_edge_flip, 1, 0), true) OVER {EARLIER} AS _clear0"]
    zone = ["pmod(_clear0 + _flips0, 2) AS _zone0"]
    take = ["_at0", "_n0", "_s0", "_q0", "_prior", "_opening", "_near", "_flips0", "_start0", "_clear0", "_zone0"]
    return carried(rows, sums, offsets, nears, edge, flips, zones, zone, take=take)


def detected(rows: DataFrame, radius: float = 100.0) -> DataFrame:
    """Trips of sanitized rows, as of `cut`; the columns are those of trajectory.detected."""
    near = [F.coalesce(F.col(c) < radius, F.lit(False)) for c in ("distance_to_first_stop", "distance_to_last_stop")]
    rows = rows.select("*", near[0].alias("_f"), near[1].alias("_l"), (near[0] | near[1]).alias("_a")).selectExpr("*", f"{PLACE} AS _here")
    between = "CASE WHEN NOT _a THEN cast(linha_sentido AS long) END"
    rows = rows.selectExpr(
        "*", f"row_number() OVER {SEGMENT} AS _at", f"count({between}) OVER {SO_FAR} AS _n", f"coalesce(sum({between}) OVER {SO_FAR}, 0) AS _s", f"coalesce(sum({between} * {between}) OVER {SO_FAR}, 0) AS _q",
        f"lag(linha_sentido) OVER {SEGMENT} AS _way", f"lag(true) OVER {SEGMENT} AS _inner",
    )
    rows = rows.selectExpr("*", f"max(CASE WHEN _a THEN _at END) OVER {BEFORE} AS _near_at", "coalesce(_inner, false) AND NOT linha_sentido <=> _way AS _turned").selectExpr("*", "coalesce(_f AND _l AND _at - _near_at > 1, false) AS _flip")
    rows = rows.selectExpr("*", f"sum(CASE WHEN _flip THEN 1 ELSE 0 END) OVER {SO_FAR} AS _flips")
    rows = _carry(rows).selectExpr("*", "coalesce(_opening.circular, false) AS _circular").where(f"CASE WHEN _circular THEN _near IS NOT NULL OR _near_at IS NOT NULL OR _a ELSE _a END")
    # From here on as if the series were whole: the row before the segment's first is the one that is carried in.
    lag = lambda c, first, name: f"CASE WHEN lag(true) OVER {SEGMENT} THEN lag({c}) OVER {SEGMENT} ELSE {first} END AS {name}"
    rows = rows.selectExpr("*", "_at + _at0 AS _i", "_n + _n0 AS _gn", "_s + _s0 AS _gs", "_q + _q0 AS _gq").selectExpr(
        "*", lag("_i", "_near.at", "_pi"), lag("_gn", "_near.n", "_pn"), lag("_gs", "_near.s", "_ps"), lag("_gq", "_near.q", "_pq"), lag("veiculo_ts", "_near.ts", "_pts"), lag("trip_linear_distance", "_near.meters", "_pmeters"),
        lag("_a", "if(_near IS NOT NULL, _prior.a, NULL)", "_pa"), lag("linha_sentido", "if(_near IS NOT NULL, _prior.way, NULL)", "_pway"), lag("_here", "if(_near IS NOT NULL, _prior.here, NULL)", "_phere"),
    )
    rows = rows.selectExpr("*", "coalesce(_i - _pi > 1, false) AS _gap", "_pa IS NOT NULL AND NOT linha_sentido <=> _pway AS _turn")
    rows = rows.selectExpr(
        "*", f"_flips0 + sum(CASE WHEN _gap AND _f AND _l THEN 1 ELSE 0 END) OVER {SO_FAR} AS _gflips", f"coalesce(last(CASE WHEN _a OR _turn THEN _here END, true) OVER {SO_FAR}, _start0) AS _start"
    )
    rows = rows.selectExpr("*", f"pmod(coalesce(last(CASE WHEN _f <> _l THEN cast(_f AS int) - _gflips END, true) OVER {SO_FAR}, _clear0) + _gflips, 2) AS _zone")
    rows = rows.selectExpr("*", lag("_zone", "_zone0", "_pzone"), lag("_start", "_start0", "_pstart")).where("CASE WHEN _circular THEN NOT _pa AND (_turn OR _a) ELSE _gap AND _zone <> _pzone END")
    rows = rows.withColumn("_loop", haversine_m(F.col("_pstart.lat"), F.col("_pstart.long"), F.expr("if(_turn, _phere.lat, veiculo_lat)"), F.expr("if(_turn, _phere.long, veiculo_long)")))
    rows = rows.withColumn("_direction", F.expr("CASE WHEN NOT _circular THEN if(_pzone = 1, 1, 2) WHEN _turn THEN _pway ELSE linha_sentido END"))
    trips = rows.selectExpr(
        *GROUP, "CASE WHEN _circular THEN _pstart.ts ELSE _pts END AS start_ts", "CASE WHEN _circular AND _turn THEN _phere.ts ELSE veiculo_ts END AS end_ts", "cast(_direction AS int) AS direction",
        "NOT _circular AND _gn > _pn AND (_gn - _pn) * (_gq - _pq) = (_gs - _ps) * (_gs - _ps) AND _gs - _ps <> _direction * (_gn - _pn) AS discrepancy", "_circular AS is_circular",
        "CASE WHEN _circular THEN _loop ELSE _pmeters END AS distance_meters", "_i", "_opening.a AS _gate",
    )
    # The first trip of a series that begins on the way doesn't count.
    first = trips.where("NOT is_circular AND NOT _gate").groupBy(F.struct(*GROUP).alias("_series")).agg(F.min("_i").alias("_i"))
    return trips.withColumn("_series", F.struct(*GROUP)).join(first, ["_series", "_i"], "left_anti").drop("_series", "_i", "_gate")


def trips(positions: DataFrame, segment: str = DAY, limit: float = 120.0, radius: float = 100.0) -> DataFrame:
    """Positions to trips, a segment at a time: what trajectory.detected gives of sanitized rows."""
    return detected(with_spikes(cut(positions, segment), limit).where("NOT spike").drop("spike"), radius)


def trips_by_size(positions: DataFrame, limit: float = 120.0, radius: float = 100.0, most: int = MOST) -> DataFrame:
    """As `trips`, where series of more than `most` rows alone are cut, `by_size`; a shorter one is one segment, which carries nothing in and needs no rounds."""
    short, long = by_size(positions, most)
    whole = trajectory.detected(trajectory.sanitize(short, limit), radius)
    return whole.unionByName(detected(with_spikes(long, limit).where("NOT spike").drop("spike"), radius))
