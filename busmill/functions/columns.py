"""Column functions of the domain: distances, speeds, trip ids and local time keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
ZONE = "America/Sao_Paulo"


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    half_lat, half_lon = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_M) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def terminal_distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance rounded to the metre; -1 if a coordinate is null or NaN."""
    bad = F.lit(False)
    for c in (lat1, lon1, lat2, lon2):
        bad = bad | c.isNull() | F.isnan(c)
    return F.when(bad, -1.0).otherwise(F.round(haversine_m(lat1, lon1, lat2, lon2)))


def planar_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Planar distance between terminals, at 106,428 metres a degree."""
    return F.round(F.sqrt(F.pow(lat1 - lat2, F.lit(2)) + F.pow(lon1 - lon2, F.lit(2))) * 106428)


def elapsed_s(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6


def speed_kmh(metres: Column, seconds: Column) -> Column:
    """Null unless time has passed."""
    return F.when(seconds > 0, metres / seconds * 3.6)


def trip_id(line: Column, direction: Column) -> Column:
    """line-0, line-1, or line-999 for any other direction."""
    return F.concat_ws("-", line, F.when(direction == 1, "0").when(direction == 2, "1").otherwise("999"))


def snapshot_trip_id(line: Column, direction: Column) -> Column:
    """As trip_id, but null for any other direction."""
    return F.when(direction == 1, F.concat(line, F.lit("-0"))).when(direction == 2, F.concat(line, F.lit("-1")))


def local(ts: Column) -> Column:
    """A UTC time as local time."""
    return F.from_utc_timestamp(ts.cast("timestamp"), ZONE)


def hour_key(ts: Column) -> Column:
    return F.date_format(local(ts), "yyyyMMddHH").cast("int")


def route_of(trip: Column) -> Column:
    return F.substring(trip, F.lit(1), F.length(trip) - 2)


def direction_of(trip: Column) -> Column:
    last = F.right(trip, F.lit(1))
    return F.when(last == "0", 1).when(last == "1", 2)


def clean_message(text: Column, most: int = 100) -> Column:
    """Tags out, common entities decoded, white space collapsed, cut."""
    out = F.regexp_replace(text, "<[^>]+>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.substring(F.trim(F.regexp_replace(out, r"\s+", " ")), 1, most)
