"""Column lineage and drift: what each column is made of, and whether a table still has the declared ones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from .positions import RENAMED

SCHEMA = "table string, column string, inputs array<string>, type string, transformation string"


@dataclass
class Column:
    name: str
    inputs: tuple[str, ...]
    type: str
    transformation: str


def raw_paths(schema: DataType, prefix: str = "", index: int = 0) -> dict[str, str]:
    """Leaf names to paths as payload.l[i].vs[j].p."""
    out: dict[str, str] = {}
    if isinstance(schema, StructType):
        for f in schema.fields:
            out |= raw_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name, index)
    elif isinstance(schema, ArrayType):
        out |= raw_paths(schema.elementType, f"{prefix}[{'ijk'[index]}]", index + 1)
    else:
        out[prefix.rpartition(".")[2]] = prefix
    return out


def position_lineage(raw: StructType) -> list[Column]:
    paths = raw_paths(raw)
    out = [Column(name, (paths[code],), "rename", f"{code} as {name}") for code, name in RENAMED]
    out.append(Column("trip_id", ("linha_lt", "linha_sentido"), "calculated", "line and direction"))
    for side in ("first", "last"):
        out += [Column(f"{side}_stop_{part}", (f"trip_details.{side}_stop_{part}",), "join", "by trip_id") for part in ("id", "lat", "lon")]
        out.append(Column(f"distance_to_{side}_stop", ("veiculo_lat", "veiculo_long", f"{side}_stop_lat", f"{side}_stop_lon"), "calculated", "great-circle metres"))
    return out


_TIMES = ("stop_times.stop_id", "stop_times.stop_sequence")
TRIP_DETAILS = [
    Column("trip_id", ("stop_times.trip_id",), "calculated", "string"),
    *[Column(f"{side}_stop_{part}", (*_TIMES, f"stops.stop_{part}"), "join", kind) for side in ("first", "last") for part, kind in (("id", "int"), ("name", "string"), ("lat", "double"), ("lon", "double"))],
    Column("trip_linear_distance", ("first_stop_lat", "first_stop_lon", "last_stop_lat", "last_stop_lon"), "calculated", "double"),
    Column("is_circular", ("first_stop_id", "last_stop_id"), "calculated", "boolean"),
]
FINISHED_TRIPS = [
    Column("trip_id", ("linha_lt", "direction"), "calculated", "line and direction"),
    Column("vehicle_id", ("veiculo_id",), "rename", "veiculo_id as vehicle_id"),
    Column("trip_start_time", ("veiculo_ts",), "calculated", "last time at the first terminal"),
    Column("trip_end_time", ("veiculo_ts",), "calculated", "first time at the other terminal"),
    Column("duration_seconds", ("trip_start_time", "trip_end_time"), "calculated", "whole seconds"),
    Column("is_circular", ("is_circular",), "copy", ""),
    Column("distance_meters", ("trip_linear_distance", "veiculo_lat", "veiculo_long"), "calculated", "linear, or from start to end"),
    Column("avg_speed_kmh", ("distance_meters", "duration_seconds"), "calculated", "distance by duration"),
    Column("logic_date", ("logic_date",), "copy", ""),
]
TRIP_FACTS = [
    Column("trip_id", ("finished_trips.trip_id",), "copy", "string"),
    Column("vehicle_id", ("finished_trips.vehicle_id",), "copy", "bigint"),
    Column("route_id", ("finished_trips.trip_id",), "calculated", "string"),
    Column("direction", ("finished_trips.trip_id",), "calculated", "int"),
    Column("started_at", ("finished_trips.trip_start_time",), "rename", "timestamp_ntz"),
    Column("ended_at", ("finished_trips.trip_end_time",), "rename", "timestamp_ntz"),
    Column("duration_seconds", ("finished_trips.duration_seconds",), "copy", "int"),
    Column("duration", ("finished_trips.duration_seconds",), "calculated", "interval day to second"),
    Column("is_circular", ("finished_trips.is_circular",), "copy", "boolean"),
    Column("distance_meters", ("finished_trips.distance_meters",), "copy", "double"),
    Column("avg_speed_kmh", ("finished_trips.avg_speed_kmh",), "copy", "double"),
    Column("started_at_time_dim_key", ("finished_trips.trip_start_time",), "calculated", "int"),
    Column("ended_at_time_dim_key", ("finished_trips.trip_end_time",), "calculated", "int"),
    Column("logic_date", ("finished_trips.logic_date",), "copy", "timestamp_ntz"),
]


def logical_type(kind: str | None) -> str:
    """Spark's type name as the lineage reports have it; unknown for a column that isn't there."""
    if kind is None:
        return "unknown"
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return "int"
    if kind in ("float", "double") or kind.startswith("decimal"):
        return "float"
    return "timestamp" if kind.startswith(("timestamp", "date")) else kind if kind == "boolean" else "string"


def column_map(columns: list[Column], actual: DataFrame) -> DataFrame:
    """One row: the map of each column's inputs, logical type and transformation, merged from one map a transformation; later ones win."""
    kinds = dict(actual.dtypes)
    fragments = []
    for how in dict.fromkeys(c.type for c in columns):
        entries = [x for c in columns if c.type == how for x in (F.lit(c.name), F.struct(F.array(*map(F.lit, c.inputs)).alias("inputs"), F.lit(logical_type(kinds.get(c.name))).alias("type"), F.lit(how).alias("transformation")))]
        fragments.append(F.create_map(*entries))
    return actual.sparkSession.range(1).select(F.map_concat(*fragments).alias("columns"))


def as_table(spark: SparkSession, table: str, columns: list[Column]) -> DataFrame:
    return spark.createDataFrame([(table, c.name, list(c.inputs), c.type, c.transformation) for c in columns], SCHEMA)


def drift(declared: list[Column], actual: DataFrame, with_types: bool = False) -> DataFrame:
    """column, change (added, removed, type_changed): how a table differs from its declaration."""
    spark, have = actual.sparkSession, dict(actual.dtypes)
    a = spark.createDataFrame([(c.name, c.transformation if with_types else "") for c in declared], "column string, declared string")
    b = spark.createDataFrame([(n, t if with_types else "") for n, t in have.items()], "column string, actual string")
    change = F.when(F.col("declared").isNull(), "added").when(F.col("actual").isNull(), "removed").when(F.col("declared") != F.col("actual"), "type_changed")
    return a.join(b, "column", "full").withColumn("change", change).where("change IS NOT NULL")
