"""Scans and sinks: raw snapshots, GTFS text, partitioned positions, and the tables that are replaced or appended to."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ZONE, local
from ..operators.facts import insert_if_absent
from ..schemas import GTFS, RAW, TRIP_DETAILS

SNAPSHOT_NAME = r"posicoes_onibus-(\d{12})\.json"


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, plain or compressed by a codec that Hadoop knows, with its name and its logical time in UTC."""
    rows = spark.read.schema(RAW).option("multiLine", True).json(path)
    return rows.select("*", F.col("_metadata.file_name").alias("source_file"), logical_time(F.col("_metadata.file_name")).alias("logical_date"))


def logical_time(name: Column) -> Column:
    """UTC time out of a snapshot's file name, which holds local time."""
    return F.to_utc_timestamp(F.try_to_timestamp(F.regexp_extract(name, SNAPSHOT_NAME, 1), F.lit("yyyyMMddHHmm")), ZONE)


def snapshot_path(utc: datetime) -> tuple[str, str]:
    """Partition path and file name of a logical time."""
    at = utc.astimezone(ZoneInfo(ZONE))
    return f"year={at:%Y}/month={at:%m}/day={at:%d}", f"posicoes_onibus-{at:%Y%m%d%H%M}.json"


def write_snapshots(raw: DataFrame, path: str, codec: str = "gzip") -> None:
    """Raw documents by local day; times without a zone are UTC. codec: a name that Spark knows, or a Hadoop codec's class: zstd
    ("org.apache.hadoop.io.compress.ZStandardCodec") needs Hadoop's native library on the executors."""
    at = local(F.to_timestamp("metadata.extracted_at"))
    parts = {"year": F.date_format(at, "yyyy"), "month": F.date_format(at, "MM"), "day": F.date_format(at, "dd")}
    raw.withColumns(parts).write.mode("append").partitionBy(*parts).option("compression", codec).json(path)


def read_gtfs(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(GTFS[name]).option("header", True).option("mode", "FAILFAST").csv(f"{path}/{name}.txt")


def stage_gtfs(spark: SparkSession, path: str, staging: str, names: list[str] | None = None) -> tuple[dict[str, str], dict[str, str]]:
    """Each text file as snappy Parquet below `staging`: (name to path, name to error). A file that can't be read or parsed is an error of its own."""
    staged, errors = {}, {}
    for name in names or list(GTFS):
        try:
            read_gtfs(spark, path, name).write.mode("overwrite").parquet(f"{staging}/{name}", compression="snappy")
            staged[name] = f"{staging}/{name}"
        except (PySparkException, Py4JJavaError) as error:
            errors[name] = str(error).splitlines()[0]
    return staged, errors


def relocate(spark: SparkSession, staged: dict[str, str], target: str) -> tuple[dict[str, str], dict[str, str]]:
    """Staged tables to the target, or to the quarantine: (name to path, name to error). The table there is replaced."""
    moved, errors = {}, {}
    for name, path in staged.items():
        try:
            spark.read.parquet(path).write.mode("overwrite").parquet(f"{target}/{name}", compression="snappy")
            moved[name] = f"{target}/{name}"
        except (PySparkException, Py4JJavaError) as error:
            errors[name] = str(error).splitlines()[0]
    return moved, errors


def read_trip_details(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRIP_DETAILS).parquet(path)


def snapshots_between(spark: SparkSession, path: str, start: datetime, end: datetime, step_minutes: int = 2) -> DataFrame:
    """Raw documents of a backfill, both ends included, whose logical time is on the step; only the days' folders are read."""
    first, last = (t.astimezone(ZoneInfo(ZONE)).date() for t in (start, end))
    days = [first + timedelta(days=k) for k in range((last - first).days + 1)]
    wanted = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int")).isin(*days)
    minutes = (F.unix_seconds("logical_date") - int(start.timestamp())) / 60
    return read_snapshots(spark, path).where(wanted).where(F.col("logical_date").between(F.lit(start), F.lit(end)) & (minutes % step_minutes == 0))


def gtfs_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, value: the lines of the text files of a folder, as of operators.gtfs.file_errors."""
    return spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), "value")


def write_positions(rows: DataFrame, path: str) -> None:
    """Positions by local hour and extraction time, which tells one snapshot from another; one that is written again replaces itself alone."""
    at = local(F.col("extracao_ts"))
    parts = {n: F.date_format(at, f) for n, f in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"), ("batch", "HHmmssSSSSSS"))}
    rows.withColumns(parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def recent_positions(spark: SparkSession, path: str, at: datetime, hours: int = 3, cross_midnight: bool = False) -> DataFrame:
    """Positions of the last local hours; without cross_midnight of the same local day alone. Only their partitions are read."""
    now = at.astimezone(ZoneInfo(ZONE))
    ticks = [now - timedelta(hours=h) for h in range(hours + 1)]
    wanted = F.lit(False)
    for t in ticks:
        if cross_midnight or t.date() == now.date():
            wanted = wanted | ((F.col("year") == t.year) & (F.col("month") == t.month) & (F.col("day") == t.day) & (F.col("hour") == t.hour))
    return spark.read.parquet(path).where(wanted)


def newest_batch(positions: DataFrame) -> DataFrame:
    """The rows of the newest extraction."""
    newest = positions.agg(F.max("extracao_ts").alias("_newest"))
    return positions.join(F.broadcast(newest), F.col("extracao_ts") == F.col("_newest"), "left_semi")  # one row


def latest_snapshot(spark: SparkSession, path: str, at: datetime) -> DataFrame | None:
    """The newest snapshot of the current local hour, or else of the hour before; None, so that a run is skipped, if neither has one."""
    now = at.astimezone(ZoneInfo(ZONE))
    for tick in (now, now - timedelta(hours=1)):
        hour = spark.read.parquet(path).where((F.col("year") == tick.year) & (F.col("month") == tick.month) & (F.col("day") == tick.day) & (F.col("hour") == tick.hour))
        newest = hour.agg(F.max("extracao_ts")).first()[0]  # partitions of one hour
        if newest is not None:
            return hour.where(F.col("extracao_ts") == F.lit(newest))
    return None


def replace_table(rows: DataFrame, path: str, version: str) -> str:
    """A full replacement as a new version; readers switch when CURRENT names it. Pointers are added, never removed, so a reader always meets one."""
    rows.write.mode("overwrite").parquet(f"{path}/{version}")
    pointer = rows.sparkSession.createDataFrame([(version,)], "version string").withColumn("since", F.unix_micros(F.current_timestamp()))
    pointer.coalesce(1).write.mode("append").json(f"{path}/CURRENT")
    return f"{path}/{version}"


def current_table(spark: SparkSession, path: str) -> DataFrame:
    pointers = spark.read.schema("version string, since long").json(f"{path}/CURRENT")
    return spark.read.parquet(f"{path}/{pointers.orderBy(F.desc('since')).first()['version']}")


def save_table(rows: DataFrame, name: str) -> None:
    """Creates or replaces a table of the catalog."""
    rows.write.mode("overwrite").saveAsTable(name)


def append_absent(rows: DataFrame, path: str, key: list[str], by: str | None = None, hourly: bool = False) -> int:
    """Appends the rows whose key the table doesn't have; gives their number. One writer at a time.

    by: a time of the key; the table is then parted by its date, and hour if `hourly`, which is what retention deletes, and only the dates of the batch
    are read."""
    spark = rows.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    parts = ["date", *["hour"] * hourly] if by else []
    if by:
        rows = rows.withColumn("date", F.to_date(by))
        rows = rows.withColumn("hour", F.hour(by)) if hourly else rows
    existing = spark.read.schema(rows.schema).parquet(path) if there else rows.limit(0)
    if by and there:
        first, last = rows.agg(F.min("date"), F.max("date")).first()
        existing = existing.where(F.col("date").between(F.lit(first), F.lit(last)))
    written = Observation()
    new = insert_if_absent(rows, existing, [*key, *parts]).observe(written, F.count("*").alias("n"))
    (new.write.mode("append").partitionBy(*parts) if parts else new.write.mode("append")).parquet(path)
    return written.get["n"]


def write_reports(reports: DataFrame, path: str) -> None:
    """Report rows as JSON by pipeline and local hour."""
    reports.write.mode("append").partitionBy("pipeline", "year", "month", "day", "hour").json(path)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def write_jdbc(rows: DataFrame, url: str, table: str, replace: bool = False, **options: str) -> None:
    """Bulk load; replace keeps the table and empties it first."""
    rows.write.format("jdbc").options(url=url, dbtable=table, batchsize="1000", truncate="true", **options).mode("overwrite" if replace else "append").save()


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Paths, sizes and times of the files below a prefix."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "length", "modificationTime")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """file, value: whole raw documents as text."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")


def read_zstd_documents(spark: SparkSession, path: str) -> DataFrame:
    """file, value: whole raw documents out of zstd files, which Hadoop reads with its native library alone; a file that isn't zstd is null."""
    import pyarrow as pa
    import zstandard

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = []
            for content in batch.column(1):
                try:
                    values.append(zstandard.ZstdDecompressor().decompressobj().decompress(content.as_buffer()).decode())
                except (zstandard.ZstdError, UnicodeDecodeError):
                    values.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.string())], ["file", "value"])

    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.zst").option("recursiveFileLookup", True).load(path)
    return rows.select(F.col("_metadata.file_name").alias("file"), "content").mapInArrow(opened, "file string, value string")


def parsed_documents(docs: DataFrame) -> DataFrame:
    """The declared structure of documents that are known to have it."""
    return docs.select(F.from_json("value", RAW).alias("r")).select("r.*")


def with_errors(docs: DataFrame) -> DataFrame:
    """docs (file, value) with errors: what keeps a raw document from its declared structure; judged on the whole text, before anything is pruned."""
    docs = docs.withColumn("_v", F.try_parse_json("value"))
    kind = lambda v, path: F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")), F.lit("VOID"))
    starts = lambda v, path, *kinds: F.exists(F.array(*[F.lit(k) for k in kinds]), lambda k: F.startswith(kind(v, path), k))
    none = F.array().cast("array<variant>")
    lines = F.coalesce(F.try_variant_get("_v", "$.payload.l", "array<variant>"), none)
    vehicles = F.flatten(F.transform(lines, lambda x: F.coalesce(F.try_variant_get(x, "$.vs", "array<variant>"), none)))
    nullable = ("VOID",)
    rules = [("metadata", "$.metadata", ("OBJECT",)), ("payload", "$.payload", ("OBJECT",)), ("metadata.extracted_at", "$.metadata.extracted_at", ("STRING",)), ("metadata.source", "$.metadata.source", ("STRING",)), ("metadata.total_vehicles", "$.metadata.total_vehicles", ("BIGINT",)), ("payload.hr", "$.payload.hr", ("BIGINT", "ARRAY", "STRING")), ("payload.l", "$.payload.l", ("ARRAY",))]
    of_lines = [("c", ("STRING",)), ("cl", ("BIGINT",)), ("sl", ("BIGINT",)), ("lt0", ("STRING", *nullable)), ("lt1", ("STRING", *nullable)), ("qv", ("BIGINT", *nullable)), ("vs", ("ARRAY",))]
    of_vehicles = [("p", ("BIGINT",)), ("a", ("BOOLEAN",)), ("ta", ("STRING",)), ("py", ("DECIMAL", "DOUBLE", "FLOAT", "BIGINT", *nullable)), ("px", ("DECIMAL", "DOUBLE", "FLOAT", "BIGINT", *nullable))]
    named = {"OBJECT": "object_required", "ARRAY": "array_required", "BIGINT": "integer_required", "BOOLEAN": "boolean_required", "STRING": "string_required", "DECIMAL": "number_required"}
    checks = [(F.col("_v").isNull(), "not_json")]
    checks += [(F.col("_v").isNotNull() & ~starts(F.col("_v"), path, *kinds), f"{name}:{named[kinds[0]] if len(kinds) == 1 else 'required'}") for name, path, kinds in rules]
    other = lambda name, kinds: lambda x: ~starts(x, f"$.{name}", *kinds)
    for prefix, held, wanted in (("payload.l[]", lines, of_lines), ("payload.l[].vs[]", vehicles, of_vehicles)):
        checks += [(F.exists(held, other(name, kinds)), f"{prefix}.{name}:{named[kinds[0]]}") for name, kinds in wanted]
    return docs.withColumn("errors", F.array_compact(F.array(*[F.when(bad, name) for bad, name in checks]))).drop("_v")


def document_errors(spark: SparkSession, path: str) -> DataFrame:
    """file, errors of each raw document below path."""
    return with_errors(read_documents(spark, path)).select("file", "errors")
