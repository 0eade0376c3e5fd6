"""A live table: the newest row of each vehicle, kept by a stream and read while it's written.

A batch writes the newest rows of its own vehicles as changes. Every few batches the changes are merged with the version before into a new one, without
vehicles that have left, and what no reader needs is deleted; so a batch costs what it holds, a version what is live, whatever came before. Both are
parted by a bucket of the vehicle: one vehicle is read from one bucket. A batch's line in `<target>.lines` is written last and names the version and the
batch that hold together. Readers go by the newest line, so they see all of a batch or nothing of it, and a batch that is run again changes nothing.

The newest row has the greatest veiculo_ts, then extracao_ts, then the greatest of the other columns in order; rows without veiculo_ts are left out, a null
vehicle is a vehicle. The clock is the greatest extracao_ts so far. A vehicle has left once its newest row is older than the clock by more than `keep`. Any row that
comes for it later is older still or takes its place, so forgetting it changes no answer. A late row never replaces a newer one.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..sources import loads

LINE = "version long, clock timestamp_ntz, batch long"


class Line(NamedTuple):
    """What holds together: a version, the changes after it up to a batch, and the clock. No version: -1."""

    version: int
    clock: datetime | None
    batch: int


def newest(rows: DataFrame) -> DataFrame:
    """The newest row of each vehicle, by sums on the map side."""
    rest = [c for c in rows.columns if c not in ("veiculo_id", "veiculo_ts", "extracao_ts")]
    row = F.struct("veiculo_ts", "extracao_ts", *rest)
    return rows.where("veiculo_ts IS NOT NULL").groupBy("veiculo_id").agg(F.max(row).alias("_row")).select("veiculo_id", "_row.*").select(*rows.columns)


def _stays(clock: Column, keep: str) -> Column:
    return F.coalesce(F.col("veiculo_ts").cast("timestamp_ntz") >= clock.cast("timestamp_ntz") - F.expr(f"INTERVAL {keep}"), F.lit(True))


def standing(rows: DataFrame, keep: str = "1 hour") -> DataFrame:
    """The live table as it stands after all of these rows."""
    return newest(rows).where(_stays(rows.agg(F.max("extracao_ts")).scalar(), keep))


def _bucket(vehicle: Column, buckets: int) -> Column:
    return F.pmod(F.hash(vehicle), F.lit(buckets))


def last_line(spark: SparkSession, target: str) -> Line:
    found = loads.existing(spark, f"{target}.lines", LINE).agg(F.max(F.struct("batch", "version", "clock")).alias("x")).first().x
    return Line(-1, None, -1) if found is None else Line(found.version, found.clock, found.batch)


def _held(spark: SparkSession, target: str, line: Line, schema: StructType) -> DataFrame:
    """Rows of the version and of the changes after it, with their bucket."""
    parts = lambda column: StructType([*schema.fields, StructField(column, LongType()), StructField("bucket", IntegerType())])
    base = loads.existing(spark, target, parts("version")).where(F.col("version") == line.version).drop("version")
    changes = loads.existing(spark, f"{target}.changes", parts("batch")).where(F.col("batch").between(line.version + 1, line.batch)).drop("batch")
    return base.unionByName(changes)


def _current(held: DataFrame, clock: datetime | None, keep: str) -> DataFrame:
    return newest(held).where(_stays(F.lit(clock and str(clock)), keep))


def live(spark: SparkSession, target: str, schema: StructType, keep: str = "1 hour", vehicle: int | None = None, buckets: int = 16) -> DataFrame:
    """One row for each vehicle that is live, of the newest whole batch; of one vehicle, from its bucket alone. schema: that of the positions; buckets: as written."""
    line = last_line(spark, target)
    held = _held(spark, target, line, schema)
    if vehicle is not None:
        key = F.lit(vehicle).cast(schema["veiculo_id"].dataType)
        # The number of the bucket is a literal, so that the scan is pruned by it.
        bucket = spark.range(1).select(_bucket(key, buckets)).first()[0]
        held = held.where((F.col("bucket") == bucket) & (F.col("veiculo_id") == key))
    return _current(held.drop("bucket"), line.clock, keep)


def _drop_below(spark: SparkSession, path: str, column: str, least: int) -> None:
    """Deletes the partitions column=n of a table for n below `least`."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        name, _, value = status.getPath().getName().partition("=")
        if name == column and int(value) < least:
            fs.delete(status.getPath(), True)


def upsert(rows: DataFrame, number: int, target: str, keep: str = "1 hour", buckets: int = 16, every: int = 20) -> None:
    """A batch's rows into the live table, under the batch's number; numbers rise."""
    spark, before = rows.sparkSession, last_line(rows.sparkSession, target)
    if number <= before.batch:
        return
    rows = rows.persist()
    try:
        seen = rows.agg(F.max(F.col("extracao_ts").cast("timestamp_ntz"))).first()[0]
        clock = max((c for c in (seen, before.clock) if c is not None), default=None)
        changed = _current(rows, clock, keep).withColumn("bucket", _bucket(F.col("veiculo_id"), buckets))
        loads.replace_batch(changed.repartition(buckets, "bucket"), f"{target}.changes", number, ["bucket"], "parquet")
    finally:
        rows.unpersist()
    version = before.version
    if number - version >= every:
        held = _held(spark, target, Line(version, clock, number), rows.schema).drop("bucket")
        whole = _current(held, clock, keep).withColumn("bucket", _bucket(F.col("veiculo_id"), buckets))
        whole.repartition(buckets, "bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{target}/version={number}")
        version = number
    line = spark.createDataFrame([(version, clock)], LINE.removesuffix(", batch long"))
    loads.replace_batch(line.coalesce(1), f"{target}.lines", number, form="parquet")
    if version == number:
        # A reader may still be at the version before and the changes after it.
        _drop_below(spark, target, "version", before.version)
        _drop_below(spark, f"{target}.changes", "batch", before.version + 1)
        _drop_below(spark, f"{target}.lines", "batch", before.version)


def live_table(rows: DataFrame, target: str, checkpoint: str, keep: str = "1 hour", buckets: int = 16, every: int = 20) -> DataStreamWriter:
    """A stream of positions into the live table."""
    return rows.writeStream.foreachBatch(lambda batch, number: upsert(batch, number, target, keep, buckets, every)).option("checkpointLocation", checkpoint)
