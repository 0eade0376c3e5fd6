"""Loads that a replay leaves as they are: each batch writes its own partition and its own line of statistics.

Beside a target stands `<target>.loads`, a small table with a row for each batch: rows derived and inserted, the greatest end, the dates. It is written last,
so a batch that has a row there is complete and is not written again; one that broke off replaces what it wrote. The high-water mark is read from it, and
neither the mark nor the check for rows that are there reads more of the target than the batch's own dates.

One writer at a time sees all others' rows. Should two write at the same time, both may add a key; `once` reads each key once, of the first batch by name.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.facts import insert_if_absent

LOADS = "derived long, inserted long, greatest_end timestamp_ntz, first_date date, last_date date, batch string"


class Load(NamedTuple):
    """Rows of a batch: derived, inserted, and there or late already."""

    derived: int
    inserted: int

    @property
    def skipped(self) -> int:
        return self.derived - self.inserted


def existing(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The table at path, or none of its rows if nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def loads(spark: SparkSession, path: str) -> DataFrame:
    """The statistics of the batches in the target at path."""
    return existing(spark, f"{path}.loads", LOADS)


def replace_batch(rows: DataFrame, path: str, batch: int | str, parts: list[str] | None = None, form: str = "json") -> None:
    """rows as the batch's own part of a table: written again, they replace themselves, and no other batch's rows."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*(parts or [])).format(form).save(f"{path}/batch={batch}")


def append_batch(rows: DataFrame, path: str, key: list[str], batch: int | str, by: str, hourly: bool = False, end: str | None = None, late: str = "keep") -> Load:
    """The rows of a batch that the target lacks, by date (and hour) of the time `by` and by batch.

    late="drop" takes only rows whose `end` is after everything that earlier loads saved, and reads none of the target; "keep" goes by the key, and reads the
    batch's dates."""
    spark, batch = rows.sparkSession, str(batch)
    done = loads(spark, path).where(F.col("batch") == batch).first()
    if done is not None:
        return Load(done.derived, done.inserted)
    parts = ["date", *["hour"] * hourly, "batch"]
    own = {"date": F.to_date(by), "hour": F.hour(by), "batch": F.lit(batch)}
    rows = rows.withColumns({p: own[p] for p in parts}).persist()
    try:
        span = rows.agg(F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("last")).first()
        others = existing(spark, path, rows.schema).where((F.col("batch") != batch) & F.col("date").between(F.lit(span.first), F.lit(span.last)))
        if late == "drop":
            mark = loads(spark, path).agg(F.max("greatest_end")).first()[0]
            rows_, others = (rows if mark is None else rows.where(F.col(end).cast("timestamp_ntz") > F.lit(mark))), rows.limit(0)
        else:
            rows_ = rows
        seen = Observation()
        greatest = F.max(F.col(end).cast("timestamp_ntz")) if end else F.lit(None).cast("timestamp_ntz")
        new = insert_if_absent(rows_, others, [*key, *parts[:-1]]).observe(seen, F.count("*").alias("n"), greatest.alias("end"))
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
        told = seen.get
        line = spark.createDataFrame([(span.n, told["n"], told["end"], span.first, span.last)], LOADS.removesuffix(", batch string"))
        replace_batch(line.coalesce(1), f"{path}.loads", batch, form="parquet")
        return Load(span.n, told["n"])
    finally:
        rows.unpersist()


def once(table: DataFrame, key: list[str]) -> DataFrame:
    """Each key once, of the first batch by name, as of writers at the same time."""
    order = Window.partitionBy(*key).orderBy("batch")
    return table.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
