"""The corpus pipeline: quality, line dedup, near duplicates, decontamination, packing.

Each stage calls one operator of busmill.llm over all that the stage before it kept, and its decisions take effect: documents that
the quality classifier rejects go; lines that an earlier line repeats go, and documents left without a line; one document of each
group of near duplicates stays, the one with the smallest id; documents that copy an item of the benchmark go; what remains is packed.

The third and fourth stage decide by row, known by its id and text together: rows without an id are judged as all others are, and of
rows with one id each goes or stays by its own text. Of a group of near duplicates one row stays, whatever its id: the smallest id before none, then
the smallest key. Rows equal in id and text are one; rows without an id and without a word are near nothing and all stay.
All stages but the last give the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from busmill.llm import decontaminate, jaccard, lines, packing, quality
from busmill.llm.common import stored, table, work_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality field, learned from the labelled ones among them, doesn't reject."""
    field = quality.trained(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, field).where("predicted = 1").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the lines that no earlier line repeats; n_chars is that of the text that is left."""
    out = lines.dedup_lines(docs.select(*COLUMNS))
    return out.where("n_dropped < n_lines OR n_lines = 0").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keyed(docs: DataFrame) -> DataFrame:
    """docs with key, a hash of id and text that is never null."""
    return docs.select(*COLUMNS, F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text").alias("key"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates."""
    rows = keyed(docs)
    found = jaccard.near_duplicates(rows.select(F.col("key").alias("doc_id"), "text"))
    groups = found.groupBy(F.col("doc_id").alias("key")).agg(F.min("component_id").alias("component"), F.max("n_shingles").alias("n_shingles"))
    ids = rows.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    # Sums before each shuffle, so a group of many copies is no single task's.
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    kept = groups.join(ids, "key").groupBy("component").agg(F.min(rank).alias("x"), F.max("n_shingles").alias("n_shingles")).select("x.key", (F.col("x.unnamed") & (F.col("n_shingles") == 0)).alias("all_stay"))
    kept = stored(kept, work_dir(spark), "kept")
    once = rows.groupBy("key").agg(F.min(F.struct(*COLUMNS)).alias("row")).join(kept.where("NOT all_stay"), "key", "left_semi").select("row.*")
    # Rows without id and words have few texts; where there are none, nothing is joined.
    empty = kept.where("all_stay").select("key")
    return once.unionByName(rows.where("doc_id IS NULL").join(empty, "key", "left_semi").select(*COLUMNS))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    rows = keyed(docs)
    leaks = decontaminate.contaminated(rows.select(F.col("key").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("key")).distinct()
    return rows.join(leaks, "key", "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences, as of op7_pack_sequences."""
    return packing.digests(packing.pack(docs, packing.vocabulary))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack),
]

#: SQL can't express the classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each but the last is written to the shared folder and read again."""
    where, docs = work_dir(spark), table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, where, f"stage-{k}")
    return docs
