"""Helpers shared by the training-data operators.

Texts reach Python as Arrow batches; `slices` cuts a batch into runs of whole documents of a bounded
number of bytes (one longer document is a run of its own) and gives their bytes without copying them.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def work_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share; where that is unset, as in tests, a temporary one.

    Executors on other machines would not see a temporary folder, so on a cluster the setting is needed."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is unset: a cluster needs a folder that all executors share")
        root = tempfile.mkdtemp(prefix="busmill-")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


#: Lets Spark delete the shuffle files of a query when it has ended.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, where: str, name: str, **options: str) -> DataFrame:
    """df written to and read from where/name: later stages no longer depend on what made it, nor keep its shuffle files."""
    spark, path = df.sparkSession, f"{where}/{name}"
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Deletes a folder written by `stored` that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(column: pa.Array, most: int = 1 << 18, rows: int = 1 << 30) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of each row in them) for runs of at most so many rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_large_binary(column.type) else "")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, side="right")) - 1)
        hi = min(hi, n, lo + rows)
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


Batches = Iterator[pa.RecordBatch]


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """run, which gives back to the system what memory its task leaves unused: Python workers live on from task to task."""

    def wrapped(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
            if trim:
                trim(0)

    return wrapped


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_RATIO = 0x9E3779B97F4A7C15
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * U64(_RATIO)) | U64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd ratio modulo 2**64, and of its inverse."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 19)
        for k, base in enumerate((_RATIO, pow(_RATIO, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H with H[e] - H[s], times the inverse power s, the polynomial hash of data[s:e]."""
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers(len(data))[0], out=h[1:])
    return h


def span_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((h[end] - h[start]) * powers(len(h))[1][start])


def spans(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true, which end at the end of a document too."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = off[(off > 0) & (off < n)]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    return _LOWER[data]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
