"""Exact top-k inner products by an impact-ordered index that is read score at a time.

Vectors are dealt into blocks by a hash. A block's postings are kept by impact level, the size of a component in powers of four.
A query takes the segments (component, level) in the order of the largest contribution they can make, tier by tier, and adds
their contributions to the vectors' partial scores; queries of one block do so together. What the segments that are left can still add bounds every score from
both sides; when the bound proves that only a few vectors can be among the first k, those are scored exactly. Each block
gives k rows a query, and a window over them gives the answer: no vector is left out without that proof.

Queries are dealt into blocks too, so any number of them meets any number of vectors: each pair of blocks is one task's group. Rows that are equal are one
entry with a count, so copies are in no one block. An index is built once for all queries of a group.

Levels and bounds are doubles; scores come from whole numbers. Where components are so large that sums of doubles aren't exact, the bounds are widened by what they
can be off, and scores are summed without rounding; a score beyond 64 bits is an error.

Vectors that are null, or hold a null, NaN or infinite component, and null ids take no part. Shorter vectors count as padded with
zeros. Ties go to the smaller id. A repeated id is one query, its smallest vector; as candidates all its rows count, but none for the query
of the same id. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import partitions, table

K, EVERY, SCALE = 5, 50, 256


def matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of floor(256 * x), as doubles, which hold them exactly."""
    flat = vectors.combine_chunks()
    size = np.diff(flat.offsets.to_numpy(zero_copy_only=False))
    out = np.zeros((len(size), width))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = np.floor(SCALE * flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    return out


class ImpactIndex:
    """A block's postings by impact level: for each level a matrix with the components of that size, and zero elsewhere."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        level = (np.frexp(np.abs(self.rows))[1] + 1) // 2
        #: No score can be further from 0 than this times a query's largest component.
        self.size = float(np.abs(self.rows).sum(1).max(initial=0))
        self.levels = [np.where(level == j, self.rows, 0.0) for j in np.unique(level[level > 0])[::-1]]
        #: The largest size in each segment: by component and level.
        self.most = np.stack([np.abs(x).max(0) for x in self.levels], 1) if self.levels else np.zeros((rows.shape[1], 0))

    def exact(self, places: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Inner products without rounding."""
        if self.size * np.abs(x).max(initial=0) < 2.0**52:
            return (self.rows[places] @ x).astype(np.int64)
        whole = [int(v) for v in x]
        return np.array([sum(int(a) * b for a, b in zip(row, whole, strict=True)) for row in self.rows[places]], np.int64)

    def search(self, own: np.ndarray, q: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the positions and exact scores of the k first vectors; all, if there are fewer."""
        n = len(self.ids)
        possible: list[np.ndarray] = [np.flatnonzero(self.ids != o) for o in own]
        open_ = np.flatnonzero([len(p) > 4 * k for p in possible]) if self.levels else []
        partial = np.zeros((len(open_), n))
        partial[self.ids == own[open_][:, None]] = -np.inf
        impact = np.abs(q[open_])[:, :, None] * self.most
        with np.errstate(divide="ignore", invalid="ignore"):
            tier = np.floor(np.log2(impact.max((1, 2), keepdims=True) / impact) / 2)
        tier[impact == 0] = np.inf
        for t in range(int(tier[np.isfinite(tier)].max(initial=-1)) + 1):
            now = q[open_]
            for j, x in enumerate(self.levels):
                use = tier[:, :, j] == t
                if use.any():
                    partial += np.where(use, now, 0.0) @ x.T
            # Every score lies within `rest` of its partial score, so those below `cut` are not among the first k.
            rest = np.where(tier > t, impact, 0.0).max(2).sum(1)
            off = self.size * np.abs(now).max(1)
            rest = rest + np.where(off < 2.0**52, 0.0, off * 2.0**-40)
            cut = np.partition(partial, n - k, axis=1)[:, n - k] - 2 * rest
            may = partial >= cut[:, None]
            # A query whose segments are all read is done, too.
            done = (may.sum(1) <= max(4 * k, n // 16)) | (np.where(np.isfinite(tier), tier, -1).max((1, 2)) <= t)
            for i in np.flatnonzero(done):
                possible[open_[i]] = np.flatnonzero(may[i])
            if done.any():
                open_, partial, impact, tier = (x[~done] for x in (open_, partial, impact, tier))
            if not len(open_):
                break
        out = []
        for p, x in zip(possible, q, strict=True):
            score = self.exact(p, x)
            first = np.lexsort((self.ids[p], -score))[:k]
            out.append((p[first], score[first]))
        return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, block: int = 16_384, together: int = 16_384, chunk: int = 256) -> DataFrame:
    """vectors and queries: vec_id, embedding. Gives query_id, rank, vec_id, score."""
    whole = F.expr("vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    vectors = vectors.where(whole).select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    queries = queries.where(whole).select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    vectors = vectors.groupBy("vec_id", "embedding").agg(F.count("*").alias("copies"))
    n = vectors.count()
    # Small inputs are cut finer, so that all tasks have some.
    blocks = max(1, math.ceil(n / block), min(partitions(vectors.sparkSession), math.ceil(n / 2048)))
    groups = max(1, math.ceil(queries.count() / together))
    held = vectors.withColumns({"b": F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)), "g": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))})
    asked = queries.withColumns({"g": F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"), "b": F.explode(F.expr(f"sequence(0L, {blocks - 1}L)"))})

    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if len(held) and len(asked):
            width = max(max(len(v) for v in t["embedding"]) for t in (held, asked))
            ids = held["vec_id"].to_numpy()
            copies = held["copies"].to_numpy()[np.argsort(ids, kind="stable")]
            index = ImpactIndex(ids, matrix(held["embedding"], width))
            for lo in range(0, len(asked), chunk):
                part = asked.slice(lo, chunk)
                owns = part["vec_id"].to_numpy()
                for own, (at, score) in zip(owns, index.search(owns, matrix(part["embedding"], width), k), strict=True):
                    times = np.minimum(copies[at], k)
                    at, score = np.repeat(at, times)[:k], np.repeat(score, times)[:k]
                    out.append((np.full(len(at), own), index.ids[at], score))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    best = held.groupBy("b", "g").cogroup(asked.groupBy("b", "g")).applyInArrow(run, "query_id long, vec_id long, score long")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


ORACLE = f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
