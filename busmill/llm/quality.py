"""Document quality by a linear-chain conditional random field over lines.

Every line of a text is good or bad. A line's evidence is the bins of its own measures and of the lines before and after
it; the chain ties neighbours together. Forward and backward passes give each line's marginal, and the mean of the
marginals, weighted by the lines' lengths, is the document's score.

The field is fitted in the driver on a bounded sample of labelled documents: about `sample` of each label, chosen by a hash
of their id, none with over LINES lines; a line's label is its document's. Scoring is one pass without a shuffle.

Null and empty texts, and texts of line breaks alone, have no lines and score 0. Null labels are not learned from; of
several labels of one document the smallest holds. With labels of one kind or none the score is 1 for every text that has a
line. Repeated rows get equal results. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, crc_mod, lean, lowered, mixed, prefix_hashes, slices, span_hashes, spans, table

BINS, LINES = 10, 2000


def _sums(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return (total[end] - total[start]).astype(np.float64)


def measures(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measures of every line that isn't empty, the lines' bytes, and each document's first line."""
    start, end = spans(data != 10, off)
    first = np.searchsorted(start, off)
    size = (end - start).astype(np.float64)
    after = np.append(data[1:], np.uint8(0))
    wide = data == 0xC3
    upper = ((data >= 65) & (data <= 90)) | (wide & (after >= 0x80) & (after <= 0x9E))
    lower = ((data >= 97) & (data <= 122)) | (wide & (after > 0x9E)) | (data > 0xC3)
    digit = (data >= 48) & (data <= 57)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    sign = (data < 128) & ~(upper | lower | digit | blank)
    odd = sign & (data != 44) & (data != 46) & (data != 39) & (data != 45)
    ws, we = spans(~blank, off)
    row = np.searchsorted(start, ws, side="right") - 1
    one = row[1:] == row[:-1]
    h = span_hashes(prefix_hashes(lowered(data)), ws, we)
    doc = np.searchsorted(off, ws, side="right").astype(np.uint64)
    key = mixed(h + doc * U64(0x9E3779B97F4A7C15))
    again = np.ones(len(ws), bool)
    again[np.unique(key, return_index=True)[1]] = False
    same = np.append(False, one & (h[1:] == h[:-1]))[: len(ws)]
    length = we - ws
    titled = upper[ws]
    count = lambda flag: np.bincount(row[flag], minlength=len(start)).astype(np.float64)
    words = np.maximum(count(np.ones(len(ws), bool)), 1)
    mean = np.bincount(row, length, minlength=len(start)) / words
    spread = np.sqrt(np.maximum(np.bincount(row, length.astype(np.float64) ** 2, minlength=len(start)) / words - mean**2, 0))
    letters = np.maximum(_sums(upper, start, end) + _sums(lower, start, end), 1)
    line = span_hashes(prefix_hashes(data), start, end)
    owner = np.searchsorted(off, start, side="right").astype(np.uint64)
    copied = np.ones(len(start), bool)
    copied[np.unique(mixed(line + owner * U64(0x9E3779B97F4A7C15)), return_index=True)[1]] = False
    lines = np.repeat(np.diff(first), np.diff(first)).astype(np.float64)
    return (
        np.stack([np.log1p(size), words, mean, spread, _sums(upper, start, end) / letters, _sums(digit, start, end) / size, _sums(sign, start, end) / size, _sums(odd, start, end) / size, count(again) / words, count(same) / words, count(length <= 3) / words, count(length >= 9) / words, count(titled) / words, letters / size, copied.astype(np.float64), np.log1p(lines), (data[end - 1] == 46).astype(np.float64), upper[start].astype(np.float64)], 1),
        size,
        first,
    )


def passes(u: np.ndarray, first: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log odds of good against bad for every line; tie[a, b]: the weight of b after a."""
    (t00, t01), (t10, t11) = tie
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    on, back = u.copy(), np.zeros_like(u)
    most = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(most), side="left")
    for t in range(1, most):
        i = begin[: active[t]] + t
        m = on[i - 1]
        on[i] += np.logaddexp(m + t11, t01) - np.logaddexp(m + t10, t00)
    for t in range(most - 1, 0, -1):
        i = begin[: active[t]] + t
        m = u[i] + back[i]
        back[i - 1] = np.logaddexp(m + t11, t10) - np.logaddexp(m + t01, t00)
    return on, back


@dataclass
class Field:
    edges: np.ndarray
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    bias: float
    tie: np.ndarray

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], 1)

    @staticmethod
    def around(bins: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bins of the line before and of the line after; BINS where there is none."""
        prev, following = np.full_like(bins, BINS), np.full_like(bins, BINS)
        prev[1:], following[:-1] = bins[:-1], bins[1:]
        here = first[:-1][np.diff(first) > 0]
        prev[here] = BINS
        following[first[1:][np.diff(first) > 0] - 1] = BINS
        return prev, following

    def marginals(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        bins = self.bins(x)
        k = np.arange(bins.shape[1])
        u = self.bias + sum(w[k, b].sum(1) for w, b in zip((self.own, self.before, self.after), (bins, *self.around(bins, first)), strict=True))
        on, back = passes(u, first, self.tie)
        return 1 / (1 + np.exp(-np.clip(on + back, -40, 40)))


def fit(x: np.ndarray, first: np.ndarray, label: np.ndarray, rounds: int = 150, rate: float = 0.05, decay: float = 2e-3) -> Field:
    """Conditional likelihood of the lines' labels, each document with equal weight, by Adam; a tie is at most 2."""
    edges = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    field = Field(edges, *(np.zeros((x.shape[1], BINS + 1)) for _ in range(3)), 0.0, np.zeros((2, 2)))
    own = field.bins(x)
    wide = BINS + 1
    flat = [b + np.arange(x.shape[1]) * wide for b in (own, *field.around(own, first))]
    size = np.diff(first)
    y = np.repeat(label, size).astype(np.float64)
    share = np.repeat(1 / np.maximum(size, 1), size) / max(1, len(size))
    inner = np.ones(len(x), bool)
    inner[first[:-1][size > 0]] = False
    inner = np.flatnonzero(inner)
    theta = np.zeros(3 * x.shape[1] * wide + 5)
    cut = x.shape[1] * wide
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        tie = theta[-4:].reshape(2, 2)
        u = theta[-5] + sum(theta[k * cut : (k + 1) * cut][f].sum(1) for k, f in enumerate(flat))
        on, back = passes(u, first, tie)
        p = 1 / (1 + np.exp(-np.clip(on + back, -40, 40)))
        pull = (y - p) * share
        grad = np.zeros_like(theta)
        for k, f in enumerate(flat):
            grad[k * cut : (k + 1) * cut] = np.bincount(f.ravel(), np.repeat(pull, f.shape[1]), minlength=cut)
        grad[-5] = pull.sum()
        if len(inner):
            a, b = on[inner - 1], u[inner] + back[inner]
            w = np.stack([np.zeros_like(a) + tie[0, 0], b + tie[0, 1], a + tie[1, 0], a + b + tie[1, 1]])
            w = np.exp(w - w.max(0))
            seen = np.stack([(y[inner - 1] == i) & (y[inner] == j) for i in (0, 1) for j in (0, 1)])
            grad[-4:] = ((seen - w / w.sum(0)) * share[inner]).sum(1)
        grad -= decay * theta / 10
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        theta[-4:] = np.clip(theta[-4:], -2, 2)
    field.own, field.before, field.after = (theta[k * cut : (k + 1) * cut].reshape(-1, wide) for k in range(3))
    field.bias, field.tie = float(theta[-5]), theta[-4:].reshape(2, 2).copy()
    return field


def learn(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = 1500) -> Field | None:
    """labels: doc_id, quality. sample: the bound, about, on the documents of each label that reach the driver, as measures."""
    known = labels.where(usable & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return None
    share = F.when(F.col("quality") == 1, min(1.0, sample / counts[1])).otherwise(min(1.0, sample / counts[0]))
    drawn = known.where(F.pmod(F.xxhash64("doc_id", F.lit("drawn")), F.lit(1 << 20)) < share * (1 << 20))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(0)):
                x, _, first = measures(data, off)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), pa.array([x[a:b].astype(np.float32).tobytes() if b - a <= LINES else None for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())], ["quality", "x"])

    # At most about 2 * sample rows: small enough to send to every executor.
    rows = docs.join(F.broadcast(drawn), "doc_id").select("text", F.col("quality").cast("int")).mapInArrow(run, "quality int, x binary").where("length(x) > 0").collect()
    rows.sort(key=lambda r: (r.quality, bytes(r.x)))
    if len({r.quality for r in rows}) < 2:
        return None
    wide = measures(np.full(1, 65, np.uint8), np.array([0, 1]))[0].shape[1]
    xs = [np.frombuffer(r.x, np.float32).reshape(-1, wide) for r in rows]
    return fit(np.concatenate(xs).astype(np.float64), np.cumsum([0] + [len(a) for a in xs]), np.array([r.quality for r in rows]))


def score(docs: DataFrame, field: Field | None, cut: float = 0.3) -> DataFrame:
    """docs with text, every other column kept: adds score and predicted (1 if score >= cut) and the number of bad lines."""
    kept = [c for c in docs.columns if c not in ("score", "predicted", "bad_lines")]
    at = kept.index("text")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, bad = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for lo, hi, data, off in slices(batch.column(at)):
                x, size, first = measures(data, off)
                p = field.marginals(x, first) if field else np.ones(len(size))
                total = np.append(0, np.cumsum(size))
                good = np.append(0, np.cumsum(p * size))
                weight = total[first[1:]] - total[first[:-1]]
                out[lo:hi] = np.clip((good[first[1:]] - good[first[:-1]]) / np.maximum(weight, 1), 0, 1)
                worse = np.append(0, np.cumsum(p < 0.5))
                bad[lo:hi] = worse[first[1:]] - worse[first[:-1]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out), pa.array((out >= cut).astype(np.int32)), pa.array(bad)], names=[*kept, "score", "predicted", "bad_lines"])

    rows = docs.select(*kept)
    schema = rows.withColumns({"score": F.lit(0.0), "predicted": F.lit(0), "bad_lines": F.lit(0).cast("long")}).schema
    return rows.mapInArrow(run, schema)


def held_out() -> Column:
    return crc_mod("doc_id", 5) == 0


def trained(docs: DataFrame, labels: DataFrame) -> Field | None:
    """The field learned from the labelled rows that are not held out."""
    return learn(docs.select("doc_id", "text"), labels, ~held_out())


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = trained(docs, table(spark, sf_dir, "labels"))
    return score(docs, field).select("doc_id", held_out().alias("held_out"), "score", "predicted", "bad_lines")
