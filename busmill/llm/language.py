"""Language identification by error-correcting output codes.

Every language gets a codeword of +1 and -1; one binary classifier a bit, over hashed letter n-grams of the whole
text, is fitted to tell the languages with +1 from those with -1. A text's language is the codeword with the
smallest loss, each bit weighted by how well its classifier does; a text is ambiguous if the second codeword is near.

The model is fitted in the driver on a bounded sample: about `sample` documents, as many of each language as
there are, chosen by a hash of their id. Everything else is one pass over the rows, without a shuffle.

Null texts and texts without a letter are `und` with score 0. Null languages are not learned from. With no language
to learn, every row is `und`; with one, all others are that one. Repeated rows get equal results, and extra columns are
not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, slices, table

THREES, TWOS = 1 << 12, 1 << 10
DIMS = THREES + TWOS
UNKNOWN = "und"


def features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, counts of hashed n-grams as unit vectors of roots, whether a row has a letter)."""
    lower = pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))
    letter = np.zeros(256, bool)
    letter[97:123] = letter[128:] = True
    for lo, hi, data, off in slices(lower, rows=256):
        n = hi - lo
        text = np.where(letter[data], data, np.uint8(32)).astype(np.uint32)
        row = np.repeat(np.arange(n), np.diff(off))
        counts = np.zeros(n * DIMS, np.float32)
        for k, size, at in ((3, THREES, 0), (2, TWOS, THREES)):
            if len(text) < k:
                continue
            m = len(text) - k + 1
            code = sum(text[j : m + j] << np.uint32(8 * j) for j in range(k))
            one = (row[:m] == row[k - 1 :]) & (code != sum(32 << (8 * j) for j in range(k)))
            spread = (code[one] * np.uint32(2654435761)) >> np.uint32(33 - size.bit_length())
            counts += np.bincount(row[:m][one] * DIMS + at + spread, minlength=n * DIMS)
        x = np.sqrt(counts.reshape(n, DIMS))
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        seen = np.add.reduceat(np.append(letter[data] & (data < 128), False).astype(np.int64), off[:-1]) * (np.diff(off) > 0) > 0
        for i in np.flatnonzero(~seen & (np.diff(off) > 0)):
            seen[i] = any(c.isalpha() for c in bytes(data[off[i] : off[i + 1]]).decode("utf-8", "replace"))
        yield lo, hi, x, seen


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n rows of +1 and -1: all distinct splits for up to 6 languages, else the random code, of 200, with the farthest rows."""
    if n <= 6:
        bits = np.array([[(k >> j) & 1 for j in range(n)] for k in range(1, 1 << n, 2)][:-1] or [[1] * n])
        return 2 * bits.T - 1
    rng, width = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best = max((rng.choice([-1, 1], (n, width)) for _ in range(200 if n < 200 else 5)), key=lambda c: -np.max(c @ c.T - 2 * width * np.eye(n)))
    return best[:, np.abs(best.sum(0)) < n]


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, x: np.ndarray, near: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the chosen language, its share among the codewords' likelihoods, and whether the choice is ambiguous."""
        margin = x @ self.weights + self.bias
        loss = np.stack([(self.trust * np.logaddexp(0, -margin * c)).sum(1) for c in self.code], 1)
        like = np.exp(loss.min(1, keepdims=True) - loss)
        like /= like.sum(1, keepdims=True)
        best = loss.argmin(1)
        score = like[np.arange(len(x)), best]
        second = np.partition(like, -2, axis=1)[:, -2] if like.shape[1] > 1 else np.zeros(len(x))
        return best, score, score - second < near


def fit(x: np.ndarray, y: np.ndarray, langs: list[str], rounds: int = 120, decay: float = 1e-4) -> Model:
    """One logistic regression a bit, by accelerated descent over the whole sample."""
    code = codewords(len(langs)).astype(np.float32)
    goal = code[y]
    w = v = np.zeros((x.shape[1], code.shape[1]), np.float32)
    b = vb = np.zeros(code.shape[1], np.float32)
    weight = (1 / np.bincount(y, minlength=len(langs))[y]).astype(np.float32)
    weight = (weight / weight.sum())[:, None]
    for k in range(rounds):
        pull = -goal / (1 + np.exp(goal * (x @ v + vb))) * weight
        w1, b1 = v - 8 * (x.T @ pull + decay * v), vb - 8 * pull.sum(0)
        m = k / (k + 3)
        v, vb, w, b = w1 + m * (w1 - w), b1 + m * (b1 - b), w1, b1
    wrong = (weight * ((x @ w + b) * goal <= 0)).sum(0)
    return Model(langs, code, w, b, np.maximum(1 - 2 * wrong, 0.01))


def learn(docs: DataFrame, usable: Column, sample: int = 3000) -> Model | None:
    """docs: text and lang. sample: the bound on the rows that reach the driver, about, shared out evenly among the languages."""
    known = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return None
    langs = sorted(counts)
    share = F.create_map(*chain.from_iterable((F.lit(k), F.lit(min(1.0, max(8, sample // len(counts)) / n))) for k, n in counts.items()))
    drawn = known.where(F.pmod(F.xxhash64("doc_id", F.lit("drawn")), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, x, _ in features(batch.column(0)):
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary())], ["lang", "x"])

    rows = drawn.select("text", "lang").mapInArrow(run, "lang string, x binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.lang, bytes(r.x)))  # the fit doesn't depend on the order of tasks
    x = np.frombuffer(b"".join(r.x for r in rows), np.float16).reshape(len(rows), DIMS).astype(np.float32)
    langs = sorted({r.lang for r in rows})
    return fit(x, np.searchsorted(langs, [r.lang for r in rows]), langs)


def identify(docs: DataFrame, model: Model | None, near: float = 0.2) -> DataFrame:
    """docs with doc_id and text, any other column kept: adds lang_pred, score and ambiguous (the second language is near)."""
    kept = [c for c in docs.columns if c not in ("text", "lang_pred", "score", "ambiguous")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            pred, score, unsure = np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n, bool)
            for lo, hi, x, seen in features(batch.column(0)) if model else ():
                best, sure, close = model.decode(x, near)
                pred[lo:hi] = np.where(seen, np.array(model.langs, object)[best], UNKNOWN)
                score[lo:hi], unsure[lo:hi] = np.where(seen, sure, 0), seen & close
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(pred, pa.string()), pa.array(score), pa.array(unsure)], names=[*kept, "lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col("text").cast("string"), *kept)
    schema = rows.drop("text").withColumns({"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0), "ambiguous": F.lit(True)}).schema
    return rows.mapInArrow(run, schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 4) == 2
    model = learn(docs.select("doc_id", "text", "lang"), ~held_out)
    return identify(docs.select("doc_id", "text", held_out.alias("held_out")), model)
