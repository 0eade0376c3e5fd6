"""Benchmark decontamination: n-gram seeds and Smith-Waterman alignment.

The word n-grams of the benchmark's items are looked up in every whole text. A hit gives a diagonal, its place in the
text less its place in the item; hits of one item on neighbouring diagonals mark one passage. Every passage is aligned
with the item word by word (match 2, other word -1, gap -1) if its words allow the score, however many texts have its
n-grams; the local score, as a share of the item's own, tells whether the passage copies it. A score can't exceed 2 for each word
of the passage that the item has, nor 2 for each word of the item that the passage has; this bound spares passages that share
a common n-gram and little else. Edited and paraphrased copies keep most of the score; a copy that has no GRAM words of the
item in a row has no seed and isn't found.

The benchmark is taken in blocks of at most `most` words, and one block at a time is sent to the executors; so its size is bounded
whatever the benchmark's. Passages, not texts, are shuffled.

A very long text is read whole; its passages are no longer than some six times their item. Of equal scores the first place holds.

Words are as in the license scan: letters and digits, and everything beyond ASCII, with A-Z in lower case. Null and empty texts
and items never match. An item of fewer than GRAM words is one seed. Repeated rows and ids give one pair, with the best score. Extra columns are not read. Empty
tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lowered, prefix_hashes, slices, span_hashes, spans, stored, table, work_dir
from .jaccard import gram_hashes

GRAM, SCORE = 4, 0.4
CELLS = 1 << 19
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def words_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and each document's first word."""
    start, end = spans(_WORD[data], off)
    return span_hashes(prefix_hashes(lowered(data)), start, end), np.searchsorted(start, off)


def windows(lowest: int, highest: int, size: int) -> list[tuple[int, int]]:
    """Ranges of diagonals that cover those of a passage. An alignment that counts has gaps of less than 1.2 times the item's words, so its diagonals
    lie within 2 * size of each other, and so in one window whole; a text that repeats an item without end is many passages, each of bounded length."""
    if highest - lowest <= 4 * size:
        return [(lowest, highest)]
    return [(w, w + 4 * size) for w in range(lowest, highest - 2 * size + 1, 2 * size)]


def slack(size: int) -> int:
    """How far the diagonals of one passage may lie apart."""
    return 4 + size // 4


@dataclass
class Items:
    """A block of benchmark items: their words, and for each length of gram the sorted grams with the items and places that have them."""

    ids: list[int]
    words: list[np.ndarray]

    def __post_init__(self) -> None:
        self.seeds = {}
        for k in range(1, GRAM + 1):
            found = [(gram_hashes(w, k), i) for i, w in enumerate(self.words) if (len(w) >= GRAM if k == GRAM else len(w) == k)]
            if found:
                gram = np.concatenate([g for g, _ in found])
                item = np.concatenate([np.full(len(g), i) for g, i in found])
                at = np.concatenate([np.arange(len(g)) for g, _ in found])
                order = np.argsort(gram, kind="stable")
                bits = max(16, int(32 * len(gram)).bit_length())
                filled = np.zeros(1 << bits, bool)
                filled[gram & np.uint64((1 << bits) - 1)] = True
                self.seeds[k] = gram[order], item[order], at[order], filled

    def hits(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """Places, items and places in them that share a gram, with the gram's length."""
        for k, (gram, item, at, filled) in self.seeds.items():
            h = gram_hashes(words, k)
            place = np.flatnonzero(filled[h & np.uint64(len(filled) - 1)])
            lo, hi = np.searchsorted(gram, h[place]), np.searchsorted(gram, h[place], side="right")
            n = hi - lo
            if n.any():
                j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
                yield np.repeat(place, n), item[j], at[j], k


def may_reach(item: np.ndarray, passage: np.ndarray, least: float) -> bool:
    """Whether an alignment of these words can have the score `least`; item is sorted."""
    known = item[np.minimum(np.searchsorted(item, passage), len(item) - 1)] == passage
    need = least * len(item) - 1e-6
    there = np.sort(passage[known])
    if len(there) < need or not len(there):
        return need <= 0
    return (there[np.minimum(np.searchsorted(there, item), len(there) - 1)] == item).sum() >= need


def passages(docs: DataFrame, items: Items, least: float) -> DataFrame:
    """doc_id, item (of the block), start, words: the passages with a seed whose words allow the score."""
    sent = docs.sparkSession.sparkContext.broadcast((items.ids, items.words))  # a block is bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Items(*sent.value)
        size = np.array([len(w) for w in known.words])
        ordered = [np.sort(w) for w in known.words]
        for batch in batches:
            out: list[tuple] = []
            for lo, _, data, off in slices(batch.column(1)):
                words, first = words_of(data, off)
                for place, item, at, k in known.hits(words):
                    doc = np.searchsorted(first, place, side="right") - 1
                    inside = place + k <= first[doc + 1]
                    place, item, at, doc = place[inside], item[inside], at[inside], doc[inside]
                    diagonal = place - at
                    order = np.lexsort((diagonal, item, doc))
                    place, item, at, doc, diagonal = (x[order] for x in (place, item, at, doc, diagonal))
                    near = (doc[1:] == doc[:-1]) & (item[1:] == item[:-1]) & (diagonal[1:] - diagonal[:-1] <= 4 + size[item[1:]] // 4)
                    cut = np.append(np.flatnonzero(np.append(True, ~near)), len(place)) if len(place) else [0]
                    for a, b in zip(cut[:-1], cut[1:], strict=True):
                        d, i = doc[a], item[a]
                        for low, high in windows(int(diagonal[a]), int(diagonal[b - 1]), int(size[i])):
                            begin, end = max(first[d], low - slack(size[i])), min(first[d + 1], high + size[i] + slack(size[i]))
                            if may_reach(ordered[i], words[begin:end], least):
                                out.append((lo + d, i, begin - first[d], words[begin:end].tobytes()))
            if out:
                row, item, start, held = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(item, pa.int32()), pa.array(start, pa.int64()), pa.array(held, pa.binary())], ["doc_id", "item", "start", "words"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, item int, start long, words binary")


def align(item: np.ndarray, texts: list[np.ndarray]) -> list[tuple[float, int, int]]:
    """For each text the best local alignment: its score as a share of the item's own, and the words of the text that it spans."""
    wide = max(map(len, texts))
    grid = np.zeros((len(texts), wide), np.uint64)
    real = np.zeros((len(texts), wide), bool)
    for i, t in enumerate(texts):
        grid[i, : len(t)] = t
        real[i, : len(t)] = True
    step = np.arange(wide)
    score, begin = np.zeros((len(texts), wide + 1), np.int32), np.tile(np.arange(wide + 1), (len(texts), 1))
    best, span = np.zeros(len(texts), np.int32), np.zeros((len(texts), 2), np.int64)
    for word in item:
        same = (grid == word) & real
        across = score[:, :-1] + np.where(same, 2, -1)
        down = score[:, 1:] - 1
        now = np.maximum(np.maximum(across, down), 0)
        origin = np.where(now == 0, step + 1, np.where(across >= down, begin[:, :-1], begin[:, 1:]))
        lifted = now + step
        most = np.maximum.accumulate(lifted, axis=1)
        source = np.maximum.accumulate(np.where(lifted == most, step, 0), axis=1)
        now = most - step
        origin = np.take_along_axis(origin, source, 1)
        score[:, 1:], begin[:, 1:] = now, origin
        at = now.argmax(1)
        top = now[np.arange(len(texts)), at]
        better = top > best
        best[better] = top[better]
        span[better] = np.stack([origin[np.arange(len(texts)), at], at + 1], 1)[better]
    return [(float(b) / (2 * len(item)), int(s), int(e)) for b, (s, e) in zip(best, span, strict=True)]


def aligned(found: DataFrame, items: Items, least: float) -> DataFrame:
    sent = found.sparkSession.sparkContext.broadcast((items.ids, items.words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words = sent.value
        for batch in batches:
            doc, item, start = (batch.column(k).to_pylist() for k in (0, 1, 2))
            texts = [np.frombuffer(w, np.uint64) for w in batch.column(3).to_pylist()]
            by: dict[int, list[int]] = {}
            for row, i in enumerate(item):
                by.setdefault(i, []).append(row)
            out = []
            for i, rows in by.items():
                rows.sort(key=lambda r: -len(texts[r]))
                while rows:
                    together = max(1, min(64, CELLS // max(1, len(texts[rows[0]]))))  # they are padded to the longest
                    part, rows = rows[:together], rows[together:]
                    for r, (score, a, b) in zip(part, align(words[i], [texts[r] for r in part]), strict=True):
                        if score >= least:
                            out.append((doc[r], ids[i], score, start[r] + a, start[r] + b))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "item_id", "score", "start_word", "end_word"])

    return found.select("doc_id", "item", "start", "words").mapInArrow(run, "doc_id long, item_id long, score double, start_word long, end_word long")


def blocks_of(items: DataFrame, most: int) -> Iterator[Items]:
    """The benchmark in blocks of about `most` words at most; one item is at most a block of its own."""
    ids, words, held = [], [], 0
    for r in items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("length(text) > 0").distinct().orderBy("item_id", "text").toLocalIterator():
        data = np.frombuffer(r.text.encode(), np.uint8)
        found, _ = words_of(data, np.array([0, len(data)]))
        if not len(found):
            continue
        if held and held + len(found) > most:
            yield Items(ids, words)
            ids, words, held = [], [], 0
        ids.append(r.item_id)
        words.append(found)
        held += len(found)
    if held:
        yield Items(ids, words)


def contaminated(docs: DataFrame, items: DataFrame, least: float = SCORE, most: int = 500_000) -> DataFrame:
    """doc_id, item_id, score, start_word, end_word: the best copy of each item in each document of docs (doc_id, text)."""
    spark, where = docs.sparkSession, work_dir(docs.sparkSession)
    out = spark.createDataFrame([], "doc_id long, item_id long, score double, start_word long, end_word long")
    for n, block in enumerate(blocks_of(items, most)):
        rows = stored(passages(docs, block, least), where, f"passages-{n}")
        out = out.unionByName(aligned(rows, block, least))
    by = ["doc_id", "item_id"]
    return out.groupBy(*by).agg(F.max_by(F.struct("score", "start_word", "end_word"), F.struct("score", -F.col("start_word"))).alias("x")).select(*by, "x.*")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
