"""Removal of word runs that occur earlier, by prefix-partitioned suffix trees.

The suffixes are those of every word, cut off at WINDOW words: what ties deeper ties there. They are split by prefixes of variable length, from GRAM words to
WINDOW: a suffix's prefix ends with its anchor, the first of the least of its runs of GRAM words by hash. Equal suffixes have equal
prefixes, and suffixes that follow one another mostly share an anchor, so they travel as one segment of words.

1. Each block of whole documents sends the hashes of its anchors, packed by bucket; buckets are sorted one at a time and tell which anchors occur more than
   once. A suffix whose prefix occurs once is a leaf at that depth already, and is left out.
2. The other segments meet in buckets by anchor. A bucket's suffixes are sorted word by word, which puts the leaves of its subtree in order; neighbours
   with WINDOW words in common hang from one internal node of that depth. Of a node's leaves the earliest stays and the others are repeats. Buckets
   are as many as keep each at some BUCKET bytes.
3. The repeats are joined back to their blocks, and the words under them are cut out.

Segments that a block has more than once are sent once, the earliest; the others are repeats whatever is elsewhere. An anchor that HOT blocks or more
have would be too much for a bucket: its suffixes take the longest prefix, all their words, are summed up by Spark to the earliest of each
before they are shuffled, and joined back, where Spark splits skewed keys.

Words are compared by 32 bits of their hash each, and a whole suffix by 32 more bits of another, so a false tie needs words that collide in both.
Null and empty texts have no words. A null id comes before all others; rows of one id come in the order of their blocks. A text beyond a block is a
block of its own; memory is some hundred times its bytes. Of repeated rows the first stays. Extra columns are not read. An empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, dropped, lean, mixed, powers, prefix_hashes, span_hashes, spans, stored, table, work_dir
from .repeats import TWICE, VOTES, _texts, _votes, blocks_of, distinct, packed, tied_entries

WINDOW, GRAM = 20, 8
BUCKET, HOT = 8_000_000, 4096
#: Bytes of a segment in a bucket, about.
ENTRY = 140
BLANKS = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LEAST_ID = np.iinfo(np.int64).min
HEAD = np.dtype([("doc", "<i8"), ("row", "<i4"), ("start", "<i4"), ("index", "<u4"), ("n", "<u4")])


class Block:
    """The words of a block and the segments of its suffixes, in the order of the text.

    at, n: a segment's first suffix (as a word of the block) and how many there are; anchor: the hash of their anchor."""

    def __init__(self, data: np.ndarray, off: np.ndarray, ids: list, window: int = WINDOW, gram: int = GRAM):
        self.data, self.off, self.window = data, off, window
        self.start, self.end = spans(~BLANKS[data], off)
        self.doc = np.searchsorted(off, self.start, side="right") - 1
        self.ids = np.array([LEAST_ID if x is None else x for x in ids], np.int64)
        self.first = np.searchsorted(self.doc, np.arange(len(ids) + 1))
        self.words = span_hashes(prefix_hashes(data), self.start, self.end)
        self.sums = np.zeros(len(self.words) + 1, np.uint64)
        np.cumsum(self.words * powers(len(self.words))[0], out=self.sums[1:])
        at = np.arange(max(0, len(self.words) - window + 1))
        at = at[self.doc[at] == self.doc[at + window - 1]]
        grams = np.arange(max(0, len(self.words) - gram + 1))
        hashes = span_hashes(self.sums, grams, grams + gram)
        least, place = hashes[at], at.copy()
        for d in range(1, window - gram + 1):
            other = hashes[at + d]
            less = other < least
            least[less], place[less] = other[less], at[less] + d
        new = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1))[: len(at)])
        self.at, self.anchor, self.n = at[new], least[new], np.diff(np.append(new, len(at)))

    def votes(self, block: int, buckets: int) -> tuple[np.ndarray, Iterator[tuple]]:
        """The segments whose anchor an earlier one of the block has, and the anchors packed by bucket."""
        first, twice, again = distinct(self.anchor)
        return again, packed(block, (self.anchor >> U64(32)) % U64(buckets), (self.anchor & U64(0xFFFFFFFF)).astype(np.uint32), first, twice)

    def places(self, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of segments one after another, and where each begins among them."""
        size = self.n[segments] + self.window - 1
        begin = np.cumsum(size) - size
        return np.repeat(self.at[segments] - begin, size) + np.arange(size.sum()), begin

    def earlier(self, segments: np.ndarray) -> np.ndarray:
        """Those of the segments that are equal to another one that comes earlier."""
        if not len(segments):
            return segments
        ids, doc = self.ids, self.doc[self.at[segments]]
        rank = np.empty(len(ids), np.int64)
        rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
        at, n = self.at[segments], self.n[segments]
        key = mixed(span_hashes(self.sums, at, at + n + self.window - 1) + n.astype(np.uint64))
        order = np.lexsort((at, rank[doc], key))
        head = np.append(True, key[order][1:] != key[order][:-1])
        later, kept = order[~head], order[np.flatnonzero(head)[np.cumsum(head) - 1][~head]]
        same = (n[later] == n[kept]) & (self.symbols(segments[later], int(n.max())) == self.symbols(segments[kept], int(n.max()))).all(1)
        return segments[later[same]]

    def symbols(self, segments: np.ndarray, most: int) -> np.ndarray:
        """The words of segments in rows; 0 behind their ends."""
        column = np.arange(most + self.window - 1)
        at = self.at[segments][:, None] + column
        return np.where(column < (self.n[segments] + self.window - 1)[:, None], self.words[np.minimum(at, len(self.words) - 1)], U64(0))

    def heads(self, segments: np.ndarray) -> np.ndarray:
        out, doc = np.zeros(len(segments), HEAD), self.doc[self.at[segments]]
        out["doc"], out["row"], out["start"] = self.ids[doc], doc, self.at[segments] - self.first[doc]
        out["index"], out["n"] = segments, self.n[segments]
        return out

    def suffixes(self, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each suffix of the segments: the segment's position among them, and its word."""
        n = self.n[segments]
        of = np.repeat(np.arange(len(segments)), n)
        return of, self.at[segments][of] + np.arange(len(of)) - (np.cumsum(n) - n)[of]

    def whole(self, at: np.ndarray) -> np.ndarray:
        return span_hashes(self.sums, at, at + self.window)


def anchor_ties(hot: int):
    """Sorts one bucket of anchors: for each block in it, which of its anchors occur more than once, and which in `hot` blocks, as bits."""

    def run(votes: pa.Table) -> pa.Table:
        value = [np.frombuffer(v.as_buffer(), np.uint32) for v in votes["value"]]
        twice = np.concatenate([np.frombuffer(p.as_buffer(), np.uint32) for p in votes["place"]]) >= TWICE
        _, of, n = np.unique(np.concatenate(value), return_inverse=True, return_counts=True)
        cut = np.cumsum([len(v) for v in value])[:-1]
        tied, often = (np.split(x, cut) for x in ((n[of] > 1) | twice, n[of] >= hot))
        packed_ = lambda parts: pa.array([np.packbits(x).tobytes() if x.any() else None for x in parts], pa.binary())
        out = pa.table({"bucket": votes["bucket"], "block": votes["block"], "bits": packed_(tied), "often": packed_(often), "n": pa.array([int(x.sum()) for x in tied])})
        return out.filter(out["bits"].is_valid())

    return run


ANCHORS = "bucket long, block long, bits binary, often binary, n long"


def open_segments(block: Block, number: int, buckets: int, told: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The segments that may be repeats: those to be sent to buckets, those of hot anchors, and those that an earlier one of the block tells."""
    again, votes = block.votes(number, buckets)
    votes = list(votes)
    tied = np.unique(np.concatenate([again, tied_entries(votes, told)]))
    often = tied_entries(votes, [t | {"bits": t["often"]} for t in told if t["often"]])
    later = block.earlier(tied)
    sent = np.setdiff1d(tied, later, assume_unique=True)
    hot = np.isin(block.anchor[sent], block.anchor[often])
    return sent[~hot], sent[hot], later


def subtree(heads: np.ndarray, blocks: np.ndarray, words: np.ndarray, checks: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Of each segment the suffixes that are not the earliest leaf of their node at the depth of a window, as bits.

    words: the segments' words one after another; checks: a number for each of their suffixes."""
    n = heads["n"].astype(np.int64)
    size = n + window - 1
    base = np.cumsum(size) - size
    of = np.repeat(np.arange(len(heads)), n)
    d = np.arange(len(of)) - (np.cumsum(n) - n)[of]
    rank = np.empty(len(heads), np.int64)
    rank[np.lexsort((heads["start"], heads["row"], blocks, heads["doc"]))] = np.arange(len(heads))
    # Words by their number among the bucket's, several to a sort key: the order is that of the words, one after another.
    known, number = np.unique(words, return_inverse=True)
    bits = max(1, int(len(known)).bit_length())
    at, keys = base[of] + d, []
    for k in range(0, window, 64 // bits):
        key = np.zeros(len(of), np.uint64)
        for j in range(k, min(k + 64 // bits, window)):
            key = (key << U64(bits)) | number[at + j].astype(np.uint64)
        keys.append(key)
    keys.append(checks)
    order = np.lexsort((rank[of] * 64 + d, *keys[::-1]))
    deep = np.ones(max(0, len(of) - 1), bool)
    for key in keys:
        deep &= key[order][1:] == key[order][:-1]
    out = np.zeros(len(heads), np.uint64)
    later = order[1:][deep]
    np.bitwise_or.at(out, of[later], U64(1) << d[later].astype(np.uint64))
    return out


def grow(window: int):
    def run(rows: pa.Table) -> pa.Table:
        columns = [[np.frombuffer(x.as_buffer(), kind) for x in rows[name]] for name, kind in (("heads", HEAD), ("words", np.uint32), ("checks", np.uint32))]
        heads, words, checks = (np.concatenate(c) for c in columns)
        blocks = np.repeat(rows["block"].to_numpy(), [len(h) for h in columns[0]])
        bits = subtree(heads, blocks, words, checks, window)
        ok = np.flatnonzero(bits)
        return pa.table({"block": pa.array(blocks[ok]), "index": pa.array(heads["index"][ok].astype(np.int64)), "bits": pa.array(bits[ok].view(np.int64))})

    return run


HITS = "block long, index long, bits long"


def cut_out(block: Block, later: np.ndarray, index: np.ndarray, bits: np.ndarray) -> list[tuple]:
    """(number of words, starts and ends of the removed runs of words, kept words joined by spaces) of each document."""
    repeated = np.zeros(len(block.words) + 1, np.int64)
    _, at = block.suffixes(later)
    repeated[at] = 1
    for d in range(int(block.n.max(initial=0))):
        repeated[block.at[index[((bits >> U64(d)) & U64(1)).astype(bool)]] + d] = 1
    run = np.cumsum(repeated)
    gone = (run[: len(block.words)] - np.append(np.zeros(block.window, np.int64), run)[: len(block.words)]) > 0
    # A repeat near a document's end doesn't reach into the next: windows end with their document.
    text, keep = block.data.copy(), np.zeros(len(block.data) + 1, np.int64)
    inner = block.end < block.off[block.doc + 1]
    text[block.end[inner]] = 0x20
    np.add.at(keep, block.start[~gone], 1)
    np.add.at(keep, (block.end + inner)[~gone], -1)
    keep = np.cumsum(keep)[:-1] > 0
    out = []
    for a, b, x, y in zip(block.off[:-1], block.off[1:], block.first[:-1], block.first[1:], strict=True):
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone[x:y], [False]]).astype(np.int8)))
        out.append((int(y - x), edge[::2], edge[1::2], text[a:b][keep[a:b]].tobytes().rstrip(b" ")))
    return out


def repeated_runs(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, bucket: int = BUCKET) -> DataFrame:
    """doc_id, n_words, starts, ends (of the removed runs, in words), kept: each document of docs (doc_id, text) without what occurs earlier."""
    if not 0 < gram <= window <= gram + 63:
        raise ValueError("a window holds 1 to 64 places of an anchor")
    spark, where = docs.sparkSession, work_dir(docs.sparkSession)
    blocks = stored(blocks_of(docs), where, "blocks", compression="zstd")
    total = blocks.agg(F.sum(F.length("data"))).first()[0] or 0
    # Some six bytes a word and a segment for six words, eight bytes each.
    anchor_buckets = max(1, math.ceil(total / 5 / bucket))
    whole = lambda ids, ends, data: Block(*_texts(ends, data), ids.as_py(), window, gram)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, *row in zip(*batch.columns, strict=True):
                if rows := list(whole(*row).votes(number.as_py(), anchor_buckets)[1]):
                    yield _votes(rows)

    columns = ["block", "ids", "ends", "data"]
    anchors = blocks.select(columns).mapInArrow(lean(vote), VOTES).groupBy("bucket").applyInArrow(anchor_ties(hot), ANCHORS)
    anchors = stored(anchors, where, "anchors")
    tree_buckets = max(1, math.ceil((anchors.agg(F.sum("n")).first()[0] or 0) * ENTRY / bucket))
    told = stored(anchors.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits", "often")).alias("told")), where, "told")
    open_ = blocks.select(columns).join(told, "block")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        for batch in batches:
            for number, *row, answer in zip(*batch.columns, strict=True):
                block = whole(*row)
                sent, _, _ = open_segments(block, number.as_py(), anchor_buckets, answer.as_py())
                of = (mixed(block.anchor[sent]) % U64(tree_buckets)).astype(np.int64)
                sent = sent[np.argsort(of, kind="stable")]
                of = np.sort(of)
                rows = []
                for part in np.split(np.arange(len(sent)), np.flatnonzero(of[1:] != of[:-1]) + 1):
                    if len(part):
                        mine = sent[part]
                        words = (block.words[block.places(mine)[0]] >> U64(32)).astype(np.uint32)
                        checks = (block.whole(block.suffixes(mine)[1]) & U64(0xFFFFFFFF)).astype(np.uint32)
                        rows.append((int(of[part[0]]), number.as_py(), block.heads(mine).tobytes(), words.tobytes(), checks.tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["bucket", "block", "heads", "words", "checks"])

    found = open_.mapInArrow(lean(send), "bucket long, block long, heads binary, words binary, checks binary").groupBy("bucket").applyInArrow(grow(window), HITS)
    hits = stored(found, where, "hits")
    if not anchors.where("often IS NOT NULL").isEmpty():
        hits = hits.unionByName(hot_hits(open_, anchor_buckets, whole, where))
    by_block = hits.groupBy("block").agg(F.collect_list("index").alias("index"), F.collect_list("bits").alias("bits"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        for batch in batches:
            for number, *row, answer, index, bits in zip(*batch.columns, strict=True):
                block = whole(*row)
                later = open_segments(block, number.as_py(), anchor_buckets, answer.as_py() or [])[2]
                index, bits = (np.zeros(0, np.int64) if x.as_py() is None else x.values.to_numpy() for x in (index, bits))
                rows = [(doc, *x) for doc, x in zip(row[0].as_py(), cut_out(block, later, index, bits.view(np.uint64)), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "n_words", "starts", "ends", "kept"])

    dropped(spark, f"{where}/anchors")
    everything = blocks.select(columns).join(told, "block", "left").join(by_block, "block", "left")
    return everything.mapInArrow(lean(cut), "doc_id long, n_words long, starts array<long>, ends array<long>, kept binary")


def hot_hits(open_: DataFrame, anchor_buckets: int, whole, where: str) -> DataFrame:
    """The repeats among suffixes of hot anchors, by the hashes of all their words: summed up to the earliest, which is joined back."""
    schema = "block long, index long, d int, h long, c long, doc long, row int, start int"

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, *row, answer in zip(*batch.columns, strict=True):
                block = whole(*row)
                _, hot, _ = open_segments(block, number.as_py(), anchor_buckets, answer.as_py())
                if len(hot):
                    of, at = block.suffixes(hot)
                    doc, h = block.doc[at], block.whole(at)
                    d = at - block.at[hot][of]
                    # A second hash, of the same words read with the last letters of their hashes first.
                    check = np.zeros(len(at), np.uint64)
                    for k in range(block.window):
                        check = mixed(check + (block.words[at + k] >> U64(32)))
                    values = (np.full(len(at), number.as_py()), hot[of], d.astype(np.int32), h.view(np.int64), check.view(np.int64), block.ids[doc], doc.astype(np.int32), (at - block.first[doc]).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], [f.split()[0] for f in schema.split(", ")])

    rows = stored(open_.mapInArrow(lean(flat), schema), where, "hot", compression="zstd")
    place = F.struct("doc", "block", "row", "start")
    least = rows.groupBy("h", "c").agg(F.min(place).alias("least"))
    later = rows.join(least, ["h", "c"]).where(place > F.col("least"))
    return later.groupBy("block", "index").agg(F.bit_or(F.expr("shiftleft(1L, d)")).alias("bits"))


def op12_repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeated_runs(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("ends", "starts", lambda b, a: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) > 1 AS again FROM s),
k AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
c AS (SELECT doc_id, i, word, coalesce(bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone FROM k LEFT JOIN r USING (doc_id, i)),
g AS (SELECT doc_id, count_if(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN g USING (doc_id)"""
