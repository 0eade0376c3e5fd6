"""Removal of long byte strings that occur more than once, by sorting suffixes in buckets over a difference cover.

Every place has, within the next PERIOD bytes, samples of the cover: the places whose position, modulo PERIOD, is in COVER. For any
two places p and q there is one d below PERIOD for which p + d and q + d both are samples, so two suffixes are compared by their d
bytes before the sample and by the ranks of their samples. So

1. The samples are ranked by their core, the CORE bytes that every string of LENGTH bytes over the sample holds: by a 64-bit hash,
   in buckets that are sorted one at a time. Samples that are the only ones of their rank are left out.
2. The other samples meet again in buckets by rank, some buckets at a time, each with the EDGE bytes before and after its core. In a
   bucket the suffixes that start d bytes before a sample are sorted by those d bytes, the sample's rank, and the bytes after the
   core that their LENGTH bytes take: for each d from 0 to EDGE. Neighbours that are equal tie. Nothing longer than an edge is
   compared, and a bucket holds its own samples alone, however long its ties are.
3. The places that tie are joined back to their documents, and the bytes that they cover are cut out.

Samples with the same rank and edges tie in all their suffixes; they are counted once for a block before they are shuffled, and take
no part in the sorting. Texts are kept in blocks of whole documents, and buckets hold packed arrays, so rows are few and large.
Buckets are as many as keep each at some BUCKET bytes. Where one rank has so many different edges that its bucket is MANY times as
large (a passage or a ruler that many documents share), that bucket's suffixes are dealt out again by d and by the hash of what they
are compared by, so equal ones still meet; the result is the same either way.

Ranks are in the order of hashes, not of bytes, and a rank's or an edge's hash may collide, with 64 bits; a false tie needs samples
whose cores differ and collide. Null and empty texts have no bytes and no spans. A text beyond a block is a block of its own; memory is
some fifty times its bytes. Repeated rows repeat each other. All suffixes of a tie are removed, so there is no order among them. Extra
columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, dropped, lean, mixed, powers, prefix_hashes, slices, span_hashes, stored, table, work_dir

LENGTH = 400
# A perfect difference set; every difference modulo 57 is one of two members.
PERIOD = 57
COVER = [0, 1, 3, 13, 32, 36, 43, 52]
CORE, EDGE = LENGTH - PERIOD + 1, PERIOD - 1
BLOCK, BUCKET, MANY = 1 << 19, 8_000_000, 8
#: An entry: the rank, the bytes before the core from the last to the first, the bytes after it, and how many there are of both.
BEFORE, AFTER, SIZES, ENTRY = 8, 8 + EDGE, 8 + 2 * EDGE, 128
TWICE = np.uint32(1 << 31)


def blocks_of(docs: DataFrame) -> DataFrame:
    """block, ids, ends (of each document in data), data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(1), BLOCK):
                ids = pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), batch.column(0).slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([pa.array([block]), ids, pa.array([off[1:].tobytes()], pa.binary()), pa.array([data.tobytes()], pa.binary())], ["block", "ids", "ends", "data"])
                block += 1

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "block long, ids array<long>, ends binary, data binary")


_sample = np.zeros(0, np.int64)


def sample_of(off: np.ndarray) -> np.ndarray:
    """The places of the cover sample in a block whose core string fits in its document."""
    global _sample
    most = int(np.diff(off).max(initial=0))
    if len(_sample) == 0 or _sample[-1] < most:
        _sample = (np.arange(0, most + PERIOD, PERIOD)[:, None] + np.array(COVER)).ravel()
    fit = np.searchsorted(_sample, np.diff(off) - CORE, side="right")
    return np.concatenate([_sample[:n] + a for n, a in zip(fit, off[:-1], strict=True)]) if len(fit) else _sample[:0]


def ranks(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sample's places, and the hashes of their core strings."""
    at = sample_of(off)
    return at, span_hashes(prefix_hashes(data), at, at + CORE)


def distinct(full: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An index of each distinct value, in the order of the values, whether it occurs again, and the indexes of the other occurrences."""
    order = np.argsort(full)
    head = np.append(True, full[order][1:] != full[order][:-1])[: len(order)]
    twice = np.append(~head[1:], False)[: len(order)]
    return order[head], twice[head], order[~head]


def packed(block: int, bucket: np.ndarray, value: np.ndarray, first: np.ndarray, twice: np.ndarray) -> Iterator[tuple]:
    """(bucket, block, values, places): for each bucket the distinct values of a block in order, and their indexes `first`, marked
    TWICE if the block has the value more than once. Equal values in any order give the same rows but for the places."""
    if not len(first):
        return
    of = bucket[first]
    by = np.argsort(of.astype(np.uint16) if of.max() < 1 << 16 else of, kind="stable")
    first, twice, of = first[by], twice[by], of[by]
    cut = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    places = first.astype(np.uint32) | np.where(twice, TWICE, np.uint32(0))
    values = value[first]
    for a, b in zip(cut, np.append(cut[1:], len(first)), strict=True):
        yield int(of[a]), block, values[a:b].tobytes(), places[a:b].tobytes()


VOTES = "bucket long, block long, value binary, place binary"


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _votes(rows: list[tuple]) -> pa.RecordBatch:
    return _batch(rows, ["bucket", "block", "value", "place"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()])


def ties(dtype: str):
    """Sorts one bucket: for each block in it, which of the block's entries tie with another, as bits in the entries' order."""

    def run(votes: pa.Table) -> pa.Table:
        value = [np.frombuffer(v, dtype) for v in votes["value"].to_pylist()]
        place = np.concatenate([np.frombuffer(p, np.uint32) for p in votes["place"].to_pylist()])
        size = [len(v) for v in value]
        value = np.concatenate(value)
        order = np.argsort(value)
        same = value[order][1:] == value[order][:-1]
        tied = np.zeros(len(value), bool)
        tied[order[1:][same]] = tied[order[:-1][same]] = True
        tied |= place >= TWICE
        bits, at = [], 0
        for n in size:
            bits.append(np.packbits(tied[at : at + n]).tobytes() if tied[at : at + n].any() else None)
            at += n
        out = pa.table({"bucket": votes["bucket"], "block": votes["block"], "bits": pa.array(bits, pa.binary())})
        return out.filter(out["bits"].is_valid())

    return run


def suffixes(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Bit d is set where the suffix d bytes before the sample has LENGTH bytes in its document."""
    before, after = before.astype(np.uint64), after.astype(np.uint64)
    return ((U64(2) << before) - U64(1)) & ~((U64(1) << (U64(EDGE) - after)) - U64(1))


def suffix_keys(entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each d: the entries that have such a suffix, and a hash of what they are compared by: d bytes, the rank, the other EDGE - d bytes."""
    power = powers(2 * EDGE)[0]
    ranks = mixed(np.ascontiguousarray(entries[:, :BEFORE]).view(np.uint64)[:, 0])
    edges = np.ascontiguousarray(entries[:, BEFORE:SIZES].T)
    has = suffixes(entries[:, SIZES], entries[:, SIZES + 1])
    key = ranks.copy()
    for k in range(EDGE, 2 * EDGE):
        key += (edges[k] + U64(1)) * power[k]
    for d in range(EDGE + 1):
        if d:
            key += (edges[d - 1] + U64(1)) * power[d - 1] - (edges[2 * EDGE - d] + U64(1)) * power[2 * EDGE - d]
        ok = np.flatnonzero((has >> U64(d)) & U64(1))
        yield ok, mixed(key[ok])


def entry_keys(entries: np.ndarray) -> np.ndarray:
    """A hash of a whole entry."""
    words = entries.view(np.uint64)
    key = np.zeros(len(words), np.uint64)
    for k in range(words.shape[1]):
        key = mixed(key + words[:, k])
    return key


def sorted_suffixes(entries: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """Sorts a bucket's suffixes; for each entry the suffixes that tie with another, as bits."""
    key = entry_keys(entries)
    order = np.argsort(key)
    head = np.append(True, key[order][1:] != key[order][:-1])[: len(order)]
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(head) - 1
    # One of each: those that occur more than once tie in all suffixes.
    one = entries[order[head]]
    again = np.bincount(of, minlength=len(one)) > 1
    again[of[twice]] = True
    bits = np.where(again, suffixes(one[:, SIZES], one[:, SIZES + 1]), U64(0))
    _, rank, size = np.unique(np.ascontiguousarray(one[:, :BEFORE]).view(np.uint64)[:, 0], return_inverse=True, return_counts=True)
    open_ = (size > 1) & (np.bincount(rank, weights=~again) > 0)
    mine = np.flatnonzero(open_[rank])
    found = np.zeros(len(mine), np.uint64)
    for d, (ok, key) in enumerate(suffix_keys(one[mine])):
        order = np.argsort(key)
        same = np.flatnonzero(key[order][1:] == key[order][:-1])
        found[ok[order[same]]] |= U64(1 << d)
        found[ok[order[same + 1]]] |= U64(1 << d)
    bits[mine] |= found
    return bits[of]


def suffix_ties(votes: pa.Table) -> pa.Table:
    """Sorts one bucket: of ranks (0 and above), or of suffixes that were dealt out again (below 0)."""
    if votes["bucket"][0].as_py() < 0:
        return ties("<u8")(votes)
    value = [np.frombuffer(v.as_buffer(), np.uint8).reshape(-1, ENTRY) for v in votes["value"]]
    place = np.concatenate([np.frombuffer(p.as_buffer(), np.uint32) for p in votes["place"]])
    found = sorted_suffixes(np.concatenate(value), place >= TWICE)
    bits = [f.tobytes() if f.any() else None for f in np.split(found, np.cumsum([len(v) for v in value])[:-1])]
    out = pa.table({"bucket": votes["bucket"], "block": votes["block"], "bits": pa.array(bits, pa.binary())})
    return out.filter(out["bits"].is_valid())


TIES = "bucket long, block long, bits binary"


def grouped(ties: DataFrame) -> DataFrame:
    return ties.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("ties"))


def tied_entries(votes: Iterator[tuple], ties: list[dict]) -> np.ndarray:
    """The indexes, in a block's own order, of the entries whose bits are set."""
    bits = {t["bucket"]: t["bits"] for t in ties}
    out = [np.zeros(0, np.int64)]
    for bucket, _, _, place in votes:
        if bucket in bits:
            place = np.frombuffer(place, np.uint32)
            out.append((place & ~TWICE)[np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=len(place)).astype(bool)].astype(np.int64))
    return np.concatenate(out)


def rank_votes(block: int, data: np.ndarray, off: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Iterator[tuple]]:
    """The samples' places and ranks, those of them whose rank an earlier one of the block has, and the votes."""
    at, rank = ranks(data, off)
    first, twice, again = distinct(rank)
    return at, rank, again, packed(block, (rank >> U64(32)) % U64(buckets), (rank & U64(0xFFFFFFFF)).astype(np.uint32), first, twice)


def entries_of(text: np.ndarray, at: np.ndarray, rank: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The entries of samples at places of a text; sizes: the number of bytes before and after their cores."""
    out = np.zeros((len(at), ENTRY), np.uint8)
    out[:, :BEFORE] = np.ascontiguousarray(rank).view(np.uint8).reshape(-1, 8)
    out[:, SIZES : SIZES + 2] = sizes
    edge = np.zeros(EDGE, np.uint8)
    runs = np.lib.stride_tricks.sliding_window_view(np.concatenate([edge, text, edge]), EDGE)
    for column, found, n in ((BEFORE, runs[at][:, ::-1], sizes[:, 0]), (AFTER, runs[at + CORE + EDGE], sizes[:, 1])):
        out[:, column : column + EDGE] = found
        short = np.flatnonzero(n < EDGE)
        out[short, column : column + EDGE] *= np.arange(EDGE) < n[short, None]
    return out


def dealt(rank: np.ndarray, turns: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The turn and the bucket of each rank."""
    turn = (rank >> U64(48)) % U64(turns)
    return turn, ((rank & U64((1 << 48) - 1)) % U64(buckets) * U64(turns) + turn).astype(np.int64)


def suffix_votes(block: int, piece: tuple, turns: int, buckets: int, hot: tuple[np.ndarray, int], turn: int) -> tuple[np.ndarray, list]:
    """The suffixes of a block's entries that tie within the block with an earlier one, as bits, and the votes of one turn.

    hot: the buckets that are dealt out again, and into how many for each d."""
    text, _, local, rank, sizes = piece
    of_turn, bucket = dealt(rank, turns, buckets)
    mine = np.flatnonzero(of_turn == turn)
    bits, votes = np.zeros(len(rank), np.uint64), []
    crowded = np.isin(bucket[mine], hot[0])
    for chosen, again_dealt in ((mine[~crowded], False), (mine[crowded], True)):
        if not len(chosen):
            continue
        entries = entries_of(text, local[chosen], rank[chosen], sizes[chosen])
        if not again_dealt:
            first, twice, again = distinct(entry_keys(entries))
            bits[chosen[again]] = suffixes(*sizes[chosen[again]].T)
            rows = packed(block, bucket[chosen], entries, first, twice)
            votes += [(b, k, v, _moved(place, chosen)) for b, k, v, place in rows]
            continue
        for d, (ok, key) in enumerate(suffix_keys(entries)):
            first, twice, again = distinct(key)
            bits[chosen[ok[again]]] |= U64(1 << d)
            rows = packed(block, key % U64(hot[1]), key, first, twice)
            # Below 0 the number of the bucket tells the turn and d, too.
            votes += [(-1 - ((b * turns + turn) * PERIOD + d), k, v, _moved(place, chosen[ok])) for b, k, v, place in rows]
    return bits, votes


def _moved(place: bytes, to: np.ndarray) -> bytes:
    place = np.frombuffer(place, np.uint32)
    return (to[place & ~TWICE].astype(np.uint32) | (place & TWICE)).tobytes()


def tied_suffixes(bits: np.ndarray, votes: list, ties: dict[int, bytes]) -> None:
    """Sets the bits that the buckets of the votes told."""
    for bucket, _, _, place in votes:
        if bucket not in ties:
            continue
        at = np.frombuffer(place, np.uint32) & ~TWICE
        if bucket >= 0:
            bits[at] |= np.frombuffer(ties[bucket], np.uint64)
        else:
            bits[at[np.unpackbits(np.frombuffer(ties[bucket], np.uint8), count=len(at)).astype(bool)]] |= U64(1 << ((-1 - bucket) % PERIOD))


def covered(at: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that the suffixes told by bits cover."""
    tied = np.zeros(int(at.max(initial=0)) + 1, bool)
    for d in range(PERIOD):
        tied[at[((bits >> U64(d)) & U64(1)).astype(bool)] - d] = True
    starts = np.flatnonzero(tied)
    if not len(starts):
        return starts, starts
    new = np.flatnonzero(np.append(True, np.diff(starts) > LENGTH))
    return starts[new], np.append(starts[new[1:] - 1], starts[-1]) + LENGTH


PIECES = "block long, at binary, local binary, rank binary, sizes binary, n long, text binary"


def piece_of(block: int, data: np.ndarray, off: np.ndarray, at: np.ndarray, rank: np.ndarray) -> pa.RecordBatch | None:
    """Those of the samples (in the order of places) over which a string fits, and the text that they need."""
    doc = np.searchsorted(off, at, side="right") - 1
    before, after = np.minimum(at - off[doc], EDGE), np.minimum(off[doc + 1] - at - CORE, EDGE)
    fit = before + after >= EDGE
    at, rank, before, after = at[fit], rank[fit], before[fit], after[fit]
    if not len(at):
        return None
    lo, hi = at - before, at + CORE + after
    new = np.append(True, lo[1:] > hi[:-1])
    start, end = lo[new], hi[np.append(np.flatnonzero(new)[1:] - 1, len(hi) - 1)]
    local = at - (start - np.cumsum(end - start) + (end - start))[np.cumsum(new) - 1]
    text = np.concatenate([data[a:b] for a, b in zip(start, end, strict=True)])
    row = (block, at.tobytes(), local.tobytes(), rank.tobytes(), np.stack([before, after], 1).astype(np.uint8).tobytes(), len(at), text.tobytes())
    return _batch([row], ["block", "at", "local", "rank", "sizes", "n", "text"], [pa.int64(), *[pa.binary()] * 4, pa.int64(), pa.binary()])


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, starts, ends, kept: the removed spans of each document of docs (doc_id, text), and the bytes that are left."""
    spark, where = docs.sparkSession, work_dir(docs.sparkSession)
    blocks = stored(blocks_of(docs), where, "blocks", compression="zstd")
    total = blocks.agg(F.sum(F.length("data"))).first()[0] or 0
    rank_buckets = max(1, math.ceil(total * len(COVER) / PERIOD * 8 / BUCKET))

    def vote_ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ends, data in zip(*batch.columns, strict=True):
                *_, votes = rank_votes(block.as_py(), *_texts(ends, data), rank_buckets)
                rows = list(votes)
                if rows:
                    yield _votes(rows)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ends, data, tied in zip(*batch.columns, strict=True):
                data, off = _texts(ends, data)
                at, rank, again, votes = rank_votes(block.as_py(), data, off, rank_buckets)
                mine = np.unique(np.concatenate([again, tied_entries(votes, tied.as_py())]))
                mine = mine[np.argsort(at[mine], kind="stable")]
                piece = piece_of(block.as_py(), data, off, at[mine], rank[mine])
                if piece is not None:
                    yield piece

    ranked = blocks.select("block", "ends", "data").mapInArrow(lean(vote_ranks), VOTES).groupBy("bucket").applyInArrow(ties("<u4"), TIES)
    marks = grouped(stored(ranked, where, "ranks"))
    pieces = stored(blocks.select("block", "ends", "data").join(marks, "block").mapInArrow(lean(mark), PIECES), where, "pieces", compression="zstd")
    samples = pieces.agg(F.sum("n")).first()[0] or 0
    # A turn's entries take at most half of the size of the texts.
    turns = max(1, math.ceil(2 * ENTRY * samples / max(total, 1)))
    buckets = max(1, math.ceil(ENTRY * samples / turns / BUCKET))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rank in batch.column(0):
                of, n = np.unique(dealt(np.frombuffer(rank.as_buffer(), np.uint64), turns, buckets)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(n)], ["bucket", "n"])

    crowded = pieces.select("rank").mapInArrow(sizes, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") * ENTRY > MANY * BUCKET)
    hot = crowded.toPandas()
    hot = hot["bucket"].to_numpy(np.int64), max(1, math.ceil(12 * hot["n"].sum() / turns / BUCKET))

    def vote_suffixes(turn: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in zip(*batch.columns, strict=True):
                    _, votes = suffix_votes(row[0].as_py(), _piece(row), turns, buckets, hot, turn)
                    if votes:
                        yield _votes(votes)

        return lean(run)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *row, told in zip(*batch.columns, strict=True):
                piece = _piece(row)
                told = {t["bucket"]: t["bits"] for t in told.as_py() or []}
                bits = np.zeros(len(piece[1]), np.uint64)
                for t in range(turns):
                    more, votes = suffix_votes(row[0].as_py(), piece, turns, buckets, hot, t)
                    tied_suffixes(more, votes, told)
                    bits |= more
                start, end = covered(piece[1], bits)
                yield _batch([(row[0].as_py(), start.tobytes(), end.tobytes())], ["block", "from", "to"], [pa.int64(), pa.binary(), pa.binary()])

    columns = pieces.select("block", "at", "local", "rank", "sizes", "text")
    found = [stored(columns.mapInArrow(vote_suffixes(t), VOTES).groupBy("bucket").applyInArrow(suffix_ties, TIES), where, f"ties-{t}", compression="zstd") for t in range(turns)]
    everything = found[0]
    for f in found[1:]:
        everything = everything.unionByName(f)
    tied = stored(columns.join(grouped(everything), "block", "left").mapInArrow(lean(spans), "block long, from binary, to binary"), where, "tied", compression="zstd")
    for name in ("pieces", "ranks", *(f"ties-{t}" for t in range(turns))):
        dropped(spark, f"{where}/{name}")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        for batch in batches:
            for ids, ends, data, start, end in zip(*batch.columns, strict=True):
                data, off = _texts(ends, data)
                gone = np.zeros(len(data), bool)
                for a, b in zip(*(np.frombuffer(x.as_py() or b"", np.int64) for x in (start, end)), strict=True):
                    gone[a:b] = True
                rows = []
                for doc, a, b in zip(ids.as_py(), off[:-1], off[1:], strict=True):
                    inside = gone[a:b]
                    turn = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
                    rows.append((doc, int(b - a), turn[::2], turn[1::2], data[a:b][~inside].tobytes()))
                yield _batch(rows, ["doc_id", "n_bytes", "starts", "ends", "kept"], kinds)

    out = "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary"
    return blocks.join(tied, "block", "left").select("ids", "ends", "data", "from", "to").mapInArrow(lean(cut), out)


def _texts(ends: pa.Scalar, data: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(data.as_buffer(), np.uint8), np.append(0, np.frombuffer(ends.as_buffer(), np.int64))


def _piece(row: tuple) -> tuple[np.ndarray, ...]:
    """text, at (places in the block), local (places in the text), rank, sizes"""
    _, at, local, rank, sizes, text = (x.as_buffer() if k else x for k, x in enumerate(row))
    return np.frombuffer(text, np.uint8), np.frombuffer(at, np.int64), np.frombuffer(local, np.int64), np.frombuffer(rank, np.uint64), np.frombuffer(sizes, np.uint8).reshape(-1, 2)


def op1_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats(table(spark, sf_dir, "documents"))
    removed = F.col("n_bytes") - F.length("kept")
    return out.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
