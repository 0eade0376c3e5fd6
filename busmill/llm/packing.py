"""Packing of documents into training sequences by the sum-of-squares rule.

Each task packs the documents of its own input partition as they come, so no task needs another's state. A document longer
than a window fills whole windows; its rest, like any shorter document, is one item. `SumOfSquares` keeps, in a level array, how many open
windows have each fill level, and places an item of size s where the sum of the squared counts grows least.

What is in open windows at the end of a partition is loose, some hundreds of windows however large the partition. Loose items of many
partitions are packed again by the same rule, about GATHER tokens a task. Only what is still open then is joined and cut into full windows; what remains of
a task after that, less than one window, is cut at powers of two, which need no padding.

Nulls and empty texts give one piece of the end token alone. A very long text is tokenized whole, in memory, by one task. Repeated rows are packed as often as they
occur; equal levels go to the fullest window. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, stored, table, work_dir

WINDOW, END, GATHER = 2048, 1, 20_000_000
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Words(dict):
    """Words with what `encode` makes of them, made when one is first looked up and kept while what is kept takes `most` bytes by estimate."""

    #: Of an entry: two objects and their places in the dictionary.
    ENTRY = 200

    def __init__(self, encode: Callable[[str], bytes], most: int):
        super().__init__()
        self.encode, self.most, self.held = encode, most, 0

    def __missing__(self, word: str) -> bytes:
        if self.held > self.most:
            self.clear()
            self.held = 0
        self[word] = ids = self.encode(word)
        self.held += self.ENTRY + 2 * len(word) + len(ids)
        return ids


class WordTokenizer:
    """Ids, as little-endian 32-bit bytes, as by Tokenizer.from_file(path).encode(text, add_special_tokens=False).

    The vocabulary splits texts into words before it merges bytes, so a word's ids never depend on its
    neighbours; each distinct word is encoded once and kept, while what is kept takes `most` bytes by estimate. Texts with
    characters above U+012F, or with a special token's opening, are encoded whole.
    """

    OTHER = re.compile("[^\x00-į]|<\\|")
    LETTER, NUMBER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-į", "0-9\xb2\xb3\xb9\xbc-\xbe"
    #: The splitter's white space, which isn't Python's: that takes U+001C to U+001F, too.
    SPACE = "\t-\r \x85\xa0"
    WORD = re.compile(f"[{LETTER}]+|'(?:[stmd]|re|ve|ll)|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+")

    def __init__(self, path: str, most: int = 96_000_000):
        from tokenizers import Tokenizer

        self.whole, self.known = Tokenizer.from_file(path), Words(self.encode, most)
        self.pieces = self.whole.model.tokenize  # `model` is made anew whenever it is asked for
        # Byte-level vocabularies write the bytes that are no visible Latin-1 characters as U+0100 and on.
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in seen]
        self.letters = {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(rest)}

    def encode(self, word: str) -> bytes:
        if not (word.isascii() and word.isprintable()):  # control characters have letters of their own, too
            word = "".join(map(self.letters.__getitem__, word.encode()))
        ids = [t.id for t in self.pieces(word)]
        return pack_ids(f"<{len(ids)}I", *ids)

    def ids(self, text: str) -> bytes:
        if not (text.isascii() and "<|" not in text) and self.OTHER.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.known.__getitem__, self.WORD.findall(text.lower())))


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker, whose tasks share the words that it keeps."""
    return WordTokenizer(path)


class SumOfSquares:
    """Open windows by fill level; `put` gives the windows that an item closes."""

    def __init__(self, window: int = WINDOW):
        self.window, self.counts, self.open = window, np.zeros(window + 1, np.int64), [[] for _ in range(window)]

    def put(self, item: tuple, size: int) -> list | None:
        """Places an item of less than a window; a window that it fills is returned and closed."""
        n, w = self.counts, self.window
        # From level h to h + size: the sum of squares grows by 2 (N[h + size] - N[h]) + 2, or falls by 2 N[h] - 1 if the
        # window becomes full; a new window grows it by 2 N[size] + 1.
        top = w - size
        grows = 2 * (n[size + 1 : w + 1] - n[1 : top + 1]) + 2
        grows[-1] = 1 - 2 * n[top] if n[top] else grows[-1]
        grows[n[1 : top + 1] == 0] = np.iinfo(np.int64).max
        best = len(grows) - 1 - int(np.argmin(grows[::-1])) if top else -1  # of equals, the fullest
        if best >= 0 and grows[best] <= 2 * n[size] + 1:
            level = best + 1
            members = self.open[level].pop()
            n[level] -= 1
        else:
            level, members = 0, []
        members.append(item)
        if level + size == w:
            return members
        n[level + size] += 1
        self.open[level + size].append(members)
        return None

    def rest(self) -> Iterator[list]:
        for level in range(self.window - 1, 0, -1):
            yield from self.open[level]


Piece = tuple[int, int, np.ndarray, int]


def closed(items: Iterator[Piece], state: SumOfSquares) -> Iterator[list[Piece]]:
    """The full windows, as they close, of items (document, start, ids, tokens of the document)."""
    window = state.window
    for doc, start, ids, n in items:
        full = len(ids) // window * window
        for at in range(0, full, window):
            yield [(doc, start + at, ids[at : at + window], n)]
        if full < len(ids) and (done := state.put((doc, start + full, ids[full:], n), len(ids) - full)):
            yield done


def cut(pieces: list[Piece], window: int) -> Iterator[list[Piece]]:
    """Sequences of a window or a power of two tokens out of what is left."""
    left = sum(len(p[2]) for p in pieces)
    while left:
        need = want = window if left >= window else 1 << (left.bit_length() - 1)
        out = []
        while need:
            doc, at, ids, n = pieces.pop()
            if len(ids) > need:
                pieces.append((doc, at + need, ids[need:], n))
                ids = ids[:need]
            out.append((doc, at, ids, n))
            need -= len(ids)
        left -= want
        yield out


def packed(docs: Iterator[tuple[int, np.ndarray]], window: int = WINDOW) -> Iterator[list[Piece]]:
    """Sequences of pieces, each of a window or a power of two tokens, of documents that one task packs alone."""
    state = SumOfSquares(window)
    yield from closed(((doc, 0, ids, len(ids)) for doc, ids in docs), state)
    yield from cut([p for members in state.rest() for p in members], window)


_FIELDS = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
_KINDS = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3


def _batches(sequences: Iterator[list[Piece]], first: int) -> Iterator[pa.RecordBatch]:
    """The sequences' pieces as rows, numbered from `first`."""
    rows: list[tuple] = []
    size = 0
    for k, sequence in enumerate(sequences):
        offset = 0
        for doc, start, ids, n in sequence:
            rows.append((doc, start, len(ids), ids.tobytes(), n, first + k, offset))
            offset += len(ids)
        size += offset
        if size > 500_000:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _KINDS, strict=True)], _FIELDS)


#: Sequence ids below are those of closed windows by input partition; loose pieces have LOOSE; ids from AGAIN are those of the second pass.
LOOSE, AGAIN = -1, 1 << 62


def pack(docs: DataFrame, tokenizer: str | Callable[[], str], window: int = WINDOW, end: int = END, gather: int = GATHER) -> DataFrame:
    """One row per piece: document, tokens before it, length, its ids (little-endian 32-bit), the document's tokens with the
    end token, and its sequence and offset there. tokenizer: the vocabulary file's path on the executors, or what gives it."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer() if callable(tokenizer) else tokenizer)
        last = np.array([end], "<u4").tobytes()
        state = SumOfSquares(window)

        def tokens() -> Iterator[Piece]:
            for batch in batches:
                for doc, text in zip(*batch.columns, strict=True):
                    ids = np.frombuffer(words.ids(text.as_py() or "") + last, "<u4")
                    yield doc.as_py(), 0, ids, len(ids)

        yield from _batches(closed(tokens(), state), TaskContext.get().partitionId() << 36)
        for loose in _batches(state.rest(), 0):
            at = loose.schema.get_field_index("sequence_id")
            yield loose.set_column(at, "sequence_id", pa.array(np.full(len(loose), LOOSE)))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Packs what a shuffle brings in the order of documents, so that a task that is run again gives the same."""
        state = SumOfSquares(window)

        def pieces() -> Iterator[Piece]:
            for batch in batches:
                for doc, start, ids, n in zip(*(batch.column(k) for k in (0, 1, 3, 4)), strict=True):
                    yield doc.as_py(), start.as_py(), np.frombuffer(ids.as_buffer(), "<u4"), n.as_py()

        def sequences() -> Iterator[list[Piece]]:
            yield from closed(pieces(), state)
            yield from cut([p for members in state.rest() for p in members], window)

        yield from _batches(sequences(), AGAIN + (TaskContext.get().partitionId() << 36))

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    first = stored(rows.mapInArrow(run, SCHEMA), work_dir(docs.sparkSession), "packed", compression="zstd")
    loose = first.where(F.col("sequence_id") == LOOSE)
    tasks = 1 + int((loose.agg(F.sum("length")).first()[0] or 0) // gather)
    return first.where(F.col("sequence_id") != LOOSE).unionByName(loose.repartition(tasks, F.xxhash64("doc_id", "start")).sortWithinPartitions("doc_id", "start", "ids").mapInArrow(again, SCHEMA))


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(pack(table(spark, sf_dir, "documents"), vocabulary))
