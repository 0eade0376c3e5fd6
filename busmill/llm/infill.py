"""Fill-in-the-middle transformation over texts that are kept as seekable compressed frames.

1. `frame_store`: each text is cut into runs of FRAME bytes, each of which is a zstandard frame of its own. Beside the frames stand the
   cumulative counts of lines that end, and of code points that begin, in them and those before. The store is a table: a row for each document.
2. `transformed`: the cuts are numbers of units (lines). The counts tell which frame a cut falls into; only these frames are decompressed and
   split, and the output is the frames in their new order with frames of markers between them. No whole text is made.
3. `digested`: the frames of an output are decompressed one after another for its digest, and for that of the text that is rebuilt from the output
   and its form alone: the output is searched for the markers as it passes, its segments are kept as frames, and are read in the order of the text.
   `texts` gives outputs as strings.

Nulls and empty texts have no frames and stay plain, and so do texts that hold a marker. A very long text is a row of many frames; a frame is all that
is ever decompressed. A null id draws as the empty one would; repeated rows draw alike, and each gives its row. Bytes that aren't UTF-8 pass as they
are. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, slices, stored, table, work_dir

FRAME, LEVEL = 1 << 16, 3
PREFIX, SUFFIX, MIDDLE = MARKERS = (b"<P>", b"<S>", b"<M>")
PLAIN = "plain"
#: Each form's markers in the order of the output, and which of the segments behind them are prefix, middle and suffix.
FORMS = {"psm": ((PREFIX, SUFFIX, MIDDLE), (0, 2, 1)), "spm": ((SUFFIX, PREFIX, MIDDLE), (1, 2, 0))}
STORE = "doc_id long, n long, marked boolean, frames array<binary>, lines array<long>, chars array<long>"
NAMES = [f.split()[0] for f in STORE.split(", ")]
KINDS = [pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64())]


def rows_of(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def chars(data: bytes) -> int:
    """Code points that begin in UTF-8 bytes."""
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


class Frames:
    """Frames of a text with the cumulative counts at their ends."""

    def __init__(self, frames: list[bytes], lines: list[int], chars: list[int]):
        self.frames, self.lines, self.chars = frames, lines, chars

    @classmethod
    def of(cls, text: bytes, size: int = FRAME, write: zstandard.ZstdCompressor | None = None) -> Frames:
        write = write or zstandard.ZstdCompressor(level=LEVEL)
        parts = [text[at : at + size] for at in range(0, len(text), size)]
        ends = np.cumsum([p.count(b"\n") for p in parts]).tolist(), np.cumsum([chars(p) for p in parts]).tolist()
        return cls([write.compress(p) for p in parts], *ends)

    def seek(self, unit: int, n: int) -> tuple[int, bytes, int]:
        """Where so many units (of n) end: the frame that is cut, the part of it before the cut, and the code points before the cut.

        A cut at a frame's edge has no part."""
        if not unit or not self.frames:
            return 0, b"", 0
        if unit == n:
            return len(self.frames), b"", self.chars[-1]
        k = int(np.searchsorted(self.lines, unit))
        data = zstandard.ZstdDecompressor().decompress(self.frames[k])
        at = -1
        for _ in range(unit - (self.lines[k - 1] if k else 0)):
            at = data.index(b"\n", at + 1)
        head = data[: at + 1]
        return k, head, (self.chars[k - 1] if k else 0) + chars(head)

    def between(self, start: tuple[int, bytes, int], end: tuple[int, bytes, int], write: zstandard.ZstdCompressor) -> list[bytes]:
        """The frames of the text from one cut to another; whole frames are taken as they are."""
        (a, head, _), (b, tail, _) = start, end
        read = zstandard.ZstdDecompressor().decompress
        if a == b:
            return [write.compress(tail[len(head) :])] if len(tail) > len(head) else []
        out = [write.compress(rest)] if head and (rest := read(self.frames[a])[len(head) :]) else []
        out += self.frames[a + bool(head) : b]
        return [*out, write.compress(tail)] if tail else out


def frame_store(docs: DataFrame, where: str | None = None, size: int = FRAME) -> DataFrame:
    """docs (doc_id, text) as a table of frames below `where`, or a new work folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(1), 1 << 22):
                rows = []
                for doc, a, b in zip(batch.column(0).slice(lo, hi - lo).to_pylist(), off[:-1], off[1:], strict=True):
                    text = data[a:b].tobytes()
                    f = Frames.of(text, size, write)
                    n = (f.lines[-1] if f.lines else 0) + (text != b"" and not text.endswith(b"\n"))
                    rows.append((doc, int(n), any(m in text for m in MARKERS), f.frames, f.lines, f.chars))
                yield rows_of(rows, NAMES, KINDS)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(lean(run), STORE)
    # Frames are compressed; a codec would only look at them once more.
    return stored(rows, where or work_dir(docs.sparkSession), "frames", compression="none")


def draws(seed: int) -> list[Column]:
    """Four numbers below 2**32 for each document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output array<binary>"


def transformed(store: DataFrame, rate: int = 100, spm: int = 50, seed: int = 7) -> DataFrame:
    """A row for each document of a frame store: units, form, sizes of prefix and middle, and the output as frames.

    Of a hundred documents `rate` are transformed, and of these `spm` have the suffix first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = zstandard.ZstdCompressor(level=LEVEL)
        marks = {m: write.compress(m) for m in MARKERS}
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary())]
        names = [f.split()[0] for f in OUTPUT.split(", ")]
        for batch in batches:
            rows, held = [], 0
            for doc, n, marked, frames, lines, ends, *h in zip(*batch.columns, strict=True):
                doc, n, (h1, h2, h3, h4) = doc.as_py(), n.as_py(), (x.as_py() for x in h)
                f = Frames(frames.as_py(), lines.as_py(), ends.as_py())
                held += sum(map(len, f.frames))
                if not f.frames or marked.as_py() or h3 % 100 >= rate:
                    rows.append((doc, n, PLAIN, None, None, f.frames))
                else:
                    cuts = [f.seek(u, n) for u in (0, *sorted((h1 % (n + 1), h2 % (n + 1))), n)]
                    prefix, middle, suffix = (f.between(a, b, write) for a, b in zip(cuts, cuts[1:], strict=False))
                    form = "spm" if h4 % 100 < spm else "psm"
                    of = {PREFIX: prefix, SUFFIX: suffix, MIDDLE: middle}
                    out = [x for m in FORMS[form][0] for x in (marks[m], *of[m])]
                    rows.append((doc, n, form, cuts[1][2], cuts[2][2] - cuts[1][2], out))
                if held > 1 << 22:
                    yield rows_of(rows, names, kinds)
                    rows, held = [], 0
            if rows:
                yield rows_of(rows, names, kinds)

    return store.select(*NAMES, *draws(seed)).mapInArrow(lean(run), OUTPUT)


def stream(frames: Iterable[bytes]) -> Iterator[bytes]:
    read = zstandard.ZstdDecompressor().decompress
    return map(read, frames)


def segments(chunks: Iterable[bytes], marks: tuple[bytes, ...]) -> Iterator[tuple[int, bytes]]:
    """(segment, bytes) of an output as it passes: segment k follows the k-th marker. Markers may lie across chunks."""
    k, held = 0, b""
    for chunk in chunks:
        held += chunk
        while k < len(marks) and (at := held.find(marks[k])) >= 0:
            if at:
                yield k - 1, held[:at]
            held, k = held[at + len(marks[k]) :], k + 1
        keep = len(held) if k == len(marks) else max(0, len(held) - len(marks[k]) + 1)
        if keep:
            yield k - 1, held[:keep]
        held = held[keep:]
    if held:
        yield k - 1, held


def rebuilt(frames: list[bytes], form: str) -> Iterator[bytes]:
    """The text of an output, from its frames and form alone; segments that come too early wait as frames."""
    if form == PLAIN:
        yield from stream(frames)
        return
    marks, order = FORMS[form]
    write, parts = zstandard.ZstdCompressor(level=LEVEL), [[] for _ in marks]
    for k, data in segments(stream(frames), marks):
        parts[k].append(write.compress(data))
    for k in order:
        yield from stream(parts[k])


def digest(chunks: Iterable[bytes]) -> str:
    out = sha256()
    for chunk in chunks:
        out.update(chunk)
    return out.hexdigest()


def digested(outputs: DataFrame) -> DataFrame:
    """outputs with output_sha256 and restored_sha256 in the place of the frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(digest(stream(f := frames.as_py())), digest(rebuilt(f, form.as_py()))) for frames, form in zip(batch["output"], batch["form"], strict=True)]
            told = [pa.array([x[k] for x in found], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *told], [*batch.schema.names[:-1], "output_sha256", "restored_sha256"])

    return outputs.mapInArrow(lean(run), OUTPUT.replace("output array<binary>", "output_sha256 string, restored_sha256 string"))


def texts(outputs: DataFrame) -> DataFrame:
    """outputs with the whole text of each in the place of its frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1)
                text = pa.array([b"".join(stream(row["output"][0].as_py()))], pa.binary())
                yield pa.RecordBatch.from_arrays([*row.columns[:-1], text], [*row.schema.names[:-1], "text"])

    return outputs.mapInArrow(lean(run), OUTPUT.replace("output array<binary>", "text binary")).withColumn("text", F.col("text").cast("string"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(transformed(frame_store(table(spark, sf_dir, "documents"))))


ORACLE = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS g FROM documents),
h AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, CAST('0x' || g[1:8] AS BIGINT) AS h1, CAST('0x' || g[9:16] AS BIGINT) AS h2, CAST('0x' || g[17:24] AS BIGINT) AS h3, CAST('0x' || g[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid, coalesce(array_to_string(u[b + 1:n], ''), '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""
