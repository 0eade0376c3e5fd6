"""Line dedup by a segment-partition edit join, with DataFrame functions alone.

A line is dropped if an earlier line, by document and then by place, is equal to it, however short it is, or, where both have `least` characters
and more, at most `tau` edits (insert, delete or replace a character) away. Lines of white space alone part paragraphs and stay. What is earlier is judged on the
input, so a line that is dropped itself still counts.

Each line is cut into tau + 1 segments; of two lines within tau edits, one segment of the shorter stands whole in the longer, and
at few places: of the i-th segment, i edits at most can be before it and the others after it. So the longer line probes, for each
shorter length that is near enough, only those substrings. Segments and probes meet by the hash of the substring, its length
class and its number. Parity sketches of neighbouring characters, which tau edits can change in few bits, rule most meetings
out as they are joined, so a large group of lines with one segment in common doesn't become all its pairs; the others are
verified by a banded bit-parallel edit distance: of its table only the 2 tau + 1 diagonals next to the main one are kept, as the bits of one
word for each number of edits up to tau, and a character of the line moves them all at once. It stops when no word has a bit left.

Equal lines are one line before they are compared, in each task first, so a line that is everywhere is no large group. Lines are known by 64-bit hashes of text
and length. A very long text is one row; its lines are spread. Ties don't occur, since each line has one place. Null texts are kept as they are; empty texts have one empty line.
Rows that are equal in id and text are treated alike, each keeping what the first keeps. Lines are parted by line feeds, and the
line feed of a dropped line goes with it. Extra columns are kept. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, stored, table, work_dir

TAU, LEAST = 2, 24
VISIBLE = r"[^\x20\x09-\x0D]"


def _probes(line: Column, size: Column, tau: int) -> tuple[list[Column], list[Column]]:
    """(segments of the line itself, which probe lines of its own length too; other probes), as hashes."""
    own, others = [], []
    parts = tau + 1
    for short in range(parts):  # the indexed line is so much shorter
        length = size - short
        base, more = F.floor(length / parts), length % parts
        for i in range(parts):
            late = F.greatest(F.lit(0), F.lit(i - parts) + more)
            start, width = base * i + late, base + F.when(more >= parts - i, 1).otherwise(0)
            for move in range(-i, i + 1):
                if abs(move - short) <= tau - i:
                    # The columns are ints: substring() counts from 1, and a start outside the line gives a text that no segment equals.
                    piece = F.substring(line, (start + 1 + move).cast("int"), width.cast("int"))
                    (own if short == 0 and move == 0 else others).append(F.xxhash64(piece, length, F.lit(i)))
    return own, others


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, at, line, size, h for the lines that aren't white space alone."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text", F.length("text")).alias("text_key"), F.posexplode(F.split(F.col("text"), "\n", -1)).alias("at", "line"))
    return rows.withColumn("size", F.length("line")).where(F.col("line").rlike(VISIBLE)).withColumn("h", F.xxhash64("line", "size"))


def _sketch(line: Column) -> Column:
    """64 bits, each the parity of the pairs of neighbouring characters that hash to it."""
    chars = F.split(line, "")
    pairs = F.zip_with(F.slice(chars, F.lit(1), F.size(chars) - 1), F.slice(chars, F.lit(2), F.size(chars) - 1), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(64)).cast("int"))
    return F.aggregate(pairs, F.lit(0).cast("long"), lambda bits, i: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))


def _points(line: Column) -> Column:
    """The line's code points."""
    return F.transform(F.split(line, ""), F.ascii)


def within(s: Column, t: Column, tau: int) -> Column:
    """Whether s and t, arrays of code points, are at most tau edits apart.

    After j characters of t, bit r of word e tells whether they are at most e edits from the first j + r - tau characters of s. An equal
    character keeps a bit; a replaced one takes it to the next word, one more in t takes it there a bit lower, and one more in s a bit higher."""
    if not 0 <= tau <= 31:
        raise ValueError("tau must be from 0 to 31, so that the diagonals fit a word")
    width = 2 * tau + 1
    shift = lambda way, bits, n: F.call_function(f"shift{way}", bits, n if isinstance(n, Column) else F.lit(n))
    start = [((1 << (e + 1)) - 1) << tau for e in range(tau + 1)]

    def equal(j: Column) -> Column:
        bits = [F.when(F.get(s, j + (r - tau)) == F.get(t, j), F.lit(1 << r).cast("long")).otherwise(F.lit(0).cast("long")) for r in range(width)]
        return reduce(Column.bitwiseOR, bits)

    def moved(words: Column, same: Column) -> Column:
        out: list[Column] = []
        for e in range(tau + 1):
            now = F.get(words, F.lit(e)).bitwiseAND(same)
            if e:
                fewer = F.get(words, F.lit(e - 1))
                now = now.bitwiseOR(fewer).bitwiseOR(shift("right", fewer, 1)).bitwiseOR(shift("left", out[-1], 1))
            out.append(now.bitwiseAND(F.lit((1 << width) - 1).cast("long")))
        return F.array(*out)

    def step(words: Column, j: Column) -> Column:
        # The inner array of one holds what is equal, lest it be worked out again for each word.
        return F.when(F.get(words, F.lit(tau)) == 0, words).otherwise(F.aggregate(F.array(equal(j)), words, moved))

    places = F.when(F.size(t) > 0, F.sequence(F.lit(0), F.size(t) - 1)).otherwise(F.array().cast("array<int>"))
    words = F.aggregate(places, F.array(*[F.lit(x).cast("long") for x in start]), step)
    apart = F.size(s) - F.size(t)
    return F.when(F.abs(apart) <= tau, shift("right", F.get(words, F.lit(tau)), apart + tau).bitwiseAND(F.lit(1).cast("long")) == 1).otherwise(False)


def repeated_lines(docs: DataFrame, tau: int = TAU, least: int = LEAST) -> DataFrame:
    """doc_id, text_key, dropped (places): the lines of docs (doc_id, text) that an earlier line makes needless."""
    spark, where = docs.sparkSession, work_dir(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    own, others = _probes(F.col("line"), F.col("size"), tau)
    long = F.col("size") >= max(least, tau + 1)
    lines = stored(_lines(docs).select("doc_id", "text_key", "at", "h", long.alias("long"), F.array(*own).alias("own"), F.array(*others).alias("others")), where, "lines")
    order = F.struct("doc_id", "text_key", "at")
    first = stored(lines.groupBy("h").agg(F.min(order).alias("first")), where, "first")
    tagged = F.expr("concat(transform(own, k -> struct(k AS key, true AS segment)), transform(others, k -> struct(k AS key, false AS segment)))")
    keys = lines.where("long").select("h", F.explode(tagged).alias("x")).select("x.key", "h", "x.segment").repartition(partitions(spark), "key")
    shared = keys.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high"), F.bool_or("segment").alias("any")).where("low < high AND any").select("key")
    met = stored(keys.join(shared, "key").distinct(), where, "met")
    # Sort-merge at every size: neither side has a bound.
    wanted = met.select("h").distinct().hint("merge")
    texts = stored(_lines(docs).where(long).select("h", "line").dropDuplicates(["h"]).join(wanted, "h", "left_semi").select("h", _points(F.col("line")).alias("points"), _sketch(F.col("line")).alias("sketch")), where, "texts")
    drawn = met.join(texts.select("h", "sketch"), "h")
    left, right = drawn.where("segment").select("key", F.col("h").alias("a"), F.col("sketch").alias("x")), drawn.select("key", F.col("h").alias("b"), F.col("sketch").alias("y"))
    # An edit changes four pairs of neighbouring characters at most.
    near = (F.col("a") != F.col("b")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= 4 * tau)
    pairs = stored(left.join(right, "key").where(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), where, "pairs")
    linked = (
        pairs.join(texts.select(F.col("h").alias("a"), F.col("points").alias("s")), "a")
        .join(texts.select(F.col("h").alias("b"), F.col("points").alias("t")), "b")
        .where(within(F.col("s"), F.col("t"), tau))
        .select("a", "b")
    )
    dated = linked.join(first.select(F.col("h").alias("a"), F.col("first").alias("x")), "a").join(first.select(F.col("h").alias("b"), F.col("first").alias("y")), "b")
    covered = dated.select(F.when(F.col("x") < F.col("y"), F.col("b")).otherwise(F.col("a")).alias("h")).distinct().withColumn("covered", F.lit(True))
    kept = first.join(covered, "h", "left").where("covered IS NULL").select("first")
    # A line stays where it is the first of its kind and no earlier line is near.
    keep = kept.select(F.col("first.doc_id").alias("d"), F.col("first.text_key").alias("k"), F.col("first.at").alias("p"))
    here = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")) & (F.col("at") == F.col("p"))
    gone = lines.select("doc_id", "text_key", "at").distinct().join(keep, here, "left_anti")
    return stored(gone.groupBy("doc_id", "text_key").agg(F.collect_set("at").alias("dropped")), where, "dropped")


def dedup_lines(docs: DataFrame, tau: int = TAU, least: int = LEAST) -> DataFrame:
    """docs (doc_id, text, others) with the text that is left, and n_lines and n_dropped."""
    gone = repeated_lines(docs, tau, least).select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"), "dropped")
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(*names).join(gone.hint("merge"), F.col("doc_id").cast("long").eqNullSafe(F.col("gone_id")) & (F.xxhash64("text", F.length("text")) == F.col("gone_key")), "left")
    # As a column of its own, lest it be split anew for each line.
    parts = F.col("_parts")
    rows = rows.withColumn("_parts", F.split(F.col("text").cast("string"), "\n", -1))
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("dropped"))
    left = F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n")
    text = F.when(F.col("dropped").isNull(), F.col("text").cast("string")).otherwise(left)
    counts = [F.coalesce(F.size(parts), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped")]
    return rows.select(*[text.alias("text") if c == "text" else F.col(c) for c in names], *counts)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = rf"""
WITH l AS MATERIALIZED (SELECT doc_id, i - 1 AS place, s[i] AS line, length(s[i]) AS size FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL))),
f AS MATERIALIZED (SELECT line, size, min((doc_id, place)) AS first FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
p AS (SELECT a.line AS a, b.line AS b, a.first AS x, b.first AS y FROM f a JOIN f b ON a.size >= {LEAST} AND b.size BETWEEN a.size AND a.size + {TAU} AND a.line <> b.line
  AND (starts_with(b.line, left(a.line, a.size // 3)) OR right(b.line, a.size // 3) = right(a.line, a.size // 3) OR contains(b.line, substr(a.line, 1 + a.size // 3, a.size - 2 * (a.size // 3))))),
c AS (SELECT DISTINCT CASE WHEN x < y THEN b ELSE a END AS line FROM p WHERE levenshtein(a, b) <= {TAU}),
k AS (SELECT first FROM f WHERE line NOT IN (SELECT line FROM c)),
g AS (SELECT l.doc_id, l.place, l.line, NOT regexp_matches(l.line, '[^\x20\x09-\x0D]') OR k.first IS NOT NULL AS kept FROM l LEFT JOIN k ON k.first = (l.doc_id, l.place)),
t AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT kept) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (kept), '') AS text FROM g GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(t.text) AS kept_sha256 FROM documents d LEFT JOIN t USING (doc_id)
"""
