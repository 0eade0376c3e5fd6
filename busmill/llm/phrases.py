"""Collocations by dynamic itemset counting: phrases of several lengths are counted at once, in cyclic scans of shards.

Texts are kept once in blocks of word numbers (`blocks`), dealt to SHARDS shards. Step t scans shard t modulo SHARDS. Words are active from step 0; a longer
phrase becomes active once both its subphrases, without its last and without its first word, have reached the threshold in what was counted so
far. An active phrase is counted in SHARDS steps on end, one full cycle, whatever step it began with; then its count is that of all texts. Scans
end when a cycle has brought no phrase that could activate another.

A task knows which phrases have reached the threshold, and after which step, by `Reached`: one byte for each of CELLS cells, two of which a phrase is
looked up in. The cells are of bounded size however large the corpus, and err one way: a phrase may count as reached that isn't, or
earlier, and then others are counted that needn't be; with more phrases than cells scans prune less and give the same. Counts are
kept by 64-bit hashes of phrases, salted by language, each step's as a table; what is reached is told by the tables of the last cycle.

With its count each hash keeps one of the blocks that it is in. `named` reads the texts of the phrases that reached the threshold from these blocks alone, with the
hashes of their parts, and `scored` joins the parts' counts to them. Two phrases of one language whose hashes meet would be counted as one.

Null texts have no words; a null language is `und`. A very long text is a block of its own. Repeated rows count as often as they occur. Ties are settled by
count and phrase. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U64, dropped, lean, lowered, mixed, prefix_hashes, slices, span_hashes, spans, stored, table, work_dir

LEAST, WORDS, FIRST = 100, 5, 2000
SHARDS, BLOCK, CELLS = 3, 1 << 23, 1 << 26
#: A phrase's hash is that of its words but the last, times this, and the last one's, mixed.
RATIO = 0x9E3779B97F4A7C15
ENDS = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
BLANKS = ENDS | np.isin(np.arange(256), [0x20, 0x09])

SCHEMA = "block long, tokens binary, width int, hashes binary, words array<string>, langs array<string>, lang_of binary, lang_n array<long>, shard int"
NAMES = [f.split()[0] for f in SCHEMA.split(", ")]
KINDS = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string()), pa.binary(), pa.list_(pa.int64()), pa.int32()]


def salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def block_of(data: np.ndarray, off: np.ndarray, langs: list[str]) -> tuple:
    """tokens (numbers of distinct words from 1; 0 between pieces), their width, hashes and words by number, languages, each word's and their sizes."""
    data = lowered(data)
    start, end = spans(~BLANKS[data], off)
    doc = np.searchsorted(off, start, side="right") - 1
    names = sorted(set(langs))
    of = np.array([names.index(x) for x in langs], np.uint16)[doc] if len(doc) else np.zeros(0, np.uint16)
    full = mixed(span_hashes(prefix_hashes(data), start, end) + np.array([salt(x) for x in names], np.uint64)[of])
    hashes, first, number = np.unique(full, return_index=True, return_inverse=True)
    piece = np.cumsum(np.append(0, ENDS[data]))[start]
    new = np.append(False, (doc[1:] != doc[:-1]) | (piece[1:] != piece[:-1]))[: len(start)]
    kind = np.uint16 if len(hashes) < 0xFFFF else np.uint32
    tokens = np.zeros(len(start) + int(new.sum()), kind)
    tokens[np.arange(len(start)) + np.cumsum(new)] = number + 1
    words = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(start[first], end[first], strict=True)]
    return tokens.tobytes(), kind().itemsize, hashes.tobytes(), words, names, of[first].tobytes(), np.bincount(of, minlength=len(names)).tolist()


def blocks(docs: DataFrame, shards: int = SHARDS, size: int = BLOCK) -> DataFrame:
    """docs (doc_id, text, lang) as blocks of whole documents, each of one shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(1), size):
                # A partition has less than 2**20 blocks, and there are less than 2**27 partitions.
                row = ((part << 20) + k, *block_of(data, off, batch.column(0).slice(lo, hi - lo).to_pylist()), (part + k) % shards)
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, KINDS, strict=True)], NAMES)
                k += 1

    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string")).mapInArrow(lean(run), SCHEMA)


class Reached:
    """When phrases reached the threshold: for a hash the first step whose scan may use it, or 0."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells

    def __call__(self, full: np.ndarray) -> np.ndarray:
        mask = U64(len(self.cells) - 1)
        a, b = self.cells[full & mask], self.cells[(full >> U64(32)) & mask]
        return np.where((a > 0) & (b > 0), np.maximum(a, b), 0)


def phrases_of(tokens: np.ndarray, hashes: np.ndarray, reached: Reached, most: int = WORDS) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: places, hashes and first active steps of the phrases whose subphrases have reached the threshold, and when they did themselves."""
    word = np.append(U64(0), hashes)
    since = np.append(0, reached(hashes)).astype(np.uint8)
    at = np.flatnonzero(tokens)
    full, began = word[tokens[at]], np.zeros(len(at), np.uint8)
    when = np.zeros(len(tokens) + 1, np.uint8)
    when[at] = since[tokens[at]]
    for k in range(1, most + 1):
        if k > 1:
            # Both subphrases lie within the tokens of one piece, so the phrase does.
            ok = np.flatnonzero((when[at] > 0) & (when[at + 1] > 0))
            at, full = at[ok], full[ok]
            began = np.maximum(when[at], when[at + 1])
            full = mixed(full * U64(RATIO) + word[tokens[at + k - 1]])
            when[:] = 0
            when[at] = reached(full)
        yield k, at, full, began, when[at]


def distinct(k: int, tokens: np.ndarray, at: np.ndarray, full: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The position among `at` of one of each distinct phrase, and how many there are of it."""
    if k == 1:  # words have numbers already
        one = np.zeros(int(tokens.max(initial=0)) + 1, np.int64)
        one[tokens[at]] = np.arange(len(at))
        n = np.bincount(tokens[at], minlength=len(one))
        return one[n > 0], n[n > 0]
    return np.unique(full, return_index=True, return_counts=True)[1:]


def row_of(row: tuple) -> tuple[np.ndarray, np.ndarray]:
    tokens, width, hashes = row[:3]
    return np.frombuffer(tokens.as_buffer(), np.uint16 if width.as_py() == 2 else np.uint32), np.frombuffer(hashes.as_buffer(), np.uint64)


#: So many hashes are broadcast at most, 8 bytes each; more are joined by a shuffle.
STRONG = 1 << 22
#: A place is a block below some bits of a hash, so the least place of a phrase is any of its blocks.
PLACE = 48


def scan(rows: DataFrame, step: int, cells, shards: int, most: int = WORDS) -> DataFrame:
    """h, k, n, place: the active phrases of one shard's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = Reached(cells.value)
        for batch in batches:
            for number, *row in zip(*batch.columns, strict=True):
                (tokens, hashes), number = row_of(row), U64(number.as_py())
                for k, at, full, began, _ in phrases_of(tokens, hashes, reached, most):
                    ok = (began <= step) & (step < began.astype(np.int64) + shards)
                    at, full = at[ok], full[ok]
                    one, n = distinct(k, tokens, at, full)
                    if len(one):
                        full = full[one]
                        place = (mixed(full + number) >> U64(PLACE + 1)) << U64(PLACE) | number
                        yield pa.RecordBatch.from_arrays([pa.array(full.view(np.int64)), pa.array(np.full(len(one), k, np.int8)), pa.array(n.astype(np.int64)), pa.array(place.view(np.int64))], ["h", "k", "n", "place"])

    votes = rows.select("block", "tokens", "width", "hashes").mapInArrow(lean(run), "h long, k byte, n long, place long")
    return votes.groupBy("h").agg(F.sum("n").alias("n"), F.max("k").alias("k"), F.min("place").alias("place"))


def cells_of(ready: DataFrame, cells: int, most: int) -> DataFrame:
    """word, bits, opens: the cells of ready phrases as bits of 64-bit words, at most cells / 64 rows, and whether a phrase among them can activate another."""
    low = F.col("h").bitwiseAND(cells - 1)
    cell = F.explode(F.array(low, F.shiftrightunsigned("h", 32).bitwiseAND(cells - 1))).alias("cell")
    return ready.select("k", cell).groupBy(F.expr("cell div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(cell % 64 AS int))")).alias("bits"), F.bool_or(F.col("k") < most).alias("opens"))


def counted(spark: SparkSession, where: str, rows: DataFrame, n: int, least: int = LEAST, most: int = WORDS, shards: int = SHARDS, cells: int = CELLS) -> tuple[DataFrame, np.ndarray]:
    """Scans until every phrase that became active has completed its cycle: h, k, a, block of the phrases that reached `least`, and their cells. n: words in all."""
    # At most n / least phrases of each length can reach it, and each takes two cells; eight times as many, up to the bound.
    size = max(64, min(cells, 1 << math.ceil(math.log2(16 * most * n / least + 1))))
    reached, votes, seen, newest, step = np.zeros(size, np.uint8), [], [], -1, 0
    while step < shards or newest >= step - shards:
        shared = spark.sparkContext.broadcast(reached)
        votes.append(stored(scan(rows.where(F.col("shard") == step % shards), step, shared, shards, most), where, f"votes-{step}", compression="zstd"))
        shared.unpersist()
        # A phrase is counted within one cycle, so the tables of the last cycle tell what it has so far; `old` is what it had before this step.
        cycle = votes[-1].withColumn("old", F.lit(0).cast("long"))
        for v in votes[-shards:-1]:
            cycle = cycle.unionByName(v.withColumn("old", F.col("n")))
        # Of those that reached the threshold in it, one table at least has a share of the count; the others needn't be shuffled.
        strong = stored(cycle.where(F.col("n") >= math.ceil(least / shards)).select("h").distinct(), where, f"strong-{step}")
        few = strong.count() <= STRONG
        totals = cycle.join(F.broadcast(strong) if few else strong, "h", "left_semi").groupBy("h").agg(F.sum("n").alias("n"), F.sum("old").alias("old"), F.max("k").alias("k"), F.min("place").alias("place"))
        seen.append(stored(totals.where(F.col("n") >= least), where, f"seen-{step}", compression="zstd"))
        ready = seen[-1].where(F.col("old") < least)
        found = cells_of(ready, size, most).toArrow()
        own = reached.reshape(-1, 64)[found["word"].to_numpy()]
        bits = np.unpackbits(found["bits"].to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
        own[bits & (own == 0)] = step + 1
        reached.reshape(-1, 64)[found["word"].to_numpy()] = own
        # Phrases of full length activate no other.
        if found["opens"].to_numpy().any():
            newest = step
        dropped(spark, f"{where}/strong-{step}")
        if len(votes) >= shards:
            dropped(spark, f"{where}/votes-{step - shards + 1}")
        step += 1
    for k in range(max(0, step - shards + 1), step):
        dropped(spark, f"{where}/votes-{k}")
    # One cycle holds all steps in which a phrase was counted; every other holds fewer.
    everything = seen[0]
    for v in seen[1:]:
        everything = everything.unionByName(v)
    whole = everything.groupBy("h").agg(F.max("n").alias("a"), F.max("k").alias("k"), F.min("place").alias("place"))
    found = stored(whole.select("h", "k", "a", F.col("place").bitwiseAND((1 << PLACE) - 1).alias("block")), where, "found", compression="zstd")
    for k in range(step):
        dropped(spark, f"{where}/seen-{k}")
    return found, reached


def parts_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of phrases, a row of word hashes each: the hashes of their first 1, 2, ... words and of what follows these, up to the last cut."""
    k = words.shape[1]
    left, right = np.empty((len(words), k - 1), np.uint64), np.empty((len(words), k - 1), np.uint64)
    for out, starts in ((left, np.zeros(k - 1, int)), (right, np.arange(1, k))):
        for cut, start in enumerate(starts):
            full = words[:, start]
            for j in range(start + 1, k if start else cut + 1):
                full = mixed(full * U64(RATIO) + words[:, j])
            out[:, cut] = full
    return left, right


NAMED = "h long, lang string, phrase string, k int, left array<long>, right array<long>"


def named(rows: DataFrame, found: DataFrame, reached: np.ndarray, most: int = WORDS) -> DataFrame:
    """The found phrases of two words and more, each read from one block: language, text, and the hashes of both parts of each cut."""
    shared = rows.sparkSession.sparkContext.broadcast(reached)
    long = found.where("k > 1")
    wanted = long.groupBy("block").agg(F.collect_list("h").alias("wanted"))
    # Blocks are large and stay where they are, as long as there aren't too many phrases for that.
    wanted = F.broadcast(wanted) if long.count() <= STRONG else wanted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = Reached(shared.value)
        for batch in batches:
            for *row, words, langs, of, wanted in zip(*batch.columns, strict=True):
                (tokens, hashes), wanted = row_of(row), wanted.values.to_numpy().view(np.uint64)
                words, langs, of = words.as_py(), langs.as_py(), np.frombuffer(of.as_buffer(), np.uint16)
                for k, at, full, _, _ in phrases_of(tokens, hashes, cells, most):
                    if k == 1:
                        continue
                    full, first = np.unique(full, return_index=True)
                    mine = np.isin(full, wanted)
                    full, ids = full[mine], tokens[at[first[mine]][:, None] + np.arange(k)].astype(np.int64) - 1
                    if not len(full):
                        continue
                    texts = [" ".join([words[x] for x in row]) for row in ids.tolist()]
                    ends = pa.array(np.arange(len(full) + 1, dtype=np.int32) * (k - 1))
                    parts = [pa.ListArray.from_arrays(ends, pa.array(p.ravel().view(np.int64))) for p in parts_of(hashes[ids])]
                    yield pa.RecordBatch.from_arrays([pa.array(full.view(np.int64)), pa.array([langs[x] for x in of[ids[:, 0]]]), pa.array(texts), pa.array(np.full(len(full), k, np.int32)), *parts], [f.split()[0] for f in NAMED.split(", ")])

    columns = ["tokens", "width", "hashes", "words", "langs", "lang_of"]
    return rows.join(wanted, "block").select(*columns, "wanted").mapInArrow(lean(run), NAMED)


def frequent(docs: DataFrame, least: int = LEAST, most: int = WORDS, shards: int = SHARDS, size: int = BLOCK, cells: int = CELLS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(h, k, a) of every phrase of at most `most` words that occurs `least` times in a language, with their texts as of `named`, and (lang, n) of the words in all."""
    spark, where = docs.sparkSession, work_dir(docs.sparkSession)
    made = blocks(docs, shards, size)
    made.write.partitionBy("shard").option("compression", "zstd").parquet(f"{where}/blocks")
    rows = spark.read.schema(made.schema).parquet(f"{where}/blocks")
    sizes = stored(rows.select(F.explode(F.arrays_zip("langs", "lang_n")).alias("x")).groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.lang_n").alias("n")), where, "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    found, reached = counted(spark, where, rows, total, least, most, shards, cells)
    texts = stored(named(rows, found, reached, most), where, "texts", compression="zstd")
    dropped(spark, f"{where}/blocks")
    return found.select("h", "k", "a"), texts, sizes


def scored(found: DataFrame, texts: DataFrame, sizes: DataFrame, share: int = 100) -> DataFrame:
    """As of `collocations`, out of the counts and texts of `frequent`."""
    counts = found.select("h", "a")
    long = texts.join(counts, "h")
    # A longer phrase is in no more places than the phrases between, so those with one word more tell: without its last word, and without its first.
    parts = F.array(F.element_at("left", -1), F.element_at("right", 1))
    held = long.where("k > 2").select(F.explode(parts).alias("h"), "a").groupBy("h").agg(F.max("a").alias("held"))
    kept = long.join(held, "h", "left").where(f"held IS NULL OR 100 * held < {share} * a").select("lang", "phrase", "a", F.posexplode(F.arrays_zip("left", "right")).alias("cut", "x"))
    part = lambda name, count: counts.select(F.col("h").alias(name), F.col("a").alias(count))
    cuts = kept.select("lang", "phrase", "a", "cut", "x.left", "x.right").join(part("left", "l"), "left").join(part("right", "r"), "right").join(sizes, "lang")
    # Products of counts pass 64 bits; decimals of 38 digits hold them.
    score = F.expr("(cast(1000 * a AS decimal(19, 0)) * cast(n AS decimal(19, 0))) div (cast(l AS decimal(19, 0)) * cast(r AS decimal(19, 0)))")
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("x"))
    return best.select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")


def collocations(docs: DataFrame, least: int = LEAST, most: int = WORDS, share: int = 100, **how: int) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the phrases of two words and more that no longer one holds in `share` of a hundred places.

    l and r are those of the cut with the lowest score, the first of equals."""
    return scored(*frequent(docs, least, most, **how), share)


def ranked(scored: DataFrame, first: int = FIRST) -> DataFrame:
    """Each language's first phrases; Spark keeps that many in every task before it brings them together."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first).select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(collocations(table(spark, sf_dir, "documents")))


ORACLE = r"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM d),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, range(1, 6) AS t(k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
s AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
p AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
sub AS (SELECT lang, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))))) AS phrase, a AS held FROM p WHERE k > 2),
kept AS (SELECT p.* FROM p LEFT JOIN (SELECT lang, phrase, max(held) AS held FROM sub GROUP BY ALL) h USING (lang, phrase) WHERE held IS NULL OR 100 * held < 100 * a),
c AS (SELECT kept.*, unnest(range(1, k)) AS cut FROM kept),
x AS (SELECT c.lang, c.phrase, c.a, c.cut, l.a AS l, r.a AS r, s.n, (1000::HUGEINT * c.a * s.n) // (l.a::HUGEINT * r.a) AS score FROM c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ') JOIN s ON s.lang = c.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM x),
o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM b WHERE o = 1)
SELECT * FROM o WHERE rank <= 2000"""
