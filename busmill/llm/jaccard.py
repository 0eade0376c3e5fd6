"""Near duplicates by word shingles: a parity-sketch join.

A text's set holds its distinct shingles of five words. For each band of set sizes a set is folded into a sketch of
cells; a cell is the XOR of the hashes of the shingles in it. A shingle that only one of two sets has changes one cell at
most, so the Hamming distance of two sketches, in cells, is at most the symmetric difference of the sets. Sets that link
differ in at most d = size / 3 shingles, and more than d cells of either hold something; so among the first d + 1 of the cells
that hold something, in any one order, two linked sets share one (pigeonhole). The order puts cells that many texts hold last.

Candidates are sets that share such a cell. Bit sketches, where each shingle flips a bit, rule most of them out by their Hamming
distance; the others are verified by their whole sets. To avoid all pairs of a group, a group's sets are first held
against two central ones, which have the most frequent cells: in a group of copies those that were changed least, so they link with most. Only
where sets of a group then still lie in different components are they held against each other, and a pair that meets in many groups
is given out in one of them: each set has the smallest of its groups in each of CLASSES classes, and a pair counts in the smallest of
these that both have. A map task settles its own equal cells itself and sends on one for each, so a cell that many texts hold is no large group.

Sets are known by 64-bit hashes, shingles too. A very long text is one set, read whole; it has a third of its shingles as signatures. Null and empty texts have an empty set, link with nothing and are components
of their own. Repeated rows are linked as equal texts. A null id never is a component's id, unless all ids in it are null. Extra columns are not read.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import U64, dropped, lowered, mixed, partitions, prefix_hashes, slices, span_hashes, spans, stored, table, work_dir
from .graph import components

WORDS, PERCENT = 5, 75
MOST_HOT = 200_000
CLASSES, SALTS = 8, 16
_STEP = U64(0x9E3779B97F4A7C15)


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and each document's first word."""
    start, end = spans(~((data == 32) | ((data >= 9) & (data <= 13))), off)
    return span_hashes(prefix_hashes(lowered(data)), start, end), np.searchsorted(start, off)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k words, across documents too."""
    h = words[: max(0, len(words) - k + 1)]
    for j in range(1, k):
        h = mixed(h * _STEP + words[j : len(h) + j])
    return h


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """For each row its sorted distinct shingle hashes."""
    for lo, hi, data, off in slices(column):
        words, first = word_hashes(data, off)
        grams = {k: gram_hashes(words, k) for k in range(1, WORDS + 1)}
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= WORDS:
                yield np.unique(grams[WORDS][a : b - WORDS + 1])
            else:
                yield grams[b - a][a : a + 1] + U64(b - a) if b > a else words[:0]


def set_hash(s: np.ndarray) -> int:
    return int(mixed(np.array([np.add.reduce(mixed(s ^ U64(len(s))))], np.uint64)).view(np.int64)[0])


def bands(n: int) -> list[int]:
    """The band of a size, powers of four, and the next if a linked set can be there."""
    b = (n.bit_length() - 1) // 2
    return [b, b + 1] if 100 * n >= PERCENT * 4 ** (b + 1) else [b]


def cells(s: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each band the signatures of the cells that hold something."""
    for b in bands(len(s)):
        shift = U64(64 - (40 if b < 2 else max(10, 2 * b + 2)))
        cell = s >> shift
        start = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        yield b, mixed(np.bitwise_xor.reduceat(mixed(s + _STEP), start) ^ mixed(cell[start] + U64((b + 1) * int(_STEP) % 2**64)))


def probes(s: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The signatures that a set is found by."""
    return signatures(s, hot)[0]


def signatures(s: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, int]:
    """The signatures that a set is found by, and how many of its cells are hot: how central it is among its like."""
    out, score = [], 0
    need = len(s) * (100 - PERCENT) // PERCENT + 1
    for _, sig in cells(s):
        late = hot[np.minimum(np.searchsorted(hot, sig), len(hot) - 1)] == sig if len(hot) else np.zeros(len(sig), bool)
        score += int(late.sum())
        if len(sig) > need:
            cool = sig[~late]
            sig = np.partition(cool, need - 1)[:need] if len(cool) > need else np.append(cool, np.sort(sig[late])[: need - len(cool)])
        out.append(sig)
    return np.concatenate(out), score


def parity(s: np.ndarray, b: int) -> np.ndarray:
    """The bit sketch of a set in band b, as 64-bit words: each shingle flips one of 4 ** (b + 1) bits, 64 at least."""
    size = max(6, 2 * b + 2)
    count = np.bincount((s >> U64(64 - size)).astype(np.int64), minlength=1 << size) & 1
    return np.packbits(count.astype(np.uint8), bitorder="little").view(np.int64)


_NONE = np.zeros(0, np.int64)


def frequent_cells(docs: DataFrame) -> np.ndarray:
    """Signatures that many texts hold, at most MOST_HOT; any such set gives the same links, a good one gives small groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4000):
                part = batch.column(0).slice(lo, 4000)
                own = {set_hash(s): s for s in shingle_sets(part) if len(s)}  # equal texts count once
                sigs = [sig for s in own.values() for _, sig in cells(s)]
                if sigs:
                    value, count = np.unique(np.concatenate(sigs), return_counts=True)
                    often = count >= max(4, len(part) // 1000)
                    yield pa.RecordBatch.from_arrays([pa.array(value[often].view(np.int64)), pa.array(count[often].astype(np.int64))], ["sig", "n"])

    found = docs.select("text").mapInArrow(run, "sig long, n long").groupBy("sig").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "sig").limit(MOST_HOT)
    return np.sort(np.array([r.sig for r in found.collect()], np.int64).view(np.uint64))


def signed(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """doc_id, n_shingles, node (hash of the set, null if empty), score (how central), alone, led: the signatures that it sends on, those that no other
    node of the task has and the others; held, pivots: those that a more central node of the task, the pivot, sends on; band, bits and next_bits, the bit sketches in the own band and, if need be, the next."""
    hot_cells = docs.sparkSession.sparkContext.broadcast(hot)  # at most MOST_HOT numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4000):
                part = batch.slice(lo, 4000)
                size, node, sigs, score, band, sketch = [], [], [], [], [], ([], [])
                for s in shingle_sets(part.column(1)):
                    size.append(len(s))
                    in_bands = bands(len(s)) if len(s) else []
                    band.append(in_bands[0] if in_bands else None)
                    for k in (0, 1):
                        sketch[k].append(parity(s, in_bands[k]) if k < len(in_bands) else _NONE)
                    node.append(set_hash(s) if len(s) else None)
                    own, of_hot = signatures(s, hot_cells.value) if len(s) else (s, 0)
                    sigs.append(own)
                    score.append(of_hot)
                flat = np.concatenate(sigs).view(np.int64)
                doc = np.repeat(np.arange(len(sigs)), [len(x) for x in sigs])
                owner = np.array([x or 0 for x in node], np.int64)[doc]
                order = np.lexsort((owner, -np.array(score, np.int64)[doc], flat))
                f, o, d = flat[order], owner[order], doc[order]
                head = np.append(True, f[1:] != f[:-1])[: len(f)]
                lead = o[np.maximum.accumulate(np.where(head, np.arange(len(f)), 0))] if len(f) else o
                tied = lead != o
                shared = np.isin(f, f[tied])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size, pa.int64()), pa.array(node, pa.int64()), pa.array(score, pa.int64()), _lists(d[head & ~shared], f[head & ~shared], len(sigs)), _lists(d[head & shared], f[head & shared], len(sigs)), _lists(d[tied], f[tied], len(sigs)), _lists(d[tied], lead[tied], len(sigs)), pa.array(band, pa.int32()), *map(_joined, sketch)],
                    ["doc_id", "n_shingles", "node", "score", "alone", "led", "held", "pivots", "band", "bits", "next_bits"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_shingles long, node long, score long, alone array<long>, led array<long>, held array<long>, pivots array<long>, band int, bits array<long>, next_bits array<long>")


def _lists(row: np.ndarray, value: np.ndarray, n: int) -> pa.Array:
    order = np.argsort(row, kind="stable")
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=n))).astype(np.int32)), pa.array(value[order]))


def _joined(values: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(v) for v in values])).astype(np.int32)), pa.array(np.concatenate([_NONE, *values])))


def sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, shingles; nodes: node, rep, the id of a document with that set. Repeated rows give repeated sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                kept = [(node, s.view(np.int64)) for node, s in zip(part.column(0).to_pylist(), shingle_sets(part.column(1)), strict=True) if len(s) and node == set_hash(s)]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in kept], pa.int64()), _joined([x[1] for x in kept])], ["node", "shingles"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(nodes, F.col("doc_id").eqNullSafe(F.col("rep")))
    return wanted.select("node", "text").mapInArrow(run, "node long, shingles array<long>")


_SKETCH = ["node", "n", "band", "bits", "next_bits"]


def _side(sketches: DataFrame, x: str) -> DataFrame:
    return sketches.select(*[c for c in sketches.columns if c not in _SKETCH], *[F.col(c).alias(f"{c}_{x}" if c != "node" else x) for c in _SKETCH])


def _may_link() -> Column:
    """Whether the sizes and bit sketches of sides a and b let their sets link.

    The symmetric difference of two sets can't be below the Hamming distance of their sketches; with a share p of the union in
    common it is (1 - p) / (1 + p) of the sum of the sizes."""
    bits = [F.when(F.col(f"band_{x}") >= F.col(f"band_{y}"), F.col(f"bits_{x}")).otherwise(F.col(f"next_bits_{x}")) for x, y in ("ab", "ba")]
    apart = F.aggregate(F.zip_with(*bits, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    return F.expr(f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)") & ((100 + PERCENT) * apart <= (100 - PERCENT) * (F.col("n_a") + F.col("n_b")))


def near(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Those of the pairs a, b of nodes that may link, with the sum of their sizes, n."""
    both = pairs.select("a", "b").join(_side(sketches, "a"), "a").join(_side(sketches, "b"), "b")
    return both.where(_may_link()).select("a", "b", (F.col("n_a") + F.col("n_b")).alias("n"))


def linked(pairs: DataFrame, docs: DataFrame, reps: DataFrame, where: str, name: str) -> DataFrame:
    """Those of the near pairs a, b, n whose sets overlap enough."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = stored(sets_of(docs, reps.join(nodes, "node", "left_semi")), where, f"sets-{name}")
    left, right = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("t"))
    common = F.size(F.array_intersect("s", "t"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "n", common.alias("c"))
    out = stored(both.where(100 * F.col("c") >= PERCENT * (F.col("n") - F.col("c"))).select("a", "b").distinct(), where, f"links-{name}")
    dropped(docs.sparkSession, f"{where}/sets-{name}")
    return out


def grouped(whole: DataFrame) -> DataFrame:
    """node, x, y, sig: for each node of a group of nodes with equal signatures the pivots that it is held against. The pivots are the most central of the group's
    nodes with an even and with an odd hash. sig: the group's, where it isn't settled by that; null elsewhere.

    All pairs with a pivot are settled, so a group of three is; but a node that leads others of its task stands for them too."""
    sent = [whole.select("node", "score", F.lit(led).alias("led"), F.explode("led" if led else "alone").alias("sig")) for led in (False, True)]
    sigs = sent[0].unionByName(sent[1]).repartition(partitions(whole.sparkSession), "sig")
    shared = sigs.groupBy("sig").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("sig")
    by = Window.partitionBy("sig")
    best = [F.max_by("node", F.when(F.col("node") % 2 == 0 if even else F.col("node") % 2 != 0, F.col("score"))).over(by) for even in (True, False)]
    met = sigs.join(shared, "sig").groupBy("sig", "node").agg(F.max("score").alias("score"), F.max("led").alias("led"))
    rows = met.select("sig", "node", best[0].alias("x"), best[1].alias("y"), F.max("led").over(by).alias("some_led"))
    rows = rows.withColumn("pivot", F.col("node").eqNullSafe(F.col("x")) | F.col("node").eqNullSafe(F.col("y"))).withColumn("rest", F.sum(F.when(F.col("pivot"), 0).otherwise(1)).over(by))
    # The pair of the pivots is given out once.
    x = F.when(~F.col("pivot"), F.col("x"))
    y = F.when(~F.col("node").eqNullSafe(F.col("y")), F.col("y"))
    sig = F.when(F.col("some_led") | ((F.col("rest") > 1) & ~F.col("pivot")), F.col("sig"))
    return rows.select("node", x.alias("x"), y.alias("y"), sig.alias("sig")).where("coalesce(x, y, sig) IS NOT NULL")


def crossing(open_rows: DataFrame) -> DataFrame:
    """a, b, n: pairs of a group of one signature that lie in different components and may link. open_rows: sig, root and a sketch's columns.

    The sketches are held against each other in the join itself, and a pair is given out once, but for few: so a group of texts
    that share a passage isn't written out as its pairs."""
    classes = [F.min(F.when(F.pmod("sig", F.lit(CLASSES)) == j, F.col("sig"))).alias(f"least{j}") for j in range(CLASSES)]
    rows = open_rows.join(open_rows.groupBy("node").agg(*classes), "node").withColumn("least", F.array(*[f"least{j}" for j in range(CLASSES)]))
    rows = rows.select("sig", "root", "least", *_SKETCH).repartition(partitions(open_rows.sparkSession), "sig")
    left, right = _side(rows, "a").withColumnRenamed("least", "here"), _side(rows, "b").withColumnRenamed("root", "other")
    shared = F.array_min(F.zip_with("here", "least", lambda x, y: F.when(x == y, x)))
    once = shared.isNull() | (shared == F.col("sig"))
    met = left.join(right, "sig").where((F.col("a") < F.col("b")) & (F.col("root") != F.col("other")) & _may_link() & once)
    return met.select("a", "b", (F.col("n_a") + F.col("n_b")).alias("n")).distinct()


def named(reps: DataFrame, roots: DataFrame) -> DataFrame:
    """node, component_id: the smallest id in the node's component; reps: node, rep. A component of many nodes is spread by salt."""
    placed = reps.join(roots, "node", "left")
    least = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("rep").alias("least")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = placed.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(least, ["root", "salt"], "left")
    return found.select("node", F.coalesce("least", "rep").alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs (doc_id, text)."""
    spark, where = docs.sparkSession, work_dir(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    whole = stored(signed(docs, frequent_cells(docs)), where, "signed")
    groups = stored(grouped(whole), where, "groups")
    rows = stored(whole.drop("alone", "led"), where, "rows")
    dropped(spark, f"{where}/signed")
    known = rows.where("node IS NOT NULL")
    reps = stored(known.groupBy("node").agg(F.min("doc_id").alias("rep")), where, "reps")
    sketches = stored(known.select("node", F.col("n_shingles").alias("n"), "band", "bits", "next_bits").dropDuplicates(["node"]), where, "sketches")
    held = rows.select("node", F.explode(F.arrays_zip("held", "pivots")).alias("x"))
    met = (
        held.select(F.col("node").alias("a"), F.col("x.pivots").alias("b"))
        .unionByName(groups.select(F.col("node").alias("a"), F.explode(F.array("x", "y")).alias("b")))
        .where("b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    pairs = stored(near(met, sketches), where, "near")
    links = linked(pairs, docs, reps, where, "pivots")
    roots = stored(components(links, where, "first"), where, "roots-1")
    # Groups that still lie over different components; nodes that a task held back are settled with the one that led them, and a group of two.
    left = groups.where("sig IS NOT NULL").select("sig", "node", F.lit(0).alias("held"))
    back = held.select(F.col("x.held").alias("sig"), F.explode(F.array("node", "x.pivots")).alias("node"), F.lit(1).alias("held"))
    tied = left.unionByName(back).groupBy("sig", "node").agg(F.max("held").alias("held"))
    placed = tied.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = F.min("root") < F.max("root")
    mixed_groups = placed.groupBy("sig").agg((several & ((F.max("held") == 0) | (F.count("*") > 2))).alias("open")).where("open").select("sig")
    open_rows = stored(placed.join(mixed_groups, "sig").join(sketches, "node").select("sig", "root", *_SKETCH), where, "open")
    more = stored(crossing(open_rows).join(pairs, ["a", "b"], "left_anti"), where, "near-2")
    dropped(spark, f"{where}/open")
    if not more.isEmpty():
        links = links.unionByName(linked(more, docs, reps, where, "others"))
        roots = stored(components(links, where, "second"), where, "roots-2")
    names = stored(named(reps, roots), where, "names")
    for name in ("groups", "sketches", "near", "near-2", "links-pivots", "links-others", "roots-1", "roots-2", "reps"):
        dropped(spark, f"{where}/{name}")
    return rows.join(names, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(len(w) - 4), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] || ' ' || w[i + 5]) END) AS g FROM d)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS b FROM r GROUP BY a) m USING (doc_id)
"""
