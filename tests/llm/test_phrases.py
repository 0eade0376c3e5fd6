"""Operator 13 against plain counting, with any number of shards, blocks and cells."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from busmill.llm import phrases
from test_llm import odd

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plainly(docs, least, first=2000, share=100):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, 6):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        long = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        held = Counter()
        for p, a in long.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    held[p[i : i + k]] = max(held[p[i : i + k]], a)
        rows = []
        for p, a in long.items():
            if 100 * held[p] >= share * a:
                continue
            score, _, l, r = min((1000 * a * n[lang] // (counts[p[:c]] * counts[p[c:]]), c, counts[p[:c]], counts[p[c:]]) for c in range(1, len(p)))
            rows.append((" ".join(p), a, l, r, n[lang], score))
        rows.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, k + 1, *x) for k, x in enumerate(rows[:first])]
    return sorted(out)


def found(spark, docs, least, first=2000, share=100, **how):
    rows = spark.createDataFrame([(k, t, g, "x", 7) for k, (g, t) in enumerate(docs)], "doc_id long, text string, lang string, phrase string, score int").repartition(3)
    return sorted(tuple(r) for r in phrases.ranked(phrases.collocations(rows, least, share=share, **how), first).collect())


def corpus(rng):
    words = [f"W{k}" if k % 7 else f"é{k}" for k in range(30)]
    passages = [[rng.choice(words) for _ in range(rng.randrange(3, 9))] for _ in range(12)]
    text = lambda: "".join(rng.choice([" ", " ", "  ", "\t", ", ", ".\n"]) + w for _ in range(rng.randrange(1, 30)) for w in (rng.choice(passages) if rng.random() < 0.5 else [rng.choice(words)]))
    docs = [(rng.choice(["en", "de", None, "und"]), text()) for _ in range(120)]
    return [*docs, *(("en", t) for t in odd(rng)), ("fr", "la la la la la la la la"), ("fr", None), (None, "a,b;c:d!e?f\rg\x0bh\x0ci"), ("en", docs[0][1])]


def test_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(phrases, "STRONG", 0)
    docs = corpus(random.Random(15))
    assert found(spark, docs, 6, shards=2, size=2000) == plainly(docs, 6)


@pytest.mark.parametrize("how", [{}, {"shards": 1, "size": 500}, {"shards": 5, "size": 500}, {"shards": 2, "size": 3000, "cells": 1 << 13}])
def test_collocations(spark, how):
    """Whatever activates a phrase early or late, every one is counted through one whole cycle."""
    docs = corpus(random.Random(13))
    got = found(spark, docs, 6, **how)
    assert got == plainly(docs, 6) and len(got) > 50


def test_first_of_each_language_and_share(spark):
    docs = corpus(random.Random(14))
    assert found(spark, docs, 5, first=3) == plainly(docs, 5, first=3)
    assert found(spark, docs, 5, share=60) == plainly(docs, 5, share=60)


def test_products_beyond_64_bits(spark):
    """The arithmetic alone, on counts as of a very large corpus."""
    found = spark.createDataFrame([(1, 1, 10**13), (2, 1, 3 * 10**12), (3, 2, 10**12 + 1)], "h long, k int, a long")
    texts = spark.createDataFrame([(3, "en", "a b", 2, [1], [2])], phrases.NAMED)
    row = phrases.scored(found, texts, spark.createDataFrame([("en", 10**14 + 7)], "lang string, n long")).first()
    assert row.score == 1000 * (10**12 + 1) * (10**14 + 7) // (10**13 * 3 * 10**12)


def test_an_active_phrase_takes_its_subphrases():
    """Scans leave out phrases with a subphrase that hasn't reached the threshold, or whose cycle is over."""
    tokens, hashes = np.array([1, 2, 3, 0, 1, 2], np.uint16), np.array([5 << 33 | 1, 6 << 33 | 2, 7 << 33 | 3], np.uint64)
    cells = np.zeros(1 << 13, np.uint8)
    for h, step in ((hashes[0], 2), (hashes[1], 3)):
        cells[[int(h) & 8191, int(h) >> 32 & 8191]] = step
    told = [(k, at.tolist(), began.tolist()) for k, at, _, began, _ in phrases.phrases_of(tokens, hashes, phrases.Reached(cells))]
    assert told[:2] == [(1, [0, 1, 2, 4, 5], [0] * 5), (2, [0, 4], [3, 3])] and all(not at for _, at, _ in told[2:])


def test_parts_have_the_hashes_of_phrases():
    """The parts of a cut are found under the hashes that they were counted by."""
    tokens, hashes = np.array([1, 2, 3, 4], np.uint16), np.array([11, 22, 33, 44], np.uint64)
    full = {(k, int(i)): int(h) for k, at, fulls, _, _ in phrases.phrases_of(tokens, hashes, phrases.Reached(np.ones(64, np.uint8))) for i, h in zip(at, fulls, strict=True)}
    left, right = phrases.parts_of(hashes[None])
    assert left[0].tolist() == [full[k, 0] for k in (1, 2, 3)] and right[0].tolist() == [full[4 - k, k] for k in (1, 2, 3)]


def test_no_documents(spark):
    assert found(spark, [("en", "a")], 100) == [] and found(spark, [(None, None)], 1) == []
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert phrases.ranked(phrases.collocations(none)).count() == 0
    assert phrases.frequent(none)[2].select(F.count("*")).first()[0] == 0
