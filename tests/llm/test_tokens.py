"""Operator 7's word tokenizer against the library, for all characters that it knows itself, and what a task that is run again gives."""

import random

import numpy as np

from busmill.llm import packing

KNOWN = 0x130


def test_every_character_and_random_texts():
    ours = packing.WordTokenizer(packing.vocabulary(), most=2_000_000)
    theirs = lambda s: np.array(ours.whole.encode(s, add_special_tokens=False).ids, "<u4").tobytes()
    for c in map(chr, range(KNOWN)):
        for s in (c, f"a{c}b", f"x {c} 1", c * 3, f"'{c}s", f"A{c}{c}é{c}", f"'{c}", f"1{c}2"):
            assert ours.ids(s) == theirs(s), hex(ord(c))
    rng = random.Random(7)
    for _ in range(100_000):
        s = "".join(chr(rng.randrange(KNOWN)) if rng.random() < 0.4 else rng.choice("abc '12.,\n\tRe") for _ in range(rng.randrange(1, 20)))
        assert ours.ids(s) == theirs(s), repr(s)


def test_words_are_made_once_and_bounded_within_a_text():
    """Each new word is looked up and encoded once; what is kept keeps to its bound in a text of new words alone, too."""
    ours = packing.WordTokenizer(packing.vocabulary(), most=60_000)
    text = " ".join(a + b + c for a in "abcdefghijklmnopqrst" for b in "uvwxyzabcd" for c in ("on", "er", "q", "xyz", "ing"))
    assert ours.ids(text) == np.array(ours.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert len(ours.known) and sum(200 + 2 * len(w) + len(ids) for w, ids in ours.known.items()) <= 60_000 + 1_000
    made = []
    ours = packing.WordTokenizer(packing.vocabulary())
    pieces = ours.pieces
    ours.pieces = lambda word: made.append(word) or pieces(word)
    assert ours.ids("one two one") == ours.ids("ONE two\tone") and made == ["one", "two"]


def test_loose_pieces_in_any_order(spark, tmp_path, monkeypatch):
    """The second pass packs by document, not in the order in which rows come."""
    rng = random.Random(8)
    docs = [(k, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 900)))) for k in range(120)]
    found = []
    for seed in (1, 2):
        rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(5, "doc_id")
        plain = packing.stored
        # The same first pass, its rows written in another order.
        monkeypatch.setattr(packing, "stored", lambda df, where, name, plain=plain, seed=seed, **o: plain(df.orderBy(packing.F.xxhash64("doc_id", "start", packing.F.lit(seed))), where, name, **o))
        found.append(sorted(tuple(r) for r in packing.digests(packing.pack(rows, packing.vocabulary)).where("sequence_id >= 4611686018427387904").collect()))
        monkeypatch.undo()
    assert found[0] and found[0] == found[1]
