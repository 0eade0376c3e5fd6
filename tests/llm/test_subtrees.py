"""Operator 12 against brute force: any blocks, buckets and hot anchors; the order of a subtree's leaves."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from busmill.llm import repeats, subtrees
from test_llm import frame, odd, prose


def plainly(docs, window=subtrees.WINDOW):
    """docs: (id, text) in the order that counts."""
    seen, out = set(), []
    for _, text in docs:
        words = re.findall("[^ \t\n\x0b\x0c\r]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if w in seen:
                gone[i : i + window] = [True] * window
            seen.add(w)
        edges = np.flatnonzero(np.diff([0, *gone, 0]))
        out.append((len(words), edges[::2].tolist(), edges[1::2].tolist(), " ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return out


def found(spark, docs, **how):
    rows = subtrees.repeated_runs(docs, **how).collect()
    return sorted(((r.doc_id, r.n_words, list(r.starts), list(r.ends), bytes(r.kept).decode()) for r in rows), key=repr)


def corpus(rng):
    """Passages that share heads, tails and middles, in documents whose ids are no order of theirs."""
    passage = prose(rng, 90).split()
    texts = [*odd(rng), "la " * 50, "la " * 30, "la la " * 40 + "end", "a b " * 40, " \t" + " ".join(passage[:20]) + "\n", " ".join(passage[:19]), " ".join(passage[1:21])]
    for _ in range(60):
        a, n = rng.randrange(70), rng.randrange(15, 50)
        texts.append(rng.choice([" ", "\n"]).join([*prose(rng, rng.randrange(4)).split(), *passage[a : a + n], *prose(rng, rng.randrange(4)).split()]))
    texts += ["  ".join(x.upper() if k % 9 == 0 else x for k, x in enumerate(passage)), " ".join(passage), " ".join(passage + passage)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("how", [{}, {"bucket": 20_000}, {"hot": 1}, {"hot": 3, "bucket": 20_000}, {"window": 9, "gram": 3}, {"window": 20, "gram": 20}])
@pytest.mark.parametrize("block", [1 << 19, 2000])
def test_repeated_runs(spark, monkeypatch, how, block):
    monkeypatch.setattr(repeats, "BLOCK", block)
    docs = corpus(random.Random(12))
    expected = [(k, *x) for (k, _), x in zip(sorted(docs), plainly(sorted(docs), how.get("window", 20)), strict=True)]
    rows = frame(spark, [t for _, t in docs], [k for k, _ in docs]).repartition(3)
    assert found(spark, rows, **how) == sorted(expected, key=repr)


def test_null_ids_and_rows_of_one_id(spark):
    """Nulls come first; rows of one id come one after another."""
    text = prose(random.Random(1), 40)
    rows = subtrees.repeated_runs(frame(spark, [text] * 6, [5, 5, None, 3, None, 5]).coalesce(1)).collect()
    assert sorted((r.doc_id is not None, bool(r.kept)) for r in rows) == [(False, False), (False, True), (True, False), (True, False), (True, False), (True, False)]
    assert found(spark, frame(spark, ["a"]).limit(0)) == []
    assert found(spark, frame(spark, [None, "", " \n"])) == [(k, 0, [], [], "") for k in range(3)]


def test_leaves_of_a_subtree():
    """Segments of few distinct words: ties at the depth of a window are those of sorted suffixes, and the earliest leaf stays."""
    rng = np.random.default_rng(3)
    n = rng.integers(1, 8, 300)
    words = [rng.integers(0, 2, k + 4).astype(np.uint32) for k in n]
    heads = np.zeros(300, subtrees.HEAD)
    heads["n"], heads["doc"], heads["start"] = n, rng.permutation(300) // 3, rng.integers(0, 50, 300) * 10
    blocks = rng.integers(0, 4, 300)
    heads["row"] = np.arange(300)
    bits = subtrees.subtree(heads, blocks, np.concatenate(words), np.zeros(int(n.sum()), np.uint32), 5)
    at = defaultdict(list)
    for k in range(300):
        for d in range(n[k]):
            at[tuple(words[k][d : d + 5])].append((heads["doc"][k], blocks[k], heads["row"][k], heads["start"][k], d, k))
    expected = np.zeros(300, np.uint64)
    for leaves in at.values():
        for *_, d, k in sorted(leaves)[1:]:
            expected[k] |= np.uint64(1 << d)
    assert len(at) == 32 and (bits == expected).all()
    # Another check tells suffixes apart whose words are alike.
    assert not subtrees.subtree(heads, blocks, np.concatenate(words), np.arange(int(n.sum()), dtype=np.uint32), 5).any()


def test_equal_suffixes_share_their_prefix():
    """An anchor depends on the window's words alone, so equal suffixes meet; a segment holds the suffixes of one anchor."""
    rng = random.Random(4)
    passage = prose(rng, 60)
    data = (prose(rng, 30) + " " + passage + " " + prose(rng, 7) + " " + passage).encode()
    block = subtrees.Block(np.frombuffer(data, np.uint8), np.array([0, len(data)]), [1])
    of, at = block.suffixes(np.arange(len(block.at)))
    anchor = dict(zip(at.tolist(), block.anchor[of].tolist(), strict=True))
    assert len(anchor) == 30 + 60 + 7 + 60 - 19 and all(anchor[30 + k] == anchor[97 + k] for k in range(41))
    assert int(block.n.max()) <= 13 and len(block.at) < len(anchor) / 3
