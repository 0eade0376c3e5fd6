"""Operator 11: cuts in frames of any size against plain string work, round trips, odd inputs."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from busmill.llm import infill
from test_llm import frame, odd


def plainly(doc, text, rate=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    form, out = ("spm", f"<S>{suf}<P>{pre}<M>{mid}") if h4 % 100 < spm else ("psm", f"<P>{pre}<S>{suf}<M>{mid}")
    return n, form, len(pre), len(mid), out


def texts():
    rng = random.Random(11)
    lines = ["".join(rng.choice("aß漢<PSM> ") for _ in range(rng.randrange(40))).replace("<P>", "").replace("<S>", "").replace("<M>", "") for _ in range(400)]
    marked = ["a<P>b", "x\n<S>", "<M>", "<P", "<", ">\n<", "S>\n<S"]
    return [*odd(rng), "\n", "a\nb", "a\n\nb\n", *marked, "\n".join(lines), "\n".join(lines) + "\n", *("\n".join(rng.sample(lines, 9)) for _ in range(40)), "z" * 300_000 + "\n" + "y" * 200_000]


@pytest.mark.parametrize("size, rate", [(infill.FRAME, 100), (7, 100), (1, 50)])
def test_outputs(spark, size, rate):
    given_ = texts() if size > 1 else [t for t in texts() if len(t or "") < 9000]
    store = infill.frame_store(frame(spark, given_), size=size)
    made = infill.transformed(store, rate)
    expected = {k: plainly(k, t, rate) for k, t in enumerate(given_)}
    assert {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.text) for r in infill.texts(made).collect()} == expected
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert {r.doc_id: (r.output_sha256, r.restored_sha256) for r in infill.digested(made).collect()} == {k: (digest(expected[k][4]), digest(t)) for k, t in enumerate(given_)}
    assert {x[1] for x in expected.values()} == {"plain", "psm", "spm"}


def test_only_cut_frames_are_read(monkeypatch):
    """A selection decompresses the frames of its two cuts and no other, and keeps the others as they are."""
    text = b"".join(b"line %d\n" % k for k in range(10_000))
    f = infill.Frames.of(text, 1000)
    read, plain = [], infill.zstandard.ZstdDecompressor

    class Counted:
        def decompress(self, data):
            read.append(data)
            return plain().decompress(data)

    monkeypatch.setattr(infill.zstandard, "ZstdDecompressor", Counted)
    write = infill.zstandard.ZstdCompressor()
    cuts = [f.seek(u, 10_000) for u in (0, 2500, 7500, 10_000)]
    parts = [f.between(a, b, write) for a, b in zip(cuts, cuts[1:], strict=False)]
    assert set(read) <= {f.frames[cuts[1][0]], f.frames[cuts[2][0]]} and len(f.frames) > 90
    assert sum(x in set(f.frames) for p in parts for x in p) >= len(f.frames) - 2
    assert [b"".join(plain().decompress(x) for x in p) for p in parts] == [b"".join(b"line %d\n" % k for k in range(*r)) for r in ((0, 2500), (2500, 7500), (7500, 10_000))]


@settings(max_examples=300, deadline=None)
@given(st.tuples(*[st.text("<PSM>\na", max_size=9)] * 3), st.sampled_from(sorted(infill.FORMS)), st.integers(1, 5))
def test_rebuilt_from_any_chunks(parts, form, size):
    """Whatever the chunks, an output without markers in its text gives the text back."""
    text = "".join(parts)
    if any(m.decode() in text for m in infill.MARKERS):
        return
    named = dict(zip((infill.PREFIX, infill.MIDDLE, infill.SUFFIX), parts, strict=True))
    out = b"".join(m + named[m].encode() for m in infill.FORMS[form][0])
    frames = infill.Frames.of(out, size).frames
    assert b"".join(infill.rebuilt(frames, form)).decode() == text


def test_no_documents(spark):
    assert infill.digested(infill.transformed(infill.frame_store(frame(spark, ["a"]).limit(0)))).count() == 0
    rows = infill.digested(infill.transformed(infill.frame_store(frame(spark, ["a\nb", None, "a\nb"], [None, None, None])))).collect()
    assert sorted(r.n for r in rows) == [0, 2, 2] and len({(r.form, r.output_sha256) for r in rows if r.n}) == 1
