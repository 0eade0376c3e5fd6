"""The training-data operators against brute force, round trips and held-out accuracy, and on odd inputs."""

import hashlib
import json
import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_oracles import duck, rows  # noqa: F401

import corpus_pipeline
from busmill.llm import decontaminate, graph, jaccard, language, licenses, lines, packing, pages, quality, queries, repeats, topk
from conftest import DATA

WORDS = "the of and bus line stop morning evening river stone paper window garden market yellow copper silver thunder harbour candle".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def frame(spark, texts, ids=None):
    """Documents with extra columns whose names clash with the operators' own."""
    data = [(i if ids is None else ids[i], t, "x", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "doc_id long, text string, score string, node long")


def odd(rng):
    base = prose(rng, 120)
    return [None, "", " ", "\n\n", "a", base, base, base[:-40] + prose(rng, 6), base + " " + prose(rng, 8), "ß漢字 " * 200, prose(rng, 4), prose(rng, 4000), "x" * 1500, ("ab " * 400).strip(), None]


@pytest.fixture(scope="module")
def texts():
    return odd(random.Random(3))


def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, duck, name):  # noqa: F811
    ours, theirs = queries.QUERIES[name](spark, DATA).toPandas(), duck.sql(queries.ORACLE_SQL[name]).df()
    assert rows(ours) == rows(theirs)


# 1


def test_cover():
    assert len({(a - b) % repeats.PERIOD for a in repeats.COVER for b in repeats.COVER}) == repeats.PERIOD


def brute_repeats(texts):
    data = [(t or "").encode() for t in texts]
    n = repeats.LENGTH
    seen = Counter(b[i : i + n] for b in data for i in range(len(b) - n + 1))
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone[i : i + n] = True
        yield len(b), bytes(np.frombuffer(b, np.uint8)[~gone]), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())


def test_repeats(spark, texts):
    found = {r.doc_id: (r.n_bytes, bytes(r.kept), len(r.starts)) for r in repeats.repeats(frame(spark, texts)).collect()}
    assert found == dict(enumerate(brute_repeats(texts)))


def test_repeats_on_documents(spark):
    rows = docs(spark).orderBy("doc_id").collect()
    found = {r.doc_id: (r.n_bytes, r.kept_sha256, r.n_spans) for r in repeats.op1_repeated_bytes(spark, DATA).collect()}
    expected = brute_repeats([r.text for r in rows])
    assert found == {r.doc_id: (n, hashlib.sha256(kept).hexdigest(), spans) for r, (n, kept, spans) in zip(rows, expected, strict=True)}


def test_suffixes_of_a_bucket():
    """Sorting a bucket finds the same ties as comparing the strings."""
    rng = np.random.default_rng(5)
    core = rng.integers(97, 123, repeats.CORE)
    text = [np.concatenate([rng.integers(97, 99, rng.integers(0, 9)), np.full(rng.integers(0, 60), 61), core, np.full(rng.integers(0, 60), 62), rng.integers(97, 99, rng.integers(0, 9))]).astype(np.uint8) for _ in range(60)]
    text += [text[0], text[0], text[1]]
    at = [bytes(t).index(bytes(core.astype(np.uint8))) for t in text]
    sizes = np.array([(min(a, repeats.EDGE), min(len(t) - a - repeats.CORE, repeats.EDGE)) for a, t in zip(at, text, strict=True)], np.uint8)
    entries = np.concatenate([repeats.entries_of(t, np.array([a]), np.array([7], np.uint64), z[None]) for t, a, z in zip(text, at, sizes, strict=True)])
    found = repeats.sorted_suffixes(entries, np.arange(len(text)) == 5)
    strings = [{d: bytes(t[a - d : a - d + repeats.LENGTH]) for d in range(repeats.PERIOD) if a >= d and len(t) >= a - d + repeats.LENGTH} for t, a in zip(text, at, strict=True)]
    seen = Counter((d, x) for s in strings for d, x in s.items()) + Counter((d, x) for d, x in strings[5].items())
    assert [{d for d in range(64) if int(f) >> d & 1} for f in found] == [{d for d, x in s.items() if seen[d, x] > 1} for s in strings]


def test_buckets_of_a_hot_rank():
    """Different strings over samples of one rank are spread over buckets, equal ones meet."""
    rng = np.random.default_rng(12)
    ruler = np.full(repeats.LENGTH - 1, 61, np.uint8)
    text = [np.concatenate([ruler, rng.integers(97, 123, 270).astype(np.uint8)]) for _ in range(20)]

    def votes(block, texts):
        off = np.append(0, np.cumsum([len(t) for t in texts]))
        data = np.concatenate(texts)
        at, rank = repeats.ranks(data, off)
        piece = repeats.piece_of(block, data, off, at, rank)
        piece = repeats._piece([x[0] for x in piece.select(["block", "at", "local", "rank", "sizes", "text"]).columns])
        hot = np.unique(repeats.dealt(piece[3], 3, 4)[1]), 16
        return [v for t in range(3) for v in repeats.suffix_votes(block, piece, 3, 4, hot, t)[1]]

    many, one = votes(1, text), votes(2, text[7:8])
    size = {bucket: len(value) // 8 for bucket, _, value, _ in many}
    assert max(size) < 0 and len(size) > 1000 and max(size.values()) < sum(size.values()) / 100
    held = {(b, v) for b, _, value, _ in many for v in np.frombuffer(value, np.uint64)}
    assert one and all((b, v) in held for b, _, value, _ in one for v in np.frombuffer(value, np.uint64))


@pytest.mark.parametrize("many", [8, 0])
def test_repeats_of_long_documents(spark, monkeypatch, many):
    """Documents beyond a block and beyond a slice, a ruler before unlike texts, runs of just 399 and 400 bytes; all buckets dealt out again, or none."""
    monkeypatch.setattr(repeats, "MANY", many)
    monkeypatch.setattr(repeats, "BUCKET", 100_000)
    rng = random.Random(9)
    passage = prose(rng, 200)
    long, longer = prose(rng, 100_000), prose(rng, 400_000)
    assert len(long) > repeats.BLOCK and len(longer) > 4 * repeats.BLOCK
    pieces = [prose(rng, 70)[:n].ljust(n, "z") for n in (399, 400, 401)]
    texts = [long + passage, longer[:1_000_000] + passage + longer[1_000_000:], "=" * 450, *("=" * 420 + prose(rng, 60) for _ in range(30)), *("q" + p + "v" for p in pieces), *("w" + p for p in pieces), *("a" + passage[i : i + 600] + str(i) for i in range(0, 400, 37))]
    found = {r.doc_id: (r.n_bytes, bytes(r.kept), len(r.starts)) for r in repeats.repeats(frame(spark, texts)).collect()}
    assert found == dict(enumerate(brute_repeats(texts)))


# 2


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", low) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            a, b = sorted((top(i), top(j)))
            root[b] = a
    return [(len(s), top(i)) for i, s in enumerate(sets)]


def test_near_duplicates(spark, texts):
    rng = random.Random(5)
    more = list(texts)
    for _ in range(4):  # chains of edits, so links are not transitive
        words = prose(rng, 60).split()
        for _ in range(8):
            more.append(" ".join(words))
            words[rng.randrange(60)] = "edit"
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(frame(spark, more)).collect()}
    assert found == dict(enumerate(brute_components(more)))


def test_sketch_bounds():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: len(a) - len(a) // 6], rng.integers(0, 2**64, n // 12, dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        union = len(a) + len(b) - common
        if 100 * common >= 75 * union:
            hot = np.sort(np.array([x for _, s in jaccard.cells(a) for x in s[:2]], np.uint64))
            for h in (hot[:0], hot):
                assert len(np.intersect1d(jaccard.probes(a, h), jaccard.probes(b, h)))
            band = max(jaccard.bands(len(a))[0], jaccard.bands(len(b))[0])
            flips = sum(int(x).bit_count() for x in (jaccard.parity(a, band) ^ jaccard.parity(b, band)).view(np.uint64))
            assert flips <= union - common


def test_components(spark, tmp_path):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long"), str(tmp_path), "g").collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


# 3


def auc(label, score):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_quality(spark):
    d = DATA.replace("0.001", "0.01")
    found = quality.op3_quality(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").toPandas()
    test = found[found.held_out]
    assert auc(test.quality.to_numpy(), test.score.to_numpy()) > 0.97 and (test.predicted == test.quality).mean() > 0.9
    assert [bool(x) for x in found.held_out] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]


def test_field_against_enumeration():
    rng = np.random.default_rng(2)
    u, tie = rng.normal(size=7), rng.normal(size=(2, 2))
    first = np.array([0, 4, 4, 7])
    on, back = quality.passes(u, first, tie)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if a == b:
            continue
        paths = [[(k >> j) & 1 for j in range(b - a)] for k in range(1 << (b - a))]
        w = np.exp([sum(u[a + j] * s for j, s in enumerate(p)) + sum(tie[x, y] for x, y in zip(p, p[1:], strict=False)) for p in paths])
        p = [w[[i for i, q in enumerate(paths) if q[j]]].sum() / w.sum() for j in range(b - a)]
        assert np.allclose(1 / (1 + np.exp(-(on + back)[a:b])), p)


def test_quality_odd(spark, texts):
    for labels in ([(5, 1), (12, 0), (13, 0), (11, 1), (5, 0), (8, None)], []):
        field = quality.trained(frame(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int"))
        out = quality.score(frame(spark, texts), field).collect()
        assert len(out) == len(texts) and all(0 <= r.score <= 1 for r in out)
        assert [r.score for r in out if not (r.text or "").strip("\n")] == [0.0] * 4


# 4


def brute_lines(texts):
    def near(a, b):
        far, width = lines.TAU + 1, lines.TAU
        row = {j: j for j in range(width + 1)}
        for i, x in enumerate(a, 1):
            now = {}
            for j in range(max(0, i - width), min(len(b), i + width) + 1):
                now[j] = min(row.get(j, far) + 1, now.get(j - 1, far) + 1, row.get(j - 1, far) + (x != b[j - 1]) if j else far)
            if min(now.values()) > width:
                return False
            row = now
        return row.get(len(b), far) <= width

    seen, kept = [], []
    for t in texts:
        if t is None:
            kept.append(None)
            continue
        out = []
        for line in t.split("\n"):
            if not line.strip(" \t\n\v\f\r"):
                out.append(line)
                continue
            if not any(line == s or (min(len(line), len(s)) >= lines.LEAST and abs(len(line) - len(s)) <= lines.TAU and near(line, s)) for s in seen):
                out.append(line)
            seen.append(line)
        kept.append("\n".join(out))
    return kept


def test_lines(spark):
    rng = random.Random(4)
    base = [prose(rng, 6) for _ in range(12)] + ["short", "", "0123456789" * 4]
    texts = [None, ""]
    for _ in range(25):
        out = []
        for _ in range(rng.randrange(1, 6)):
            s = list(rng.choice(base))
            for _ in range(rng.randrange(4)):
                if s:
                    k = rng.randrange(len(s))
                    s[k : k + rng.randrange(2)] = rng.choice(["", "q", "é"])
            out.append("".join(s))
        texts.append("\n".join(out))
    texts += ["short\n\n \nshort", "shorts\nshort", "é\né\n\n", "x" * 23 + "\n" + "x" * 22, "x" * 23, "\n".join([prose(rng, 3000), "short", prose(rng, 60_000)])]
    found = {r.doc_id: r.text for r in lines.dedup_lines(frame(spark, texts)).collect()}
    assert found == dict(enumerate(brute_lines(texts)))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


@pytest.mark.parametrize("tau", [0, 1, 2, 4])
def test_band(spark, tau):
    """The bit-parallel band against the whole table of edit distances."""
    rng = random.Random(tau)
    pairs = [("", ""), ("", "a"), ("ab", ""), ("a\U0001f600b" * 9, "a\U0001f601b" + "a\U0001f600b" * 8), ("x" * 3000, "x" * 3001)]
    for _ in range(400):
        a = "".join(rng.choice("abé\U0001f600") for _ in range(rng.randrange(30)))
        b = list(a)
        for _ in range(rng.randrange(7)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = rng.choice(["", "a", "b"])
        pairs.append((a, "".join(b)))
    rows = spark.createDataFrame(pairs, "s string, t string").select("s", "t", lines._points(F.col("s")).alias("x"), lines._points(F.col("t")).alias("y"))
    found = [(r.s, r.t, r.w) for r in rows.select("s", "t", lines.within(F.col("x"), F.col("y"), tau).alias("w")).collect()]
    assert [w for _, _, w in found] == [abs(len(s) - len(t)) <= tau and (len(s) > 999 or edits(s, t) <= tau) for s, t, _ in found]
    assert {w for _, _, w in found} == {True, False}


def test_lines_native(spark):
    plan = lines.op4_line_dedup(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    plan += licenses.op5_license_scan(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# 5


def test_licenses(spark):
    texts = [None, "", "MIT License. the mit  license", "GNU General Public License", "general public", "Licensed under CC BY-NC 4.0.", "permission is hereby granted free of charge to every person obtaining a copy of this software and associated documentation files", "mité license", "MIT License. the mit  license"]
    out = {(r.doc_id, i): r for i, r in enumerate(licenses.scan(frame(spark, texts))[1].orderBy("doc_id").collect())}
    got = [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in out.values()]
    assert got == [(0, 0, None, None, "", ""), (0, 0, None, None, "", ""), (5, 2, 0, 3, "mit", "mit"), (4, 1, 1, 1, "gpl", "gpl"), (2, 0, None, None, "", ""), (7, 0, None, None, "", "cc-by-nc"), (20, 0, None, None, "", "mit"), (2, 0, None, None, "", ""), (5, 2, 0, 3, "mit", "mit")]
    twice = frame(spark, ["mit license"] * 3, [1, 1, 1])
    assert [(r.n_base, r.score) for r in licenses.scan(twice)[1].collect()] == [(1, 1.0)] * 3


def test_whole_license_texts(spark):
    """Long templates, edited and cut; what covers too little doesn't count."""
    mit, bsd = licenses.TEXTS[0][0], licenses.TEXTS[2][0]
    assert len(licenses.template_words(mit)) > 150 and len(licenses.template_words(bsd)) > 150
    edited = mit.replace("to any person obtaining", "free to anyone obtaining").replace("IN NO EVENT SHALL THE AUTHORS", "in no event shall the good authors").split()
    texts = ["Copyright 2020 somebody. " + " ".join(edited), bsd.upper(), " ".join(bsd.split()[60:120]), "before " * 500 + mit + " after" * 500]
    places, results = licenses.scan(frame(spark, texts))
    found = {r.doc_id: r for r in results.collect()}
    assert [found[k].labels for k in range(4)] == ["mit", "bsd", "", "mit"] and found[1].score == 1.0 and 0 < found[2].score < licenses.COVER
    whole = len(licenses.PHRASES) + len(licenses.NOTICES)
    spans = {(r.doc_id, r.template): (r.first_word, r.cover) for r in places.collect()}
    assert spans[1, whole + 2] == (0, 1.0) and spans[3, whole] == (500, 1.0) and 0.75 <= spans[0, whole][1] < 1


# 6


def page(main, extra=""):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href='/a'>Home</a></li></ul></nav><div class=\"cookie-notice\">We use cookies</div>{main}{extra}<footer>&copy; x</footer></body></html>"


def test_pages(spark):
    article = "<article><h1>Title</h1><p>One &amp; two<br>three <b>four<p>five</p><aside>side</aside><form>f</form></article>"
    html = [(0, "http://h/0", page(article)), (1, "http://h/1", page("<article><p>other</p></article>", "<section class='comments'><p>nice</p></section>")), (2, "http://h/2", None), (3, None, ""), (4, "http://h/4", page(article)[:-180]), (5, "http://k/5", page("<div class='content'><p>alone</p></div>")), (6, "http://h/6", "<article>cut &am")]
    found = {r.page_id: (r.text, r.n_chars) for r in pages.extract(spark.createDataFrame(html, "page_id long, url string, html string")).collect()}
    full = "Title\nOne & two\nthree four\nfive"
    assert found[0] == (full, len(full)) and found[1][0] == "other" and found[2] == ("", 0) and found[3] == ("", 0) and found[5][0] == "alone" and found[6][0] == "cut &am"


def texts_of(spark, html):
    return {r.page_id: r.text for r in pages.extract(spark.createDataFrame(html, "page_id long, url string, html string")).collect()}


def test_page_names(spark):
    """Names of the frame or pieces of names cut nothing; whole names of parts do."""
    bodies = ["has-sidebar", "no-sidebar", "sidebar-right", "single-header", "layout-nav", "sidebar"]
    main = "<article class='post comments-open'><p>one {0}</p><div class='legal-analysis'>two {0}</div><div class='search-results'>three {0}</div><figure><figcaption>four {0}</figcaption></figure><div class='share'>no</div></article>"
    html = [(k, f"http://h{k}/", f"<html><body class='{c}'><div class='sidebar'><article>no</article></div><div class='page-wrap'>{main.format(k)}</div></body></html>") for k, c in enumerate(bodies)]
    html += [(10, "http://b/", "<body class='has-sidebar'><p>bare</p></body>"), (11, "http://c/", "<body><div class='header'><div class='sidebar'><main><p>only</p></main></div></div></body>")]
    found = texts_of(spark, html)
    assert found == {k: f"one {k}\ntwo {k}\nthree {k}\nfour {k}" for k in range(len(bodies))} | {10: "bare", 11: "only"}


def test_page_template_in_the_article(spark):
    """Texts that a host repeats in its article go under any name; frequent words, copies of a page and texts of one page stay."""
    end = "<div class='zz'>Read our guide</div>"
    html = [(k, f"http://a/{k}", f"<body><article><p>own {k}</p>{'<p>Yes.</p>' * (1 + k % 3)}{end}{'<p>Rate this</p>' if k % 4 else ''}</article></body>") for k in range(8)]
    html += [(20 + k, f"http://b/{k}", f"<body><i>ad {k}</i><article><p>same</p><p>twice</p></article></body>") for k in range(5)]
    html += [(30 + k, f"http://c/{k}", f"<body><article>{end}{f'<p>c {k}</p>' if k else ''}</article></body>") for k in range(4)]
    found = texts_of(spark, html)
    assert {k: found[k] for k in range(8)} == {k: "\n".join([f"own {k}"] + ["Yes."] * (1 + k % 3)) for k in range(8)}
    assert {found[20 + k] for k in range(5)} == {"same\ntwice"}
    assert [found[30 + k] for k in range(4)] == ["Read our guide", "c 1", "c 2", "c 3"]


def test_page_slot_by_template(spark):
    """Where no tag or name tells, the host's template does: the slot is the section with most of what differs, and without it the result is another."""
    words = random.Random(21)
    html = []
    for k in range(6):
        body = "".join(f"<p>{prose(words, 20)}</p>" for _ in range(1 + k % 3))
        html.append((k, f"http://x/{k}", f"<body><div id=q1><p>Teaser {k}</p><p>Subscribe now</p></div><div id=q2><div id=q3><h2>Head {k}</h2>{body}</div></div><div id=q4>tail {k} {prose(words, 3)}</div></body>"))
    found = texts_of(spark, html)
    for k, _, page_html in html:
        assert found[k].startswith(f"Head {k}\n") and "Teaser" not in found[k] and "tail" not in found[k] and found[k].count("\n") == 1 + k % 3
        assert pages.text_of(page_html, ("",), frozenset()) != found[k]


def brute_classes(html, support=0.5, fewest=3):
    """Sections and texts of a host's valid classes from plain occurrence vectors, page by page."""
    read = [[(kind, place, pages.clean(text) if kind == "t" else "") for kind, place, text in pages.read(h)] for h in html]
    counts = [Counter((("section", p) if k == "<" else ("text", p, t)) for k, p, t in page if k == "<" or t) for page in read]
    for c in counts:
        c["section", ""] = 1
    vectors = {}
    for token in set().union(*counts):
        vectors.setdefault(tuple(c[token] for c in counts), []).append(token)
    sections, texts = set(), set()
    for vector, members in vectors.items():
        on = [n for n in vector if n]
        if len(on) < support * len(html):
            continue
        of_texts = [m for m in members if m[0] == "text"] if len(on) >= fewest else []
        if len(of_texts) < len(members) - sum(m[0] == "text" for m in members) or len(set(on)) == 1 or any(m[0] == "section" for m in members):
            sections |= {m[1] for m in members if m[0] == "section"}
            texts |= {pages.text_key(m[1], m[2]) for m in of_texts}
    return sections, texts


def test_classes_against_brute_force(spark, monkeypatch):
    rng = random.Random(22)
    html = []
    for k in range(9):
        parts = ["<div class=a><p>fixed</p></div>"] + [f"<p>{rng.choice('uvw')} {k}</p>" for _ in range(rng.randrange(1, 4))] + ["<div class=b>both</div>"] * rng.randrange(0, 3) + ["<i>x</i><section>often</section>"] * (k > 1)
        rng.shuffle(parts)
        html.append(f"<html><body>{''.join(parts)}<h3>unique {k}</h3></body></html>")
    seen = []
    monkeypatch.setattr(pages, "main_slot", lambda sections, texts: seen.append(1) or ("",))
    frame = spark.createDataFrame([(h, "h") for h in html], "html string, host string")
    held = pages.tokens(frame).where("pages >= 4.5").collect()
    by = {}
    for r in held:
        by.setdefault((r.pages, r.vector), []).append(r)
    valid = [m for m in by.values() if any(r.place is not None for r in m) or all(r.fixed for r in m)]
    sections, texts = brute_classes(html)
    assert {r.place for m in valid for r in m if r.place is not None} == sections
    assert {r.text for m in valid for r in m if r.place is None} == texts


def test_repeated_and_clashing_pages(spark):
    """Repeated rows get equal results; other columns, even with the operator's own names, play no part."""
    html = [(k % 4, f"http://x/{k % 4}", page(f"<article><p>text {k % 4}</p></article>"), "no", 7) for k in range(8)]
    frame = spark.createDataFrame(html, "page_id long, url string, html string, text string, host long")
    assert sorted((r.page_id, r.text) for r in pages.extract(frame).collect()) == sorted((k % 4, f"text {k % 4}") for k in range(8))


def test_templates_either_way(spark, monkeypatch):
    a = rows(pages.op6_main_text(spark, DATA).toPandas())
    monkeypatch.setattr(pages, "SMALL", 0)
    assert rows(pages.op6_main_text(spark, DATA).toPandas()) == a


# 7


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.vocabulary())
    more = [*texts, "it's <|endoftext|> don't''s", "İstanbul ΑΣ x² ½"]
    ids = [np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], np.uint32) for t in more]
    out = packing.pack(frame(spark, more), packing.vocabulary).collect()
    for i, want in enumerate(ids):
        pieces = sorted((r.start, bytes(r.ids)) for r in out if r.doc_id == i)
        assert b"".join(p for _, p in pieces) == want.astype("<u4").tobytes() and all(r.doc_tokens == len(want) for r in out if r.doc_id == i)
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:k]) for k in range(len(s))]
        n = sum(n for _, n in s)
        assert n == 2048 or n & (n - 1) == 0


def test_sum_of_squares():
    state, items, rng = packing.SumOfSquares(16), 0, random.Random(1)
    for _ in range(500):
        size = rng.randrange(1, 16)
        before = state.counts.copy()
        cost = {0: 2 * before[size] + 1} | {h: (2 * (before[h + size] - before[h]) + 2 if h + size < 16 else 1 - 2 * before[h]) for h in range(1, 17 - size) if before[h]}
        state.put((items, size), size)
        assert (state.counts[1:16] ** 2).sum() - (before[1:16] ** 2).sum() == min(cost.values())
        items += 1


def test_few_pieces_are_cut(spark):
    """Documents shorter than a window stay whole, but for what the last pass leaves open; how many partitions there are says little."""
    rng = random.Random(31)
    short = [(k, prose(rng, rng.randrange(20, 200))) for k in range(1200)]
    shares = {}
    for parts in (1, 16):
        frame = spark.createDataFrame(short, "doc_id long, text string").repartition(parts)
        pieces = packing.pack(frame, packing.vocabulary, 512).cache()
        assert sorted(r.doc_id for r in pieces.select("doc_id").distinct().collect()) == list(range(1200))
        sizes = [r.n for r in pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()]
        assert all(n == 512 or n & (n - 1) == 0 for n in sizes)
        lost = pieces.where("doc_tokens <= 512").groupBy("doc_id").count().where("count > 1").count()
        shares[parts] = lost / 1200
        pieces.unpersist()
    assert shares[16] < shares[1] + 0.05 < 0.3


# 8


def test_alignment():
    item = np.arange(1, 21, dtype=np.uint64)
    edited = np.concatenate([np.array([90, 91]), item[:8], [95], item[9:], [92]]).astype(np.uint64)
    (score, a, b), (less, _, _) = decontaminate.align(item, [edited, item[:6]])
    assert (round(score, 3), a, b) == (round((19 * 2 - 1) / 40, 3), 2, 22) and less == 0.3


def test_decontamination(spark):
    rng = random.Random(6)
    items = [(k, prose(rng, 30)) for k in range(6)] + [(6, None), (7, ""), (8, "two words")]
    edited = items[1][1].split()
    edited[5], edited[17] = "other", "word"
    texts = [None, "", prose(rng, 200), prose(rng, 50) + " " + items[0][1] + " " + prose(rng, 50), prose(rng, 20) + ", " + " ".join(edited).upper() + "!", "here are two words", items[2][1]]
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found == {(3, 0), (4, 1), (5, 8), (6, 2)}
    small = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame(spark, texts), spark.createDataFrame(items, "item_id long, text string"), most=40).collect()}
    assert small == found  # in blocks
    assert decontaminate.contaminated(frame(spark, texts), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_decontamination_of_popular_items(spark):
    """Copies of a half are found however many texts have its n-grams."""
    rng = random.Random(8)
    item = prose(rng, 40)
    half = " ".join(item.split()[:20])
    texts = [f"{prose(rng, 9)} {item if k < 30 else half} {prose(rng, 9)}" for k in range(80)] + [" ".join(item.split()[:6]) + " " + prose(rng, 60)]
    found = decontaminate.contaminated(frame(spark, texts), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r.doc_id for r in found} == set(range(80))


def test_bound_of_the_score():
    rng = np.random.default_rng(9)
    for _ in range(300):
        item, text = (rng.integers(0, 12, rng.integers(1, 30)).astype(np.uint64) for _ in range(2))
        score = decontaminate.align(item, [text])[0][0]
        assert decontaminate.may_reach(np.sort(item), text, score)


def brute_score(item, text):
    """The best local alignment's share, cell by cell."""
    before, best = [0] * (len(text) + 1), 0
    for w in item:
        now = [0]
        for j, t in enumerate(text):
            now.append(max(0, before[j] + (2 if w == t else -1), before[j + 1] - 1, now[j] - 1))
        best, before = max(best, *now), now
    return best / (2 * len(item))


def test_alignment_against_brute_force(spark):
    """Every pair whose whole alignment reaches the score and that has a seed is found, with that score; nothing else is."""
    rng = random.Random(41)
    items = [(k, prose(rng, n)) for k, n in enumerate((6, 20, 30, 40, 3))]
    texts = []
    for _ in range(60):
        words = prose(rng, rng.randrange(5, 60)).split()
        source = rng.choice(items)[1].split()
        a = rng.randrange(len(source))
        part = source[a : a + rng.randrange(4, 40)]
        for _ in range(rng.randrange(6)):
            k = rng.randrange(len(part) + 1)
            part[k : k + rng.randrange(2)] = rng.choice([[], ["edit"], ["two", "more"]])
        k = rng.randrange(len(words))
        texts.append(" ".join(words[:k] + part + words[k:]))
    texts.append(" ".join([*items[1][1].split()[:5], "gap"] * 3000))  # one seed again and again
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for d, text in enumerate(texts):
        for i, item in items:
            w, t = item.split(), text.split()
            grams = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)}
            seeded = any(tuple(t[k : k + len(next(iter(grams)))]) in grams for k in range(len(t)))
            score = brute_score(w, t[:400])
            assert ((d, i) in found) == (seeded and score >= decontaminate.SCORE - 1e-9), (d, i, score)
            if (d, i) in found:
                assert abs(found[d, i] - score) < 1e-6


def test_passages_are_bounded():
    for size, high in ((3, 11), (20, 10_000), (20, 81)):
        got = decontaminate.windows(5, 5 + high, size)
        assert all(b - a <= max(4 * size, high if high <= 4 * size else 0) for a, b in got)
        assert all(any(a <= at and at + 2 * size <= b for a, b in got) for at in range(5, 5 + high - 2 * size))
        assert got[0][0] == 5 and got[-1][1] >= 5 + high


# 9


def test_top_k(spark):
    rng = np.random.default_rng(7)
    values = rng.normal(0, 0.1, (300, 8))
    values[50:120] = values[50]
    data = [(i, [float(x) for x in v]) for i, v in enumerate(values)] + [(300, None), (301, [1.0, None]), (302, [float("nan")] * 8), (303, []), (304, [0.5] * 3), (None, [1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    ints = {i: np.floor(256 * np.array(v + [0.0] * (8 - len(v)))) for i, v in data if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    ints[303] = np.zeros(8)
    out = topk.top_k(df, df.where("vec_id % 50 = 0"), block=64, together=3).collect()
    for q in [i for i in ints if i % 50 == 0]:
        best = sorted(((-int(ints[q] @ v), i) for i, v in ints.items() if i != q))[:5]
        assert [(r.vec_id, r.score) for r in sorted((r for r in out if r.query_id == q), key=lambda r: r.rank)] == [(i, -s) for s, i in best]


def test_top_k_of_large_numbers_and_copies(spark):
    """Scores beyond 2 ** 53 are exact, and copies of a row count each; a column of another meaning plays no part."""
    rng = random.Random(9)
    data = [(i, [float(rng.randrange(-(2**21), 2**21)) for _ in range(6)], 1) for i in range(120)] + [(7, [float(2**22)] * 6, 2)] * 7
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, copies int")
    out = topk.top_k(df, df.where("vec_id IN (0, 7, 50)"), block=16, chunk=2).collect()
    ints = [(i, [int(256 * x) for x in v]) for i, v, _ in data]
    for q in (0, 7, 50):
        own = min(v for i, v in ints if i == q)
        best = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in ints if i != q)[:5]
        assert [(r.vec_id, r.score) for r in sorted((r for r in out if r.query_id == q), key=lambda r: r.rank)] == [(i, -s) for s, i in best]


# 10


def test_language(spark):
    d = DATA.replace("0.001", "0.01")
    found = language.op10_language_id(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    test = found[found.held_out]
    assert (test.lang == test.lang_pred).mean() > 0.98
    assert [bool(x) for x in found.held_out] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id]


def test_language_odd(spark, texts):
    model = language.learn(docs(spark).select("doc_id", "text", "lang"), F.lit(True))
    out = {r.doc_id: r for r in language.identify(frame(spark, [*texts, "123 !!"]), model).collect()}
    assert [i for i, r in out.items() if r.lang_pred == "und"] == [0, 1, 2, 3, 14, 15] and out[0].score == 0.0
    assert language.learn(docs(spark).select("doc_id", "text", "lang").limit(0), F.lit(True)) is None
    assert {r.lang_pred for r in language.identify(frame(spark, texts), None).collect()} == {"und"}
    for n in (1, 2, 4, 9, 30):
        code = language.codewords(n)
        assert len({tuple(r) for r in code}) == n


# all


def test_empty_tables(spark):
    none = frame(spark, [])
    model = spark.createDataFrame([], "doc_id long, quality int")
    assert repeats.repeats(none).count() == 0 and jaccard.near_duplicates(none).count() == 0 and lines.dedup_lines(none).count() == 0
    assert licenses.scan(none)[1].count() == 0 and packing.pack(none, packing.vocabulary).count() == 0
    assert quality.score(none, quality.trained(none, model)).count() == 0
    assert topk.top_k(*[spark.createDataFrame([], "vec_id long, embedding array<float>")] * 2).count() == 0
    assert pages.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert decontaminate.contaminated(none, spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")).count() == 0


def test_pipeline(spark, tmp_path):
    d = DATA
    frames, now = [docs(spark)], docs(spark)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, d).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        frames.append(now)
    good, cut, single, clean, packed = ({r.doc_id: r for r in f.collect()} if i < 4 else f.collect() for i, f in enumerate(frames[1:]))
    assert all(f.columns == corpus_pipeline.COLUMNS for f in frames[1:5])
    before = [r.text for r in sorted(good.values(), key=lambda r: r.doc_id)]
    kept = brute_lines(before)
    assert {r.doc_id: t for r, t in zip(sorted(good.values(), key=lambda r: r.doc_id), kept, strict=True) if t or r.text == t} == {i: r.text for i, r in cut.items()}
    ids = sorted(cut)
    roots = [ids[c] for _, c in brute_components([cut[i].text for i in ids])]
    assert {i for i, c in zip(ids, roots, strict=True) if i == c} == set(single)
    leaks = {r.doc_id for r in decontaminate.contaminated(frames[3], spark.read.parquet(f"{d}/benchmark.parquet")).collect()}
    assert set(clean) == set(single) - leaks and {r.doc_id for r in packed} == set(clean)
    assert json.dumps(sorted(r.doc_id for r in corpus_pipeline.run(spark, d).collect())) == json.dumps(sorted(r.doc_id for r in packed))


def test_pipeline_rows_without_an_own_id(spark):
    """Stages three and four judge each row by its id and text, null ids and shared ones too."""
    rng = random.Random(11)
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").where("length(text) > 100").orderBy("item_id").first().text
    copies, other, alone, clean = prose(rng, 60), prose(rng, 60), prose(rng, 60), prose(rng, 60)
    data = [(None, copies)] * 6 + [(None, copies + " end")] + [(None, other), (9, other + " end"), (5, alone), (5, clean), (5, other), (7, clean + " end"), (7, f"{prose(rng, 30)} {item}"), (None, f"{prose(rng, 30)} {item}")]
    data += [(None, ""), (None, ""), (8, ""), (8, ""), (8, None), (None, None)]
    rows = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    single = corpus_pipeline.drop_near_duplicates(spark, rows, DATA)
    got = Counter((r.doc_id, r.text) for r in single.collect())
    assert sum(n for (_, t), n in got.items() if t in (copies, copies + " end")) == 1
    kept = Counter(data[9:12]) + Counter(data[13:15]) + Counter([(None, "")] * 2 + [(8, ""), (8, None), (None, None)])
    assert Counter({k: n for k, n in got.items() if k[1] not in (copies, copies + " end")}) == kept
    left = Counter((r.doc_id, r.text) for r in corpus_pipeline.drop_leaks(spark, single, DATA).collect())
    assert left == Counter({k: n for k, n in got.items() if item not in (k[1] or "")})
