"""Main text of web pages by deducing the template of their host.

A page is read as tokens: a tag with its place among the sections that are open, or a text with its place. Pages of a host whose own
main slots hold the same texts are one page here, so copies of an article don't look like a template. Tokens that occur equally
often on each page of their host (equal occurrence vectors, compared by a sum of hashes over the pages) form an equivalence
class. A class on enough pages is valid if it holds a section, or if it is nested in a valid class as a fixed part: its texts
occur equally often on every page that has them. Texts that are merely frequent have neither and are no template. (A text's section
is on all pages that have the text, so the class of that section has enough pages too.)

The sections of the valid classes are the host's template, nested by place. Its slots hold what differs from page to page, and the main slot is where most of that
is: from the page down, the section, once on every page that has it, that holds more than half of the characters that are no texts of valid classes, as
long as there is one. Articles and main parts within it are preferred to the rest of it. In the main slot the parts that are boilerplate by tag or
name are cut out, and the texts of the valid classes, whatever part they are in. What remains of a page in that slot is its text. A page that lacks
the slot is read by itself, and so is one whose host has no section below the body that holds most; a page whose slot holds template texts alone keeps them.

Texts are shuffled as hashes. Templates of a measured, small size are sent to the pages; beyond it
pages meet their host's template salted, so one host with most of the pages does no harm.

Null and empty pages give the empty text. Pages cut off anywhere are read as far as they go. A very long page is one row, read once by one task. Of sections
with equal shares the first by place holds. Pages without a host share one
template. Repeated rows get equal results. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, work_dir

SALTS = 32
#: Bytes of templates that are sent to every executor; more of them meet their pages by a salted join.
SMALL = 4_000_000
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(script|style|noscript|template|textarea|iframe|svg|select|button)\b[^>]*>.*?(?:</\1\s*>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|$)|<[!?/][^>]*(?:>|$)",
    re.S | re.I,
)
NAME = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr img input label".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER = frozenset("nav header footer aside form head title menu dialog".split())
#: Whole class names, ids and roles of parts that are no text of the page; pieces of a name say nothing ("has-sidebar", "search-results").
BOILER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements sponsored cookie cookies cookie-notice cookie-banner cookie-bar cookie-consent consent-banner popup modal"
    " sidebar side-bar menu main-menu nav navbar nav-bar navigation breadcrumb breadcrumbs footer site-footer page-footer header site-header page-header masthead"
    " comments comment-list comments-area disqus disqus_thread share sharing share-buttons social social-links social-share related related-posts related-articles"
    " newsletter newsletter-signup pagination pager toolbar widget widget-area contentinfo complementary".split()
)
#: Steps whose names say how a page is laid out or labelled, not that it is boilerplate.
FRAME = frozenset("html body article main".split())
CLOSED_BY = {"p": frozenset(["p"]), "li": frozenset(["li", "p"]), "dt": frozenset(["dt", "dd", "p"]), "dd": frozenset(["dt", "dd", "p"]), "tr": frozenset(["tr", "td", "th", "p"]), "td": frozenset(["td", "th", "p"]), "th": frozenset(["td", "th", "p"])}
BLOCK_CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())
BARRIER = frozenset("article body div html main section td table".split())


def read(page: str) -> Iterator[tuple[str, str]]:
    """(kind, place, text): kind < for an opened section, > for a closed one, t for a text, | for a break; in page order."""
    stack: list[tuple[str, str]] = []
    place, at = "", 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            yield "t", place, page[at : m.start()]
        at = m.end()
        tag = m[3].lower() if m[3] else ""
        if not tag or tag in INLINE:
            continue
        if tag in EMPTY:
            yield "|", place, ""
            continue
        if m[2]:
            if any(t == tag for t, _ in stack):
                while stack:
                    gone, place = stack.pop()
                    if gone == tag:
                        break
                yield ">", place, ""
            else:
                yield "|", place, ""
            continue
        closes = CLOSED_BY.get(tag) or (frozenset(["p"]) if tag in BLOCK_CLOSES_P else frozenset())
        while stack and stack[-1][0] in closes:
            place = stack.pop()[1]
        name = " ".join(sorted({w for x in NAME.finditer(m[4]) for w in (x[1] or x[2] or x[3] or "").lower().split()}))
        stack.append((tag, place))
        place = f"{place}/{tag}" + (f" {name}" if name else "")
        yield "<", place, ""
    if at < len(page):
        yield "t", place, page[at:]


def clean(text: str) -> str:
    return " ".join(entities.unescape(text).split())


def boilerplate(step: str) -> bool:
    tag, _, names = step.partition(" ")
    return tag in BOILER or (tag not in FRAME and not BOILER_NAMES.isdisjoint(names.split()))


def main_places(places: list[str]) -> tuple[str, ...]:
    """The outermost articles of a template; else its main parts; else its bodies; else everything.

    Those in parts with a boilerplate tag don't count, and those in parts with a boilerplate name only where there are no others."""
    for tag in ("article", "main", "body"):
        found = {p for p in places if is_a(p.rpartition("/")[2], tag) and not any(step.split(" ")[0] in BOILER for step in p.split("/")[1:])}
        found = {p for p in found if not any(map(boilerplate, p.split("/")[1:-1]))} or found
        if found:
            return tuple(sorted(p for p in found if not any(p.startswith(q + "/") for q in found)))
    return ("",)


def is_a(step: str, tag: str) -> bool:
    own, _, names = step.partition(" ")
    return own == tag or (tag == "main" and "main" in names.split())


def text_key(place: str, text: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{place}\n{text}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def roots_in(page: list[tuple[str, str, str]]) -> tuple[str, ...]:
    """The main slot of a page without regard to others."""
    return main_places([place for kind, place, _ in page if kind == "<"])


class Slot:
    """Tells for each place whether it is in the main slot and in no boilerplate part of it."""

    def __init__(self, roots: tuple[str, ...]):
        self.roots, self.known = roots, {}

    def __contains__(self, place: str) -> bool:
        if place not in self.known:
            root = next((r for r in self.roots if place == r or place.startswith((r + "/", r + " "))), None)
            self.known[place] = root is not None and not any(map(boilerplate, place[len(root) :].split("/")[1:]))
        return self.known[place]


def held_below(found: list[tuple[str, str, str]]) -> Counter:
    """For each section the characters of the texts in it and below, without those in parts that are boilerplate."""
    size: Counter = Counter()
    whole = Slot(("",))
    for kind, place, text in found:
        if kind == "t" and text and place in whole:
            while True:
                size[place] += len(text)
                if not place:
                    break
                place = place.rpartition("/")[0]
    return size


def tokens(pages: DataFrame) -> DataFrame:
    """host, place (of a section), text (its key), at (its place), pages, vector, fixed, once, size: the number of the different pages that hold a token, the hash
    of how often each does, whether all do so equally often, and never more than once; the characters in a section and below, or of a text, on all of them.
    The section "" is on every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[tuple, tuple[int, int, str | None]] = {}
            for host, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not page:
                    continue
                found = [(kind, place, clean(text) if kind == "t" else "") for kind, place, text in read(page)]
                slot = Slot(roots_in(found))
                main = text_key("", "\n".join(text for kind, place, text in found if text and place in slot))
                below = held_below(found)
                counts = Counter((place, None) if kind == "<" else (None, text_key(place, text)) for kind, place, text in found if kind == "<" or text)
                counts["", None] = 1
                texts = {text_key(place, text): (len(text), place) for kind, place, text in found if text}
                for (place, text), n in counts.items():
                    size, at = texts[text] if place is None else (below[place], None)
                    key = host, main, place, text
                    before = held.get(key, (0, 0, at))
                    held[key] = max(n, before[0]), max(size * n if place is None else size, before[1]), at
            if held:
                cols = [*zip(*held, strict=True), *zip(*held.values(), strict=True)]
                kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["host", "page", "place", "text", "n", "size", "at"])

    rows = pages.select("host", "html").mapInArrow(run, "host string, page long, place string, text long, n long, size long, at string")
    # Copies of a page that differ outside the slot count as one with all that they have.
    once = rows.groupBy("host", "place", "text", "page").agg(F.max("n").alias("n"), F.max("size").alias("size"), F.min("at").alias("at"))
    vector = F.sum(F.xxhash64("page", "n").cast("decimal(20,0)"))
    counts = [F.count("*").alias("pages"), vector.alias("vector"), (F.min("n") == F.max("n")).alias("fixed"), (F.max("n") == 1).alias("once"), F.sum("size").alias("size"), F.min("at").alias("at")]
    return once.groupBy("host", "place", "text").agg(*counts)


def main_slot(sections: list[dict], texts: list[dict]) -> tuple[str, ...]:
    """The places of a template's main slot. sections: place, once, size; texts: at, size; of the valid classes."""
    own = {x["place"]: x["size"] for x in sections}
    for x in texts:
        place = x["at"]
        while place:
            own[place] = own.get(place, 0) - x["size"]
            place = place.rpartition("/")[0]
        own[""] = own.get("", 0) - x["size"]
    below: dict[str, list[str]] = {}
    for x in sections:
        parent, _, step = x["place"].rpartition("/")
        if x["place"] and x["once"] and step.split(" ")[0] in BARRIER and not boilerplate(step):
            below.setdefault(parent, []).append(x["place"])
    here = ""
    while not any(is_a(here.rpartition("/")[2], tag) for tag in ("article", "main")):
        best = max(sorted(below.get(here, [])), key=own.__getitem__, default=None)
        if best is None or 2 * own[best] <= own[here]:
            break
        here = best
    inner = main_places([x["place"] for x in sections if x["place"] == here or x["place"].startswith(here + "/")])
    return inner if inner != ("",) else (here,)


def templates(pages: DataFrame, support: float = 0.5, fewest: int = 3) -> DataFrame:
    """host, roots, texts: the main slot of the host's template, and the keys of the texts of its valid classes.

    A class's pages are at least `support` of the host's different ones; texts need `fewest` pages too. So sections of one in
    `support` of the pages bound the number of places; texts are bounded likewise."""
    held = stored(tokens(pages).where(F.col("place").isNotNull() | (F.col("pages") >= fewest)), work_dir(pages.sparkSession), "tokens")
    sizes = held.where("place = ''").select(F.col("host").alias("of"), F.col("pages").alias("host_pages"))
    common = held.join(sizes, F.col("host").eqNullSafe(F.col("of"))).where(F.col("pages") >= support * F.col("host_pages"))
    section, text = F.when(F.col("place").isNotNull(), F.struct("place", "once", "size")), F.when(F.col("place").isNull(), F.struct("text", "at", "size"))
    classes = common.groupBy("host", "pages", "vector").agg(F.collect_list(section).alias("sections"), F.collect_list(text).alias("texts"), F.bool_and("fixed").alias("fixed"))
    valid = classes.where((F.size("sections") > 0) | F.col("fixed"))
    rows = valid.groupBy("host").agg(F.flatten(F.collect_list("sections")).alias("sections"), F.flatten(F.collect_list("texts")).alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = [list(main_slot(*x)) for x in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)]
            texts = [[x["text"] for x in t] for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(roots, pa.list_(pa.string())), pa.array(texts, pa.list_(pa.int64()))], ["host", "roots", "texts"])

    return rows.mapInArrow(run, "host string, roots array<string>, texts array<long>")


def _bare(roots: tuple[str, ...]) -> bool:
    return all(r.rpartition("/")[2].split(" ")[0] in ("", "html", "body") for r in roots)


def text_of(page: str, roots: tuple[str, ...], texts: frozenset[int]) -> str:
    """The blocks of a page's main slot."""
    read_page = list(read(page))
    if _bare(roots) or not any(p == r or p.startswith((r + "/", r + " ")) for _, p, _ in read_page for r in roots):
        roots = roots_in(read_page)
    bare = _bare(roots)
    slot = Slot(roots)

    def blocks(cut: frozenset[int]) -> str:
        out, open_block = [], []
        for kind, place, text in read_page:
            if kind != "t":
                out.append("".join(open_block))
                open_block = []
            elif place in slot and not (cut and text_key(place, clean(text)) in cut):
                open_block.append(text)
        out.append("".join(open_block))
        return "\n".join(b for b in map(clean, out) if b)

    return blocks(texts) or ("" if bare else blocks(frozenset()))


def extract(pages: DataFrame) -> DataFrame:
    """pages: page_id, url, html. Gives page_id, url, text, n_chars."""
    pages = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string")).withColumn("host", F.expr("lower(regexp_extract(url, '^[^:/?#]*:?//([^/?#]*)', 1))"))
    known = stored(templates(pages), work_dir(pages.sparkSession), "templates")
    size = known.agg(F.sum(64 + F.length(F.concat_ws(" ", "host", F.concat_ws(" ", "roots"))) + 8 * F.size("texts"))).first()[0] or 0
    known = known.withColumnRenamed("host", "of")
    same = F.col("host").eqNullSafe(F.col("of"))
    if size <= SMALL:
        joined = pages.join(F.broadcast(known), same, "left")
    else:
        salted = pages.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        joined = salted.join(known.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), same & (F.col("salt") == F.col("part")), "left")
    joined = joined.select("page_id", "url", "html", "roots", "texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [text_of(page or "", tuple(roots or ("",)), frozenset(texts or ())) for page, roots, texts in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    schema = pages.select("page_id", "url", F.lit("").cast("string").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return joined.mapInArrow(run, schema)


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
