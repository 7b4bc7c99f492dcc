"""Main text of web pages by two-pass block rules.

Pass one cuts a page into blocks and labels each by its link density, stop-word density and length.
What holds a block only shifts the thresholds: none are left in an article, they are lower in a container that
names itself content and higher in one whose name is doubtful. Menus, footers, forms, comments and
the like, known by their tags or by names that say nothing else, are left out. Pass two lets
ambiguous blocks inherit the label of their nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordgate.llm.common import small_batches, table, tidy

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<(?P<raw>script|style|noscript|template|textarea|select|svg|iframe|object|title|button)\b.*?(?:</(?P=raw)\s*>|$)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?"
    r"|<[!?][^>]*>?",
    re.S | re.I,
)
_BLOCK = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINER = frozenset("address article aside blockquote body details dialog div dl fieldset figure footer form head header html main menu nav ol section table ul".split())
_BAD_TAG = frozenset("nav footer aside form menu dialog head".split())
_GOOD_TAG = frozenset(("article", "main"))
_NAMED = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
#: Words that name what is no article, those of reader comments, and words that say nothing of their own beside them.
_JUNK = frozenset(
    """ad ads advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promos promotion promotions banner banners cookie cookies consent gdpr notice notices alert alerts popup modal
    nav navbar navigation menu menus breadcrumb breadcrumbs sidebar side aside widget widgets related recommend recommended recommendations share sharing social footer header masthead topbar toolbar newsletter subscribe
    signup login search form forms pagination pager tag tags complementary contentinfo""".split()
)
_COMMENT = frozenset("comment comments respond reply replies discussion disqus".split())
_NEUTRAL = frozenset("box boxes list lists area bar block blocks wrap wrapper container inner outer item items top bottom left right site page main global links link posts post articles buttons icons icon section body content text group panel row col column slot unit big small primary secondary id the form thread meta author title count js hidden".split())
_CONTENT = frozenset("article post entry story content main body text".split())
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_SPACE = re.compile(r"\s+")

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """the and of to in is that it for was on are as with be by this at from or have not they his her which you were
    der die das und ist nicht mit den von zu ein eine auf für im dem des sich auch als wie bei
    le la les de des du et un une est que qui dans pour pas sur avec ce par au plus
    el los las y en un una es por con para del se no lo como más su al""".split()
)
STOP_HIGH, STOP_LOW = 0.30, 0.12
LINKS_HIGH = 0.33
SHORT, LONG = 40, 140
#: What holds a block.
ARTICLE, CONTENT, PLAIN, DOUBTFUL, JUNK, OUT = 2, 1, 0, -1, -2, -3
#: By what holds it: density from which a long block is text, density from which it may be, length from which it is long.
THRESHOLDS = {ARTICLE: (0.0, 0.0, SHORT - 1), CONTENT: (0.20, STOP_LOW, SHORT - 1), PLAIN: (STOP_HIGH, STOP_LOW, LONG), DOUBTFUL: (STOP_HIGH, STOP_HIGH, LONG)}
#: Bytes of html whose texts are given on together.
CHUNK = 4 << 20


def blocks(page: str) -> list[tuple[str, float, int, bool]]:
    """(text, link density, what holds it, heading) in page order."""
    out: list[tuple[str, float, int, bool]] = []
    stack: list[tuple[str, int]] = []
    open_: Counter[str] = Counter()
    text: list[str] = []
    linked, anchor, hint, heading = 0, 0, 0, False

    def flush() -> None:
        nonlocal linked
        if text:
            whole = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if whole:
                out.append((whole, min(1.0, linked / max(1, len(whole))), hint, heading))
            text.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            text.append(piece)
            if anchor:
                linked += len(_SPACE.sub(" ", piece))

    at = 0
    for m in _TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            anchor = 0 if m["close"] else 1
        elif tag == "br":
            text.append(" ")
        elif tag in _BLOCK:
            flush()
            anchor = 0
            heading = not m["close"] and tag[0] == "h" and tag[1:].isdigit()
            if tag in _CONTAINER:
                if not m["close"]:
                    stack.append((tag, _judge(tag, m["attrs"], hint)))
                    open_[tag] += 1
                elif open_[tag]:  # else nothing is closed, however much is open
                    last = None
                    while last != tag:
                        last = stack.pop()[0]
                        open_[last] -= 1
                hint = stack[-1][1] if stack else 0
    add(page[at:])
    flush()
    return out


def _named(name: str) -> int:
    """What a class, id or role says: junk only if it says nothing else."""
    parts = [x.lower() for x in _PARTS.findall(name)]
    comment, junk = any(x in _COMMENT for x in parts), any(x in _JUNK for x in parts)
    if comment or junk:
        if all(x in _JUNK or x in _COMMENT or x in _NEUTRAL or x.isdigit() for x in parts):
            return OUT if comment else JUNK
        return DOUBTFUL
    return CONTENT if any(x in _CONTENT for x in parts) else PLAIN


def _judge(tag: str, attrs: str, outer: int) -> int:
    """What a container is. What its tag or comments rule out stays out; an article within what only its name rules out is one."""
    if outer == OUT or tag in _BAD_TAG or (attrs and _HIDDEN.search(attrs)):
        return OUT
    if tag in ("html", "body"):  # their names are those of the page
        return outer
    said = [_named(x) for v in _NAMED.findall(attrs or "") for x in v.strip("\"'").split()]
    names = min(said, default=PLAIN)
    if names <= JUNK:
        return names
    if tag in _GOOD_TAG:
        return ARTICLE
    if outer == JUNK or (tag == "header" and outer <= PLAIN):
        return JUNK
    # what an article holds is of it; a header belongs to the article that holds it
    return outer if outer == ARTICLE else names or max(said, default=PLAIN) or outer


def density(text: str) -> float:
    """Share of stop words."""
    words = text.lower().split()
    return sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / max(1, len(words))


def first_pass(block: tuple[str, float, int, bool]) -> str:
    """good, bad, near (probably text) or short (undecided)."""
    text, links, hint, heading = block
    if hint < DOUBTFUL or links > LINKS_HIGH:
        return "bad"
    if heading or len(text) < SHORT:
        return "short"
    high, low, long = THRESHOLDS[hint]
    dense = density(text)
    if dense >= high:
        return "good" if len(text) > long else "near"
    return "near" if dense >= low else "bad"


def _runs(found: list[tuple[str, float, int, bool]], labels: list[str]) -> list[str]:
    """Neighbouring dense blocks that are short each are text if they are long together: paragraphs need no long one beside them."""
    out, at = list(labels), 0
    while at < len(labels):
        stop, size = at, 0
        while stop < len(labels) and labels[stop] == "near" and density(found[stop][0]) >= STOP_HIGH:
            size += len(found[stop][0])
            stop += 1
        if size > LONG:
            out[at:stop] = ["good"] * (stop - at)
        at = max(stop, at + 1)
    return out


def _neighbours(decided: list[str | None]) -> list[tuple[str | None, str | None]]:
    """Nearest decided label before and after each block."""
    before, after, last = [], [], None
    for x in decided:
        before.append(last)
        last = x or last
    last = None
    for x in reversed(decided):
        after.append(last)
        last = x or last
    return list(zip(before, reversed(after), strict=True))


def main_text(page: str) -> str:
    found = blocks(page)
    labels = _runs(found, [first_pass(b) for b in found])
    if any(b[2] == ARTICLE and x == "good" for b, x in zip(found, labels, strict=True)):
        # outside the article of a page that has one
        labels = ["bad" if b[2] < CONTENT else x for b, x in zip(found, labels, strict=True)]
    # blocks of an article look for neighbours in it, the others anywhere
    inner = _neighbours([x if x in ("good", "bad") and b[2] > 0 else None for b, x in zip(found, labels, strict=True)])
    outer = _neighbours([x if x in ("good", "bad") else None for x in labels])
    final = []
    for i, (b, label) in enumerate(zip(found, labels, strict=True)):
        left, right = (inner if b[2] > 0 else outer)[i]
        if label in ("good", "bad"):
            final.append(label)
        elif b[2] == ARTICLE:
            final.append("good" if "good" in (left, right) or not (left or right) else "bad")
        elif label == "near" or b[2] == CONTENT:
            final.append("good" if "good" in (left, right) else "bad")
        elif b[3]:  # a heading belongs to what follows it
            final.append("good" if right == "good" else "bad")
        else:
            final.append("good" if left == right == "good" else "bad")
    return "\n".join(b[0] for b, x in zip(found, final, strict=True) if x == "good")


def _run(batches):
    """Texts of some megabytes of html at a time, whatever the batch holds."""
    for b in batches:
        lo, size, texts = 0, 0, []
        for hi in range(1, b.num_rows + 1):
            page = b.column(1)[hi - 1].as_py() or ""
            texts.append(main_text(page))
            size += len(page)
            if size >= CHUNK or hi == b.num_rows:
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(texts, pa.string())], ["page_id", "url", "text"])
                lo, size, texts = hi, 0, []


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """page_id, url, text, n_chars, one row per row of ``pages``.

    Null or empty html gives an empty text; null ids and urls stay null; repeated rows are extracted
    alike; an empty table gives an empty result; other columns are not read.
    """
    small_batches(pages.sparkSession)
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("html"), F.col(url_col).cast("string").alias("url"))
    return source.mapInArrow(tidy(_run), "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
