"""Block rules over many page shapes, the segmentation against an HTML parser, and time on nested markup."""

import html as entities
import random
import re
import time
from html.parser import HTMLParser

import pytest

from recordgate.llm import html_extract

LONG = "The old house by the river was built of stone and it had stood there for as long as any of the people in the village could say, and they said it was the first of all."
SHORT = "It was in the north of the town and the men who had built it were at work for a year to get it on its feet, as they said by the fire"
NONSENSE = "zx qv bn mm kk zx qv bn mm kk zx qv bn mm kk zx qv bn mm kk zx qv bn"
LINKS = "".join(f'<li><a href="/{i}">Section number {i}</a></li>' for i in range(8))


def p(*texts):
    return "".join(f"<p>{t}</p>" for t in texts)


ARTICLE = p(LONG, LONG)
TEXT = f"{LONG}\n{LONG}"
#: Pages and their texts.
PAGES = {
    "plain": (f"<div>{ARTICLE}</div>", TEXT),
    "name with another word, side": (f'<div class="side-story">{ARTICLE}</div>', TEXT),
    "name with another word, related": (f'<div class="related-work">{ARTICLE}</div>', TEXT),
    "name with another word, social": (f'<div class="social-history">{ARTICLE}</div>', TEXT),
    "article in a name": (f'<div class="notice-of-motion"><article>{ARTICLE}</article></div>', TEXT),
    "article in a junk name": (f'<div class="banner"><article>{ARTICLE}</article></div>', TEXT),
    "short paragraphs": (f"<div>{p(*[SHORT] * 4)}</div>", "\n".join([SHORT] * 4)),
    "one short paragraph": (f"<div>{p(SHORT)}</div>", ""),
    "nonsense in content": (f'<div class="content">{p(*[NONSENSE] * 6)}</div>', ""),
    "advert in content": (f'<div class="content">{p(*["Buy now cheap Buy now cheap Buy now cheap Buy now cheap"] * 6)}</div>', ""),
    "text in content": (f'<div class="content">{p(LONG, "A word.", LONG)}</div>', f"{LONG}\nA word.\n{LONG}"),
    "sidebar": (f'<div class="sidebar">{ARTICLE}</div><div>{p(LONG)}</div>', LONG),
    "camel case": (f'<div class="relatedPosts">{ARTICLE}</div><div id="mainContent">{p(LONG)}</div>', LONG),
    "cookie notice": (f'<div id="cookie-notice">{p(LONG)}</div><div>{p(LONG)}</div>', LONG),
    "comments": (f'<article>{ARTICLE}</article><section id="comments"><article class="comment-1">{p(LONG)}</article></section>', TEXT),
    "article within comments": (f'<div>{ARTICLE}</div><div class="comment-list"><article>{p(LONG)}</article></div>', TEXT),
    "navigation": (f"<nav>{p(LONG)}</nav><ul>{LINKS}</ul><div>{p(LONG)}</div>", LONG),
    "links": (f"<div>{p(LONG)}<p><a href=x>{LONG}</a></p></div>", LONG),
    "few links": (f"<div><p>{LONG} <a href=x>and so on</a></p></div>", f"{LONG} and so on"),
    "heading before text": (f"<div><h1>Title</h1>{p(LONG)}<h2>Nothing follows</h2></div>", f"Title\n{LONG}"),
    "short between": (f"<div>{p(LONG, 'Then.', LONG)}</div>", f"{LONG}\nThen.\n{LONG}"),
    "short at the end": (f"<div>{p(LONG, 'Then.')}</div>", LONG),
    "header and footer": (f"<header>{p(LONG)}</header><div>{p(LONG)}</div><footer>{p(LONG)}</footer>", LONG),
    "header of an article": (f"<article><header><h1>Title</h1></header>{p(LONG)}</article>", f"Title\n{LONG}"),
    "form": (f"<form>{p(LONG)}</form><div>{p(LONG)}</div>", LONG),
    "hidden": (f'<div style="display: none">{p(LONG)}</div><div hidden>{p(LONG)}</div><div>{p(LONG)}</div>', LONG),
    "script and style": (f"<style>p{{}}</style><script>var t='{LONG}'</script><div>{p(LONG)}</div>", LONG),
    "outside the article": (f"<article>{p(LONG)}</article><div>{p(LONG)}</div>", LONG),
    "article of few words": ("<article><p>One.</p></article>", "One."),
    "low density in an article": (f"<article>{p(LONG, NONSENSE)}</article>", f"{LONG}\n{NONSENSE}"),
    "name of the page": (f'<html class="no-js"><body class="home comments-open sidebar-left">{ARTICLE}</body></html>', TEXT),
    "references": (f"<div><p>{LONG} &amp; &#233;&nbsp;x</p></div>", f"{LONG} & é x"),
    "white space": (f"<div><p>{LONG}\n\t  x</p></div>", f"{LONG} x"),
    "nothing": ("", ""),
    "only text": (LONG, LONG),
    "not closed": (f"<div><p>{LONG}<p>{LONG}", TEXT),
    "closed too often": (f"</div></article><div>{p(LONG)}</div></section>", LONG),
    "comment in markup": (f"<div><!-- <nav> --><p>{LONG}</p></div>", LONG),
}


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    page, text = PAGES[name]
    assert html_extract.main_text(page) == text


class Slow(HTMLParser):
    """Blocks of a well-formed page by the standard parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.text, self.linked, self.anchor, self.heading = [], [], 0, 0, False

    def cut(self):
        whole = re.sub(r"\s+", " ", "".join(self.text)).strip()
        if whole:
            self.out.append((whole, self.heading))
        self.text = []

    def handle_starttag(self, tag, attrs):
        if tag in html_extract._BLOCK:
            self.cut()
            self.heading = tag[0] == "h" and tag[1:].isdigit()

    def handle_endtag(self, tag):
        if tag in html_extract._BLOCK:
            self.cut()
            self.heading = False

    def handle_data(self, data):
        self.text.append(data)


def test_blocks_equal_those_of_a_parser():
    rng = random.Random(8)
    for _ in range(300):
        parts, open_ = [], []
        for _ in range(rng.randint(1, 40)):
            kind = rng.random()
            if kind < 0.35:
                tag = rng.choice(["div", "p", "h2", "section", "b", "a", "ul", "li", "span", "article", "table", "td"])
                parts.append(f'<{tag} class="{rng.choice(["x", "nav", "a > b"])}">')
                open_.append(tag)
            elif kind < 0.6 and open_:
                parts.append(f"</{open_.pop()}>")
            else:
                parts.append(entities.escape(rng.choice(["one two", "a & b", "<x>", " \n ", "é"])) + rng.choice(["", " ", "<!-- c -->", "<br>"]).replace("<br>", " "))
        page = "".join(parts) + "".join(f"</{t}>" for t in reversed(open_))
        slow = Slow()
        slow.feed(page)
        slow.close()
        slow.cut()
        assert [(b[0], b[3]) for b in html_extract.blocks(page)] == slow.out


def test_density_runs_and_neighbours_equal_plain_rules():
    """The labels of pages without names against the rules written out block by block."""
    rng = random.Random(9)
    kinds = {"good": LONG, "dense": SHORT, "bad": NONSENSE, "short": "A word.", "some": "zx qv bn the kk zx qv and mm kk zx qv bn of kk zx"}
    for _ in range(200):
        texts = [rng.choice(list(kinds)) for _ in range(rng.randint(0, 9))]
        labels = list(texts)
        for i, x in enumerate(texts):
            if x == "dense":
                lo = i
                while lo and texts[lo - 1] == "dense":
                    lo -= 1
                hi = i
                while hi + 1 < len(texts) and texts[hi + 1] == "dense":
                    hi += 1
                labels[i] = "good" if (hi - lo + 1) * len(SHORT) > html_extract.LONG else "some"
        want = []
        for i, x in enumerate(labels):
            near = lambda side: next((y for y in side if y in ("good", "bad")), None)
            left, right = near(labels[:i][::-1]), near(labels[i + 1 :])
            if x == "good" or (x == "some" and "good" in (left, right)) or (x == "short" and left == right == "good"):
                want.append(kinds[texts[i]])
        assert html_extract.main_text("<div>" + p(*[kinds[x] for x in texts]) + "</div>") == "\n".join(want)


def test_deep_and_long_pages_take_linear_time(spark):
    began = time.process_time()
    html_extract.main_text("<div>" * 40000 + "</p></ul>" * 40000)
    html_extract.main_text("<div>" * 40000 + "</div>" * 40000)
    assert time.process_time() - began < 10
    rows = [(1, "u", None, 1), (None, None, "", 2), (2, "u", "<div>" + p(LONG) * 3000 + "</div>", 3), (2, "u", "<div>" + p(LONG) * 3000 + "</div>", 3)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 0), (2, 3000 * len(LONG) + 2999), (2, 3000 * len(LONG) + 2999)]
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
