"""Main text of HTML pages: flat text blocks, classified by a decision tree.

A page is cut into blocks of text at block-level tags. A block is described by its words, its link density, those of
its neighbours, and what encloses it; a decision tree grown on the small labelled table below tells article text from the rest.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
#: Elements whose content is not text of the page.
_SILENT = {"script", "style", "noscript", "template", "svg", "head", "select", "button", "textarea", "iframe", "object", "canvas", "title", "math", "audio", "video", "datalist"}
#: Elements that do not end a block.
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold something else than the article, those that often do but may also wrap it, and those of lists in which articles are comments or teasers.
_SIDE = {"nav", "footer", "aside", "menu", "header", "dialog"}
_ODD = {"form", "fieldset"}
_NEVER = {"nav", "footer", "aside", "menu", "dialog"}
#: Words of names (class, id, role). What an element is, is said by the last word that isn't a box of something: user-comments and comment-list are comments, social-science is a science.
_AD_WORDS = set("ad ads advert adverts advertisement advertisements advertising advertorial promo promos promoted promotion promotions promotional sponsor sponsors sponsored sponsorship".split())
_SIDE_WORDS = _AD_WORDS | set(
    "cookie cookies consent gdpr popup modal overlay sidebar comment comments commenters replies respond disqus feedback share sharing social related recommended recommendation recommendations recommends"
    " menu nav navbar navigation breadcrumb breadcrumbs footer newsletter newsletters subscribe signup copyright disclaimer complementary contentinfo".split()
)
#: Words that say it wherever they stand, also run together with others.
_PLAIN_WORDS = set("ad ads advert adverts advertisement advertisements sidebar comments disqus gdpr navbar breadcrumb breadcrumbs newsletter signup".split())
_ENDINGS = ("sidebar", "comments", "footer", "navigation", "breadcrumbs", "newsletter", "advertisement", "disclaimer", "feedback")
_BOX_WORDS = set(
    "list lists box section area block container wrapper wrap item items bar panel form body thread link links button buttons icon icons tools slot unit banner notice message alert label zone"
    " module group inner outer top bottom left right row col column header title heading widget count text strip holder frame content policy".split()
)
_TEASER_WORDS, _TEASED_WORDS = set("related more recommended popular latest trending similar sponsored promoted other".split()), set("posts articles stories news reading topics headlines entries".split())
_ODD_WORDS = set("banner notice alert side widget more header masthead login search tag tags pagination pager toolbar".split())
_APART_WORDS = _AD_WORDS | set("share sharing newsletter subscribe".split())
_NEVER_WORDS = _AD_WORDS | set("popup modal sidebar widget comment comments commenters replies respond disqus feedback related recommended recommendation recommendations recommends nav navbar navigation footer complementary contentinfo".split())
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
#: Names that say what a layout has or lacks, not what the element is.
_LAYOUT_NAME = re.compile(r"(?:(?<=[\s_-])|^)(?:has|with|without|no)[_-][\w-]*", re.IGNORECASE)
_MAIN_NAME = re.compile(r"(?:^|[\s_-])(?:article|main|post|entry|story|content|body-?text)(?:$|[\s_-])", re.IGNORECASE)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)



def _words(token: str) -> list[str]:
    """The words of a name: parted at signs, digits and capitals, and where a known word and a box, or a known ending, are written as one."""
    out = []
    for word in _WORD.findall(token):
        word = word.lower()
        cut = next((k for k in range(len(word) - 2, 2, -1) if word[:k] in _SIDE_WORDS and word[k:] in _BOX_WORDS), 0) if word not in _SIDE_WORDS else 0
        cut = cut or next((len(word) - len(e) for e in _ENDINGS if len(word) > len(e) and word.endswith(e)), 0)
        out += [word[:cut], word[cut:]] if cut else [word]
    return [*out[:-2], "sidebar"] if out[-2:] == ["side", "bar"] else out


@lru_cache(maxsize=1 << 14)
def _named(names: str) -> tuple[bool, bool, bool, bool]:
    """Whether an element of these names is beside the article, may be, is set apart from the line it stands in, and holds no article."""
    side = odd = apart = never = False
    for token in names.split():
        words = _words(token)
        if not words:
            continue
        boxed = len(words)
        while boxed > 1 and words[boxed - 1] in _BOX_WORDS:
            boxed -= 1
        head = words[boxed - 1]
        teaser = words[boxed - 1] in _TEASED_WORDS and not _TEASER_WORDS.isdisjoint(words[: boxed - 1])
        told = {head} | _PLAIN_WORDS.intersection(words)
        side |= teaser or not _SIDE_WORDS.isdisjoint(told)
        odd |= not (_SIDE_WORDS | _ODD_WORDS).isdisjoint(words)
        apart |= not _APART_WORDS.isdisjoint(told) or head == "social" and boxed < len(words)
        never |= teaser or not _NEVER_WORDS.isdisjoint(told) or "widget" in words
    return side, odd and not side, apart, never


FEATURES = ("side", "odd", "main", "heading", "words", "links", "words_before", "links_before", "words_after", "links_after", "sentence")
#: Labelled blocks: side (enclosed by an element for something else than the article), odd (by one that may be), main (enclosed by an article element), heading,
#: words, link density, words and link density of the block before, of the block after, and whether it is article text. What counts as a sentence is told by SENTENCES.
LABELLED = [
    (1, 0, 0, 0, 1, 1.0, 0, 0.0, 1, 1.0, 0), (1, 0, 0, 0, 2, 1.0, 1, 1.0, 1, 1.0, 0), (1, 0, 0, 0, 12, 0.0, 1, 1.0, 14, 0.0, 0), (1, 0, 0, 0, 60, 0.0, 1, 1.0, 14, 0.0, 0),
    (1, 0, 0, 0, 9, 0.0, 45, 0.0, 0, 0.0, 0), (1, 0, 0, 0, 25, 0.1, 80, 0.0, 0, 0.0, 0), (1, 0, 1, 0, 30, 0.0, 50, 0.0, 22, 0.0, 0), (1, 0, 1, 0, 5, 0.2, 70, 0.0, 40, 0.0, 0),
    (1, 0, 1, 0, 80, 0.0, 90, 0.0, 60, 0.0, 0), (1, 0, 0, 1, 3, 0.0, 20, 0.0, 10, 1.0, 0), (1, 0, 1, 1, 2, 0.0, 60, 0.0, 20, 0.0, 0), (1, 0, 0, 0, 150, 0.0, 10, 0.0, 5, 0.0, 0),
    (0, 0, 1, 1, 11, 0.0, 12, 0.0, 60, 0.0, 1), (0, 0, 1, 1, 3, 0.0, 40, 0.0, 70, 0.0, 1), (0, 0, 1, 0, 1, 0.0, 30, 0.0, 45, 0.0, 1), (0, 0, 1, 0, 4, 0.0, 1, 1.0, 5, 0.0, 1),
    (0, 0, 1, 0, 25, 0.0, 11, 0.0, 90, 0.0, 1), (0, 0, 1, 0, 160, 0.0, 20, 0.0, 14, 0.0, 1), (0, 0, 1, 0, 45, 0.15, 50, 0.0, 30, 0.0, 1), (0, 0, 1, 0, 20, 0.4, 60, 0.0, 50, 0.0, 1),
    (0, 0, 1, 0, 2, 0.0, 2, 0.0, 2, 0.0, 1), (0, 0, 1, 0, 12, 0.0, 60, 0.0, 15, 0.0, 1), (0, 0, 1, 0, 3, 1.0, 80, 0.0, 70, 0.0, 1), (0, 0, 1, 0, 8, 1.0, 90, 0.1, 40, 0.0, 1),
    (0, 0, 0, 0, 1, 1.0, 0, 0.0, 1, 1.0, 0), (0, 0, 0, 0, 3, 1.0, 1, 1.0, 2, 1.0, 0), (0, 0, 0, 0, 8, 0.9, 2, 1.0, 3, 1.0, 0), (0, 0, 0, 0, 20, 0.8, 30, 0.0, 2, 1.0, 0),
    (0, 0, 0, 0, 2, 0.0, 1, 1.0, 1, 1.0, 0), (0, 0, 0, 0, 4, 0.0, 3, 1.0, 2, 0.0, 0), (0, 0, 0, 0, 5, 0.0, 2, 0.0, 3, 0.0, 0), (0, 0, 0, 0, 6, 0.1, 4, 0.5, 0, 0.0, 0),
    (0, 0, 0, 0, 40, 0.0, 30, 0.0, 50, 0.0, 1), (0, 0, 0, 0, 90, 0.05, 2, 1.0, 60, 0.0, 1), (0, 0, 0, 0, 25, 0.0, 70, 0.0, 5, 0.0, 1), (0, 0, 0, 0, 16, 0.0, 40, 0.0, 35, 0.1, 1),
    (0, 0, 0, 0, 60, 0.2, 80, 0.0, 30, 0.0, 1), (0, 0, 0, 0, 7, 0.0, 60, 0.0, 55, 0.0, 1), (0, 0, 0, 0, 3, 0.0, 50, 0.0, 70, 0.0, 1), (0, 0, 0, 1, 7, 0.0, 3, 1.0, 60, 0.0, 1),
    (0, 0, 0, 1, 4, 0.0, 50, 0.0, 45, 0.0, 1), (0, 0, 0, 1, 2, 0.0, 2, 1.0, 2, 1.0, 0), (0, 0, 0, 0, 30, 0.7, 5, 1.0, 6, 1.0, 0), (0, 0, 0, 0, 18, 0.0, 3, 0.0, 40, 0.0, 1),
    (0, 0, 0, 0, 61, 0.0, 0, 0.0, 0, 0.0, 1), (0, 0, 0, 0, 20, 0.0, 0, 0.0, 0, 0.0, 1), (0, 0, 0, 0, 35, 0.1, 3, 1.0, 2, 1.0, 1), (0, 0, 0, 0, 2, 0.0, 0, 0.0, 0, 0.0, 0),
    (0, 0, 1, 0, 40, 0.0, 4, 1.0, 35, 0.0, 1), (0, 0, 1, 1, 5, 0.0, 4, 1.0, 40, 0.0, 1), (0, 0, 1, 0, 60, 0.0, 40, 0.0, 6, 0.5, 1), (0, 0, 0, 0, 50, 0.0, 4, 1.0, 45, 0.0, 1),
    (0, 0, 0, 0, 2, 1.0, 1, 1.0, 40, 0.0, 0), (0, 0, 0, 0, 6, 1.0, 2, 1.0, 80, 0.0, 0), (0, 0, 0, 0, 9, 0.8, 0, 0.0, 120, 0.0, 0), (0, 0, 0, 0, 1, 1.0, 60, 0.0, 70, 0.0, 0),
    (0, 1, 0, 0, 17, 0.0, 1, 1.0, 11, 0.0, 0), (0, 1, 0, 0, 8, 0.0, 40, 0.0, 40, 0.0, 0), (0, 1, 0, 0, 1, 0.0, 60, 0.0, 0, 0.0, 0), (0, 1, 0, 0, 3, 1.0, 2, 1.0, 2, 1.0, 0),
    (0, 1, 0, 0, 12, 0.5, 30, 0.0, 60, 0.0, 0), (0, 1, 1, 0, 8, 0.0, 80, 0.0, 70, 0.0, 0), (0, 1, 1, 0, 15, 0.1, 60, 0.0, 90, 0.0, 0), (0, 1, 0, 1, 2, 0.0, 1, 1.0, 9, 0.0, 0),
    (0, 1, 0, 0, 22, 0.1, 5, 0.5, 3, 1.0, 0), (0, 1, 0, 0, 30, 0.8, 20, 0.9, 15, 1.0, 0), (0, 1, 0, 0, 40, 0.0, 40, 0.0, 40, 0.0, 1), (0, 1, 0, 0, 60, 0.0, 5, 0.0, 70, 0.0, 1),
    (0, 1, 0, 0, 90, 0.05, 60, 0.0, 1, 1.0, 1), (0, 1, 0, 0, 34, 0.0, 1, 1.0, 36, 0.0, 1), (0, 1, 0, 0, 120, 0.1, 2, 1.0, 80, 0.0, 1), (0, 1, 0, 1, 6, 0.0, 2, 1.0, 55, 0.0, 1),
    (0, 1, 0, 1, 5, 0.0, 70, 0.0, 60, 0.0, 1), (0, 1, 0, 0, 38, 0.0, 34, 0.0, 0, 0.0, 1), (0, 1, 1, 0, 70, 0.0, 60, 0.0, 50, 0.0, 1), (1, 0, 0, 0, 1, 1.0, 0, 0.0, 1, 1.0, 0),
    (1, 0, 0, 0, 1, 1.0, 1, 1.0, 12, 0.0, 0), (1, 0, 0, 0, 12, 0.0, 1, 1.0, 8, 0.0, 0), (1, 0, 0, 0, 13, 0.0, 1, 1.0, 8, 0.0, 0), (0, 0, 1, 1, 8, 0.0, 12, 0.0, 8, 0.0, 1),
    (0, 0, 1, 0, 8, 0.0, 8, 0.0, 102, 0.0, 1), (0, 0, 1, 0, 1, 0.0, 14, 0.0, 10, 0.0, 1), (0, 0, 1, 0, 102, 0.0, 8, 0.0, 63, 0.0, 1), (0, 0, 1, 0, 10, 0.0, 1, 0.0, 56, 0.0, 1),
    (0, 0, 1, 0, 16, 0.0, 86, 0.0, 15, 0.0, 1), (1, 0, 0, 0, 15, 0.0, 16, 0.0, 0, 0.0, 0), (1, 0, 0, 0, 13, 0.0, 1, 0.0, 0, 0.0, 0),
    (0, 0, 1, 0, 1, 0.0, 1, 0.0, 1, 0.0, 1), (0, 0, 1, 0, 1, 0.0, 0, 0.0, 1, 0.0, 1), (0, 0, 1, 0, 1, 0.0, 1, 0.0, 0, 0.0, 1), (0, 0, 1, 0, 1, 0.0, 1, 1.0, 1, 0.0, 1), (0, 0, 1, 0, 1, 0.0, 1, 0.0, 1, 1.0, 1),
    (0, 0, 1, 0, 100, 0.0, 50, 0.0, 3, 0.0, 1), (0, 0, 1, 0, 30, 0.0, 40, 0.0, 3, 0.0, 1), (0, 0, 1, 0, 6, 0.0, 40, 0.0, 3, 0.0, 1), (0, 0, 0, 0, 60, 0.0, 40, 0.0, 3, 0.0, 1), (0, 0, 0, 0, 30, 0.0, 60, 0.0, 3, 0.0, 1),
]

#: Labelled blocks outside of articles and side elements that end as a sentence does, in the same columns; none of them is text without that end.
SENTENCES = [
    (0, 0, 0, 0, 3, 0.0, 0, 0.0, 3, 0.0, 1), (0, 0, 0, 0, 3, 0.0, 3, 0.0, 0, 0.0, 1), (0, 0, 0, 0, 5, 0.0, 3, 0.0, 6, 0.0, 1), (0, 0, 0, 0, 2, 0.0, 8, 0.0, 4, 0.0, 1), (0, 0, 0, 0, 4, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 0, 0, 0, 6, 0.0, 2, 0.0, 3, 0.1, 1), (0, 0, 0, 0, 8, 0.0, 1, 0.0, 2, 0.0, 1), (0, 0, 0, 0, 4, 0.0, 1, 1.0, 1, 1.0, 0), (0, 0, 0, 0, 6, 0.0, 2, 1.0, 2, 1.0, 0), (0, 0, 0, 0, 5, 0.0, 1, 1.0, 0, 0.0, 0),
    (0, 0, 0, 0, 4, 0.0, 3, 1.0, 2, 0.0, 0), (0, 0, 0, 0, 6, 0.1, 4, 0.5, 0, 0.0, 0), (0, 0, 0, 0, 2, 0.0, 1, 1.0, 1, 1.0, 0), (0, 0, 0, 0, 3, 0.9, 2, 1.0, 3, 1.0, 0), (0, 0, 0, 0, 20, 0.8, 30, 0.0, 2, 1.0, 0),
]
_SENTENCE = re.compile(r"[.!?\u2026\u3002\uff01\uff1f][\"')\]\u00bb\u201d\u2019]*$")


def labelled() -> np.ndarray:
    """The table with the feature `sentence`: of LABELLED, short lines without links that stand alone are no sentences, and of all other rows there are both forms."""
    bare = [(*r[:-1], 0, r[-1]) for r in LABELLED]
    both = [(*r[:-1], 1, r[-1]) for r in LABELLED if r[-1] or r[0] or r[1] or r[5] >= 0.5]
    return np.array([*bare, *both, *((*r[:-1], 1, r[-1]) for r in SENTENCES), *((*r[:-1], 0, 0) for r in SENTENCES)], float)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 12) -> tuple:
    """A decision tree: (feature, threshold, tree where the feature is at most it, tree elsewhere), or a label; splits have the least Gini impurity."""
    if depth == 0 or len(set(labels.tolist())) < 2:
        return (int(labels.mean() >= 0.5),)
    best = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for t in (values[:-1] + values[1:]) / 2:
            low = rows[:, f] <= t
            impurity = sum(m.sum() * labels[m].mean() * (1 - labels[m].mean()) for m in (low, ~low))
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, f, t, low
    if best is None:
        return (int(labels.mean() >= 0.5),)
    _, f, t, low = best
    return f, float(t), grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1)


def default_tree() -> tuple:
    table = labelled()
    return grow(table[:, :-1], table[:, -1])


def classify(tree: tuple, block: tuple) -> int:
    while len(tree) > 1:
        tree = tree[2] if block[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def _given(attributes: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}


def _hidden(given: dict[str, str]) -> bool:
    return "hidden" in given or given.get("aria-hidden") == "true" or bool(_HIDDEN.search(given.get("style", "")))


def blocks(page: str) -> list[tuple[str, float, int, int, int, int]]:
    """The non-empty text blocks of a page, in order: (text, link density, side, odd, main, heading)."""
    out, text, linked = [], [], []
    # name, what the element adds to side, odd and main, and what becomes of side at an article or main element in it
    stack: list[tuple[str, int, int, int, str]] = []
    side = odd = main = heading = anchor = 0
    at, ends = 0, len(page)

    def close():
        if text:
            own = " ".join(html.unescape("".join(text)).split())
            if own:
                n = len(own.split(" "))
                out.append((own, min(1.0, len(html.unescape("".join(linked)).split()) / n), int(side > 0), int(odd > 0), int(main > 0), int(heading > 0)))
            text.clear()
            linked.clear()

    def say(part: str):
        if part:
            text.append(part)
            if anchor:
                linked.append(part)

    def push(name: str, s: int = 0, o: int = 0, a: int = 0, keeps: str = ""):
        nonlocal side, odd, main
        stack.append((name, s, o, a, keeps))
        side, odd, main = side + s, odd + o, main + a

    def pop(k: int):
        nonlocal side, odd, main, heading
        for name, s, o, a, _ in stack[k:]:
            side, odd, main = side - s, odd - o, main - a
            heading -= name in ("h1", "h2", "h3", "h4", "h5", "h6")
        del stack[k:]

    while at < ends:
        m = _TOKEN.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                say(html.escape(m[0][9:-3]))
            continue
        if m[1]:
            if name == "a":
                anchor = max(0, anchor - 1)
                if linked:
                    linked.append(" ")
            if name == "br":
                say(" ")
            elif name not in _INLINE or any(x[0] == name for x in stack):
                if name not in _INLINE or next(x for x in reversed(stack) if x[0] == name)[1]:
                    close()
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        pop(k)
                        break
            continue
        if name in _SILENT:
            if not m[3].endswith("/"):
                shut = re.compile(rf"</{re.escape(name)}\s*>" + (r"|(?=<body\b)" if name == "head" else ""), re.IGNORECASE).search(page, at)
                at = shut.end() if shut else ends
            if name not in ("svg", "button", "math"):
                close()
            continue
        if name == "a":
            anchor += 1
        if name in ("br", "wbr"):
            say(" " if name == "br" else "")
            continue
        given = _given(m[3]) if m[3] else {}
        named = f"{given.get('class', '')} {given.get('id', '')} {given.get('role', '')}"
        if name in _INLINE:
            apart = name not in _VOID and bool(given) and (_hidden(given) or _named(_LAYOUT_NAME.sub(" ", named))[2])
            if apart:
                close()
                push(name, 1, keeps="all")
            elif any(x[0] == name for x in stack):
                push(name)  # so that its end isn't taken for that of the one around it
            continue
        close()
        if name in _VOID or m[3].endswith("/"):
            continue
        if stack and stack[-1][0] == "p" and name != "p" or stack and stack[-1][0] == name and name in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
            pop(len(stack) - 1)
        hidden = _hidden(given)
        by_name, may, _, never = _named(_LAYOUT_NAME.sub(" ", named))
        s = int((name in _SIDE and not (name == "header" and main)) or by_name or hidden)
        o = int(name in _ODD or may)
        a = int(name in ("article", "main") or bool(_MAIN_NAME.search(named)))
        keeps = ""
        if name in ("body", "html", "article", "main"):
            s = o = 0
            if name in ("article", "main") and not any(x[4] == "all" or x[4] == name for x in stack):
                s, o = -side, -odd
        elif name in _NEVER or hidden:
            keeps = "all"
        elif (by_name or o) and (never or any(x[0] in ("article", "main") for x in stack)):
            keeps = "article"
        push(name, s, o, a, keeps)
        heading += name in ("h1", "h2", "h3", "h4", "h5", "h6")
    close()
    return out


def main_text(page: str, tree: tuple) -> str:
    found = blocks(page)
    words = [0, *(len(b[0].split(" ")) for b in found), 0]
    links = [0.0, *(b[1] for b in found), 0.0]
    return " ".join(b[0] for i, b in enumerate(found, 1) if classify(tree, (*b[2:], words[i], links[i], words[i - 1], links[i - 1], words[i + 1], links[i + 1], int(bool(_SENTENCE.search(b[0]))))))


def extract(pages: DataFrame, tree: tuple | None = None) -> DataFrame:
    """Adds text, the main text, to the rows of `pages` and drops html.

    A null or empty page has an empty text; a very long one is worked on whole. Other columns, null or not, repeated rows and an empty table stay as they
    are; a column named text is replaced.
    """
    tree = tree or default_tree()
    pages = pages.drop("text")
    kept = [c for c in pages.columns if c != "html"]

    def run(batches):
        for batch in batches:
            found = pa.array([main_text(x.as_py() or "", tree) for x in batch.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), found], names=[*kept, "text"])

    return pages.select(*(f"`{c}`" for c in kept), "html").mapInArrow(run, StructType([*(pages.schema[c] for c in kept), StructField("text", StringType())]))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
