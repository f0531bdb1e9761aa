"""Main text of web pages: flat text blocks, judged by a decision tree on themselves and their neighbours.

A page is cut into flat blocks at block-level tags.  A block has its word count and link density
(share of words inside links), the same two figures of the blocks before and after it, and the
strongest cue of the containers it stands in.  A small tree, trained on ``LABELLED``, keeps or
drops each block; a page's text is the kept blocks in order, joined by one space.

Scripts, styles, comments, ``<head>`` and form controls never become blocks.  Only elements of raw
text (``RAW``) and comments run to the end of the page if they are not closed; other unseen elements
end with their parent, a head also before the first thing that can't stand in it.  Character
references are decoded after the tags are cut off, white space inside a block becomes one space.

Defined results: NULL or empty html, or a page without kept blocks, has the text ``''``; tags that
are never closed end with their container, an unclosed comment or script runs to the end of the
page; repeated pages each keep their row; other columns are kept, ``text`` and ``n_chars`` replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame

from statflow.llm.common import pass_through, schema_with

# HTML element names by what they do.
RAW = "script style noscript title textarea iframe"
UNSEEN = "template head svg math object select button option canvas"
#: What may stand in a head; anything else ends it, as text does.
HEAD = "base basefont bgsound head html link meta noframes noscript script style template title"
#: Unseen elements that an opening tag ends.
ENDS = {"option": {"option"}, "button": {"button"}, "select": {"option", "select"}}
INLINE = (
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr"
)
CONTAINERS = "nav header footer aside form div section article main ul ol table blockquote body dialog menu fieldset details"
# Names and words in class, id or role that mark what a container is for.
SIDE_TAGS = "nav footer aside form menu dialog fieldset"
SIDE_WORDS = (
    "ad ads advert adverts advertisement banner banners sponsor sponsored promo promotion menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar widget related recommended comment comments respond reply disqus discussion cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login share sharing "
    "social footer copyright legal masthead topbar toolbar pagination pager skip contentinfo complementary search form"
)
COMMENT_WORDS = "comment comments respond reply replies disqus discussion"
MAIN_TAGS = "article main"
MAIN_WORDS = "article content post entry story main"

_SIDE_TAGS, _SIDE_WORDS = frozenset(SIDE_TAGS.split()), frozenset(SIDE_WORDS.split())
_COMMENT_WORDS = frozenset(COMMENT_WORDS.split())
_MAIN_TAGS, _MAIN_WORDS = frozenset(MAIN_TAGS.split()), frozenset(MAIN_WORDS.split())
_INLINE, _CONTAINERS = frozenset(INLINE.split()), frozenset(CONTAINERS.split())
_HEAD = frozenset(HEAD.split())
_PIECES = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<unseen>" + "|".join(RAW.split()) + r")(?=[\s/>])[^>]*(?:(?<=/)>|>.*?(?:</(?P=unseen)\s*>|\Z)|\Z)"
    r"|<(?P<dark>" + "|".join(UNSEEN.split()) + r")(?=[\s/>])(?:(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")

#: Cues of the innermost telling container; reader comments stay comments whatever they contain.
COMMENT, SIDE, NONE, MAIN = -2, -1, 0, 1

# The labelled table. Words, link density, then both of the block before and of the
# one after, cue, and whether the block belongs to the main text.
LABELLED = (
    (1, 1.0, 0, 0.0, 1, 1.0, SIDE, False), (1, 1.0, 1, 1.0, 1, 1.0, SIDE, False), (2, 1.0, 1, 1.0, 14, 0.0, SIDE, False),
    (14, 0.0, 1, 1.0, 9, 0.0, SIDE, False), (5, 0.0, 2, 1.0, 12, 0.0, SIDE, False), (30, 0.1, 40, 0.0, 0, 0.0, SIDE, False),
    (12, 0.0, 80, 0.0, 0, 0.0, SIDE, False), (6, 0.5, 60, 0.0, 3, 1.0, SIDE, False), (45, 0.0, 20, 0.0, 33, 0.0, SIDE, False),
    (120, 0.0, 7, 0.0, 45, 0.0, SIDE, False), (3, 0.0, 1, 0.0, 2, 0.0, SIDE, False), (25, 0.3, 90, 0.0, 8, 0.9, SIDE, False),
    (9, 0.0, 14, 0.0, 30, 0.0, MAIN, True), (30, 0.0, 9, 0.0, 110, 0.0, MAIN, True), (110, 0.0, 30, 0.0, 1, 0.0, MAIN, True),
    (1, 0.0, 110, 0.0, 70, 0.0, MAIN, True), (2, 0.0, 1, 1.0, 2, 0.0, MAIN, True), (70, 0.1, 2, 0.0, 12, 0.0, MAIN, True),
    (40, 0.4, 55, 0.0, 12, 0.2, MAIN, True), (3, 0.0, 14, 0.0, 12, 0.0, MAIN, True), (1, 0.0, 14, 0.0, 12, 0.0, MAIN, True),
    (4, 1.0, 35, 0.0, 60, 0.0, MAIN, True), (1, 1.0, 22, 0.0, 31, 0.0, MAIN, True), (12, 0.9, 45, 0.0, 28, 0.0, MAIN, True),
    (2, 1.0, 3, 1.0, 4, 1.0, MAIN, False), (1, 1.0, 1, 1.0, 2, 1.0, MAIN, False), (5, 1.0, 2, 1.0, 1, 1.0, MAIN, False),
    (3, 0.33, 2, 0.0, 2, 0.5, MAIN, True), (6, 0.0, 20, 0.0, 3, 1.0, MAIN, True), (1, 0.0, 12, 0.0, 1, 1.0, MAIN, True),
    (12, 0.1, 30, 0.0, 4, 0.9, MAIN, True), (2, 0.5, 6, 0.3, 5, 1.0, MAIN, True), (18, 0.2, 2, 1.0, 3, 0.8, MAIN, True),
    (7, 0.0, 9, 0.0, 12, 0.0, SIDE, False), (40, 0.0, 9, 0.0, 35, 0.0, COMMENT, False), (4, 0.0, 60, 0.0, 10, 0.0, COMMENT, False),
    (16, 0.0, 4, 0.0, 22, 0.0, COMMENT, False), (2, 0.0, 5, 0.0, 30, 0.0, SIDE, False), (10, 0.0, 2, 0.0, 60, 0.1, SIDE, False),
    (60, 0.0, 20, 0.0, 45, 0.0, NONE, True), (35, 0.1, 60, 0.0, 5, 0.0, NONE, True), (20, 0.0, 50, 0.0, 30, 0.0, NONE, True),
    (7, 0.0, 2, 1.0, 45, 0.0, NONE, True), (8, 0.0, 35, 0.0, 40, 0.1, NONE, True), (16, 0.2, 25, 0.0, 22, 0.0, NONE, True),
    (90, 0.0, 0, 0.0, 0, 0.0, NONE, True), (12, 0.0, 0, 0.0, 0, 0.0, NONE, True), (28, 0.0, 1, 1.0, 4, 1.0, NONE, True),
    (2, 1.0, 25, 0.0, 0, 0.0, NONE, False), (3, 1.0, 30, 0.0, 5, 0.0, NONE, False), (2, 1.0, 40, 0.0, 12, 0.2, NONE, False),
    (6, 0.9, 20, 0.0, 0, 0.0, NONE, False), (1, 1.0, 0, 0.0, 14, 0.0, NONE, False), (4, 0.8, 3, 0.0, 2, 0.0, NONE, False),
    (1, 1.0, 1, 1.0, 1, 1.0, NONE, False), (3, 1.0, 0, 0.0, 2, 1.0, NONE, False), (2, 1.0, 60, 0.0, 2, 1.0, NONE, False),
    (8, 0.9, 3, 1.0, 5, 0.8, NONE, False), (15, 0.8, 30, 0.0, 6, 1.0, NONE, False), (4, 0.6, 1, 1.0, 6, 0.7, NONE, False),
    (4, 0.0, 1, 1.0, 2, 1.0, NONE, False), (3, 0.0, 5, 0.9, 4, 1.0, NONE, False), (2, 0.0, 2, 1.0, 3, 0.8, NONE, False),
)


@cache
def tree():
    """The tree grown on ``LABELLED`` by Gini impurity."""
    return _grow([row[:-1] for row in LABELLED], [row[-1] for row in LABELLED])


def _grow(rows: list[tuple], labels: list[bool], least: int = 2):
    share = sum(labels) / len(labels)
    if share in (0, 1) or len(rows) < 2 * least:
        return share >= 0.5
    best = None
    for feature in range(len(rows[0])):
        for low, high in pairwise(sorted({row[feature] for row in rows})):
            cut = (low + high) / 2
            left = [label for row, label in zip(rows, labels) if row[feature] <= cut]
            if least <= len(left) <= len(rows) - least:
                right = sum(labels) - sum(left)
                sides = ((sum(left), len(left)), (right, len(rows) - len(left)))
                loss = sum(n - (k * k + (n - k) ** 2) / n for k, n in sides)
                best = min(best, (loss, feature, cut)) if best else (loss, feature, cut)
    if best is None:
        return share >= 0.5
    _, feature, cut = best
    lower = [row[feature] <= cut for row in rows]
    parts = [([r for r, s in zip(rows, lower) if s is side], [y for y, s in zip(labels, lower) if s is side]) for side in (True, False)]
    return feature, cut, _grow(*parts[0], least), _grow(*parts[1], least)


def decide(node, row: tuple) -> bool:
    while not isinstance(node, bool):
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return node


def _cue(tag: str, rest: str, around: int) -> int:
    """The cue inside an element that opens with ``tag`` and attributes ``rest`` in one with cue ``around``."""
    if around == COMMENT:
        return COMMENT
    words = set()
    if rest and tag != "body":
        words = {word for found in _NAMES.findall(rest) for word in _WORDS.findall("".join(found).lower())}
    if words & _COMMENT_WORDS:
        return COMMENT
    if tag in _SIDE_TAGS or words & _SIDE_WORDS or (tag == "header" and around != MAIN):
        return SIDE
    # an article also ends what was opened before it and never closed
    if tag in _MAIN_TAGS or (around != SIDE and words & _MAIN_WORDS):
        return MAIN
    return around


def _begun(piece: re.Match) -> str:
    """The element that a piece opens, or one that may stand anywhere."""
    return (piece["unseen"] or piece["dark"] or (not piece["close"] and piece["tag"]) or "html").lower()


def flat_blocks(page: str) -> list[tuple[str, int, float, int]]:
    """(text, words, link density, cue) of each block with text, in page order."""
    found, pieces, linked, stack, cue, now, link = [], [], [], [], NONE, NONE, 0
    # unseen elements around, tags that were opened outside and inside of them
    dark, outer, inner = [], Counter(), Counter()

    def close() -> None:
        text = " ".join(entities.unescape("".join(pieces)).split())
        if text:
            words = text.count(" ") + 1
            inside = len(entities.unescape(" ".join(linked)).split())
            found.append((text, words, min(1.0, inside / words), now))
        pieces.clear()
        linked.clear()

    for piece in _PIECES.finditer(page):
        text = piece["text"]
        if dark == ["head"] and (not text.isspace() if text is not None else _begun(piece) not in _HEAD):
            dark.clear()
        if text is not None:
            if dark:
                continue
            pieces.append(text)
            if link:
                linked.append(text)
            continue
        if tag := (piece["dark"] or "").lower():
            while dark and dark[-1] in ENDS.get(tag, ()):
                dark.pop()
            if not piece[0].endswith("/>"):
                dark.append(tag)
            continue
        tag = (piece["tag"] or "").lower()
        if not tag:
            continue
        if dark:
            if not piece["close"]:
                inner[tag] += not piece["rest"].endswith("/")
                continue
            if tag in dark or inner[tag] or not outer[tag]:
                if tag in dark:
                    while dark.pop() != tag:
                        pass
                elif inner[tag]:
                    inner[tag] -= 1
                if not dark:
                    inner.clear()
                continue
            dark.clear()
            inner.clear()
        if not piece["close"]:
            outer[tag] += not piece["rest"].endswith("/")
        elif outer[tag]:
            outer[tag] -= 1
        if tag in _INLINE:
            if tag == "a":
                link = 0 if piece["close"] else 1
            continue
        close()
        if tag not in _CONTAINERS:
            # a paragraph or item speaks for itself only
            now = cue if piece["close"] else _cue(tag, piece["rest"], cue)
            continue
        link = 0
        if not piece["close"]:
            if not piece["rest"].endswith("/"):
                stack.append((tag, cue))
                cue = _cue(tag, piece["rest"], cue)
        elif any(tag == opened for opened, _ in stack):
            while stack:
                opened, cue = stack.pop()
                if opened == tag:
                    break
        now = cue
    close()
    return found


def main_text(page: str | None) -> str:
    blocks = flat_blocks(page) if page else []
    node, kept = tree(), []
    for at, (text, words, density, cue) in enumerate(blocks):
        before = blocks[at - 1][1:3] if at else (0, 0.0)
        after = blocks[at + 1][1:3] if at + 1 < len(blocks) else (0, 0.0)
        if decide(node, (words, density, *before, *after, cue)):
            kept.append(text)
    return " ".join(kept)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` without ``column``, with ``text`` and its length in code points, ``n_chars``."""
    names = [name for name in pages.columns if name not in (column, "text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch[column]]
            yield pass_through(batch, names, text=pa.array(texts, pa.string()), n_chars=pa.array([len(t) for t in texts], pa.int64()))

    return pages.select(*names, column).mapInArrow(run, schema_with(pages.select(*names), "text string, n_chars long"))
