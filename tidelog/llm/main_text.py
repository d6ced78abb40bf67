"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with its path of block tags from the root.  Text length
and punctuation are aggregated per path, divided by the number of nodes on it, smoothed along
the page and fused; paths above a threshold of the page hold content.  Content nodes then name
their containers, as many as hold them all, whose other blocks (headings, short paragraphs,
lists) belong to the text.

Scripts, controls, menus, footers and hidden parts take no part.  A part whose class, role or tag
only hints that it is not content (forms, adverts, comments ...) stands trial by the same ratios:
it stays if it holds most of the page's dense text, or the page's article, and goes otherwise.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidelog.llm.common import batches_of_texts

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre
section summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is never markup, up to their own end tag.
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
# Elements that hold no main text, whatever is in them.
OUT = frozenset("""aside audio button canvas datalist dialog footer head iframe input label map menu nav
noembed noframes noscript object optgroup option select script style svg template textarea title video""".split())
# Elements that hold main text only if their ratios say so.
DOUBTED = frozenset("fieldset form".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
                  "toolbar tooltip".split())
HINTS = frozenset("""ad ads adv advert adverts advertisement advertising advertorial alert announcement banner
breadcrumb breadcrumbs byline comment comments consent cookie cookies disclaimer discussion disqus footer footnav form
gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager
pagination popup promo promos promotion recommended related remark remarks replies reply responses rss search share
sharing sidebar signup skip social sponsor sponsored sponsors subscribe subscription thread threads toolbar widget
widgets""".split())
# Hints of what readers say.  It is dense too, so it stays only where nothing else is.
SPEECH = frozenset("""comment comments discussion disqus remark remarks replies reply responses thread
threads""".split())
# Words that may follow a hint ("comment-list") without changing what it says.
PLACE = frozenset("area block body box container content form group inner item items list panel section thread wrap "
                  "wrapper".split())
# Words that may stand before a hint ("site-header") without changing what it says.
WHOSE = frozenset("article blog global left main mobile page post reader right site top user".split())
# Elements that are content themselves, whatever their class.
KEPT = frozenset("html body main".split())
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"),
             "tfoot": ("tbody", "thead", "tr", "td", "th")}
SCOPES = frozenset("html body table ul ol dl article section main div td th li aside nav footer header form".split())
_TAG = re.compile(r"""<!--(?:>|->|.*?(?:-->|--!>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'=/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PART = re.compile(r"[a-z]+|\d+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：«»\"'()-]")
SMOOTH = np.array([0.05, 0.25, 0.4, 0.25, 0.05])
# A path is content if its fused ratio reaches this share of the page's spread.
THRESHOLD = 0.5
# What an element says about holding main text.
CLEAR, HINTED, SPOKEN, NEVER = range(4)
# Share of the content's text, outside the containers already found, that a container holds.
CONTAINED = 0.8


@dataclass
class Element:
    tag: str
    label: str
    says: int
    number: int


@dataclass
class Block:
    """Text between two block boundaries, and the elements around it."""

    path: tuple[str, ...]
    inside: tuple[tuple[int, str], ...]
    # The elements around it that may not be content: (number, what they say).
    doubts: tuple[tuple[int, int], ...] = ()
    parts: list[str] = field(default_factory=list)
    text: str = ""
    linked: int = 0


def _says(tag: str, attributes: str, within_article: bool) -> tuple[int, str]:
    """What an element says about holding main text; its label for tag paths."""
    if tag in OUT or (tag == "header" and not within_article):
        return NEVER, tag
    says = HINTED if tag in DOUBTED else CLEAR
    if not attributes or attributes.isspace():
        return says, tag
    named = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        named.setdefault(name.lower(), a or b or c)
    if tag in KEPT:
        return CLEAR, tag
    if "hidden" in named or named.get("aria-hidden", "").lower() == "true" or re.search(
            r"display\s*:\s*none|visibility\s*:\s*hidden", named.get("style", ""), re.I):
        return NEVER, tag
    classes = named.get("class", "").split()
    for value in [*classes, *named.get("id", "").split()]:
        words = _PART.findall(_CAMEL.sub("-", value).lower())
        while len(words) > 1 and words[0] in WHOSE:
            words = words[1:]
        if words and words[0] in HINTS:
            whole = all(w in HINTS or w in PLACE or w.isdigit() for w in words)
            # An article with a hint among other words is an article.
            if whole or tag != "article":
                says = max(says, SPOKEN if whole and words[0] in SPEECH else HINTED)
    if named.get("role", "").lower() in ROLES:
        says = max(says, HINTED)
    return says, f"{tag}.{'.'.join(sorted(classes))}" if classes else tag


def blocks(page: str) -> list[Block]:
    """The blocks of text of a page that may be content, doubted ones included, in page order."""
    found: list[Block] = []
    stack: list[Element] = []
    out = links = count = 0
    current: Block | None = None
    at, end = 0, len(page)
    last = page.rfind(">") + 1
    # Open elements by tag, so that a stray end tag costs nothing.
    opened: dict[str, int] = {}

    def pop_to(depth: int) -> None:
        nonlocal out
        while len(stack) > depth:
            gone = stack.pop()
            out -= gone.says == NEVER
            opened[gone.tag] -= 1

    def add(text: str) -> None:
        nonlocal current
        if out or not text:
            return
        if current is None:
            current = Block(tuple(e.label for e in stack if e.tag in BLOCKS), tuple((e.number, e.tag) for e in stack),
                            tuple((e.number, e.says) for e in stack if e.says))
            found.append(current)
        current.parts.append(text)
        if links:
            current.linked += len(text)

    while at < end:
        # Behind the last ">" only a comment can still open.
        tag = _TAG.search(page, at) if at < last or "<!" in page[at:] else None
        if tag is None:
            add(page[at:])
            break
        add(page[at:tag.start()])
        at = tag.end()
        if tag[0].startswith("<![CDATA["):
            continue
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        attributes = (tag[3] if tag[2] else tag[6]) or ""
        block = name in BLOCKS
        if tag[1] or tag[4]:
            if block:
                current = None
            if name == "a":
                links = max(0, links - 1)
            elif opened.get(name):
                depth = len(stack) - 1
                while stack[depth].tag != name:
                    depth -= 1
                if stack[depth].says in (HINTED, SPOKEN):
                    current = None
                pop_to(depth)
            continue
        if name == "br":
            add(" ")
            continue
        if block:
            current = None
            links = 0
            if opened.get("p"):
                depth = len(stack) - 1
                while depth >= 0 and stack[depth].tag != "p" and stack[depth].tag not in SCOPES:
                    depth -= 1
                if depth >= 0 and stack[depth].tag == "p":
                    pop_to(depth)
            if name in CLOSED_BY:
                depth = len(stack) - 1
                stop = None
                while depth >= 0 and (stack[depth].tag not in SCOPES or stack[depth].tag in CLOSED_BY[name]):
                    if stack[depth].tag in CLOSED_BY[name]:
                        stop = depth
                    depth -= 1
                if stop is not None:
                    pop_to(stop)
        if name in VOID or attributes.rstrip().endswith("/") and not block:
            continue
        if name == "a":
            links += 1
            continue
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if block or name in OUT or "class" in attributes or "id" in attributes or "hidden" in attributes:
            says, label = _says(name, attributes, bool(opened.get("article") or opened.get("main")))
            if not block and not says:
                continue
            count += 1
            current = None if says and says != NEVER else current
            stack.append(Element(name, label, says, count))
            opened[name] = opened.get(name, 0) + 1
            out += says == NEVER
    for b in found:
        b.text = " ".join(entities.unescape("".join(b.parts)).split())
    return [b for b in found if b.text]


def path_ratios(found: list[Block]) -> np.ndarray:
    """For each block the smoothed, fused ratio of its tag path: text and punctuation per node."""
    paths: dict[tuple[str, ...], int] = {}
    which = np.array([paths.setdefault(b.path, len(paths)) for b in found])
    nodes = np.bincount(which)
    text = np.bincount(which, [len(b.text) - min(b.linked, len(b.text)) for b in found]) / nodes
    marks = np.bincount(which, [len(_PUNCTUATION.findall(b.text)) for b in found]) / nodes
    fused = np.sqrt(text * (1 + marks))[which]
    padded = np.pad(fused, len(SMOOTH) // 2, mode="edge")
    smooth = np.convolve(padded, SMOOTH, mode="valid")
    # One value a path again: the mean over its nodes.
    return (np.bincount(which, smooth) / nodes)[which]


def _content(found: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    """The ratios of the blocks' paths, and which of them are over the page's threshold."""
    ratios = path_ratios(found)
    return ratios, ratios >= THRESHOLD * ratios.std()


def tried(found: list[Block]) -> list[Block]:
    """The blocks without those in doubted elements that the ratios do not speak for.

    The heaviest element comes first.  One that holds more dense text than all blocks free of
    doubt is freed, and so is one around an article with dense text, unless there is text in an
    article elsewhere; readers' speech is freed only if no dense text is free of doubt.
    """
    if not any(b.doubts for b in found):
        return found
    _, dense = _content(found)
    weights = [len(b.text) if d else 0 for b, d in zip(found, dense.tolist())]
    members: dict[tuple[int, int], list[int]] = {}
    held: dict[tuple[int, int], int] = {}
    for at, b in enumerate(found):
        for doubt in b.doubts:
            members.setdefault(doubt, []).append(at)
            held[doubt] = held.get(doubt, 0) + weights[at]
    open_ = [len(b.doubts) for b in found]
    articles = [[number for number, tag in b.inside if tag in ("article", "main")] for b in found]
    free = sum(w for w, o in zip(weights, open_) if not o)
    free_articles = {number for a, o in zip(articles, open_) if not o for number in a}
    for doubt in sorted(members, key=lambda d: (-held[d], d)):
        if doubt[1] == SPOKEN:
            stays = not free and held[doubt] > 0
        elif free_articles.difference(articles[members[doubt][0]]):
            stays = False
        else:
            stays = held[doubt] > free or any(
                weights[at] and articles[at] and articles[at][-1] >= doubt[0]
                and all(says == HINTED for _, says in found[at].doubts) for at in members[doubt])
        if stays:
            for at in members[doubt]:
                open_[at] -= 1
                if not open_[at]:
                    free += weights[at]
                    free_articles.update(articles[at])
    return [b for b, o in zip(found, open_) if not o]


def main_text(page: str | None) -> str:
    """The main text of one page; empty if it has none."""
    found = tried(blocks(page or ""))
    if not found:
        return ""
    ratios, content = _content(found)
    lengths = [len(b.text) for b in found]
    inside: set[int] = set()
    around: set[int] = set()
    open_ = content.copy()
    # Of each element, the content blocks in it and the length of those still open.
    within: dict[int, list[int]] = {}
    held: dict[int, int] = {}
    for at in np.flatnonzero(content).tolist():
        for number, _ in found[at].inside:
            within.setdefault(number, []).append(at)
            held[number] = held.get(number, 0) + lengths[at]
    # The best block that is still open names the next container.
    for best in np.lexsort((lengths, ratios))[::-1].tolist():
        # Elements around the block but not around a container found before, from the outermost.
        levels = [e for e in found[best].inside if e[0] not in around]
        if not open_[best] or not levels:
            continue
        # The deepest that holds nearly all open content of its branch, or the article it is in.
        deepest = max(at for at, e in enumerate(levels) if held[e[0]] >= CONTAINED * held[levels[0][0]])
        named = [at for at in range(deepest + 1) if levels[at][1] in ("article", "main")]
        container, _ = levels[max(named) if named else deepest]
        inside.add(container)
        for number, _ in found[best].inside:
            around.add(number)
            if number == container:
                break
        for at in within[container]:
            if open_[at]:
                open_[at] = False
                for number, _ in found[at].inside:
                    held[number] -= lengths[at]
    return " ".join(b.text for at, b in enumerate(found)
                    if content[at] or any(number in inside for number, _ in b.inside))


def extract(pages: DataFrame, html: str = "html", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    Character references are decoded, white space inside a block is one space, blocks are
    joined by one space.  A null or empty page, and one without main text, gives an empty text.
    Markup may be broken.  Repeated rows are each answered; an empty table gives an empty
    result.  A page is worked on in one pass over its characters.
    """
    kind = pages.schema[page_id].dataType.simpleString()

    def run(batches):
        for batch, bodies in batches_of_texts(batches, "html"):
            texts = [main_text(b) for b in bodies]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"), pages[html].alias("html"))
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
