"""Main text of web pages by composite text density.

Every DOM node gets the density of its text: characters per tag, lowered where
links hold much of it, relative to the whole body. The densities of a node's
children are summed; the node with the largest sum is the centre of the content.
The smallest density on its path to the body is the threshold: below every node
that reaches it, the subtree with the largest sum is content too. If the centre
lies in an article or main, the outermost of these is content as a whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# Names of the HTML standard and words that mark page furniture in class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
#: Elements whose content is text up to their end tag; none of it is seen.
RAW = frozenset("script style title textarea iframe noembed noframes".split())
NEVER = frozenset(
    "script style noscript template title iframe object embed canvas svg audio video map nav footer aside button input "
    "select option textarea datalist label dialog menu noembed noframes".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Names that a stretch of a page has for no other reason than to be furniture.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle adbox sponsor sponsored promo promotion nav navbar "
    "navigation menu menus submenu breadcrumb breadcrumbs sidebar aside footer cookie cookies consent gdpr notice notices "
    "notification popup modal overlay comment comments commentlist disqus related recommended recommendations newsletter "
    "subscribe subscription complementary contentinfo hidden".split()
)
#: Names that content has as well, so they stand for furniture only where they do not hold most of the text.
GENERIC = frozenset(
    "banner banners header foot masthead topbar alert discussion reply replies respond share sharing social signup login "
    "signin search form toolbar pagination pager copyright legal disclaimer widget widgets skip dialog".split()
)
#: What follows one of these is not what the stretch is.
ABOUT = frozenset("has have no not with without is".split())
COMMENTS = frozenset("comment comments".split())
#: A start tag of the key ends an open element of these names, up to the nearest of the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")


NAME = re.compile(r"[^\s/>]+")
ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)?\s*(=\s*)?")
BARE = re.compile(r"[^\s>]*")
KEPT = frozenset("class id role hidden aria-hidden style".split())


def _attributes(html: str, at: int) -> tuple[int, dict[str, str]]:
    """Where a start tag ends, whose name ended at ``at``, and the attributes that count; -1 if it never ends."""
    found: dict[str, str] = {}
    while True:
        match = ATTRIBUTE.match(html, at)
        at, name, value = match.end(), match[1], ""
        if match[2]:
            quote = html[at : at + 1]
            if quote in ('"', "'") and quote:
                end = html.find(quote, at + 1)
                if end < 0:
                    return -1, found
                value, at = html[at + 1 : end], end + 1
            else:
                bare = BARE.match(html, at)
                value, at = bare[0], bare.end()
        if name and name.lower() in KEPT:
            found.setdefault(name.lower(), unescape(value))
        if at >= len(html):
            return -1, found
        if html[at] == ">":
            return at + 1, found


class Tree:
    """Nodes in page order; a text run is a node too. Unclosed and stray tags are borne.

    A page is read once: what does not end, such as a tag without its ``>``, reaches to the end of the page, as
    in a browser; of a comment that does not end only the beginning is left out. The open elements' places are
    kept by name, so an end tag that ends nothing costs nothing, however deep the page is.
    """

    def __init__(self, html: str) -> None:
        self.tags, self.parents, self.texts, self.attrs = ["body"], [-1], [""], [{}]
        self.open = [0]
        #: places among the open elements, by name and of all blocks.
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.read(html)

    def read(self, html: str) -> None:
        at, comments = 0, True
        while at < len(html):
            mark = html.find("<", at)
            if mark < 0:
                mark = len(html)
            if mark > at:
                self.add("", unescape(html[at:mark]), {})
            after = html[mark + 1 : mark + 2]
            if after.isascii() and after.isalpha():
                name = NAME.match(html, mark + 1)
                at, attrs = _attributes(html, name.end())
                if at < 0:
                    return
                tag = name[0].lower()
                self.start(tag, attrs)
                if tag in RAW:
                    end = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(html, at)
                    at = end.start() if end else len(html)
            elif after == "/" and html[mark + 2 : mark + 3].isalpha():
                end = html.find(">", mark)
                if end < 0:
                    return
                self.end(NAME.match(html, mark + 2)[0].lower())
                at = end + 1
            elif html.startswith("<!--", mark):
                end = html.find("-->", mark + 2) if comments else -1
                comments = end >= 0
                at = end + 3 if comments else mark + 4
            elif after and after in "!?/":
                end = html.find(">", mark)
                if end < 0:
                    return
                at = end + 1
            else:
                if mark < len(html):
                    self.add("", "<", {})
                at = mark + 1

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in ("html", "head", "body"):
            self.attrs[0] |= {k: v for k, v in attrs.items() if tag == "body" and k in ("class", "id")}
            return
        if tag in BLOCK and tag != "br":
            self.close_up_to({"p"}, {"td", "th", "table", "button"})
        if tag in ENDS:
            self.close_up_to(*ENDS[tag])
        self.add(tag, "", attrs)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            if tag in BLOCK:
                self.blocks.append(len(self.open))
            self.open.append(len(self.tags) - 1)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.add("br", "", {})
        at = self.last(tag)
        # an inline end tag does not end blocks around it
        if at and (tag in BLOCK or not self.blocks or self.blocks[-1] < at):
            self.close(at)

    def last(self, name: str) -> int:
        """Place of the innermost open element of a name; 0 if there is none."""
        places = self.places.get(name)
        return places[-1] if places else 0

    def close(self, at: int) -> None:
        """End the open elements from a place on."""
        while len(self.open) > at:
            name = self.tags[self.open.pop()]
            self.places[name].pop()
            if name in BLOCK:
                self.blocks.pop()

    def add(self, tag: str, text: str, attrs: dict[str, str]) -> None:
        self.tags.append(tag)
        self.parents.append(self.open[-1])
        self.texts.append(text)
        self.attrs.append(attrs)

    def close_up_to(self, names: set[str], border: set[str]) -> None:
        at = max(map(self.last, names))
        if at > max(map(self.last, border)):
            self.close(at)


def _is_unseen(tag: str, attrs: dict[str, str]) -> bool:
    if tag in NEVER:
        return True
    return "hidden" in attrs or attrs.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", attrs.get("style", "")))


def _words(attrs: dict[str, str]) -> set[str]:
    """The words of class, id and role, but those that only tell what a stretch has or has not."""
    found: set[str] = set()
    for name in ("class", "id", "role"):
        words = [word.lower() for word in TOKEN.findall(attrs[name])] if name in attrs else []
        found.update(word for before, word in zip(["", *words], words) if before not in ABOUT)
    return found


def _furniture(tags: list[str], parents: list[int], gone: list[bool], plain: list[int], marked: list[int], scopes: list[int]) -> list[bool]:
    """Which marked nodes are furniture: all, but where nothing else is said.

    A scope is an article, or a page without one. If no text of a scope stands outside marked nodes, the one of them
    with most text is not furniture but a scope itself, so a name does not remove the only text there is, while a
    marked stretch beside other text goes, however long it is. ``marked``: 0 no, 1 generic, 2 furniture for certain,
    3 never a scope. ``plain``: characters outside headings and links.
    """
    count = len(tags)
    whole, inside = [0] * count, [0] * count  # text of a subtree, and of it below the outermost marked nodes
    largest: list[tuple[int, int, int]] = [(0, 0, -1)] * count
    for at in range(count - 1, -1, -1):
        if gone[at]:
            continue
        whole[at] += plain[at]
        if at:
            up = parents[at]
            whole[up] += whole[at]
            inside[up] += whole[at] if marked[at] else inside[at]
            # generic names before others, then most text, then the first in the page
            best = (int(marked[at] == 1), whole[at], at) if marked[at] in (1, 2) and whole[at] else largest[at] if not marked[at] else (0, 0, -1)
            if best[2] >= 0 and (largest[up][2] < 0 or best[:2] >= largest[up][:2]):
                largest[up] = best
    stays = [False] * count
    for scope in scopes:
        while scope >= 0 and whole[scope] == inside[scope]:
            scope = largest[scope][2]
            if scope >= 0:
                stays[scope] = True
    return [bool(mark) and not stay for mark, stay in zip(marked, stays)]


def main_text(html: str) -> str:
    """The article's text: white space runs are one space, blocks are joined by one space."""
    tree = Tree(html)
    tags, parents, texts = tree.tags, tree.parents, tree.texts
    count = len(tags)
    words = [_words(attrs) if attrs else set() for attrs in tree.attrs]

    # what each subtree holds, for the choice of furniture
    content, heading = [False] * count, [False] * count
    linked, headed, unseen = [False] * count, [False] * count, [False] * count
    plain, prose = [0] * count, [0] * count  # characters outside links; of these, outside headings
    for at in range(1, count):
        up = parents[at]
        linked[at] = tags[at] == "a" or linked[up]
        headed[at] = tags[at] in HEADINGS or headed[up]
        unseen[at] = unseen[up] or _is_unseen(tags[at], tree.attrs[at])
        if tags[at] == "" and not linked[at] and not unseen[at]:
            prose[at] = len("".join(texts[at].split()))
            plain[at] = 0 if headed[at] else prose[at]
    for at in range(count - 1, 0, -1):
        up = parents[at]
        prose[up] += prose[at]
        if tags[at] in ("article", "main") and not words[at] & COMMENTS or content[at]:
            content[up] = True
        if tags[at] == "h1" or heading[at]:
            heading[up] = True
    article, region = [-1] * count, [-1] * count  # innermost article; outermost article or main
    marked = [0] * count
    for at in range(count):
        up = parents[at]
        if at and region[up] >= 0:
            region[at] = region[up]
        elif tags[at] in ("article", "main") and not words[at] & COMMENTS:
            region[at] = at
        within = at and article[up] >= 0
        if not (content[at] or heading[at] and not within or tags[at] in ("", "body") or tags[at] in ("article", "main") and not words[at] & COMMENTS):
            if tags[at] == "header":
                marked[at] = 0 if heading[at] else 3
            elif words[at] & FURNITURE:
                marked[at] = 2
            elif (tags[at] == "form" or words[at] & GENERIC) and 2 * prose[at] <= prose[0]:
                marked[at] = 1
        article[at] = at if tags[at] == "article" or tags[at] == "main" and not content[at] else article[up] if at else -1
    scopes = [at for at in range(1, count) if region[at] == at and not unseen[at]]
    furniture = _furniture(tags, parents, unseen, plain, marked, scopes or [0])
    gone = [False] * count
    for at in range(1, count):
        gone[at] = gone[parents[at]] or unseen[at] or furniture[at]

    # characters, tags, and those of links, of every subtree
    chars, marks, link_chars, link_marks = [0] * count, [0] * count, [0] * count, [0] * count
    for at in range(1, count):
        if tags[at] == "" and not gone[at]:
            chars[at] = len("".join(texts[at].split()))
            link_chars[at] = chars[at] if linked[at] else 0
    for at in range(count - 1, 0, -1):
        if not gone[at]:
            up = parents[at]
            chars[up] += chars[at]
            link_chars[up] += link_chars[at]
            marks[up] += marks[at] + (tags[at] != "")
            link_marks[up] += link_marks[at] + (tags[at] == "a")
    share = link_chars[0] / max(1, chars[0])
    density = [0.0] * count
    for at in range(count):
        c = chars[at]
        if c and not gone[at]:
            t, lc, lt = max(1, marks[at]), max(1, link_chars[at]), max(1, link_marks[at])
            base = math.log(c / max(1, c - link_chars[at]) * lc + share * c + math.e)
            density[at] = c / t * max(0.0, math.log(c / lc * t / lt)) / math.log(base)
    sums = [0.0] * count
    for at in range(1, count):
        sums[parents[at]] += density[at]

    best = list(range(count))  # the node with the largest sum in each subtree; of equal ones the outermost
    for at in range(count - 1, 0, -1):
        if sums[best[at]] > sums[best[parents[at]]]:
            best[parents[at]] = best[at]
    centre = best[0]
    chosen = [False] * count
    if region[centre] >= 0:
        chosen[region[centre]] = True
    threshold, at = density[centre], centre
    while at >= 0:
        threshold, at = min(threshold, density[at]), parents[at]
    for at in range(count):
        if density[at] >= threshold and not gone[at]:
            chosen[best[at]] = True
    parts = []
    for at in range(count):
        chosen[at] = chosen[at] or at > 0 and chosen[parents[at]]
    ends: list[int] = []  # open blocks, to put a border behind them
    for at in range(count):
        while ends and parents[at] < ends[-1]:
            parts.append(" ")
            ends.pop()
        if tags[at] in BLOCK:
            parts.append(" ")
            ends.append(at)
        if chosen[at] and not gone[at] and texts[at]:
            parts.append(texts[at])
    return " ".join("".join(parts).split())


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row; a null html counts as empty and gives the empty text.

    Ids and urls pass unchanged, nulls and repeated rows too; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py() or "") for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    picked = pages.select("page_id", "url", "html")
    kinds = [picked.schema[name].dataType.simpleString() for name in ("page_id", "url")]
    return picked.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
