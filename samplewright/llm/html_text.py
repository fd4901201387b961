"""Main text of web pages by minimum-cut labelling (operator 7).

A page is cut into text blocks at block-level tags.  A linear classifier gives each
block a cost for either label from its nearest telling ancestor, its own tag, its length,
its links and its sentences; the costs are the capacities to the two terminals.
A class or id tells by a whole name or a compound of known words, not by any word in it.
Outside articles such a name decides what is below it.  Inside one it counts on block-level
elements only (a word in mid-sentence stays) and not as the id of a heading or section; the name of
a container that no article has a part of (comments, adverts, newsletters, notices) decides there
too, and a word that may be a topic (legal, search, reply) only lowers the score, which
long blocks of several sentences outweigh.
Neighbouring blocks are joined by edges that weaken with their distance in the
document tree, and so are successive blocks of one parent.  The minimum cut
separates content from boilerplate, by maximum flow over what is left after blocks
whose cost exceeds all their edges have been fixed (which no minimum cut contradicts).

A page is one row; nothing is shuffled.  Time and memory grow with the page's length, however
deeply it nests and whatever it leaves open.

Defined results: null and empty pages, and pages without content, have the empty
text; what scripts, styles, comments, forms and hidden elements hold is never
text; character references are decoded; runs of white space in a block become one
space; blocks are joined by one line feed in page order; unclosed, unmatched and
badly nested tags never fail; repeated rows give repeated results.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import deque
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tags by what they do to the text around them.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td
tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
DEAD = RAW | frozenset("""head svg canvas object audio video select button datalist input label
annotation annotation-xml""".split())
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "optgroup": {"option", "optgroup"}}
#: Elements that an implied end does not reach over.
SCOPES = frozenset("article aside body div dl footer form header main nav ol section table td th ul".split())
GOOD_TAGS = frozenset("article main".split())
BAD_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
GOOD_ROLES = frozenset("main article".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
GOOD_NAMES = frozenset("article articlebody content main maincontent post entry story".split())
BAD_NAMES = frozenset("""ad ads adbox adsense advert adverts advertisement advertisements banner sponsor sponsored promo promotion
cookie cookies consent gdpr notice notices alert popup modal overlay sidebar side menu menus nav navbar navigation breadcrumb
breadcrumbs footer masthead topbar comment comments commentlist reply replies respond disqus related recommended recommendations
share sharing social newsletter subscribe subscription signup login search widget widgets pagination pager toolbar copyright
legal disclaimer feedback""".split())
#: Those that may be what an article is about.
TOPICS = frozenset("alert banner copyright disclaimer feedback header legal login menu menus navigation overlay pager reply replies respond search side signup social toolbar".split())
#: Words that a compound such as comments-area or site-footer-links may have besides those.
LAYOUT = GOOD_NAMES | frozenset("""a aside area b bar block body bottom box btn button buttons center col column container desktop element
entries fixed foot global grid group holder icon icons id inline inner item items js label large layout left level link links list
mobile module outer page panel parent placeholder position posts primary rail recent region right root row secondary section site
slot small sticky tab tabs text thread title top unit user users view wrap wrapper x header""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

NAMED_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
QUOTED = re.compile(r"[^>\"']*+(?:\"[^\"]*\"[^>\"']*+|'[^']*'[^>\"']*+)*+>")
SPECIAL = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"([^\s=/>\"'][^\s=/>]*+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?。！？](?:\s|$)")

# The classifier's weights, in units of log-odds.
ANCESTOR, LENGTH, MOST_LENGTH, LINKS, ENDS, PLAIN, HEADING, BARE = 6.0, 1 / 120, 2.0, 4.0, 1.0, 0.8, 2.2, -1.5
#: For blocks below a boilerplate name inside an article; their length and sentences count further.
NAMED, NAMED_LENGTH, NAMED_ENDS = 9.0, 4.0, 4
ADJACENT, SIBLING = 1.2, 0.4


class Node:
    """A place in the document tree: the block-level elements around a text."""

    __slots__ = ("parent", "depth")

    def __init__(self, parent: Node | None):
        self.parent, self.depth = (parent, parent.depth + 1) if parent else (self, 0)

    def distance(self, other: Node) -> int:
        """Steps in the tree from one place to the other; only what was closed and opened in between is walked."""
        a, b, steps = self, other, 0
        while a is not b:
            if a.depth >= b.depth:
                a = a.parent
            else:
                b = b.parent
            steps += 1
        return steps


class Element:
    __slots__ = ("tag", "side", "dead", "node", "inside", "named", "block", "scopes")

    def __init__(self, tag: str, side: int, dead: bool, node: Node, inside: bool, named: bool, block: str, scopes: int):
        self.tag, self.side, self.dead, self.node, self.inside, self.named = tag, side, dead, node, inside, named
        self.block, self.scopes = block, scopes  # the nearest block-level tag, and how many elements from the root on bound implied ends

    def splits(self, parent: Element) -> bool:
        """Whether its text is not of one block with its parent's; what a dead one in mid-sentence holds just goes."""
        return (self.side, self.named) != (parent.side, parent.named)


class Block:
    __slots__ = ("text", "links", "tag", "side", "node", "named")

    def __init__(self, text: str, links: int, tag: str, side: int, node: Node, named: bool):
        self.text, self.links, self.tag, self.side, self.node, self.named = text, links, tag, side, node, named

    def score(self) -> float:
        """Cost of calling the block boilerplate, less that of calling it content."""
        n = len(self.text)
        value = BARE + ANCESTOR * self.side + min(n * LENGTH, MOST_LENGTH) - LINKS * self.links / n
        if self.named:
            value += min(max(n * LENGTH - MOST_LENGTH, 0.0), NAMED_LENGTH - MOST_LENGTH) - NAMED
            value += ENDS * min(len(SENTENCE.findall(self.text)), NAMED_ENDS)
        elif SENTENCE.search(self.text):
            value += ENDS
        if self.tag == "p":
            value += PLAIN
        elif self.tag in HEADINGS:
            value += HEADING
        return value


def _boilerplate(value: str, inside: bool) -> int:
    """2 if one of the names is of a container that is never content, or a compound of such and layout words; 1 if it may be a topic; else 0."""
    found = 0
    for name in value.split():
        words = set(NAME.findall(name))
        bad = words & BAD_NAMES or not inside and "header" in words
        if bad and words <= BAD_NAMES | LAYOUT:
            found = max(found, 1 if words & BAD_NAMES <= TOPICS else 2)
    return found


def _opened(tag: str, attributes: str, parent: Element) -> Element:
    """What an element says about the text inside it."""
    side, dead, inside, named = parent.side, parent.dead or tag in DEAD, parent.inside, parent.named
    if tag in GOOD_TAGS:
        if not (parent.inside and parent.side < 0):  # a comment in a list of comments may be an article
            side = 1
        inside = True
    elif tag in BAD_TAGS or tag == "header" and not inside:
        side = -1
    if attributes and not attributes.isspace():
        found = [(key.lower(), (a or b or c).lower()) for key, a, b, c in ATTRIBUTE.findall(attributes)]
        section = tag in HEADINGS or tag == "section" or any(key == "class" and "section" in value.split() for key, value in found)
        for key, value in found:
            if key in ("class", "id", "itemprop") and tag not in ("html", "body"):
                bad = _boilerplate(value, inside)
                if bad and not (key == "id" and section and (inside or tag in HEADINGS)):
                    if not parent.inside or bad > 1 and tag in BLOCK:
                        side = -1
                    else:
                        named = named or tag in BLOCK
                elif not GOOD_NAMES.isdisjoint(NAME.findall(value)) and side == parent.side == 0:
                    side, inside = 1, True
            elif key == "role":
                side = 1 if value in GOOD_ROLES else -1 if value in BAD_ROLES else side
            elif key == "style":
                dead = dead or "display:none" in value.replace(" ", "")
            elif key == "aria-hidden":
                dead = dead or value == "true"
            elif key == "hidden":
                dead = True
    block = tag in BLOCK
    return Element(tag, side, dead, Node(parent.node) if block else parent.node, inside, named,
                   tag if block else parent.block, parent.scopes + (tag in SCOPES))


class Tags:
    """The tags, comments and declarations of a page, each found once."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.places: list[int] | None = None

    def end(self, at: int) -> int:
        """Where a tag whose attributes begin at ``at`` ends: behind the first ``>`` outside quotes, or else behind the first."""
        if self.places is None:
            found = QUOTED.match(self.page, at)
            if found:
                return found.end()
            self._plan()
        k = bisect_left(self.places, at)
        stop = self.closing[k] if k < len(self.places) else -1
        return (stop if stop >= 0 else self.page.find(">", at)) + 1

    def _plan(self) -> None:
        """For each quote and ``>``, the ``>`` that ends a tag if it stands outside quotes; in one pass from the back."""
        marks = [(m.start(), m.group()) for m in SPECIAL.finditer(self.page)]
        self.places, self.closing = [p for p, _ in marks], [-1] * len(marks)
        after = {'"': -1, "'": -1}
        for k in range(len(marks) - 1, -1, -1):
            place, mark = marks[k]
            if mark == ">":
                self.closing[k] = place
            else:
                j = after[mark]
                self.closing[k] = self.closing[j + 1] if 0 <= j < len(marks) - 1 else -1
                after[mark] = k

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start, end, slash, name and attributes of what follows; the name is empty for comments and declarations."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                stop = page.find("-->", start + 4)
                return start, (stop + 3 if stop >= 0 else len(page)), "", "", ""
            if page.startswith(("<!", "<?"), start):
                stop = page.find(">", start)
                return start, (stop + 1 if stop >= 0 else len(page)), "", "", ""
            if start > self.last:
                at = start + 1
                continue
            found = NAMED_TAG.match(page, start)
            if not found:
                at = start + 1
                continue
            stop = self.end(found.end())
            return start, stop, found.group(1), found.group(2).lower(), page[found.end():stop - 1]
        return None


class Stack:
    """The open elements, with where each tag stands, so that no tag is looked for."""

    def __init__(self):
        self.open = [Element("", 0, False, Node(None), False, False, "", 0)]
        self.places: dict[str, list[int]] = {}
        self.bounds = [0]

    def top(self) -> Element:
        return self.open[-1]

    def push(self, element: Element) -> None:
        self.places.setdefault(element.tag, []).append(len(self.open))
        if element.tag in SCOPES:
            self.bounds.append(len(self.open))
        self.open.append(element)

    def place(self, tag: str) -> int:
        """The place of the innermost ``tag``, 0 if none is open."""
        found = self.places.get(tag)
        return found[-1] if found else 0

    def cut(self, place: int) -> None:
        for element in self.open[place:]:
            self.places[element.tag].pop()
        del self.open[place:]
        while self.bounds[-1] >= place:
            self.bounds.pop()


def blocks_of(page: str) -> list[Block]:
    """The visible text blocks of a page, in order."""
    stack, tags = Stack(), Tags(page)
    blocks: list[Block] = []
    pieces: list[str] = []
    links, block_tag = 0, ""

    def flush() -> None:
        nonlocal links
        text = " ".join(unescape("".join(pieces)).split())
        if text:
            top = stack.top()
            blocks.append(Block(text, min(links, len(text)), block_tag, top.side, top.node, top.named))
        pieces.clear()
        links = 0

    def add(text: str) -> None:
        nonlocal links
        if text and not stack.top().dead:
            pieces.append(text)
            if stack.place("a") and not text.isspace():
                links += len(text.strip())

    at = 0
    while (found := tags.next(at)) is not None:
        start, stop, close, tag, attributes = found
        add(page[at:start])
        at = stop
        if not tag:
            continue
        if close:
            place = stack.place(tag)
            if tag == "br" or tag == "p" and not place:
                add(" ")
                continue
            if not place or tag not in BLOCK and stack.top().scopes > stack.open[place].scopes:
                continue
            if any(e.tag in BLOCK or e.splits(stack.open[place - 1]) for e in stack.open[place:]):
                flush()
            stack.cut(place)
        else:
            if tag in VOID:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    add(" ")
                continue
            if tag in RAW:
                end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
                continue
            if tag in BLOCK:
                flush()
                ended = max(map(stack.place, {"p"} | CLOSES.get(tag, set())))
                if ended and ended >= stack.bounds[-1]:
                    stack.cut(ended)
            element = _opened(tag, attributes, stack.top())
            if element.splits(stack.top()):
                flush()
            stack.push(element)
        block_tag = stack.top().block
    add(page[at:])
    flush()
    return blocks


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: of page neighbours, by their distance in the tree, and of one parent's successive blocks."""
    edges: list[tuple[int, int, float]] = []
    last: dict[Node, int] = {}
    for i, block in enumerate(blocks):
        if i:
            edges.append((i - 1, i, ADJACENT / (1 + blocks[i - 1].node.distance(block.node))))
        parent = block.node.parent
        if last.get(parent, i) < i - 1:
            edges.append((last[parent], i, SIBLING))
        last[parent] = i
    return edges


def _source_side(part: list[int], value: list[float], links: list[list[tuple[int, float]]], side: list[int]) -> set[int]:
    """The open nodes of ``part`` that residual capacity still reaches from the source after maximum flow."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {i: {} for i in (*part, source, sink)}
    for i in part:
        for j, w in links[i]:
            if not side[j]:
                room[i][j] = room[i].get(j, 0.0) + w
        a, b = (source, i) if value[i] > 0 else (i, sink)
        if value[i]:
            room[a][b], room[b][a] = abs(value[i]), 0.0
    while True:
        came, queue = {source: source}, deque([source])
        while queue and sink not in came:
            a = queue.popleft()
            for b, w in room[a].items():
                if w > 1e-9 and b not in came:
                    came[b] = a
                    queue.append(b)
        if sink not in came:
            return set(came)
        path, b = [], sink
        while b != source:
            path.append((came[b], b))
            b = came[b]
        flow = min(room[a][b] for a, b in path)
        for a, b in path:
            room[a][b] -= flow
            room[b][a] = room[b].get(a, 0.0) + flow


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the side of the source in the least minimum cut.

    A positive score is a capacity from the source, a negative one to the sink.
    """
    n = len(scores)
    links: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, w in edges:
        links[a].append((b, w))
        links[b].append((a, w))
    value, side = list(scores), [0] * n
    waiting = deque(range(n))
    while waiting:  # a node that outweighs its open edges is settled and pulls its neighbours
        i = waiting.popleft()
        if side[i] or abs(value[i]) <= sum(w for j, w in links[i] if not side[j]):
            continue
        side[i] = 1 if value[i] > 0 else -1
        for j, w in links[i]:
            if not side[j]:
                value[j] += w * side[i]
                waiting.append(j)
    for start in range(n):
        if side[start]:
            continue
        part, queue = [start], [start]  # what is joined by edges between open nodes is settled by itself
        met = {start}
        while queue:
            for j, _ in links[queue.pop()]:
                if not side[j] and j not in met:
                    met.add(j)
                    part.append(j)
                    queue.append(j)
        reached = _source_side(part, value, links, side)
        for i in part:
            side[i] = 1 if i in reached else -1
    return [s > 0 for s in side]


def main_text(page: str | None) -> str:
    """The content blocks of a page, joined by line feeds."""
    blocks = blocks_of(page or "")
    content = minimum_cut([b.score() for b in blocks], edges_of(blocks))
    return "\n".join(b.text for b, keep in zip(blocks, content) if keep)


def with_main_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the main text of each."""
    @F.arrow_udf("string")
    def extract(html: pa.Array) -> pa.Array:
        return pa.array([main_text(page.as_py()) for page in html], pa.string())

    return pages.withColumn(out_col, extract(F.col(html_col)))
