"""Main text of web pages by a minimum cut between content and boilerplate."""

from __future__ import annotations

import re
from collections import Counter, deque
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from wardscope.llm.common import apply_arrow, with_struct

BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td textarea tfoot
th thead tr ul""".split())
HIDDEN = frozenset("script style template noscript iframe object svg math canvas audio video title".split())
#: Of these, elements that cannot hold a block, so that one ends them where their end tag is missing.
INLINE_ONLY = frozenset("svg math title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements and landmark roles that hold no article text.
APART = frozenset("nav footer aside form menu button select option textarea dialog search fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Class and id names, or first or last parts of such names, that tell what stands beside an article.
BESIDE = frozenset("""ad ads adv advert adverts advertisement adbox banner cookie cookies consent gdpr notice notices alert sidebar widget widgets promo
promotion sponsor sponsored related recommended recommendations share sharing social comment comments disqus reply replies respond breadcrumb
breadcrumbs pagination pager menu nav navbar navigation footer header masthead topbar toolbar popup modal overlay newsletter subscribe subscription
signup login search skip copyright legal""".split())
OWN = frozenset("article post hentry entry content story main".split())
#: Parts that make what follows a property of the element and not its kind: has-sidebar, category-social, no-comments.
PROPERTIES = frozenset("has have with without no not non is in on off show hide hidden enable enabled disable disabled category cat tag tagged topic type format status author lang theme".split())
#: An article by one of these names is none.
SIDE_ARTICLES = frozenset("comment comments reply replies respond ad advert advertisement promo promotion sponsor sponsored related recommended widget".split())
EDGE_NAMES = frozenset("header footer banner".split())

#: Costs of the classifier: what each feature adds for content (above zero) or boilerplate (below).
BIAS, IN_ARTICLE, PARAGRAPH, HEADING, PER_WORD, WORDS_AT_MOST, LINKS, BESIDE_ARTICLE = -1.0, 3.0, 1.0, 0.5, 0.1, 2.0, -4.0, -8.0
#: Capacities between neighbours in the page with one parent, with different parents, and between a block and its parent.
NEAR, FAR, PARENT = 1.0, 0.25, 0.3


def kinds(names: str) -> set[str]:
    """What the names of an element call it: of each the first and last of its parts before any property."""
    found = set()
    for name in re.sub(r"([a-z])([A-Z])", r"\1-\2", names).lower().split():
        parts = re.findall(r"[a-z]+", name)
        size = next((k for k, part in enumerate(parts) if part in PROPERTIES), len(parts))
        found.update(parts[:1] if size else [], parts[size - 1:size] if size else [])
    return found


class Page(HTMLParser):
    """Blocks of a page in order: text, costs and the element that holds them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, float, int]] = []
        self.open: list[tuple[str, float, bool, int]] = [("", 0.0, False, 0)]  # tag, costs of what stands apart, in an article, number
        self.tags: Counter[str] = Counter()  # open elements by tag
        self.count, self.hidden, self.link = 0, "", False
        self.inside: list[str] = []  # elements open in the hidden one
        self.within: Counter[str] = Counter()  # the same by tag
        self.parts: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        if self.parts:
            words = "".join(self.parts).split()
            if words:
                text = " ".join(words)
                tag, apart, article, _ = self.open[-1]
                cost = BIAS + IN_ARTICLE * article + apart + min(PER_WORD * len(words), WORDS_AT_MOST) + LINKS * min(1.0, self.linked / len(text))
                cost += PARAGRAPH if tag in ("p", "blockquote", "pre") else HEADING if tag in HEADINGS or tag in ("li", "dd", "dt", "td", "figcaption") else 0.0
                self.blocks.append((text, cost, self.open[-2][3] if len(self.open) > 1 else 0))
        self.parts, self.linked = [], 0

    def apart(self, tag: str, attrs: list[tuple[str, str | None]], article: bool) -> bool:
        if tag in APART or tag == "header" and not article:
            return True
        if tag in ("html", "body") or not attrs:
            return False
        own = {k: v or "" for k, v in attrs}
        if own.get("role", "").lower() in ROLES or "hidden" in own or own.get("aria-hidden") == "true" or re.search(r"display:\s*none", own.get("style", "")):
            return True
        names = kinds(f"{own.get('class', '')} {own.get('id', '')}")
        if tag in ("article", "main") or own.get("role") == "main" or own.get("itemprop") == "articleBody":
            return tag == "article" and bool(names & SIDE_ARTICLES) and not names & OWN
        return bool(names & BESIDE and not (names & OWN and names & BESIDE <= EDGE_NAMES))

    def show(self) -> None:
        """Leave the hidden element."""
        self.hidden, self.inside, self.within = "", [], Counter()

    def close_down_to(self, depth: int) -> None:
        """Close the open elements from ``depth`` on."""
        self.tags.subtract(tag for tag, *_ in self.open[depth:])
        del self.open[depth:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.hidden:
            if tag != "body" and not (self.hidden in INLINE_ONLY and tag in BLOCKS):
                if tag in HIDDEN or tag in BLOCKS and tag not in VOID:
                    self.inside.append(tag)
                    self.within[tag] += 1
                return
            self.show()
        if tag in HIDDEN:
            self.hidden = tag
        elif tag == "br":
            self.parts.append(" ")
        elif tag == "a":
            self.link = True
        elif tag in BLOCKS:
            self.flush()
            if tag in VOID:
                return
            last = self.open[-1][0]
            if last in HEADINGS and tag in HEADINGS or last == "p" or last == tag in ("li", "dd", "dt", "td", "th", "tr", "option"):
                self.close_down_to(len(self.open) - 1)
            _, cost, article, _ = self.open[-1]
            self.count += 1
            self.tags[tag] += 1
            self.open.append((tag, cost + BESIDE_ARTICLE * self.apart(tag, attrs, article),
                              article or tag in ("article", "main") or any(k == "role" and v == "main" or k == "itemprop" and v == "articleBody" for k, v in attrs), self.count))

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            while self.within[tag]:
                last = self.inside.pop()
                self.within[last] -= 1
                if last == tag:
                    return
            if tag == self.hidden:
                self.show()
                return
            if not self.tags[tag]:
                return
            self.show()  # the end of an element around it
        if tag == "a":
            self.link = False
        elif tag in BLOCKS:
            self.flush()
            if self.tags[tag]:  # the walk is paid for by what it closes
                self.close_down_to(next(k for k in range(len(self.open) - 1, 0, -1) if self.open[k][0] == tag))

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)
            if self.link:
                self.linked += len(data.strip())


def minimum_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are content at the least sum of costs given up and capacities cut (the fewest of equals).

    First come nodes whose own cost outweighs all their undecided neighbours: their label is sure and moves into the
    neighbours' costs. What is left goes through a maximum flow (shortest augmenting paths, level by level).
    """
    near: list[dict[int, float]] = [{} for _ in costs]
    for a, b, c in edges:
        near[a][b] = near[a].get(b, 0.0) + c
        near[b][a] = near[b].get(a, 0.0) + c
    cost, label = list(costs), [None] * len(costs)
    waiting = deque(range(len(costs)))
    while waiting:
        a = waiting.popleft()
        if label[a] is None and abs(cost[a]) >= sum(near[a].values()) and (cost[a] or not near[a]):
            label[a] = cost[a] > 0
            for b, c in near[a].items():
                del near[b][a]
                cost[b] += c if label[a] else -c
                waiting.append(b)
            near[a] = {}
    rest = [a for a in range(len(costs)) if label[a] is None]
    if rest:
        source, sink = len(costs), len(costs) + 1
        room: dict[int, dict[int, float]] = {a: dict(near[a]) for a in rest} | {source: {}, sink: {}}
        for a in rest:
            if cost[a] > 0:
                room[source][a], room[a][source] = cost[a], 0.0
            elif cost[a] < 0:
                room[a][sink], room[sink][a] = -cost[a], 0.0
        while True:
            level, queue = {source: 0}, deque([source])
            while queue:
                a = queue.popleft()
                for b, c in room[a].items():
                    if c > 1e-12 and b not in level:
                        level[b] = level[a] + 1
                        queue.append(b)
            if sink not in level:
                break
            left = {a: list(room[a]) for a in level}
            path = [source]
            while path:
                a = path[-1]
                if a == sink:
                    flow = min(room[x][y] for x, y in zip(path, path[1:]))
                    for x, y in zip(path, path[1:]):
                        room[x][y] -= flow
                        room[y][x] = room[y].get(x, 0.0) + flow
                    k = next(k for k, (x, y) in enumerate(zip(path, path[1:])) if room[x][y] <= 1e-12)
                    path = path[:k + 1]
                elif left[a]:
                    b = left[a][-1]
                    if room[a].get(b, 0.0) > 1e-12 and level.get(b) == level[a] + 1:
                        path.append(b)
                    else:
                        left[a].pop()
                else:
                    path.pop()
                    if path:
                        left[path[-1]].pop()
        for a in rest:
            label[a] = a in level
    return label


def main_text(html: str | None) -> str:
    """Text of the blocks that the cut leaves on the side of content, one per line."""
    page = Page()
    page.feed(html or "")
    page.close()
    page.flush()
    blocks = page.blocks
    costs, edges, hubs = [b[1] for b in blocks], [], {}
    for k, (_, _, parent) in enumerate(blocks):
        if k:
            edges.append((k - 1, k, NEAR if blocks[k - 1][2] == parent else FAR))
        hubs.setdefault(parent, []).append(k)
    for own in hubs.values():
        if len(own) > 1:
            edges += [(k, len(costs), PARENT) for k in own]
            costs.append(0.0)
    return "\n".join(b[0] for b, kept in zip(blocks, minimum_cut(costs, edges)) if kept)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text, and ``n_chars``, its code points (replaced if there).

    The page is read leniently into blocks (runs of text between block-level tags; white space becomes one space, a line
    break in a block too; character references are decoded; scripts, styles and the like are left out). A linear classifier over
    place, length, links, and names of elements gives each block its cost as content or boilerplate, the terminal
    capacities; neighbours in the page and blocks of one parent are tied by capacities that favour one label. A minimum cut
    labels all blocks of a page at once, and content blocks are joined by line breaks in page order. Each page is worked on
    alone. Null, empty or unreadable pages have the empty text; repeated rows return as often as they occur.
    """
    def texts(column: pa.Array) -> pa.Array:
        found = [main_text(h.as_py()) for h in column]
        return pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], ["text", "n_chars"])

    return with_struct(pages, apply_arrow(pages, texts, "text string, n_chars long", html), ["text", "n_chars"])
