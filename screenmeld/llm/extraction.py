"""HTML main-text extraction by minimum-cut labelling.

A page is cut into blocks of text. A logistic classifier, fitted here on a bounded sample of pages, gives each
block the cost of either label: the capacities to the two terminals. Smoothness edges join neighbours in page order, more
strongly under the same parent element. The minimum cut (maximum flow) separates content from boilerplate.

Training labels are those of blocks whose elements say what they are (``article``, ``nav``, class names such as ``comment``);
the classifier sees text features alone. When a page is labelled, what elements and class words say is added to the capacities
as evidence of the size of the classifier's and the edges' costs, so that the cut decides: text and neighbours can outweigh a statement.
An ``article`` or ``main`` outweighs the class words of elements around it, such as ``has-sidebar``.

Defined cases: NULL or empty html gives an empty text; cut-off pages keep the text before a broken tag; pages are
judged one by one, so ties, repeated rows and empty tables need no rule; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque

import numpy as np
from pyspark.sql import DataFrame

from screenmeld.llm.text import lowest_hashes, map_values

#: Element names of HTML by role, and words in class, id and role attributes.
UNSEEN = frozenset("script style noscript template svg math iframe object head title textarea select option button "
                   "canvas audio video map datalist".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr".split())
OUTSIDE = frozenset("nav footer aside form menu dialog fieldset".split())
INSIDE = frozenset("article main".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                   "h6 header hr main menu nav ol p pre section table ul".split())
ENDS_SAME = frozenset("li dt dd tr td th option".split())
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar side aside footer foot header masthead topbar cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login register search share sharing social related "
    "recommended recommendations widget widgets comment comments reply replies respond disqus discussion pagination pager tags "
    "toolbar copyright legal disclaimer paywall contentinfo complementary".split())
INSIDE_WORDS = frozenset("article content main post entry story body text prose".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)",
                   re.S)
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(\"[^\"]*+\"?|'[^']*+'?|[^\s>]++))?+")
SCORE = 4.0  # largest cost by the classifier
TAG, WORDS = 4.0, 3.0  # evidence of an element's name and of its class words
NEIGHBOUR, SIBLING = 0.4, 0.8
SAMPLE_PAGES = 1000
N_FEATURES = 8


class Block:
    __slots__ = ("parent", "linked", "stated", "heading", "parts", "text")

    def __init__(self, parent: int, stated: float, heading: bool) -> None:
        self.parent, self.stated, self.heading = parent, stated, heading
        self.parts: list[str] = []
        self.linked, self.text = 0, ""


def _states(name: str, attributes: str, outer: float) -> tuple[float, bool]:
    """Evidence on an element's text, above 0 for content, below for boilerplate; and whether it is hidden."""
    words, hidden = set(), False
    seen: set[str] = set()
    for key, value in ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        key = key.lower()
        if key in seen:
            continue  # the first of a name counts
        seen.add(key)
        value = html.unescape(value.strip("\"'")).lower()
        if key in ("class", "id", "role"):
            words.update(re.split(r"[^a-z0-9]+", value))
        elif key in ("hidden", "aria-hidden", "style"):
            hidden |= key == "hidden" or (key == "aria-hidden" and value == "true") or (
                key == "style" and "display:none" in value.replace(" ", ""))
    page = name in ("html", "body")
    if name in OUTSIDE or (name == "header" and outer <= 0):
        return -TAG, hidden
    if words & OUTSIDE_WORDS and not (outer >= 0 and (page or name in INSIDE)):
        return min(outer, -WORDS), hidden
    if name in INSIDE:
        return min(TAG, outer + TAG), hidden
    if words & INSIDE_WORDS and not page and outer > -TAG:
        return max(outer, min(WORDS, outer + WORDS)), hidden
    return outer, hidden


def blocks_of(page: str | None) -> list[Block]:
    """The blocks of one page in page order, with decoded and trimmed text."""
    page = page or ""
    found: list[Block] = []
    stack = [("", 0.0, False, 0)]  # element, statement, unseen, number
    number, at, size = 0, 0, len(page)
    current: Block | None = None
    links = 0

    def add(text: str) -> None:
        nonlocal current
        if stack[-1][2] or not text:
            return
        if current is None:
            top = next(e for e in reversed(stack) if e[0] not in INLINE)
            current = Block(top[3], top[1], any(e[0][:1] == "h" and e[0][1:].isdigit() for e in stack[-3:]))
            found.append(current)
        current.parts.append(text)
        if links:
            current.linked += len(text)

    def close(upto: int) -> None:
        nonlocal current, links
        while len(stack) > upto:
            name = stack.pop()[0]
            links -= name == "a"
            if name not in INLINE:
                current = None

    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            rest = page[at:]
            cut = re.search(r"<[a-zA-Z/!?]", rest)
            add(rest[:cut.start()] if cut else rest)
            break
        add(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    close(k)
                    break
                if name in INLINE and stack[k][0] not in INLINE:
                    break
            if name not in INLINE:
                current = None
            continue
        if name in ENDS_P or name in ENDS_SAME:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p" and name in ENDS_P or stack[k][0] == name and name in ENDS_SAME:
                    close(k)
                    break
                if stack[k][0] not in INLINE:
                    break
        if name == "br":
            add(" ")
        if name not in INLINE:
            current = None
        if name in VOID:
            continue
        stated, hidden = _states(name, m[3], stack[-1][1])
        unseen = stack[-1][2] or hidden or name in UNSEEN
        if name in RAW:
            end = re.compile(f"</{name}", re.I).search(page, at)
            if end is None:
                break
            at = end.start()
        number += 1
        links += name == "a"
        stack.append((name, stated, unseen, number))
    for block in found:
        block.text = " ".join(html.unescape("".join(block.parts)).split())
    return [b for b in found if b.text]


def features(blocks: list[Block]) -> np.ndarray:
    out = np.zeros((len(blocks), N_FEATURES))
    sizes = [math.log1p(len(b.text)) for b in blocks]
    for k, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        out[k] = (1.0, sizes[k] / 5, min(1.0, b.linked / len(b.text)), sum(map(b.text.count, ".,;:!?")) / words,
                  "©" in b.text, b.heading, (sizes[k - 1] if k else 0.0) / 5,
                  (sizes[k + 1] if k + 1 < len(blocks) else 0.0) / 5)
    return out


def minimum_cut(cost: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Label True for the source side: pays ``-cost`` where cost < 0, ``cost`` where it is cut off, and for cut edges.

    Blocks whose own cost exceeds all their edges are settled first, which leaves small pieces for the flow.
    """
    n = len(cost)
    cost = list(cost)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    label: list[bool | None] = [None] * n
    open_ = deque(range(n))
    while open_:
        k = open_.popleft()
        if label[k] is None and abs(cost[k]) >= sum(near[k].values()):
            label[k] = cost[k] > 0
            for j, w in near[k].items():
                cost[j] += w if label[k] else -w
                del near[j][k]
                open_.append(j)
            near[k] = {}
    rest = [k for k in range(n) if label[k] is None]
    if not rest:
        return label
    source, sink = n, n + 1
    room: dict[int, dict[int, float]] = {k: dict(near[k]) for k in rest}
    room[source], room[sink] = {}, {}
    for k in rest:
        a, b = (source, k) if cost[k] > 0 else (k, sink)
        room[a][b] = abs(cost[k])
        room[b].setdefault(a, 0.0)
    while True:  # blocking flows on the layers of shortest paths
        came, layer = {source: 0}, [source]
        while layer and sink not in came:
            below = []
            for k in layer:
                for j, w in room[k].items():
                    if w > 1e-9 and j not in came:
                        came[j] = came[k] + 1
                        below.append(j)
            layer = below
        if sink not in came:
            break
        onward = {k: [j for j in room[k] if came.get(j) == d + 1] for k, d in came.items()}
        path = [source]
        while path:
            k = path[-1]
            if k == sink:
                steps = list(zip(path, path[1:]))
                flow = min(room[a][b] for a, b in steps)
                for a, b in steps:
                    room[a][b] -= flow
                    room[b][a] = room[b].get(a, 0.0) + flow
                full = next(i for i, (a, b) in enumerate(steps) if room[a][b] <= 1e-9)
                del path[full + 1:]
                continue
            while onward[k] and room[k][onward[k][-1]] <= 1e-9:
                onward[k].pop()
            if onward[k]:
                path.append(onward[k][-1])
            else:
                path.pop()
                if path:
                    onward[path[-1]].pop()
    for k in rest:
        label[k] = k in came
    return label


def main_text(page: str | None, weights: np.ndarray) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    score = np.clip(features(blocks) @ weights, -SCORE, SCORE)
    cost = [float(s) + b.stated for s, b in zip(score, blocks)]
    edges, last = [], {}
    for k, b in enumerate(blocks):
        if k:
            edges.append((k - 1, k, NEIGHBOUR))
        if b.parent in last:
            edges.append((last[b.parent], k, SIBLING))
        last[b.parent] = k
    return "\n".join(b.text for b, kept in zip(blocks, minimum_cut(cost, edges)) if kept)


def fit_weights(pages: DataFrame, sample: int = SAMPLE_PAGES, seed: int = 42) -> np.ndarray:
    """Logistic regression on the stated blocks of at most ``sample`` pages, lowest hash of page_id first."""
    chosen = lowest_hashes(pages.select("page_id", "html"), "page_id", seed, sample).limit(2 * sample).collect()
    chosen = sorted(chosen, key=lambda r: (r["at"], r["html"] or ""))[:sample]
    x, y = [np.zeros((0, N_FEATURES))], []
    for row in chosen:
        blocks = blocks_of(row["html"])
        if blocks:
            said = np.array([b.stated for b in blocks])
            x.append(features(blocks)[said != 0])
            y += (said[said != 0] > 0).tolist()
    weights = np.zeros(N_FEATURES)
    data, label = np.vstack(x), np.array(y, float)
    for _ in range(25 if len(label) else 0):  # Newton steps with a ridge
        p = 1 / (1 + np.exp(-data @ weights))
        slope = data.T @ (label - p) - 1.0 * weights
        curve = (data * (p * (1 - p))[:, None]).T @ data + np.eye(N_FEATURES)
        weights = weights + np.linalg.solve(curve, slope)
    return weights


def extract(pages: DataFrame, sample: int = SAMPLE_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row."""
    weights = fit_weights(pages, sample)

    def prepare():
        def run(values: list[str | None]) -> list[tuple]:
            texts = [main_text(v, weights) for v in values]
            return [(t, len(t)) for t in texts]
        return run

    return map_values(pages.select("page_id", "url", "html"), "html", prepare, "text string, n_chars long")
