"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text. Each block has a cost of being called content
and one of being called boilerplate, from a classifier and from what the page's
own names say; neighbouring blocks, and blocks of one container, have a cost of
being called differently. The labels of the least total cost are a minimum cut
of a flow network: source and sink edges hold the blocks' costs, edges between
blocks and containers the smoothness. A maximum flow finds it.

The classifier is a logistic regression over a block's length, links and
punctuation. Its labels come from the pages themselves: blocks inside elements
whose names say what they are (``article``, ``nav`` and the like) teach it, and
it judges those where no name helps.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import arrow_schema, pick, slices

# The elements of HTML by what they do here.
RAW = frozenset("script style iframe noembed noframes textarea title noscript template svg object canvas audio video select".split())
TO_END = frozenset("script style iframe noembed noframes textarea title".split())  # left open, these swallow the rest of the page
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var math mi mn mo mrow msub msup msubsup mfrac msqrt mroot mtext mstyle semantics".split()
)
# An element that starts closes these that are open, up to one that holds them.
CLOSES = {
    **dict.fromkeys("li".split(), (frozenset(["li"]), frozenset("ul ol menu".split()))),
    **dict.fromkeys("dt dd".split(), (frozenset(["dt", "dd"]), frozenset(["dl"]))),
    **dict.fromkeys("td th".split(), (frozenset(["td", "th"]), frozenset(["tr", "table"]))),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    **dict.fromkeys("option optgroup".split(), (frozenset(["option"]), frozenset(["select"]))),
}
NEVER = frozenset("nav footer aside menu dialog form button fieldset".split())
MAIN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES_NEVER = frozenset("navigation contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
ROLES_MAIN = frozenset("main article".split())
# Words of class and id that name boilerplate or content.
NAMES_NEVER = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted outbrain taboola nav navbar navigation menu menus submenu breadcrumb breadcrumbs "
    "footer foot header masthead topbar toolbar sidebar aside rail widget widgets cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup login signin register paywall share sharing social sociallinks follow related recommended recommendations trending popular teaser teasers tags tagcloud pagination pager "
    "comment comments commentlist reply replies respond disqus discussion feedback search searchbox form copyright legal disclaimer skip skiplink print tools".split()
)
NAMES_MAIN = frozenset("article articlebody content main post posttext postbody entry story storybody body text prose richtext maincontent".split())
PHRASES = re.compile(
    r"©|\(c\) ?\d{4}|all rights reserved|cookie|privacy policy|terms of (?:use|service)|subscribe|newsletter|sign (?:in|up)|log ?in|advertis|sponsored|share (?:this|on)|follow us|read more|leave a (?:comment|reply)|javascript",
    re.I,
)

# A tag (name, attributes), a comment, or a declaration; everything else is text.
MARKUP = re.compile(r"<(?:!--(?:(?=-?>)|.*?(?:--!?>|\Z))|(/?)([A-Za-z][^\s/>]*+)((?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+)(?:>|\Z)|[!?/][^>]*+(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)
NAME_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
SPACE = re.compile(r"[ \t\n\r\f\v]+")
END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}

# Log odds of content, or of boilerplate where below 0, that names give.
SAYS_NEVER, SAYS_MAIN, SAYS_HEADER, SAYS_PHRASE = -8.0, 3.0, -8.0, -1.5
# Smoothness: between neighbours in the page, a block and its container, and containers.
ADJACENT, CONTAINED, NESTED = 0.75, 0.5, 0.25
UNIT = 100  # capacities are integers, hundredths
# The classifier without any page to learn from, which it keeps near to (a Gaussian
# prior): bias, words (log2), link share, ends a sentence, heading, symbols, longest neighbour (log2).
PRIOR = (-2.5, 0.7, -5.0, 1.0, 0.5, -1.0, 0.2)
PRIOR_WEIGHT, CLAMP = 8.0, 4.0
TRAIN_PAGES = 2048


class Block:
    __slots__ = ("parts", "box", "words", "linked", "heading", "text")

    def __init__(self, box: int, heading: bool):
        self.parts, self.box, self.words, self.linked, self.heading, self.text = [], box, 0, 0, heading, ""


class Box:
    """A block-level element that text lies in."""

    __slots__ = ("name", "parent", "says", "inside_main", "weak")

    def __init__(self, name: str, parent: int, says: float, inside_main: bool, weak: bool):
        self.name, self.parent, self.says, self.inside_main, self.weak = name, parent, says, inside_main, weak


def says(name: str, attributes: str, inside_main: bool) -> tuple[float, bool]:
    """(log odds that the element's own names give for what is inside it,
    whether only its class or id say so)."""
    if name in NEVER:
        return SAYS_NEVER, False
    if name == "header" and not inside_main:
        return SAYS_HEADER, False
    own = SAYS_MAIN if name in MAIN else 0.0
    if "=" not in attributes or name in ("html", "body"):
        return own, False
    words = set()
    for m in ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind == "role":
            role = value.strip().lower()
            if role in ROLES_NEVER or role == "banner" and not inside_main:
                return SAYS_NEVER, False
            if role in ROLES_MAIN:
                own = SAYS_MAIN
        elif kind == "itemprop":
            if value.strip().lower() == "articlebody":
                own = SAYS_MAIN
        else:
            words.update(w.lower() for w in NAME_WORD.findall(value))
    if own or not words or name in HEADINGS:  # an article's own class names say nothing against it
        return own, False
    never, main = bool(words & NAMES_NEVER), bool(words & NAMES_MAIN)
    if never and words & {"comment", "comments", "commentlist", "disqus", "respond", "reply", "replies"}:
        return SAYS_NEVER, False
    if inside_main and never and words & NAMES_NEVER == {"header"}:  # an article's own header
        return 0.0, False
    return (SAYS_NEVER, True) if never and not main else (SAYS_MAIN / 2, True) if main and not never else (0.0, False)


def blocks_of(page: str) -> tuple[list[Block], list[Box]]:
    """A page's blocks of text in order, and the elements that they lie in.

    Text ends a block where a block-level element starts or ends, or at a line
    break; scripts, styles, form controls and the title are skipped."""
    boxes = [Box("", -1, 0.0, False, False)]
    open_: list[tuple[str, int]] = [("", 0)]  # names of open elements, with the box that text in them is in
    blocks: list[Block] = []
    block: Block | None = None
    links, at, n = 0, 0, len(page)
    while at < n:
        m = MARKUP.search(page, at)
        end = m.start() if m else n
        if end > at:
            raw = page[at:end]
            text = html.unescape(raw) if "&" in raw else raw
            if block is None:
                if not text.isspace():
                    block = Block(open_[-1][1], any(name in HEADINGS for name, _ in open_[-4:]))
            if block is not None:
                block.parts.append(text)
                if links:
                    block.linked += len(text.split())
        if m is None:
            break
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:  # an end tag
            if name in VOID:
                if name == "br" and block is not None:
                    block.parts.append(" ")
                continue
            if name == "a":
                links = max(0, links - 1)
            depth = len(open_) - 1
            if name in INLINE:  # closes only inline elements within its block
                while depth and open_[depth][0] in INLINE and open_[depth][0] != name:
                    depth -= 1
                if open_[depth][0] == name:
                    del open_[depth]
                continue
            while depth and open_[depth][0] != name:
                depth -= 1
            if depth:
                if any(x == "a" for x, _ in open_[depth:]):
                    links = 0
                del open_[depth:]
            if block is not None:
                blocks.append(block)
                block = None
            continue
        attributes = m[3]
        if name == "br" or name == "wbr":
            if name == "br" and block is not None:
                block.parts.append(" ")
            continue
        if name in RAW:
            if attributes.endswith("/") and name in ("svg", "math"):
                continue
            close = END[name].search(page, at)
            if close is None:
                at = n if name in TO_END else at
            else:
                after = page.find(">", close.end())
                at = n if after < 0 else after + 1
            if name in ("select", "textarea") and block is not None:
                block.parts.append(" ")
            continue
        if name in VOID:
            if name == "hr" and block is not None:
                blocks.append(block)
                block = None
            continue
        if name in INLINE:
            if name == "a":
                links = 1
            box = open_[-1][1]
            if "=" in attributes and (own := says(name, attributes, boxes[box].inside_main))[0] < 0 and name != "a":
                if block is not None:  # an inline element that is named as boilerplate is a block of its own
                    blocks.append(block)
                    block = None
                boxes.append(Box(name, box, own[0], boxes[box].inside_main, own[1]))
                open_.append((name + "!", len(boxes) - 1))
                # its end tag must end the block too
                stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                inner, at = page[at : stop.start() if stop else n], stop.end() if stop else n
                text = SPACE.sub(" ", html.unescape(MARKUP.sub(" ", inner))).strip(" ")
                if text:
                    blocks.append(Block(len(boxes) - 1, False))
                    blocks[-1].parts.append(text)
                open_.pop()
                continue
            open_.append((name, box))
            continue
        if block is not None:
            blocks.append(block)
            block = None
        # A paragraph ends where any block-level element starts; inline elements left open end with it.
        while len(open_) > 1 and (open_[-1][0] in INLINE or open_[-1][0] == "p"):
            if open_.pop()[0] == "a":
                links = 0
        if name in CLOSES:
            same, holders = CLOSES[name]
            for depth in range(len(open_) - 1, 0, -1):
                if open_[depth][0] in holders:
                    break
                if open_[depth][0] in same:
                    del open_[depth:]
                    break
        box = open_[-1][1]
        inside = boxes[box].inside_main
        own, weak = says(name, attributes, inside)
        if (own or name not in ("p", "li", "tr", "td", "th", "dt", "dd", *HEADINGS)):
            boxes.append(Box(name, box, own, inside or name in MAIN or own == SAYS_MAIN, weak))
            box = len(boxes) - 1
        open_.append((name, box))
    if block is not None:
        blocks.append(block)
    kept = []
    for b in blocks:
        b.text = SPACE.sub(" ", "".join(b.parts)).strip(" ")
        b.parts = []
        if b.text:
            b.words = b.text.count(" ") + 1
            kept.append(b)
    return kept, boxes


def evidence(blocks: list[Block], boxes: list[Box]) -> list[float]:
    """What names say for each block. A name against an element or one that it
    lies in outweighs all for it. Class names alone don't count on a wrapper of
    more than half of the page's words with an article or heading 1 in it."""
    words, holds = [0] * len(boxes), [False] * len(boxes)
    for b in blocks:
        words[b.box] += b.words
        holds[b.box] |= b.heading
    for i in range(len(boxes) - 1, 0, -1):
        box = boxes[i]
        words[box.parent] += words[i]
        holds[box.parent] |= holds[i] or box.name in MAIN
    total = [0.0] * len(boxes)
    for i in range(1, len(boxes)):
        box = boxes[i]
        own = 0.0 if box.weak and box.says < 0 and holds[i] and 2 * words[i] > words[0] else box.says
        above = total[box.parent]
        total[i] = min(own, above) if own < 0 or above < 0 else max(own, above)
    return [total[b.box] for b in blocks]


def features(blocks: list[Block]) -> np.ndarray:
    """One row of classifier inputs a block, in steps, so that few rows differ."""
    n = len(blocks)
    x = np.zeros((n, len(PRIOR)))
    size = np.array([b.words for b in blocks], float)
    log = np.minimum(np.round(np.log2(1 + size)), 8)
    padded = np.concatenate([[0], log, [0]])
    x[:, 0], x[:, 1] = 1, log
    x[:, 2] = np.round(4 * np.minimum(np.array([b.linked for b in blocks]) / size, 1)) / 4
    x[:, 3] = [b.text[-1] in ".!?…。！？:\"”»'" for b in blocks]
    x[:, 4] = [b.heading for b in blocks]
    x[:, 5] = [b.words <= 40 and PHRASES.search(b.text) is not None for b in blocks]
    x[:, 6] = np.maximum(padded[:-2], padded[2:])
    return x


def fit(x: np.ndarray, y: np.ndarray, n: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Logistic regression near the prior, by Newton's steps; ``n`` counts rows.
    Both labels weigh the same, whatever their number."""
    prior = np.array(PRIOR)
    if not len(x) or not (y == 1).any() or not (y == 0).any():
        return prior
    weight = n * np.where(y == 1, 1 / n[y == 1].sum(), 1 / n[y == 0].sum()) * 500

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + PRIOR_WEIGHT / 2 * ((w - prior) ** 2).sum())

    w = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + PRIOR_WEIGHT * (w - prior)
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + PRIOR_WEIGHT * np.eye(len(w)), gradient)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return w


class Network:
    """A flow network with terminal capacities, for a minimum cut.

    ``cut`` first settles nodes whose terminal capacity is no less than all their
    edges (their label can't change), which turns their edges into terminal
    capacity of their neighbours. Maximum flow then labels what is left."""

    def __init__(self, n: int):
        self.gain = [0] * n  # source minus sink capacity
        self.edges: list[dict[int, int]] = [{} for _ in range(n)]

    def join(self, a: int, b: int, capacity: int) -> None:
        if a != b and capacity > 0:
            self.edges[a][b] = self.edges[a].get(b, 0) + capacity
            self.edges[b][a] = self.edges[b].get(a, 0) + capacity

    def cut(self) -> list[bool]:
        """Whether each node is on the source side of the least such minimum cut
        that leaves ties on the sink side."""
        n = len(self.gain)
        label: list[bool | None] = [None] * n
        gain, edges = self.gain[:], [dict(e) for e in self.edges]
        around = [sum(e.values()) for e in edges]
        queue = deque(range(n))
        while queue:
            a = queue.popleft()
            if label[a] is not None:
                continue
            # On the source side a node must win; a tie is on the sink side.
            side = True if gain[a] > around[a] else False if -gain[a] >= around[a] else None
            if side is None:
                continue
            label[a] = side
            for b, c in edges[a].items():
                if label[b] is None:
                    gain[b] += c if side else -c
                    around[b] -= c
                    queue.append(b)
        left = [a for a in range(n) if label[a] is None]
        if left:
            place = {a: i for i, a in enumerate(left)}
            for a, side in zip(left, max_flow([gain[a] for a in left], [{place[b]: c for b, c in edges[a].items() if b in place} for a in left])):
                label[a] = side
        return label


def max_flow(gain: list[int], edges: list[dict[int, int]]) -> list[bool]:
    """The source side of the minimum cut nearest to the source, by blocking
    flows over shortest paths; the dicts of residual capacities are changed."""
    n = len(gain)
    source, sink = [max(g, 0) for g in gain], [max(-g, 0) for g in gain]
    while True:
        level = [-1] * n
        queue = deque()
        for a in range(n):
            if source[a]:
                level[a] = 0
                queue.append(a)
        reached = False
        while queue:
            a = queue.popleft()
            reached |= sink[a] > 0
            for b, c in edges[a].items():
                if c > 0 and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        if not reached:
            return [x >= 0 for x in level]
        paths = [iter(list(e)) for e in edges]
        for start in range(n):
            path = [start]
            while source[start] and path:
                a = path[-1]
                if sink[a]:
                    flow = min(source[start], sink[a], *(edges[u][v] for u, v in zip(path, path[1:])))
                    source[start] -= flow
                    sink[a] -= flow
                    back = None
                    for i, (u, v) in enumerate(zip(path, path[1:])):
                        edges[u][v] -= flow
                        edges[v][u] = edges[v].get(u, 0) + flow
                        if back is None and not edges[u][v]:
                            back = i + 1
                    if back is not None:
                        del path[back:]
                    continue
                for b in paths[a]:
                    if edges[a].get(b, 0) > 0 and level[b] == level[a] + 1:
                        path.append(b)
                        break
                else:
                    path.pop()
                    if path:  # the edge to here is of no more use in this round
                        continue


def label_blocks(blocks: list[Block], boxes: list[Box], weights: np.ndarray) -> list[bool]:
    """Whether each block is content, by a minimum cut."""
    if not blocks:
        return []
    unary = np.clip(features(blocks) @ weights, -CLAMP, CLAMP) + np.array(evidence(blocks, boxes))
    used: dict[int, int] = {}
    net = Network(len(blocks))
    net.gain = np.round(unary * UNIT).astype(int).tolist()

    def node(box: int) -> int:
        if box not in used:
            used[box] = len(net.gain)
            net.gain.append(0)
            net.edges.append({})
            if boxes[box].parent >= 0:
                net.join(used[box], node(boxes[box].parent), round(NESTED * UNIT))
        return used[box]

    for i, b in enumerate(blocks):
        net.join(i, node(b.box), round(CONTAINED * UNIT))
        if i:
            near = blocks[i - 1].box == b.box
            net.join(i - 1, i, round(ADJACENT * UNIT) if near else round(ADJACENT * UNIT) // 3)
    return net.cut()[: len(blocks)]


def main_text(page: str | None, weights: np.ndarray = np.array(PRIOR)) -> tuple[str, int, int]:
    """(main text, number of blocks, number of content blocks) of a page."""
    blocks, boxes = blocks_of(page) if page else ([], [])
    kept = [b.text for b, content in zip(blocks, label_blocks(blocks, boxes, weights)) if content]
    return " ".join(kept), len(blocks), len(kept)


def train(pages: DataFrame, html_col: str, train_pages: int) -> np.ndarray:
    """The classifier's weights from about ``train_pages`` pages, chosen by hash.
    Blocks are reduced to counts of distinct rows of inputs, a few hundred."""
    schema_text = ", ".join(f"x{i} double" for i in range(len(PRIOR))) + ", y int, n long"
    schema = arrow_schema(schema_text)
    total = pages.count()
    sample = pick(pages, html=html_col).filter(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, train_pages / max(1, total)))).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, int] = {}
        for batch in slices(batches, 64):
            for page in batch.column(0).to_pylist():
                if not page:
                    continue
                blocks, boxes = blocks_of(page)
                for row, said in zip(features(blocks).tolist() if blocks else [], evidence(blocks, boxes)):
                    if said <= SAYS_NEVER or said >= SAYS_MAIN:
                        key = (*row, int(said > 0))
                        seen[key] = seen.get(key, 0) + 1
        rows = [(*k, c) for k, c in seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)

    names = [f.name for f in schema][:-1]
    rows = np.array([tuple(r) for r in sample.mapInArrow(run, schema_text).groupBy(*names).agg(F.sum("n").alias("n")).orderBy(*names).collect()], float)
    if not len(rows):
        return np.array(PRIOR)
    return fit(rows[:, : len(PRIOR)], rows[:, -2], rows[:, -1])


def extract_main_text(pages: DataFrame, train_pages: int = TRAIN_PAGES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(``page_id``, ``url``, ``text``, ``n_chars``, ``n_blocks``, ``n_content``):
    the main text of each page and its length in code points, with the number of
    its blocks of text and of those that are content.

    White space (space, tab, line breaks, form feed) within a block becomes one
    space, blocks are joined by one space, character references are decoded as
    HTML5 says. Headings inside an article are part of it. A null or empty page,
    or one without content, gives an empty text; a text without any markup is one
    block. Ids and urls pass through, null and repeated ones too; other columns are
    ignored; an empty table gives no rows. Pages are read whole.

    The classifier learns from about ``train_pages`` pages (all, if there are
    fewer), chosen by a hash of their text, so it does not change with the number
    of partitions. Time and memory of a page grow with its own length.
    """
    weights = train(pages, html_col, train_pages).tolist()
    schema_text = "page_id long, url string, text string, n_chars long, n_blocks int, n_content int"
    schema_text = schema_text.replace("page_id long", f"page_id {pages.schema[id_col].dataType.simpleString()}", 1)
    schema = arrow_schema(schema_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = np.array(weights)
        for batch in slices(batches, 64):
            got = [main_text(page, learned) for page in batch.column(2).to_pylist()]
            texts = [t for t, _, _ in got]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([n for _, n, _ in got], pa.int32()), pa.array([n for _, _, n in got], pa.int32())], schema=schema)

    return pick(pages, page_id=id_col, url=url_col, html=html_col).mapInArrow(run, schema_text)
