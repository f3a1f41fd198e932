"""Main text of HTML pages by minimum-cut labelling.

A page is cut into blocks of text at block-level tags. A logistic classifier over a block's link share, length,
punctuation and the tags and class words around it gives each block its log odds of being content: these are the
capacities to the two terminals. Neighbouring blocks, and a block and the next one of the same parent, are joined by
edges of the same scale, whose capacity is `EDGE` for blocks of one parent and falls with their distance in the document
tree (none beyond `FAR` steps; the border of a marked advert, menu or the like counts as `BORDER` steps). The minimum cut is the labelling of least total cost; blocks whose own cost exceeds all
their edges are decided beforehand, which leaves the optimum as it is. So a short or plain block takes the side of what
surrounds it, while a footer or notice inside an article stays out.

The classifier is fitted on at most `SAMPLE` distinct pages of up to `SAMPLE_CHARS` characters, `SAMPLE_TOTAL` together, in the order of a hash,
with blocks inside article or main as content and those inside nav, footer, aside or form as boilerplate; it is held near
given weights, which also serve alone where no page has both kinds.

Null and empty html give an empty text. Pages are read in one pass that takes time in proportion to their length: quotes
inside unquoted values are plain characters, a tag without `>` ends at the next `<`, a quote that never closes ends with
its word, stray closing tags and unknown tags are passed over, an unfinished tag at the end is no text. Hidden elements (by attribute or
style) are no text. Class words count on containers, and at the start of a class on paragraphs and headings; a page without article or main has no bias against its blocks. Repeated rows and
ids give repeated results; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict, deque

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiscope.llm.common import first_by_hash, small

SAMPLE = 1000
#: Characters of a page that the fit takes, and of all its pages together.
SAMPLE_CHARS, SAMPLE_TOTAL = 1 << 20, 1 << 25
EDGE = 1.5
FAR = 16
BORDER = 8
SCHEMA = "page_id long, url string, text string, n_chars long, n_blocks long, n_changed long"

# Tags of HTML by their role.
BLOCK = frozenset("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html iframe legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("head script style template noscript svg math iframe object select textarea button title canvas audio video".split())
CLOSES_P = BLOCK - {"br", "body", "html", "td", "th", "tr", "li", "option", "optgroup", "legend", "caption", "button"}
GOOD = frozenset(("article", "main"))
BAD = frozenset(("nav", "footer", "aside", "form", "menu", "dialog"))
ITEMS = frozenset("li dt dd option tr td th".split())
LISTS = ("ul", "ol", "dl", "table", "select", "menu")
RAW = frozenset("script style textarea title iframe noscript".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class, id and role that mark what is not the article, and what is; a word after one of these prefixes says nothing.
BAD_WORD = re.compile(r"(?:^|[-_])(?:ad|ads|adv|advert\w*|banner|promo\w*|sponsor\w*|cookie\w*|consent|notice\w*|popup|modal|newsletter|subscribe|signup|login|comment\w*|disqus|respond|responses?|replies|reply|reviews?|feedback|discussion|sidebar\w*|side|aside|widget\w*|related\w*|recommend\w*|share\w*|social|menu\w*|nav\w*|breadcrumb\w*|footer\w*|foot|header|masthead|topbar|toolbar|pagination|pager|copyright|legal|disclaimer|search\w*|contentinfo|navigation|complementary|alert\w*)(?:$|[-_])", re.I)
GOOD_WORD = re.compile(r"(?:^|[-_])(?:article\w*|content|main|post|entry|story|body)(?:$|[-_])", re.I)
#: The same at the start of a class: all that counts on a paragraph or heading, which says more of what it is after words for where it is.
BAD_START = re.compile("^" + BAD_WORD.pattern.removeprefix("(?:^|[-_])"), re.I)
NO_WORD = re.compile(r"(?:no|has|with|without|hide|show)[-_]", re.I)
# Weights held near: bias, good tag, bad tag, good word, bad word, link share, log words, sentence marks, list item, heading, page header, page without article or main, mark of ownership first.
PRIOR = np.array([-1.5, 4.0, -10.0, 1.0, -8.0, -4.0, 0.5, 1.0, -0.5, 0.5, -8.0, 0.3, -4.0])
OWNED = re.compile(r"\s*(?:©|\(c\)|copyright\b|all rights reserved)", re.I)

#: A tag as it is mostly written; possessive, so it never goes back.
PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*+)((?:\s++[^\s=<>/\"']++(?:=(?:\"[^\"<>]*+\"|'[^'<>]*+'|[^\s<>\"'=]++))?+)*+)\s*+(/?)>")
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*+)")
SPACE = re.compile(r"[\s/]*+")
ATTRIBUTE = re.compile(r"([^\s=<>/][^\s=<>/]*+)(\s*+=\s*+)?+")
VALUE = re.compile(r"[^\s>]*+")
QUOTED = re.compile(r"(=\s*)(?:\"[^\"]*\"|'[^']*')")
MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_GOOD, _BAD, _GOOD_WORD, _BAD_WORD, _ITEM, _HEADING, _HEADER, _OWNED = (1 << k for k in range(8))


def _hides(attributes: str) -> bool:
    """Whether a tag's attributes hide it."""
    low = attributes.lower()
    if "hidden" not in low and "none" not in low:
        return False
    bare = QUOTED.sub(r"\1v", attributes)
    return bool(re.search(r"(?:^|\s)hidden(?=$|[\s=/])", bare, re.I)) or bool(re.search(r"\baria-hidden\s*=\s*[\"']?true|\bstyle\s*=\s*(?:\"[^\"]*|'[^']*)(?:display\s*:\s*none|visibility\s*:\s*hidden)", attributes, re.I))


class Block:
    """Text, its block-level node, its characters inside links, and flags of what is around it."""

    __slots__ = ("text", "node", "linked", "flags")

    def __init__(self, text: str, node: int, linked: int, flags: int):
        self.text, self.node, self.linked, self.flags = text, node, linked, flags


class Page:
    """Blocks in order, and the parent and depth of every block-level node."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.parent, self.depth = [0], [0]

    def distance(self, a: int, b: int) -> int:
        """Steps between two nodes, or FAR + 1 if there are more than FAR."""
        steps = abs(self.depth[a] - self.depth[b])
        while a != b and steps <= FAR:
            if self.depth[a] >= self.depth[b]:
                up = self.parent[a]
                steps += self.depth[a] == self.depth[b]
                a = up
            else:
                b = self.parent[b]
        return steps if a == b else FAR + 1


def _slow_tag(page: str, at: int, gone: set[str]) -> tuple[int, str, str, list[str], bool]:
    """A tag that PLAIN doesn't match: where it ends, "/" if it closes, its name, marks, and whether it closes itself."""
    m = NAME.match(page, at)
    at, marks, end = m.end(), [], len(page)
    while True:
        to = SPACE.match(page, at).end()
        own = page[to - 1 : to] == "/" and page[to : to + 1] == ">"
        at = to
        if at >= end or page[at] == "<":
            return at, m[1], m[2], marks, False
        if page[at] == ">":
            return at + 1, m[1], m[2], marks, own
        a = ATTRIBUTE.match(page, at)
        if a is None:  # a stray "="
            at += 1
            continue
        at = a.end()
        if not a[2]:
            continue
        quote, value = page[at : at + 1], None
        if quote in ("'", '"') and quote and quote not in gone:
            if (stop := page.find(quote, at + 1)) < 0:
                gone.add(quote)  # none is left in the page
            else:
                value, at = page[at + 1 : stop], stop + 1
        if value is None:
            v = VALUE.match(page, at)
            value, at = v[0].strip("\"'"), v.end()
        if a[1].lower() in ("class", "id", "role"):
            marks.append(value)


def _words(marks: list[str], bad: re.Pattern) -> tuple[bool, bool]:
    """Whether the words of class, id and role mark what is not the article, and what is."""
    words = [w for m in marks for w in m.split() if not NO_WORD.match(w)]
    return any(map(bad.search, words)), any(map(GOOD_WORD.search, words))


def read(page: str) -> Page:
    """The page's blocks of visible text, in order."""
    out = Page()
    stack: list[tuple[str, int, int, bool]] = []  # tag, block-level node, flags of it and all around it, hidden
    places: dict[str, list[int]] = defaultdict(list)  # of each tag's open elements in the stack
    parts: list[str] = []
    gone: set[str] = set()  # quotes and closing tags that do not occur any more
    linked = skip = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                _, node, flags, _ = stack[-1] if stack else ("", 0, 0, False)
                out.blocks.append(Block(text, node, min(linked, len(text)), flags | _OWNED * (not flags & _GOOD and OWNED.match(text) is not None)))
            parts.clear()
        linked = 0

    def cut(size: int) -> None:
        """Close all elements of the stack from this place on."""
        nonlocal skip
        while len(stack) > size:
            tag, _, _, hidden = stack.pop()
            skip -= hidden
            places[tag].pop()

    at, end = 0, len(page)
    while at < end:
        to = page.find("<", at)
        to = end if to < 0 else to
        if to > at and not skip:
            text = page[at:to]
            parts.append(text)
            if places["a"]:
                linked += len(text.strip())
        if to == end:
            break
        at, after = to, page[to + 1 : to + 2]
        if after in ("!", "?"):
            for begins, ends in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<", ">")):
                if page.startswith(begins, at):
                    stop = page.find(ends, at + len(begins))
                    at = end if stop < 0 else stop + len(ends)
                    break
            continue
        if m := PLAIN.match(page, at):
            at, closing, tag, own = m.end(), m[1], m[2].lower(), bool(m[4])
            marks = ["".join(x) for x in MARKS.findall(m[3])] if "=" in m[3] and not closing else []
            unseen = not closing and _hides(m[3])
        elif NAME.match(page, at):
            at, closing, tag, marks, own = _slow_tag(page, at, gone)
            tag, unseen = tag.lower(), False
            if at >= end and page[-1] != ">":
                break
        else:  # a plain "<"
            if not skip:
                parts.append("<")
            at += 1
            continue
        if tag in BLOCK and not skip:
            flush()
        if closing:
            if places[tag]:
                cut(places[tag][-1])
            continue
        if tag in CLOSES_P:
            if places["p"] and places["p"][-1] >= len(stack) - 4:
                cut(places["p"][-1])
        elif tag in ITEMS and places[tag]:
            if places[tag][-1] > max((places[x][-1] for x in LISTS if places[x]), default=-1):
                cut(places[tag][-1])
        if tag in VOID or own:
            continue
        if tag == "body":  # what the head left open ends here
            cut(0)
        _, node, flags, _ = stack[-1] if stack else ("", 0, 0, False)
        if tag in BLOCK:
            out.parent.append(node)
            out.depth.append(out.depth[node] + 1)
            node = len(out.parent) - 1
        bad, good = _words(marks, BAD_START if tag == "p" or tag in HEADINGS else BAD_WORD)
        flags |= _GOOD * (tag in GOOD) | _BAD * (tag in BAD) | _GOOD_WORD * good | _BAD_WORD * (bad and tag not in ("html", "body", "main")) | _ITEM * (tag in ("li", "td")) | _HEADING * (tag in HEADINGS)
        flags |= _HEADER * (tag == "header" and not flags & _GOOD)
        hidden = tag in SKIP or (unseen and tag not in ("html", "body"))
        places[tag].append(len(stack))
        stack.append((tag, node, flags, hidden))
        skip += hidden
        if tag in RAW:
            close = None if f"</{tag}" in gone else re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            if close:
                at = close.start()
            else:
                gone.add(f"</{tag}")
                at = end if tag in ("script", "style") else at
    flush()
    return out


def features(found: list[Block]) -> np.ndarray:
    out, none = np.zeros((len(found), len(PRIOR))), not any(b.flags & _GOOD for b in found)
    for row, b in zip(out, found):
        f = b.flags
        row[:] = (1, f & _GOOD > 0, f & _BAD > 0, f & _GOOD_WORD > 0, f & _BAD_WORD > 0, b.linked / max(1, len(b.text)), np.log(b.text.count(" ") + 1),
                  min(4, sum(map(b.text.count, ".!?"))) / 4, f & _ITEM > 0, f & _HEADING > 0, f & _HEADER > 0, none, f & _OWNED > 0)
    return out


def _bordered(a: Block, b: Block) -> bool:
    """Whether one of the two is marked as no article, by itself or by what it is in, and the other is not."""
    marked = _BAD | _BAD_WORD | _HEADER | _OWNED
    return bool(a.flags & marked) != bool(b.flags & marked)


def edges_of(page: Page) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours, and a block and the next one of the same parent."""
    out, last = [], {}
    for i, b in enumerate(page.blocks):
        if i and (d := page.distance(page.blocks[i - 1].node, b.node)) <= FAR:
            out.append((i - 1, i, EDGE / (max(1, d - 1) + BORDER * _bordered(page.blocks[i - 1], b))))
        home = page.parent[b.node]
        if (j := last.get(home)) is not None and j != i - 1:
            out.append((j, i, EDGE / (1 + BORDER * _bordered(page.blocks[j], b))))
        last[home] = i
    return out


def minimum_cut(gain: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Labels (True: content) of least cost; gain is the cost of calling a block boilerplate less that of content."""
    n = len(gain)
    weight = np.zeros(n)
    for i, j, w in edges:
        weight[i] += w
        weight[j] += w
    label = gain > 0
    fixed = np.abs(gain) > weight
    if fixed.all():
        return label
    # the rest keep their edges to decided blocks as terminal capacity
    rest = gain.astype(float)
    net = _Net(n + 2)
    for i, j, w in edges:
        if not fixed[i] and not fixed[j]:
            net.join(i, j, w, w)
        elif not fixed[i]:
            rest[i] += w if label[j] else -w
        elif not fixed[j]:
            rest[j] += w if label[i] else -w
    for k in np.flatnonzero(~fixed).tolist():
        if rest[k] > 0:
            net.join(n, k, rest[k], 0.0)
        elif rest[k] < 0:
            net.join(k, n + 1, -rest[k], 0.0)
    reached = net.saturate(n, n + 1)
    for k in np.flatnonzero(~fixed).tolist():
        label[k] = reached[k] >= 0
    return label


class _Net:
    """Maximum flow by blocking flows along shortest paths."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[float] = []

    def join(self, a: int, b: int, there: float, back: float) -> None:
        for u, v, c in ((a, b, there), (b, a, back)):
            self.out[u].append(len(self.to))
            self.to.append(v)
            self.room.append(c)

    def _levels(self, source: int) -> list[int]:
        level, queue = [-1] * len(self.out), deque([source])
        level[source] = 0
        while queue:
            u = queue.popleft()
            for e in self.out[u]:
                if self.room[e] > 1e-12 and level[v := self.to[e]] < 0:
                    level[v] = level[u] + 1
                    queue.append(v)
        return level

    def saturate(self, source: int, sink: int) -> list[int]:
        """Push all flow there is; returns each node's level from the source, -1 where it can't be reached any more."""
        while (level := self._levels(source))[sink] >= 0:
            tried, path, u = [0] * len(self.out), [], source
            while True:
                if u == sink:
                    flow = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= flow
                        self.room[e ^ 1] += flow
                    k = next(k for k, e in enumerate(path) if self.room[e] <= 1e-12)
                    u = self.to[path[k] ^ 1]
                    del path[k:]
                elif tried[u] < len(self.out[u]):
                    e = self.out[u][tried[u]]
                    if self.room[e] > 1e-12 and level[self.to[e]] == level[u] + 1:
                        path.append(e)
                        u = self.to[e]
                    else:
                        tried[u] += 1
                elif path:
                    u = self.to[path.pop() ^ 1]
                    tried[u] += 1
                else:
                    break
        return level


def label(page: Page, weights: np.ndarray) -> tuple[np.ndarray, int]:
    """Whether each block is content, and how many of them the classifier alone would have told otherwise."""
    gain = features(page.blocks) @ weights
    kept = minimum_cut(gain, edges_of(page))
    return kept, int((kept != (gain > 0)).sum())


def main_text(page: str | None, weights: np.ndarray = PRIOR) -> tuple[str, int, int]:
    """Text, number of blocks, and number of labels that the cut changes."""
    found = read(page or "")
    if not found.blocks:
        return "", 0, 0
    kept, changed = label(found, weights)
    return " ".join(b.text for b, k in zip(found.blocks, kept) if k), len(kept), changed


def fit(pages: list[str], rounds: int = 20, hold: float = 50.0) -> np.ndarray:
    """Weights near PRIOR from blocks whose tags tell what they are (these tags themselves left out half the time)."""
    x, y = [], []
    for page in pages:
        found = [b for b in read(page).blocks if bool(b.flags & _GOOD) != bool(b.flags & _BAD)]
        if not any(b.flags & _GOOD for b in found):
            continue
        x.append(features(found))
        y += [bool(b.flags & _GOOD) for b in found]
    x, y = np.concatenate(x) if x else np.zeros((0, len(PRIOR))), np.array(y, float)
    if not len(y) or y.min() == y.max():
        return PRIOR
    blind = x.copy()
    blind[:, 1:3] = 0
    x, y = np.concatenate([x, blind]), np.concatenate([y, y])
    w = PRIOR.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - hold * (w - PRIOR)
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold * np.eye(len(w)), grad)
    return w


def train(pages: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    some = pages.where(F.length("html") <= SAMPLE_CHARS).select("page_id", F.xxhash64("page_id", "html").alias("mark"), "html")
    sized = some.select(F.lit(0).alias("all"), "mark", F.length("html").alias("size"))
    picked = first_by_hash(sized, "all", sample, size="size", total=SAMPLE_TOTAL)
    some = some.join(F.broadcast(picked.select("mark")), "mark").dropDuplicates(["mark"]).select("html")  # at most `sample` marks, a page each

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"w": [fit(sorted(pdf["html"]))[:].tolist()]})

    got = some.groupBy().applyInPandas(run, "w array<double>").collect()
    return np.array(got[0].w) if got else PRIOR


def extract(pages: DataFrame, weights: np.ndarray) -> DataFrame:
    """page_id, url, text and n_chars of every page, and how many blocks it has and how many labels the cut changed."""

    def run(batches):
        for b in small(batches):
            got = [main_text(x.as_py(), weights) for x in b.column("html")]
            counts = [pa.array(c, pa.int64()) for c in ([len(g[0]) for g in got], [g[1] for g in got], [g[2] for g in got])]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array([g[0] for g in got], pa.string()), *counts], names=["page_id", "url", "text", "n_chars", "n_blocks", "n_changed"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, SCHEMA)
