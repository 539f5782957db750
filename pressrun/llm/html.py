"""Main text of web pages by wrapper induction.

Pages of one host are parsed into trees and aligned with the largest of them by simple tree matching. A node
whose text stays the same below most of the matched nodes belongs to the template, one whose text varies is a slot for
content. Menus, headers, footers, sidebars, notices, adverts, forms, scripts and reader comments are left out by
element and by name. Where a page has article or main elements, the one that holds most of the slots' text is the article;
elsewhere the slots of the whole page are, so there the alignment alone tells content from template.

Pages are dealt by host, and those of a large host by (host, salt) too, so html moves once and no task holds a hot host.
A task reads its pages in order and induces BLOCK to 2 * BLOCK pages of a host at a time.

Matching depends on the labels of a subtree only, so each pair of shapes is matched once. Lists of children are matched by
dynamic programming whatever their length, beyond CELLS cells by halving one list (Hirschberg), with the same result; no
step recurses with the depth of a page.

Defined cases: null or empty html gives an empty text; a null url is the host ''; fewer than MIN_PAGES distinct
pages in a block prove no template; equal pages vote once; a template never takes more than half of an article, nor
all of a page without one, so copies of an article do not erase it; repeated rows are each returned; an empty table gives an empty result;
columns besides page_id, url and html are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressrun.llm._base import HOT_SHARE

#: Pages that are induced together, those that prove a template, share of them with one text.
BLOCK, MIN_PAGES, SAME = 100, 4, 0.8
#: Bytes of html that are induced together at most, but for MIN_PAGES pages.
BLOCK_BYTES = 32_000_000
#: Cells of a table of child matches that is kept whole, and of one that is filled without arrays.
CELLS, FEW = 4_000_000, 600

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SKIPPED = frozenset("head script style noscript template nav footer aside form button select textarea input iframe object svg canvas dialog menu audio video map title xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"}}
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|adsense|banners?|sponsor(?:ed|s)?|promo(?:tion|s)?|cookies?|consent|gdpr|notices?|alerts?|newsletter|subscribe|subscription|paywall"
    r"|sidebars?|side|menus?|nav|navbar|navigation|breadcrumbs?|masthead|topbar|toolbar|footers?|comments?|disqus|replies|reply|respond|share|sharing|social|related|recommended"
    r"|popup|modal|overlay|pagination|pager|widgets?|login|signup|search|skip|copyright|disclaimer)(?:$|[\s_-])",
    re.I,
)
HEADER = re.compile(r"(?:^|[\s_-])header(?:$|[\s_-])", re.I)

# Quotes open a value after = only. No part goes back, and a text that is searched ends with >, so that every tag that begins also ends.
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*+>|<\?[^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "name", "role", "hidden", "children", "inner", "parent", "shape", "size", "text", "fixed")

    def __init__(self, tag: str, parent: Node | None, attributes: str = "") -> None:
        self.tag, self.parent, self.children, self.inner, self.name, self.role, self.hidden = tag, parent, [], [], "", "", False
        self.shape, self.size, self.text, self.fixed = 0, 1, "", False
        if attributes.strip(" /"):
            for key, a, b, c in ATTRIBUTE.findall(attributes):
                key, value = key.lower(), a or b or c
                if key in ("class", "id"):
                    self.name += " " + value
                elif key in ("role", "itemprop"):
                    self.role += " " + value.lower()
                elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
                    self.hidden = True

    @property
    def label(self) -> tuple[str, str]:
        return self.tag, self.name


def parse(html: str) -> Node:
    """A tree of elements; children that are strings are text, with character references decoded."""
    root = here = Node("#root", None)
    at, n, limit = 0, len(html), html.rfind(">") + 1

    def shut(tags: set[str] | frozenset[str], stops: set[str] | frozenset[str]) -> None:
        nonlocal here
        node = here
        found = None
        while node is not root and node.tag not in stops:
            if node.tag in tags:
                found = node
            node = node.parent
        if found is not None:
            here = found.parent

    while at < limit:
        m = TOKEN.search(html, at, limit)
        if m is None:
            break
        if m.start() > at:
            here.children.append(unescape(html[at : m.start()]))
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                return root
            continue
        tag = m[2].lower()
        if m[1]:
            node = here
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                here = node.parent
            continue
        if tag in CLOSES_P:
            shut({"p"}, {"table", "td", "th", "button", "object", "div", "article", "section", "li"})
        if tag in SIBLINGS:
            shut(SIBLINGS[tag], SCOPES[tag])
        node = Node(tag, here, m[3])
        here.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else n
        elif tag not in VOID:
            here = node
    rest = html[at:].partition("<!--")[0]
    if rest:
        here.children.append(unescape(rest))
    return root


def measure(root: Node) -> None:
    """Own text, size and shape of every node, leaves first."""
    stack, order = [root], []
    while stack:
        node = stack.pop()
        order.append(node)
        node.inner = [x for x in node.children if not isinstance(x, str)]
        stack += node.inner
    for node in reversed(order):
        node.text = SPACE.sub(" ", " ".join([x for x in node.children if isinstance(x, str)])).strip()
        node.size = 1 + sum(x.size for x in node.inner)
        node.shape = hash((node.label, tuple([x.shape for x in node.inner])))


#: Weight of the largest match of two shapes, and the places of the matched children.
Memo = dict[tuple[int, int], tuple[int, list[tuple[int, int]]]]


def ends(a: Node, b: Node) -> tuple[int, int]:
    """How many children at both ends have equal shapes. Some largest match pairs them: none can weigh more."""
    x, y = a.inner, b.inner
    most, head, tail = min(len(x), len(y)), 0, 0
    while head < most and x[head].shape == y[head].shape:
        head += 1
    while tail < most - head and x[-1 - tail].shape == y[-1 - tail].shape:
        tail += 1
    return head, tail


def align(a: Node, b: Node, memo: Memo) -> int:
    """Simple tree matching: the size of the largest match that keeps labels, parents and order."""
    stack = [(a, b)]
    while stack:
        p, q = stack[-1]
        key = p.shape, q.shape
        if key in memo:
            stack.pop()
        elif p.label != q.label:
            memo[key] = 0, []
        elif p.shape == q.shape:
            memo[key] = p.size, [(k, k) for k in range(len(p.inner))]
        else:
            head, tail = ends(p, q)
            x, y = p.inner[head : len(p.inner) - tail], q.inner[head : len(q.inner) - tail]
            kinds_x, kinds_y = {c.shape: c for c in x}, {c.shape: c for c in y}
            need = [(c, d) for c in kinds_x.values() for d in kinds_y.values() if (c.shape, d.shape) not in memo]
            if need:
                stack += need
                continue
            weight = np.array([[memo[c, d][0] for d in kinds_y] for c in kinds_x], "i8").reshape(len(kinds_x), len(kinds_y))
            at_x, at_y = {c: k for k, c in enumerate(kinds_x)}, {d: k for k, d in enumerate(kinds_y)}
            middle = best_pairs(np.array([at_x[c.shape] for c in x], "i8"), np.array([at_y[d.shape] for d in y], "i8"), weight)
            found = [(k, k) for k in range(head)] + [(head + i, head + j) for i, j in middle] + [(len(p.inner) - k, len(q.inner) - k) for k in range(tail, 0, -1)]
            same = sum(c.size for c in p.inner[:head]) + sum(c.size for c in p.inner[len(p.inner) - tail :])
            memo[key] = 1 + same + sum(int(weight[at_x[x[i].shape], at_y[y[j].shape]]) for i, j in middle), found
    return memo[a.shape, b.shape][0]


def best_pairs(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[tuple[int, int]]:
    """Pairs in order of greatest weight in all; weight is by kinds, x and y are the kinds of both lists."""
    if not len(x) or not len(y) or not weight.any():
        return []
    if len(x) * len(y) > CELLS and len(x) > 1:
        half = len(x) // 2
        split = int((last_row(x[:half], y, weight) + last_row(x[half:][::-1], y[::-1], weight)[::-1]).argmax())
        return best_pairs(x[:half], y[:split], weight) + [(i + half, j + split) for i, j in best_pairs(x[half:], y[split:], weight)]
    if len(x) * len(y) <= FEW:
        best = [[0] * (len(y) + 1)]
        for a in x.tolist():
            w, above, row = weight[a, y].tolist(), best[-1], [0]
            for j, v in enumerate(w):
                row.append(max(above[j + 1], row[j], above[j] + v))
            best.append(row)
        up = [[p == q for p, q in zip(r[1:], s[1:])] for s, r in zip(best, best[1:])]
        left = [[p == q for p, q in zip(r[1:], r)] for r in best[1:]]
    else:
        up, left = np.empty((len(x), len(y)), bool), np.empty((len(x), len(y)), bool)
        row = np.zeros(len(y) + 1, "i8")
        for i, a in enumerate(x):
            new = next_row(row, weight[a, y])
            up[i], left[i] = new[1:] == row[1:], new[1:] == new[:-1]
            row = new
    out, i, j = [], len(x) - 1, len(y) - 1
    while i >= 0 and j >= 0:
        if up[i][j]:
            i -= 1
        elif left[i][j]:
            j -= 1
        else:
            out.append((i, j))
            i, j = i - 1, j - 1
    return out[::-1]


def next_row(row: np.ndarray, weight: np.ndarray) -> np.ndarray:
    out = row.copy()
    out[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + weight))
    return out


def last_row(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    row = np.zeros(len(y) + 1, "i8")
    for a in x:
        row = next_row(row, weight[a, y])
    return row


def pairs(a: Node, b: Node, memo: Memo | None = None) -> list[tuple[Node, Node]]:
    """All matched nodes of two trees."""
    memo = {} if memo is None else memo
    align(a, b, memo)
    out, stack = [], [(a, b)] if a.label == b.label else []
    while stack:
        p, q = stack.pop()
        out.append((p, q))
        if p.shape == q.shape:
            stack += list(zip(p.inner, q.inner))[::-1]
        else:
            stack += [(p.inner[i], q.inner[j]) for i, j in reversed(memo[p.shape, q.shape][1])]
    return out


def induce(trees: list[Node]) -> None:
    """Marks the template's nodes (`fixed`) in every tree.

    A child of a matched node is constant if most nodes matched there have a child of its label and text: among
    children of one label a match fixes their order only, not which of them stands for which.
    """
    if len(trees) < MIN_PAGES:
        return
    seed, memo = max(trees, key=lambda t: t.size), {}
    met = [pairs(seed, t, memo) for t in trees]
    matched: Counter = Counter()
    seen: Counter = Counter()
    for found in met:
        for p, q in found:
            matched[id(p)] += 1
            seen.update({(id(p), c.tag, c.name, c.text) for c in q.inner if c.text})
    for found in met:
        for p, q in found:
            n = matched[id(p)]
            for c in q.inner:
                c.fixed = bool(c.text) and n >= MIN_PAGES and seen[id(p), c.tag, c.name, c.text] >= SAME * n


def boilerplate(node: Node, inside: bool) -> bool:
    """inside: whether an article or main element is around the node."""
    if node.tag in SKIPPED or node.hidden:
        return True
    if node.tag in ("html", "body", "article", "main", "#root") and node.tag != "article":
        return False
    if node.name and (NAMES.search(node.name) or not inside and HEADER.search(node.name)):
        return True
    if node.tag == "header" and not inside:
        return True
    return any(x in node.role for x in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert"))


def weigh(node: Node, inside: bool, slots: dict[int, int], mains: list[Node]) -> int:
    """Characters of slots under each node that is not boilerplate."""
    stack: list[tuple[Node, bool, bool]] = [(node, inside, False)]
    while stack:
        node, inside, done = stack.pop()
        if done:
            slots[id(node)] = (0 if node.fixed else len(node.text)) + sum(slots.get(id(c), 0) for c in node.children if not isinstance(c, str))
            continue
        if boilerplate(node, inside):
            continue
        if node.tag in ("article", "main") or "main" in node.role or "articlebody" in node.role:
            mains.append(node)
            inside = True
        stack.append((node, inside, True))
        stack += [(c, inside, False) for c in node.children if not isinstance(c, str)]
    return 0


def blocks(article: Node, template: bool) -> tuple[list[str], list[str]]:
    """Blocks of text in page order; those kept, and those the template takes."""
    kept: list[str] = []
    taken: list[str] = []
    run: list[str] = []
    fixed: list[bool] = []

    def flush() -> None:
        text = SPACE.sub(" ", "".join(run)).strip()
        if text:
            (taken if template and fixed and all(fixed) else kept).append(text)
        run.clear()
        fixed.clear()

    stack: list = [(article, False)]
    while stack:
        node, closing = stack.pop()
        if closing:
            flush()
            continue
        if isinstance(node, tuple):
            text, mark = node
            run.append(text)
            if text.strip():
                fixed.append(mark)
            continue
        if node.tag == "br" or node.tag == "img":
            run.append(" ")
            continue
        if node is not article and boilerplate(node, True):
            if node.tag not in INLINE:
                flush()
            continue
        if node.tag not in INLINE:
            flush()
            stack.append((node, True))
        stack += [((c, node.fixed), False) if isinstance(c, str) else (c, False) for c in reversed(node.children)]
    flush()
    return kept, taken


def extract(root: Node) -> str:
    slots: dict[int, int] = {}
    mains: list[Node] = []
    weigh(root, False, slots, mains)
    if mains:
        article = max(mains, key=lambda x: slots.get(id(x), 0))
        # A main element around several articles gives way to the one with most of its text.
        for x in mains:
            if x.tag == "article" and slots.get(id(x), 0) >= 0.5 * slots.get(id(article), 0) and _within(x, article):
                article = x
    else:
        article = root
    kept, taken = blocks(article, True)
    if sum(map(len, taken)) > sum(map(len, kept)) and (mains or not kept):
        kept, _ = blocks(article, False)
    return "\n\n".join(kept)


def _within(node: Node, other: Node) -> bool:
    while node.parent is not None:
        node = node.parent
        if node is other:
            return True
    return False


def main_texts(pages: list[str]) -> list[str]:
    """Main texts of pages of one host."""
    distinct = list(dict.fromkeys(pages))
    trees = [parse(x) for x in distinct]
    for tree in trees:
        measure(tree)
    induce(trees)
    found = dict(zip(distinct, map(extract, trees)))
    return [found[x] for x in pages]


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row."""
    kind = dict(pages.dtypes)["page_id"]
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host.alias("host"))
    # At most HOT_SHARE hosts have so many of all pages.
    many = max(2 * BLOCK, -(-rows.count() // HOT_SHARE))
    large = rows.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") >= many).select("host", (F.col("n") / BLOCK + 1).cast("int").alias("salts"))
    place = F.xxhash64("page_id", "url")
    dealt = rows.join(F.broadcast(large), "host", "left").withColumn("salt", F.pmod(place, F.coalesce("salts", F.lit(1)))).withColumn("place", place)
    dealt = dealt.select("host", "salt", "place", "page_id", "url", "html").repartition("host", "salt").sortWithinPartitions("host", "salt", "place", "page_id", "url")

    def texts(block: pd.DataFrame) -> pd.DataFrame:
        found = main_texts(block["html"].tolist())
        return pd.DataFrame({"page_id": block["page_id"], "url": block["url"], "text": found, "n_chars": [len(x) for x in found]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < 2 * BLOCK and sum(x["html"].map(len).sum() for x in held) < BLOCK_BYTES:
                continue
            rest = pd.concat(held)
            cut, left = blocks_of(rest, True)
            for a, b in cut:
                yield texts(rest.iloc[a:b])
            held = [rest.iloc[left:]]
        if held:
            rest = pd.concat(held)
            for a, b in blocks_of(rest, False)[0]:
                yield texts(rest.iloc[a:b])

    return dealt.mapInPandas(run, f"page_id {kind}, url string, text string, n_chars long")


def blocks_of(rows: pd.DataFrame, more: bool) -> tuple[list[tuple[int, int]], int]:
    """Places of the blocks of rows in order, and where the rows begin whose block depends on rows to come (`more`).

    A run of one (host, salt) is cut after every BLOCK rows, unless fewer than BLOCK follow, and where it holds BLOCK_BYTES.
    """
    new = ((rows["host"] != rows["host"].shift()) | (rows["salt"] != rows["salt"].shift())).to_numpy()
    sizes, edges = rows["html"].map(len).tolist(), [*np.flatnonzero(new).tolist(), len(rows)]
    out = []
    for a, b in zip(edges, edges[1:]):
        open_, held, k = more and b == len(rows), 0, a
        while k < b:
            held += sizes[k]
            k += 1
            full = held >= BLOCK_BYTES and k - a >= MIN_PAGES
            if not full and k - a == BLOCK:
                if open_ and b - k < BLOCK:
                    return out, a
                full = b - k >= BLOCK
            if full:
                out.append((a, k))
                a, held = k, 0
        if open_:
            return out, a
        if a < b:
            out.append((a, b))
    return out, len(rows)
