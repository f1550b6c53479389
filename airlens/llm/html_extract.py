"""Main text of pages by a minimum cut (operator 2).

A page is cut into blocks of text at block-level tags. A fixed linear classifier turns what is known of a block (its
ancestors, their class and id names, link density, length) into a cost of calling it boilerplate or content; these are
the capacities to the two terminals. Neighbouring blocks and blocks under one parent are tied by smoothness
edges, the weaker the further apart they are in the tree. The minimum cut labels the blocks of least total cost.

Spark deals the pages; one page, however long, is labelled inside its row by Arrow batches.

Defined cases: a null or empty page, or one without content, has empty text; text outside any tag is a block; unclosed or stray
tags are tolerated; a raw element ends at its own end tag only, whatever else it holds; a form is boilerplate except for an
article or main inside it, and so is an element that only a part of a name, as in ``related-content``, speaks against; lists to choose from
and buttons have no text; time and memory grow in proportion to a page, however deep it nests; repeated rows return one row each; other columns are ignored; an empty table gives an empty result.
"""

import html as entities
import re
from collections import Counter, deque

from pyspark.sql import DataFrame, functions as F

#: fixed values: tags that end a block, tags whose content is never text, tags that hold no element
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody "
    "tfoot thead tr ul".split())
RAW_TAGS = frozenset("button iframe noscript object script select style svg template textarea title".split())
#: of these, tags whose content is elements: they nest, and one without an end tag is passed over
NESTED_TAGS = frozenset("button noscript object select svg template".split())
#: head is one of these, as all it may hold is raw or void; so it ends with or without its end tag
VOID_TAGS = frozenset("area base br col embed head hr img input link meta param source track wbr".split())
#: tags and names of classes, ids and roles that mark boilerplate
OFF_TAGS = frozenset("aside button dialog fieldset footer form menu nav select".split())
OFF_NAMES = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie "
    "cookies discussion disqus footer header login masthead menu modal nav navbar navigation newsletter notice popup promo promotion "
    "related replies search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split())
#: parts of names that speak of the layout around something, not of the thing; names of a page's or an article's head; names of comments
LAYOUT_PARTS = frozenset("has is layout no with without wrap wrapper".split())
HEAD_NAMES = frozenset("banner header masthead".split())
COMMENT_NAMES = frozenset("comment comments discussion replies reply".split())
#: how much speaks against an element: nothing, part of a name, a tag or whole name
CLEAR, DOUBTED, OFF = 0, 1, 2
#: fixed weights of the classifier
W_ARTICLE, W_OFF, W_LINKS, W_TEXT_TAG, W_WORDS, W_BASE = 5.0, -12.0, -4.0, 1.0, 2.0, -1.0
ADJACENT, SIBLING = 1.0, 1.0

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|$)|([^<]+|<)", re.S)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_RAW_ENDS = {tag: re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*(?:>|$)", re.I) for tag in RAW_TAGS}
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)


class Block:
    __slots__ = ("text", "node", "links", "off", "article", "tag")

    def __init__(self, text, node, links, off, article, tag):
        self.text, self.node, self.links, self.off, self.article, self.tag = text, node, links, off, article, tag


class Tree:
    """Parent and depth of the elements that blocks lie in, by number; 0 is the page."""

    def __init__(self):
        self.parent, self.depth = [0], [0]

    def add(self, parent: int) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        return len(self.parent) - 1

    def distance(self, a: int, b: int) -> int:
        """Steps from one to the other. Over all neighbouring blocks of a page no more than twice its elements."""
        steps = 0
        while a != b:
            if self.depth[a] >= self.depth[b]:
                a = self.parent[a]
            else:
                b = self.parent[b]
            steps += 1
        return steps


def _against(tag: str, attributes: str, in_article: bool) -> int:
    """How much an element's own tag and names speak against it; a form's tag does not count here."""
    if tag != "form" and tag in OFF_TAGS or (tag == "header" and not in_article):
        return OFF
    if tag in ("html", "body", "main") or not attributes:
        return CLEAR
    if tag != "article" and _HIDDEN.search(attributes):
        return OFF
    names = [n for m in _NAMED.finditer(attributes) for n in m[2].strip("\"'").lower().split()]
    if tag == "article":        # comments are articles too
        return OFF if any(n in COMMENT_NAMES or n.startswith("comment-") for n in names) else CLEAR
    marks = OFF_NAMES - HEAD_NAMES if in_article else OFF_NAMES
    if any(n in marks for n in names):
        return OFF
    parts = [[q for q in re.split(r"[^a-z0-9]+", n) if q] for n in names]
    return DOUBTED if any(not LAYOUT_PARTS.intersection(p) and marks.intersection(p) for p in parts) else CLEAR


def _behind(page: str, tag: str, at: int) -> int:
    """Place behind the end tag of the raw element whose content starts at ``at``; without one the end of the page, or ``at`` if elements nest."""
    depth = 1
    for m in _RAW_ENDS[tag].finditer(page, at):
        if m[1]:
            depth -= 1
        elif tag in NESTED_TAGS and not m[0].endswith("/>"):
            depth += 1
        if not depth:
            return m.end()
    if tag in NESTED_TAGS:
        first = next((m for m in _RAW_ENDS[tag].finditer(page, at) if m[1]), None)
        return first.end() if first else at
    return len(page)


def blocks_of(page: str) -> tuple[list[Block], Tree]:
    """Blocks in page order. A stack entry is (tag, node, place of the nearest block tag in the stack, off, form, article);
    form: in one that no article or main is inside of."""
    found, tree, parts, place, linked, endless, opened = [], Tree(), [], 0, 0, set(), Counter()
    stack = [("", 0, 0, CLEAR, False, False)]

    def close():
        nonlocal parts, linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            _, node, near, off, form, article = stack[-1]
            found.append(Block(text, node, min(1.0, linked / max(1, len(text))), off != CLEAR or form, article, stack[near][0]))
        parts, linked = [], 0

    def leave(at):
        opened.subtract(entry[0] for entry in stack[at:])
        del stack[at:]

    while m := _TOKEN.match(page, place):
        place = m.end()
        end, tag, attributes, text = m.groups()
        if text is not None:
            parts.append(text)
            if any(entry[0] == "a" for entry in stack[-3:]):
                linked += len(text.strip())
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCK_TAGS:
            close()
        elif tag in ("br", "td", "th"):
            parts.append(" ")
        if end:
            if opened[tag] > 0:
                leave(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag))
        elif tag in RAW_TAGS:
            if not attributes.rstrip().endswith("/") and tag not in endless:
                place = _behind(page, tag, place)
                if place == m.end() and tag in NESTED_TAGS:
                    endless.add(tag)
        elif tag not in VOID_TAGS:
            if tag in ("p", "li", "tr", "dd", "dt", "option") or tag[:1] == "h" and tag[1:].isdigit():
                at = stack[-1][2]
                if at and stack[at][0] in (tag, "p"):
                    leave(at)  # its end tag was left out
            _, node, near, off, form, article = stack[-1]
            main = tag in ("article", "main")
            if main and off == DOUBTED:
                off = CLEAR
            if tag in BLOCK_TAGS:
                node, near = tree.add(node), len(stack)
            stack.append((tag, node, near, max(off, _against(tag, attributes, article)), tag == "form" or form and not main, article or main))
            opened[tag] += 1
    close()
    return found, tree


def leaning(block: Block) -> float:
    """Positive: rather content."""
    return (W_BASE + W_ARTICLE * block.article + W_OFF * block.off + W_LINKS * block.links
            + W_TEXT_TAG * (block.tag in ("p", "pre", "blockquote") or block.tag[:1] == "h" and block.tag[1:].isdigit())
            + W_WORDS * min(1.0, block.text.count(" ") / 20))


def ties(blocks: list[Block], tree: Tree) -> list[tuple[int, int, float]]:
    """Smoothness edges: next in the page, and next under the same parent; weaker with distance in the tree."""
    found, last = [], {}
    for k, block in enumerate(blocks):
        if k:
            found.append((k - 1, k, ADJACENT / (1 + tree.distance(blocks[k - 1].node, block.node))))
        parent = tree.parent[block.node]
        if parent in last and last[parent] != k - 1:
            found.append((last[parent], k, SIBLING / 3))
        last[parent] = k
    return found


def min_cut(gains: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for nodes on the source's side of a minimum cut (level graphs, blocking flows).

    A node's gain is its capacity from the source, or if negative to the sink; edges have one capacity both ways.
    """
    n = len(gains)
    source, sink, to, room, out = n, n + 1, [], [], [[] for _ in range(n + 2)]

    def join(a, b, there, back):
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for k, gain in enumerate(gains):
        join(source, k, gain, 0.0) if gain > 0 else join(k, sink, -gain, 0.0)
    for a, b, capacity in edges:
        join(a, b, capacity, capacity)
    least = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > least and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[k] >= 0 for k in range(n)]
        at, path = [0] * (n + 2), []
        while True:
            a = to[path[-1]] if path else source
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                path = path[: next(k for k, e in enumerate(path) if room[e] <= least)]
                continue
            while at[a] < len(out[a]):
                e = out[a][at[a]]
                if room[e] > least and level[to[e]] == level[a] + 1:
                    path.append(e)
                    break
                at[a] += 1
            else:
                if not path:
                    break
                path.pop()
                at[to[path[-1]] if path else source] += 1


def main_text(page: str | None) -> tuple[str, int]:
    """Text of the content blocks, and how many blocks the page has."""
    blocks, tree = blocks_of(page or "")
    content = min_cut([leaning(b) for b in blocks], ties(blocks, tree))
    return "\n\n".join(b.text for b, kept in zip(blocks, content, strict=True) if kept), len(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks`` of every page."""
    import pyarrow as pa

    def compute(batches):
        for batch in batches:
            found = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("url"), pa.array([t for t, _ in found], pa.string()),
                pa.array([n for _, n in found], pa.int64())], ["page_id", "url", "text", "n_blocks"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        compute, "page_id long, url string, text string, n_blocks long").select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks")
