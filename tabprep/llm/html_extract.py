"""Main text of web pages by wrapper induction: DOM trees of one host are aligned by simple tree matching."""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import BROADCAST_BYTES, checkpointed, name, with_lookup

REFERENCES = 3                           # pages of a host that others are aligned with
TABLE = 4_000_000                        # sums of one alignment that are held at a time
# HTML elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCKS = frozenset((
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption").split())
CLOSES_P = BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
CONTAINERS = frozenset("html body article aside div dl fieldset footer form header main nav ol section table td ul".split())
NEVER = frozenset("head script style noscript template iframe nav footer aside form button select option textarea svg canvas object dialog menu title".split())
UNWANTED = frozenset((
    "ad ads advert adverts advertisement advertising banner banners sponsor sponsored promo promotion sidebar side rail menu menus nav "
    "navbar navigation breadcrumb breadcrumbs footer foot header masthead topbar cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay newsletter subscribe signup login form search share sharing social comment comments disqus replies reply "
    "respond related recommended recommendations widget toolbar pagination pager skip copyright legal disclaimer tags").split())
WANTED = frozenset("article main content post entry story body text".split())
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
TAG_END = re.compile(r">|=\s*([\"'])")
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
SPACES = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "names", "items", "parent", "size", "drop", "mark")

    def __init__(self, tag: str, names: str, parent: Node | None):
        self.tag, self.names, self.parent, self.items, self.size, self.drop, self.mark = tag, names, parent, [], 0, False, 0

    @property
    def label(self) -> str:
        return f"{self.tag}.{self.names}"


class Scanner:
    """Finds tags from left to right, in time proportional to the page whatever its mistakes.

    A tag ends at the first ``>`` outside quoted values. If a page has none for some tag, the tags from there on end at the
    first ``>`` of all, so one search at most is in vain; behind the last ``>`` everything is text.
    """

    def __init__(self, source: str):
        self.source, self.last, self.lenient = source, source.rfind(">"), False
        self.quotes = {q: source.rfind(q) for q in "\"'"}

    def _tag_end(self, at: int) -> int:
        if not self.lenient:
            place = at
            while (found := TAG_END.search(self.source, place)) is not None:
                if found[1] is None:
                    return found.start()
                if found.end() > self.quotes[found[1]]:
                    break
                place = self.source.index(found[1], found.end()) + 1
            self.lenient = True
        return self.source.index(">", at)

    def next(self, at: int) -> tuple[int, int, tuple[str, str, str] | None] | None:
        """The start and end of the next tag or comment, and of a tag its slash, name and attributes."""
        while (start := self.source.find("<", at)) >= 0:
            if self.source.startswith("<!--", start):
                end = self.source.find("-->", start + 4)
                return start, len(self.source) if end < 0 else end + 3, None
            if start > self.last:
                return None
            if (tag := TAG.match(self.source, start)) is not None:
                if tag.end() > self.last:
                    return None
                end = self._tag_end(tag.end())
                return start, end + 1, (tag[1], tag[2].lower(), self.source[tag.end():end])
            if self.source[start + 1:start + 2] in ("!", "?"):
                return start, self.source.index(">", start) + 1, None
            at = start + 1
        return None


def _implied_end(tag: str) -> tuple[set[str], set[str]]:
    """The open elements that a start tag ends, and those at which the search for them stops."""
    if tag in ("li", "tr", "option"):
        return {tag}, {"ul", "ol", "table", "dl", "select"}
    if tag in ("td", "th"):
        return {"td", "th"}, {"ul", "ol", "table", "dl", "select", "tr"}
    return ({"dt", "dd"} if tag in ("dt", "dd") else {"p"}), {"ul", "ol", "table", "dl", "select"}


def parse(source: str) -> Node:
    """A tree of elements and texts; unclosed and crossing elements are closed as browsers would, roughly."""
    root = now = Node("html", "", None)
    at, low, scanner, open_ = 0, None, Scanner(source), Counter()

    def leave(node: Node) -> Node:
        """Close all elements up to and with one that is open."""
        here = now
        while here is not node.parent:
            open_[here.tag] -= 1
            here = here.parent
        return node.parent

    while (found := scanner.next(at)) is not None:
        start, end, read = found
        if start > at:
            now.items.append(source[at:start])
        at = end
        if read is None:
            continue
        slash, tag, rest = read
        if slash:
            if open_[tag] > 0:                                 # else a walk to the root would find nothing
                node = now
                while node.tag != tag:
                    node = node.parent
                now = leave(node)
            continue
        if tag in CLOSES_P or tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            ends, stop = _implied_end(tag)
            node = now if any(open_[t] > 0 for t in ends) else None
            while node is not None and node.tag not in ends and (node.tag not in BLOCKS or node.tag == "p") and node.tag not in stop:
                node = node.parent
            if node is not None and node.tag in ends and node.parent is not None:
                now = leave(node)
        names = " ".join(sorted({w for _, v in ATTRIBUTE.findall(rest) for w in re.split(r"[^a-z0-9]+", v.lower()) if w and not w.isdigit()})) if rest else ""
        node = Node(tag, names, now)
        now.items.append(node)
        if tag in RAW:
            low = source.lower() if low is None else low
            closing = low.find("</" + tag, at)
            closing = len(source) if closing < 0 else closing
            if tag in ("title", "textarea"):
                node.items.append(source[at:closing])
            after = source.find(">", closing)
            at = len(source) if after < 0 else after + 1
        elif tag not in VOID and not rest.endswith("/"):
            now = node
            open_[tag] += 1
    if at < len(source):
        now.items.append(source[at:])
    return root


def _unwanted(node: Node, inside: bool) -> bool:
    if node.tag in NEVER:
        return True
    if node.tag == "header":
        return not (inside and any(isinstance(x, Node) and x.tag in ("h1", "h2") for x in node.items))
    if node.tag in ("html", "body", "article", "main") or not node.names:
        return False
    own = set(node.names.split())
    return bool(own & UNWANTED) and not (own & WANTED and not own & {"comment", "comments", "ad", "ads", "sidebar", "footer", "nav", "menu", "related"})


def measure(root: Node) -> None:
    """Mark what is boilerplate by its element or name, and sum the letters of the rest, links aside."""
    order, stack = [], [(root, False, False)]
    while stack:
        node, inside, linked = stack.pop()
        node.drop = _unwanted(node, inside)
        order.append((node, linked))
        if not node.drop:
            inside, linked = inside or node.tag in ("article", "main"), linked or node.tag == "a"
            stack.extend((x, inside, linked) for x in node.items if isinstance(x, Node))
    for node, linked in reversed(order):
        node.size = 0 if node.drop else sum(x.size if isinstance(x, Node) else 0 if linked or node.tag == "a" else len(x.strip()) for x in node.items)


def skeleton(root: Node) -> tuple[dict, list[Node]]:
    """The containers in page order: their labels, marks of their whole content, and how many each holds, itself
    counted; and their nodes. Marks are built from the inside out, so each text is read once."""
    order, stack = [], [(root, -1)]
    while stack:
        node, above = stack.pop()
        order.append((node, above))
        above = len(order) - 1 if node is root or node.tag in CONTAINERS else above
        stack.extend((x, above) for x in reversed(node.items) if isinstance(x, Node))
    counts = [0] * len(order)
    for i in range(len(order) - 1, -1, -1):
        node, above = order[i]
        own = b"\0".join(x.mark.to_bytes(4, "big") if isinstance(x, Node) else x.strip().encode("utf-8", "replace")
                         for x in node.items if (x.tag not in RAW if isinstance(x, Node) else x.strip()))
        node.mark = crc32(own)
        if node is root or node.tag in CONTAINERS:
            counts[i] += 1
            if above >= 0:
                counts[above] += counts[i]
    kept = [(node, counts[i]) for i, (node, _) in enumerate(order) if counts[i]]
    nodes = [node for node, _ in kept]
    return {"label": [n.label for n in nodes], "mark": [n.mark for n in nodes], "size": [c for _, c in kept]}, nodes


def _children(tree: dict, i: int) -> list[int]:
    out, at, end = [], i + 1, i + tree["size"][i]
    while at < end:
        out.append(at)
        at += tree["size"][at]
    return out


def best_path(m: int, n: int, weights) -> list[tuple[int, int]]:
    """The pairs, rising on both sides, with the largest sum of weights; ``weights(i)`` gives those of row i.

    Large tables of sums are not kept: the upper half of the rows is met with the lower half at the best column, and each
    half is solved by itself.
    """
    def sums(rows: range, low: int, high: int, back: bool) -> np.ndarray:
        best = np.zeros(high - low + 1, np.int64)
        for i in rows:
            w = weights(i)[low:high]
            best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + (w[::-1] if back else w)))
        return best

    out, todo = [], [(0, m, 0, n)]
    while todo:
        top, end, low, high = todo.pop()
        if top == end or low == high:
            continue
        if (end - top) * (high - low) > TABLE and end - top > 1:
            half = (top + end) // 2
            cut = low + int((sums(range(top, half), low, high, False) + sums(range(end - 1, half - 1, -1), low, high, True)[::-1]).argmax())
            todo += [(top, half, low, cut), (half, end, cut, high)]
            continue
        best = np.zeros((end - top + 1, high - low + 1), np.int64)
        for i in range(top, end):
            row = best[i - top]
            best[i - top + 1, 1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + weights(i)[low:high]))
        i, j = end - top, high - low
        while i and j:
            if best[i, j] == best[i - 1, j]:
                i -= 1
            elif best[i, j] == best[i, j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((top + i, low + j))
    return out


class _Shapes:
    """Containers by the labels in and below them: equal shapes have one number, so each two are compared once."""

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.label: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.total: list[int] = []
        self.known: dict[tuple[int, int], int] = {}

    def of(self, tree: dict) -> tuple[list[int], list[list[int]]]:
        """The shape and the children of every container of a tree."""
        inside = [_children(tree, i) for i in range(len(tree["label"]))]
        out = [0] * len(inside)
        for i in range(len(inside) - 1, -1, -1):
            kids = tuple(out[k] for k in inside[i])
            seen = self.number.setdefault((tree["label"][i], kids), len(self.label))
            if seen == len(self.label):
                self.label.append(tree["label"][i])
                self.kids.append(kids)
                self.total.append(tree["size"][i])
            out[i] = seen
        return out, inside

    def score(self, p: int, q: int) -> int:
        """The containers two shapes share; of those with children on both sides only after ``compare``."""
        if p == q:
            return self.total[p]
        if self.label[p] != self.label[q]:
            return 0
        return self.known[p, q] if self.kids[p] and self.kids[q] else 1

    def rows(self, left: Sequence[int], right: Sequence[int]):
        """Scores of a place on the left with all on the right."""
        each, place = np.unique(np.array(right, np.int64), return_inverse=True)
        held = {p: np.array([self.score(p, q) for q in each.tolist()], np.int64) for p in set(left)}
        return lambda i: held[left[i]][place]

    def compare(self, p: int, q: int) -> int:
        """Score two shapes, and all pairs of shapes below them that this needs, the smaller ones first."""
        order, seen = [(p, q)], {(p, q)}
        for x, y in order:                                     # grows while it is read
            for c in set(self.kids[x]):
                for d in set(self.kids[y]):
                    if c != d and (c, d) not in seen and self.label[c] == self.label[d] and self.kids[c] and self.kids[d]:
                        seen.add((c, d))
                        order.append((c, d))
        for x, y in sorted(order, key=lambda o: self.total[o[0]] + self.total[o[1]]):
            if x != y and self.label[x] == self.label[y] and self.kids[x] and self.kids[y]:
                row, best = self.rows(self.kids[x], self.kids[y]), np.zeros(len(self.kids[y]) + 1, np.int64)
                for i in range(len(self.kids[x])):
                    best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + row(i)))
                self.known[x, y] = 1 + int(best[-1])
        return self.score(p, q)


def tree_match(a: dict, b: dict) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: the most containers that two trees share in order, and the pairs of places.

    Below two matched containers the children are matched in order, by the largest sum of what matches inside them, and of
    equal sums by that with more equal texts. Pairs inside containers that agree in text and shape are not listed. No
    recursion and no table of all pairs, so trees may be deep and lists long.
    """
    if a["label"][0] != b["label"][0]:
        return 0, []
    shapes = _Shapes()
    (sa, ca), (sb, cb) = shapes.of(a), shapes.of(b)
    score = shapes.compare(sa[0], sb[0])
    ma, mb = a["mark"], np.array(b["mark"], np.int64)
    same = lambda x, y: sa[x] == sb[y] and ma[x] == mb[y]
    out, stack = [], [(0, 0)]
    while stack:
        i, j = stack.pop()
        out.append((i, j))
        if same(i, j):
            continue
        left, right = ca[i], cb[j]
        k, limit = 0, min(len(left), len(right))
        while k < limit and same(left[k], right[k]):
            k += 1
        e = 0
        while e < limit - k and same(left[-1 - e], right[-1 - e]):
            e += 1
        stack += [*zip(left[:k], right[:k]), *zip(left[len(left) - e:], right[len(right) - e:])]
        x, y = left[k:len(left) - e], right[k:len(right) - e]
        if x and y:
            row, texts, more = shapes.rows([sa[p] for p in x], [sb[q] for q in y]), mb[y], min(len(x), len(y)) + 1

            def weights(r: int, row=row, texts=texts, x=x, more=more) -> np.ndarray:
                w = row(r)
                return w * more + ((texts == ma[x[r]]) & (w > 0))

            stack += [(x[r], y[c]) for r, c in best_path(len(x), len(y), weights)]
    return score, out


def main_node(root: Node, nodes: list[Node], template: set) -> Node:
    """The container of the article: an article or main element with the most text of its own page, else the
    innermost container that holds most of the text in varying slots."""
    named = [n for n in nodes if n.tag in ("article", "main") and n.size and not n.drop]
    free = [n for n in named if id(n) not in template] or named
    if free:
        best = max(free, key=lambda n: n.size)
        inner = [n for n in free if n.tag == "article" and n is not best and n.size >= 0.8 * best.size]
        return inner[0] if best.tag == "main" and inner else best
    now = next((n for n in nodes if n.tag == "body"), root)
    while True:
        inside = [x for x in now.items if isinstance(x, Node) and x.tag in CONTAINERS and not x.drop and id(x) not in template]
        best = max(inside, key=lambda x: x.size, default=None)
        if best is None or best.size < 0.6 * now.size or not best.size:
            return now
        now = best


def blocks(node: Node, template: set) -> str:
    """The text of a node: blocks in order, one line each."""
    lines, words = [], []

    def flush() -> None:
        text = SPACES.sub(" ", entities.unescape("".join(words))).strip()
        if text:
            lines.append(text)
        words.clear()

    stack = [node]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            words.append(x)
        elif x.tag == "br":
            words.append(" ")
        elif not (x.drop or (id(x) in template and x is not node)):
            if x.tag in BLOCKS:
                flush()
                stack.append(None)
            stack.extend(reversed(x.items))
    flush()
    return "\n".join(lines)


def extract(source: str | None, references: list | None) -> str:
    """The main text of a page, given the skeletons of some pages of its host."""
    root = parse(source or "")
    measure(root)
    own, nodes = skeleton(root)
    template = set()
    for other in references or []:
        if own["mark"][0] == other["mark"][0]:        # the same page, or a copy of it: says nothing
            continue
        for p, q in tree_match(own, other)[1]:        # what a constant node holds is constant too
            if own["mark"][p] == other["mark"][q] and nodes[p].tag not in ("html", "body", "article", "main"):
                template |= {id(n) for n in nodes[p:p + own["size"][p]]}
    return blocks(main_node(root, nodes, template), template)


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        trees = [json.dumps(skeleton(parse(x or ""))[0]) for x in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(trees, pa.string())], ["host", "tree"])


def extract_text(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Per page: key, ``url`` and ``text``, the main text, empty if there is none.

    Three pages of every host, by a hash of key and url, are its references. A page is parsed into a tree and its
    containers are aligned with those of the references by simple tree matching. Containers whose text is the
    same are the template of the host, the others its slots. Menus, headers, footers, forms, adverts, notices and
    comments are also known by their elements and names, as they may vary from page to page. The article is the
    article or main element with the most text, else the container that holds most of the text in varying slots;
    paragraphs in it stay even if other pages repeat them.

    References are chosen by a top-3 per host that is cut in the map tasks, so no host is gathered. Null pages are
    empty, pages without host form a group, copies of a page say nothing about its template, rows that repeat a
    key are extracted one by one, and an empty table gives an empty table.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(name(key).alias("id"), name("url").cast("string").alias("url"), name("html").cast("string").alias("html")).withColumn("host", host)
    first = Window.partitionBy("host").orderBy(F.xxhash64("id", "url"), "id")
    chosen = rows.select("id", "url", "host").withColumn("__r", F.row_number().over(first)).filter(F.col("__r") <= REFERENCES)
    chosen = chosen.select(F.col("id").alias("__id"), F.col("url").alias("__url"))
    n = chosen.count()
    side = F.broadcast(chosen) if n * 300 <= BROADCAST_BYTES else chosen
    same = F.col("id").eqNullSafe(F.col("__id")) & F.col("url").eqNullSafe(F.col("__url"))
    trees = checkpointed(
        rows.join(side, same, "left_semi").select("host", "html").mapInArrow(_skeletons, "host string, tree string")
        .groupBy("host").agg(F.slice(F.array_sort(F.collect_set("tree")), 1, REFERENCES).alias("trees")))
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for batch in batches:
            texts = []
            for host, source, trees in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "trees"))):
                if host not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[host] = [json.loads(t) for t in trees or []]
                texts.append(extract(source, known[host]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"])

    joined = with_lookup(rows, trees, "host", F.xxhash64("id", "url"))
    out = joined.select("id", "url", "host", "html", "trees").mapInArrow(run, f"id {kind}, url string, text string")
    return out.withColumnRenamed("id", key)
