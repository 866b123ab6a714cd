"""Main text of web pages, by wrapper induction.

Pages become light DOM trees. All differing pages of a host take part, dealt into groups of at least sixteen; a group's are aligned by simple
tree matching (the largest order-preserving matching of nodes with equal labels). Block nodes that are aligned and read the same in all of a group's pages
are its template, and those that half of a host's groups find are the host's; slots that vary are content. A page's main region is its article or main element if these hold most of its text, or else its body; in it, elements that name themselves menus,
notices, adverts, comments and the like go, then the template's nodes, and what remains is the text, block by block.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from sys import intern

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import texts

GROUP_PAGES, LEAST_PAGES = 16, 4
BROADCAST_ROWS = 1_000_000
CELLS = 250_000

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noframes xmp svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul br option select".split()
)
CLOSES_P = BLOCKS - frozenset("body html td th tr tbody thead tfoot caption br option select".split())
# An element that opens closes these, up to the listed limits.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
# Elements, roles and words in class or id that are not main text.
DROPPED = frozenset("head nav footer aside form button select dialog menu search object audio video canvas map input label fieldset".split()) | RAW
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar "
    "cookie cookies consent gdpr notice notices alert popup modal overlay subscribe subscription newsletter signup share sharing social related recommended recommendations "
    "comment comments reply replies disqus respond discussion login search form toolbar pagination pager widget skip copyright".split()
)
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Node:
    __slots__ = ("tag", "attrs", "children", "label")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []
        self.label = intern(tag), intern(attrs.get("class", ""))


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)} if text and not text.isspace() else {}


def parse(page: str) -> Node:
    """A tree of a page: raw elements are left out, missing end tags are supplied, stray ones ignored."""
    root = Node("#root", {})
    open_ = [root]
    at, size = 0, len(page)

    def close(tags: set[str], limits: set[str]) -> None:
        for k in range(len(open_) - 1, 0, -1):
            if open_[k].tag in limits:
                return
            if open_[k].tag in tags:
                del open_[k:]
                return

    while at < size:
        m = TOKEN.search(page, at)
        if not m:
            open_[-1].children.append(page[at:])
            break
        if m.start() > at:
            open_[-1].children.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                open_[-1].children.append(html.escape(m[0][9:].removesuffix("]]>"), quote=False))
            continue
        tag = m[2].lower()
        if m[1]:
            inline = tag not in BLOCKS
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    del open_[k:]
                    break
                if inline and open_[k].tag in BLOCKS:
                    break
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                end = re.compile(f"</{tag}\\s*>", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if tag in CLOSES_P:
            close({"p"}, {"article", "section", "div", "td", "th", "li", "body", "blockquote", "button", "object", "main", "aside", "form"})
        if tag in SIBLINGS:
            tags, limits = SIBLINGS[tag]
            close(tags, limits)
        node = Node(tag, attributes(m[3]))
        open_[-1].children.append(node)
        if tag not in VOID and not m[3].endswith("/"):
            open_.append(node)
    return root


def off_topic(node: Node, in_article: bool) -> bool:
    """Whether an element is, by its own account, not main text. An article's header holds its heading and stays."""
    if node.tag in DROPPED or (node.tag == "header" and not in_article):
        return True
    attrs = node.attrs
    if not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", ""):
        return True
    if attrs.get("role", "").lower() in DROPPED_ROLES:
        return True
    if node.tag in ("html", "body", "main"):
        return False
    named = f"{attrs.get('class', '')} {attrs.get('id', '')}"
    return any(w.lower() in DROPPED_WORDS for w in NAME.findall(named)) if not named.isspace() else False


def pruned(node: Node, in_article: bool = False) -> Node:
    """The tree without off-topic elements."""
    out = Node(node.tag, node.attrs)
    stack = [(node, out, in_article)]
    while stack:
        old, new, inside = stack.pop()
        for child in old.children:
            if isinstance(child, str):
                new.children.append(child)
            elif not off_topic(child, inside):
                copy = Node(child.tag, child.attrs)
                new.children.append(copy)
                stack.append((child, copy, inside or is_region(child)))
    return out


def is_region(node: Node) -> bool:
    return node.tag in ("article", "main") or node.attrs.get("role", "").lower() == "main" or node.attrs.get("itemprop", "").lower() == "articlebody"


def text_size(node: Node) -> int:
    size, stack = 0, [node]
    while stack:
        for child in stack.pop().children:
            if isinstance(child, str):
                size += len(child.strip())
            else:
                stack.append(child)
    return size


def region(tree: Node) -> Node:
    """What holds most of a page's text: of main and all, main if it does; in that, an article with its siblings of the same class, or all
    articles together, or else the whole. Articles keep the order of the page."""
    def inside(top: Node, article: bool) -> list[tuple[Node, Node]]:
        """Outermost articles, or all main elements outside of articles, each with its parent."""
        out, stack = [], [(top, top)]
        while stack:
            node, parent = stack.pop()
            if node is not top and is_region(node) and article == (node.tag == "article"):
                out.append((node, parent))
            if node.tag == "article":
                continue
            stack += [(c, node) for c in reversed(node.children) if not isinstance(c, str)]
        return out

    def together(nodes: list[Node]) -> Node:
        out = Node("#root", {})
        out.children += nodes
        return out

    top = together([max((n for n, _ in mains), key=text_size)]) if (mains := inside(tree, False)) else tree
    if 2 * text_size(top) <= text_size(tree):
        top = tree
    if articles := inside(top, True):
        whole = text_size(top)
        largest, parent = max(articles, key=lambda a: text_size(a[0]))
        if 2 * text_size(largest) > whole:
            return together([n for n, p in articles if p is parent and n.label == largest.label])
        if 2 * sum(text_size(n) for n, _ in articles) > whole:
            return together([n for n, _ in articles])
    return top


def spaced(text: str) -> str:
    """Character references read, one blank for each run of white space, none at the ends."""
    return " ".join(html.unescape(text).split())


def blocks(node: Node) -> list[tuple[str, str]]:
    """``(path, text)`` of each block in order; a path is the tags and classes down to it."""
    out: list[tuple[str, str]] = []
    held: list[str] = []

    def flush(path: str) -> None:
        text = spaced("".join(held))
        held.clear()
        if text:
            out.append((path, text))

    # An explicit stack, as pages can be nested deeper than Python calls.
    stack: list[tuple[object, str, bool]] = [(node, "", False)]
    while stack:
        item, path, leaving = stack.pop()
        if isinstance(item, str):
            held.append(item)
        elif leaving:
            flush(path)
        else:
            own = f"{path}/{item.tag}.{item.attrs.get('class', '')}"
            if item.tag in BLOCKS:
                flush(path)
                stack.append((item, own, True))
            stack += [(c, own if item.tag in BLOCKS else path, False) for c in reversed(item.children)]
    flush("")
    return out


def leaves(node: Node) -> Node:
    """The tree of block elements only, each with the text it holds outside of inner blocks as its first child."""
    out = Node(node.tag, node.attrs)
    stack = [(node, out)]
    texts_: dict[int, list[str]] = {id(out): []}
    all_ = [out]
    while stack:
        old, new = stack.pop()
        for child in old.children:
            if isinstance(child, str):
                texts_[id(new)].append(child)
            elif child.tag in BLOCKS:
                copy = Node(child.tag, child.attrs)
                new.children.append(copy)
                all_.append(copy)
                texts_[id(copy)] = []
                stack.append((child, copy))
            else:
                stack.append((child, new))
    for n in all_:
        n.attrs = n.attrs | {"#text": spaced("".join(texts_[id(n)]))}
    return out


def below(root: Node) -> list[Node]:
    """All nodes of a tree of block elements, parents before their children."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += node.children
    return order


def signatures(*roots: Node) -> dict[int, int]:
    """A number for each subtree, the same for equal ones (labels, texts and order)."""
    out: dict[int, int] = {}
    numbers: dict[tuple, int] = {}
    for root in roots:
        for node in reversed(below(root)):
            own = node.label, node.attrs["#text"], tuple([out[id(c)] for c in node.children])
            out[id(node)] = numbers.setdefault(own, len(numbers))
    return out


def matched(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Simple tree matching: pairs of nodes of the largest matching that keeps labels, parents and order; equal texts weigh double.

    Children are aligned exactly, however many they are: equal subtrees at both ends of two lists belong together, and what lies between is halved until
    the table of a part is small. No step calls itself once a level, so trees may be as deep as pages make them.
    """
    known, sign = {}, signatures(a, b)  # weights of pairs that have children

    def own(x: Node, y: Node) -> int:
        return 2 if x.attrs["#text"] == y.attrs["#text"] else 1

    def weights(x: Node, ys: list[Node]) -> list[int]:
        label, text, inner, at = x.label, x.attrs["#text"], x.children, id(x)
        return [0 if y.label != label else known[at, id(y)] if inner and y.children else 2 if y.attrs["#text"] == text else 1 for y in ys]

    def middle(xs: list[Node], ys: list[Node]) -> tuple[int, int]:
        """How many equal subtrees both lists begin with, and end with."""
        most, first, last = min(len(xs), len(ys)), 0, 0
        while first < most and sign[id(xs[first])] == sign[id(ys[first])]:
            first += 1
        while last < most - first and sign[id(xs[-1 - last])] == sign[id(ys[-1 - last])]:
            last += 1
        return first, last

    def totals(xs: list[Node], ys: list[Node]) -> list[int]:
        """The weight of the best alignment of all ``xs`` with each beginning of ``ys``."""
        row = [0] * (len(ys) + 1)
        for x in xs:
            diagonal = 0
            for j, w in enumerate(weights(x, ys)):
                here = row[j + 1]
                best = diagonal + w
                if best < here:
                    best = here
                diagonal, row[j + 1] = here, best if best > row[j] else row[j]
        return row

    def aligned(xs: list[Node], ys: list[Node]) -> list[tuple[Node, Node]]:
        out, parts = [], [(xs, ys)]
        while parts:
            xs, ys = parts.pop()
            first, last = middle(xs, ys)
            out += zip(xs[:first], ys[:first])
            out += zip(xs[len(xs) - last :], ys[len(ys) - last :])
            xs, ys = xs[first : len(xs) - last], ys[first : len(ys) - last]
            if not xs or not ys:
                continue
            if len(xs) > 1 and len(xs) * len(ys) > CELLS:
                half = len(xs) // 2
                left, right = totals(xs[:half], ys), totals(xs[half:][::-1], ys[::-1])[::-1]
                at = max(range(len(ys) + 1), key=lambda j: left[j] + right[j])
                parts += [(xs[:half], ys[:at]), (xs[half:], ys[at:])]
                continue
            best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
            for i, x in enumerate(xs):
                row, above = best[i + 1], best[i]
                for j, w in enumerate(weights(x, ys)):
                    row[j + 1] = max(row[j], above[j + 1], above[j] + w)
            i, j = len(xs), len(ys)
            while i and j:
                if best[i][j] == best[i - 1][j]:
                    i -= 1
                elif best[i][j] == best[i][j - 1]:
                    j -= 1
                else:
                    out.append((xs[i - 1], ys[j - 1]))
                    i, j = i - 1, j - 1
        return out

    # Weights from the leaves up: a pair waits until those of its children are known.
    waiting = [(a, b)] if a.label == b.label and a.children and b.children else []
    while waiting:
        x, y = waiting[-1]
        if (id(x), id(y)) in known:
            waiting.pop()
            continue
        first, last = middle(x.children, y.children)
        xs, ys = x.children[first : len(x.children) - last], y.children[first : len(y.children) - last]
        same = [*zip(x.children[:first], y.children[:first]), *zip(x.children[len(x.children) - last :], y.children[len(y.children) - last :])]
        needed = [(c, d) for c, d in same if c.children and (id(c), id(d)) not in known]
        needed += [(c, d) for c in xs if c.children for d in ys if d.children and c.label == d.label and (id(c), id(d)) not in known]
        if needed:
            waiting += needed
            continue
        known[id(x), id(y)] = own(x, y) + sum(weights(c, [d])[0] for c, d in same) + (totals(xs, ys)[-1] if xs and ys else 0)
        waiting.pop()

    found, open_ = [], [(a, b)] if a.label == b.label else []
    while open_:
        x, y = open_.pop()
        found.append((x, y))
        open_ += aligned(x.children, y.children)
    return found


def paths(node: Node) -> dict[int, str]:
    out, stack = {}, [(node, "")]
    while stack:
        item, path = stack.pop()
        own = f"{path}/{item.tag}.{item.attrs.get('class', '')}" if item.tag in BLOCKS else path
        out[id(item)] = own
        stack += [(c, own) for c in item.children]
    return out


def name_of(path: str, text: str) -> str:
    return xxhash.xxh3_128_hexdigest(f"{path}\0{text}")


def word_pairs(found: set[tuple[str, str]]) -> set[tuple[str, str]]:
    return {pair for _, text in found for words in [text.split()] for pair in zip(words, words[1:])}


def differing(pages: list[set[tuple[str, str]]]) -> list[int]:
    """Pages that are no copies of an earlier one. What stands in most of the pages, or is an edited form of that (by three quarters of its
    word pairs), does not count, however much it is: copies hold half of their other blocks, or three quarters of these blocks' word pairs, in common."""
    held = Counter(b for own in pages for b in own)
    common = word_pairs({b for b, n in held.items() if 2 * n > len(pages)})
    out, seen = [], []
    for k, own in enumerate(pages):
        slots = set()
        for block in own:
            pairs = word_pairs({block})
            if 2 * held[block] <= len(pages) and (not pairs or 4 * len(pairs & common) < 3 * len(pairs)):
                slots.add(block)
        pairs = word_pairs(slots)
        copies = (2 * len(slots & a) >= min(len(slots), len(a)) or (pairs and b and 4 * len(pairs & b) >= 3 * min(len(pairs), len(b))) for a, b in seen)
        if slots and not any(copies):
            out.append(k)
            seen.append((slots, pairs))
    return out


def most_usual(shapes: list[Counter]) -> int:
    """The page that shares the most paths with all of them."""
    place: dict[str, int] = {}
    for own in shapes:
        for path in own:
            place.setdefault(path, len(place))
    held = np.zeros((len(shapes), len(place)), np.int64)
    for k, own in enumerate(shapes):
        held[k, [place[p] for p in own]] = list(own.values())
    return max(range(len(shapes)), key=lambda k: np.minimum(held, held[k]).sum())


def induce(pages: list[str]) -> list[str]:
    """Names of the template's nodes, none where too few pages differ."""
    return induced(pages) or []


def induced(pages: list[str]) -> list[str] | None:
    """Names of the template's nodes: aligned in at least LEAST_PAGES and half of the differing pages, and equal in all these. None where too few pages differ."""
    regions = [region(pruned(parse(page))) for page in pages]
    owns = [set(blocks(r)) for r in regions]
    chosen = differing(owns)
    trees, seen = [leaves(regions[k]) for k in chosen], [owns[k] for k in chosen]
    if len(trees) < LEAST_PAGES:
        return None
    # The page that shares the most paths with the others stands for the host; pages of another layout do not matter.
    first = most_usual([Counter(p for p, _ in own) for own in seen])
    met, same = Counter(), Counter()
    for k, tree in enumerate(trees):
        if k != first:
            for x, y in matched(trees[first], tree):
                if x.attrs["#text"]:
                    met[id(x)] += 1
                    same[id(x)] += x.attrs["#text"] == y.attrs["#text"]
    first = trees[first]
    constant = {x for x, n in met.items() if n >= LEAST_PAGES - 1 and 2 * n >= len(trees) - 1 and same[x] == n}
    where, out, stack = paths(first), [], [first]
    while stack:
        node = stack.pop()
        if id(node) in constant:
            out.append(name_of(where[id(node)], node.attrs["#text"]))
        stack += node.children
    return out


def main_text(page: str, template: set[str]) -> str:
    kept = blocks(region(pruned(parse(page))))
    return "\n".join(t for p, t in kept if not template or name_of(p, t) not in template)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text)`` for each row: the main text of the whole page, its blocks joined by ``\\n``.

    A null or empty page has the empty text. Pages without an address share one host that has no template, and so do hosts with under
    LEAST_PAGES differing pages; only what elements say of themselves counts there. All pages of a host take part in its template, each once: they are dealt by
    hash into groups of GROUP_PAGES to twice as many on average (a host of fewer is one group), every group is aligned, and what half of the groups find, of those with
    LEAST_PAGES differing pages, is the template. In a group, pages that are copies of another one, apart from what stands in most of its pages, do not help,
    so copied articles are not taken for a template. ``br`` ends a block. Repeated rows get equal texts, null ids stay null, other columns are not read.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), host.alias("host"))
    hashed = rows.filter("host <> '' and html is not null").withColumn("h", F.xxhash64("html"))
    groups = F.greatest(F.lit(1), F.floor(F.col("n") / GROUP_PAGES)).alias("groups")
    sizes = hashed.select("host", "h").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_PAGES).select("host", groups)
    sizes = stage(sizes, "host-groups")
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes
    dealt = hashed.join(sizes, "host").select("host", F.pmod(F.shiftright("h", 8), F.col("groups")).alias("group"), "h", "html")

    def once(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's pages without copies, so that a page held by many rows is sent once a task."""
        seen: set[tuple] = set()
        for part in parts:
            keys = list(zip(part.column("host").to_pylist(), part.column("h").to_pylist()))
            new = [k for k, key in enumerate(keys) if key not in seen and not seen.add(key)]
            yield part.take(pa.array(new, pa.int64())) if len(new) < len(keys) else part

    def learn(key: tuple, table: pa.Table) -> pa.Table:
        found = induced(table.sort_by("h").column("html").to_pylist())
        out = {"host": [key[0].as_py()], "votes": [int(found is not None)], "names": pa.array([found or []], pa.list_(pa.string()))}
        return pa.table(out, pa.schema([("host", pa.string()), ("votes", pa.int32()), ("names", pa.list_(pa.string()))]))

    # Keyed by host and group first: the removal of copies and the groups then need no exchange of their own.
    single = dealt.mapInArrow(once, dealt.schema).repartition("host", "group").dropDuplicates(["host", "group", "h"])
    found = stage(single.groupBy("host", "group").applyInArrow(learn, "host string, votes int, names array<string>").filter("votes = 1"), "group-templates")
    voting = found.groupBy("host").agg(F.count(F.lit(1)).alias("groups"))
    names = found.select("host", F.explode(F.array_distinct("names")).alias("name")).groupBy("host", "name").agg(F.count(F.lit(1)).alias("votes"))
    wrappers = names.join(voting, "host").filter("2 * votes >= groups").groupBy("host").agg(F.collect_set("name").alias("template"))
    wrappers = stage(wrappers, "wrappers")
    wrappers = F.broadcast(wrappers) if wrappers.count() <= BROADCAST_ROWS // 100 else wrappers

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            templates = part.column("template").to_pylist()
            out = [main_text(t.decode(), set(w or ())) for t, w in zip(texts(part, "html"), templates)]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])

    id_type = dict(rows.dtypes)["id"]
    joined = rows.join(wrappers, "host", "left").select("id", "url", "html", "template")
    return joined.mapInArrow(read, f"page_id {id_type}, url string, text string")
