"""HTML extraction by wrapper induction.

The pages of a host fall into layouts, by the elements and classes that they are
built of. Of each layout one page (that whose key hashes lowest) is the pivot, and
all pages of the layout are aligned with its whole tree by simple tree matching.
An aligned text is recurrent when it stands in one and the same slot of LEAST
different articles or more (pages of one and the same text count once). A slot is template when CONSTANT of its articles hold a recurrent text
there; other slots vary, which makes them content. Texts that align with no slot
follow their path: it is template when all slots on it are. A wrapper that would
take over VOID of the text of its own pivot (VOID_MARKED, where the page marks its
article), as happens where a host's pages are near copies of one article, is void.

Every page then gives its blocks, in page order, without template slots. Of slots
that vary, elements are dropped that are never main text by their kind (menus,
headers, footers, sidebars, notices, adverts, forms, comments), which constancy
can't tell; where a page marks its article, only what stands inside counts, and
class words judge containers only. Hosts or layouts of fewer than LEAST pages have
no wrapper: there the kinds decide alone.

Matching is exact at any size: children with equal shapes at both ends of two
lists are matched at once, which is always optimal, the rest by dynamic
programming in linear space. Nothing recurses, so depth has no limit.

Defined cases: null or empty html, or pages without main text, give an empty
string and 0; a page without a host in its url forms the host ''; repeated rows
are extracted each; white space in a block becomes one space, <br> counts as
white space; other columns of the table are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: The least articles that make a text recurrent and pages that make a wrapper, the
#: share of recurrent texts that makes a slot template, and the share of a pivot's
#: text, and of a marked article, that no wrapper takes.
LEAST, CONSTANT, VOID, VOID_MARKED = 3, 0.7, 0.8, 0.3
#: Cells of an alignment table that are kept at once; beyond it lists are halved.
CELLS = 1 << 20
#: Pivots that a worker keeps, and shapes that it keeps for one of them.
PIVOTS, SHAPES = 64, 50_000

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea|title|math|object|canvas)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>|<[!?][^>]*>", re.S | re.I)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
#: Fixed values of HTML: elements without content, inline elements, implied ends.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SCOPE = frozenset("html body div article section main aside nav header footer ul ol dl table td th blockquote form figure".split())
#: Elements, roles and words of class or id that are never main text.
NEVER = frozenset("head nav footer aside form menu button select dialog option".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Inside a marked article class words judge containers only, and these words alone.
CONTAINERS = frozenset("div section aside ul ol dl table figure".split())
INSIDE = frozenset("ad ads advert adverts advertisement advertising comment comments consent cookie cookies disqus menu nav navigation newsletter notice notices promo related replies share sharing sidebar social sponsored subscribe".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus footer gdpr header masthead menu modal nav navbar navigation "
    "newsletter notice notices notification overlay popup promo promotion related recommended reply replies respond share sharing sidebar skip social sponsor sponsored subscribe subscription tags toolbar widget".split()
)
_SPACE = re.compile(r"\s+")


_DIGITS = re.compile(r"\d+")


class Node:
    __slots__ = ("bad", "children", "main", "shape", "tag", "text")

    def __init__(self, tag: str, bad: bool, main: bool):
        self.tag, self.bad, self.main, self.children, self.text, self.shape = tag, bad, main, [], "", -1


def _kind(tag: str, attributes: str, main: bool) -> tuple[str, bool]:
    """The label for matching, and whether the element is never main text."""
    bad = tag in NEVER or tag == "header" and not main
    label = tag
    if attributes.strip():
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name in ("class", "id"):
                label += "." + _DIGITS.sub("#", value)
                if main:
                    bad = bad or tag in CONTAINERS and any(not INSIDE.isdisjoint((x := re.split(r"[_-]+", token))[:1] + x[-1:]) for token in value.split())
                else:
                    bad = bad or tag not in ("html", "body", "article", "main") and not WORDS.isdisjoint(re.split(r"[\s_-]+", value))
            elif name == "role":
                bad = bad or value in ROLES
            else:
                bad = bad or name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "")
    return label, bad


def parse(page: str) -> Node:
    """A tree of block elements; runs of inline text are leaves named '#'."""
    root = Node("#root", False, False)
    stack: list[tuple[str, Node]] = [("#root", root)]
    opened: Counter = Counter()
    run: list[str] = []

    def flush() -> None:
        if run:
            text = _SPACE.sub(" ", html.unescape("".join(run))).strip()
            run.clear()
            if text:
                parent = stack[-1][1]
                leaf = Node("#", parent.bad, parent.main)
                leaf.text = text
                parent.children.append(leaf)

    def close(size: int) -> None:
        for t, _ in stack[size:]:
            opened[t] -= 1
        del stack[size:]

    at = 0
    for m in _MARKUP.finditer(page):
        if m.start() > at:
            run.append(page[at : m.start()])
        at = m.end()
        if not m[3]:
            continue
        tag, closing = m[3].lower(), m[2]
        if tag == "br":
            run.append(" ")
            continue
        if tag in INLINE:
            continue
        flush()
        if tag in VOID_TAGS:
            continue
        if closing:
            if opened[tag]:
                size = len(stack) - 1
                while stack[size][0] != tag:
                    size -= 1
                close(size)
            continue
        if tag in ENDS_P and opened["p"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in SCOPE:
                    break
        ends = CLOSES.get(tag)
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in ends:
                    close(i)
                    break
                if stack[i][0] in SCOPE and stack[i][0] not in ("td", "th"):
                    break
        parent = stack[-1][1]
        label, bad = _kind(tag, m[4], parent.main)
        node = Node(label, parent.bad or bad, parent.main or tag in ("article", "main"))
        parent.children.append(node)
        stack.append((tag, node))
        opened[tag] += 1
    run.append(page[at:])
    flush()
    return root


def nodes(root: Node) -> list[Node]:
    """All nodes, parents before children, in page order."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo += reversed(n.children)
    return out


class Shapes:
    """Trees without their texts, by number, and the scores of matching them."""

    def __init__(self):
        self.ids: dict[tuple, int] = {}
        self.label: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.size: list[int] = []
        self.scores: dict[tuple[int, int], int] = {}

    def number(self, root: Node) -> None:
        for n in reversed(nodes(root)):
            key = n.tag, tuple([c.shape for c in n.children])
            n.shape = self.ids.setdefault(key, len(self.label))
            if n.shape == len(self.label):
                self.label.append(key[0])
                self.kids.append(key[1])
                self.size.append(1 + sum(self.size[k] for k in key[1]))

    @staticmethod
    def ends(x: tuple[int, ...], y: tuple[int, ...]) -> tuple[int, int]:
        """Lengths of the equal beginnings and of the equal ends of two lists."""
        most, front = min(len(x), len(y)), 0
        while front < most and x[front] == y[front]:
            front += 1
        back = 0
        while back < most - front and x[-1 - back] == y[-1 - back]:
            back += 1
        return front, back

    def score(self, a: int, b: int) -> int:
        """Simple tree matching: the most node pairs with equal labels that keep
        order and ancestry."""
        todo = [(a, b)]
        while todo:
            x, y = todo[-1]
            if (x, y) in self.scores:
                todo.pop()
            elif self.label[x] != self.label[y] or x == y:
                self.scores[x, y] = self.size[x] if x == y else 0
            else:
                front, back = self.ends(self.kids[x], self.kids[y])
                left, right = self.kids[x][front : len(self.kids[x]) - back], self.kids[y][front : len(self.kids[y]) - back]
                missing = [(c, d) for c in set(left) for d in set(right) if (c, d) not in self.scores]
                if missing:
                    todo += missing
                    continue
                ends = self.kids[x][:front] + self.kids[x][len(self.kids[x]) - back :]
                self.scores[x, y] = 1 + sum(self.size[k] for k in ends) + (int(self.row(left, right)[-1]) if left and right else 0)
        return self.scores[a, b]

    def row(self, x: tuple[int, ...], y: tuple[int, ...], rows: list | None = None) -> np.ndarray:
        """The best scores of ``x`` with the beginnings of ``y``; all rows if asked."""
        known: dict[int, np.ndarray] = {}
        last = np.zeros(len(y) + 1, np.int64)
        for c in x:
            if c not in known:
                known[c] = np.array([self.score(c, d) for d in y], np.int64)
            if rows is not None:
                rows.append(last)
            step = np.concatenate(([0], np.maximum(last[1:], last[:-1] + known[c])))
            last = np.maximum.accumulate(step)
        if rows is not None:
            rows.append(last)
        return last

    def pairs(self, x: tuple[int, ...], y: tuple[int, ...]) -> list[tuple[int, int]]:
        """Places of ``x`` and ``y`` that a best alignment matches."""
        out, todo = [], [(0, len(x), 0, len(y))]
        while todo:
            a, b, c, d = todo.pop()
            front, back = self.ends(x[a:b], y[c:d])
            out += [(a + i, c + i) for i in range(front)] + [(b - 1 - i, d - 1 - i) for i in range(back)]
            a, b, c, d = a + front, b - back, c + front, d - back
            if a == b or c == d:
                continue
            if (b - a) * (d - c) <= CELLS or b - a == 1:
                rows: list[np.ndarray] = []
                self.row(x[a:b], y[c:d], rows)
                n, m = b - a, d - c
                while n and m:
                    if rows[n][m] == rows[n - 1][m]:
                        n -= 1
                    elif rows[n][m] == rows[n][m - 1]:
                        m -= 1
                    else:
                        n, m = n - 1, m - 1
                        out.append((a + n, c + m))
                continue
            half = (a + b) // 2
            k = int(np.argmax(self.row(x[a:half], y[c:d]) + self.row(x[half:b][::-1], y[c:d][::-1])[::-1]))
            todo += [(a, half, c, c + k), (half, b, c + k, d)]
        return out

    def matched(self, a: Node, b: Node) -> list[tuple[Node, Node]]:
        """Node pairs of a best matching of two numbered trees."""
        out, todo = [], [(a, b)] if a.tag == b.tag else []
        while todo:
            x, y = todo.pop()
            out.append((x, y))
            if x.shape == y.shape:
                todo += zip(x.children, y.children, strict=True)
            elif x.children and y.children:
                todo += [(x.children[i], y.children[j]) for i, j in self.pairs(self.kids[x.shape], self.kids[y.shape])]
        return out


class Pivot:
    """A layout's pivot: its tree, its slots, which are its texts in page order, and
    once they are known those that are template."""

    def __init__(self, page: str, template: tuple[int, ...] = ()):
        self.root, self.shapes = parse(page), Shapes()
        self.shapes.number(self.root)
        self.leaves = [n for n in nodes(self.root) if n.tag == "#"]
        self.slot = {id(n): i for i, n in enumerate(self.leaves)}
        self.paths: dict[tuple[int, str], int] = {}
        own = self.path_of(self.root, True)
        self.template = frozenset(template)
        kept = {id(n) for n in blocks(self.root)}
        text = [len(n.text) if id(n) in kept else 0 for n in self.leaves]
        marked = any(n.main for n in self.leaves)
        if sum(text[i] for i in self.template) > (VOID_MARKED if marked else VOID) * sum(text):
            self.template = frozenset()
        varying = {own[id(n)] for i, n in enumerate(self.leaves) if i not in self.template}
        self.template_paths = {own[id(self.leaves[i])] for i in self.template} - varying

    def path_of(self, root: Node, new: bool = False) -> dict[int, int]:
        """For each text the number of its path; -2 for paths that the pivot lacks."""
        out, todo = {}, [(root, -1)]
        while todo:
            n, path = todo.pop()
            if n.tag == "#":
                out[id(n)] = path
            else:
                path = self.paths.setdefault((path, n.tag), len(self.paths)) if new else self.paths.get((path, n.tag), -2)
                todo += [(c, path) for c in n.children]
        return out

    def aligned(self, root: Node) -> dict[int, int]:
        """For each text of a page that a slot matches, the slot."""
        if len(self.shapes.label) > SHAPES:
            self.shapes = Shapes()
            self.shapes.number(self.root)
        self.shapes.number(root)
        return {id(x): self.slot[id(y)] for x, y in self.shapes.matched(root, self.root) if x.tag == "#"}

    def is_template(self, root: Node) -> set[int]:
        """The texts of a page that belong to the template."""
        if not self.template:
            return set()
        slots, paths = self.aligned(root), self.path_of(root)
        return {i for i, path in paths.items() if (slots[i] in self.template if i in slots else path in self.template_paths)}


def pivot_of(page: str, template: tuple[int, ...], known: dict) -> Pivot:
    key = xxhash.xxh3_128_digest(page), template
    if key not in known:
        if len(known) >= PIVOTS:
            known.pop(next(iter(known)))
        known[key] = Pivot(page, template)
    return known[key]


def blocks(root: Node) -> list[Node]:
    """All texts that may be main by their kind, in page order."""
    out = [n for n in nodes(root) if n.tag == "#" and not n.bad]
    return [n for n in out if n.main] if any(n.main for n in out) else out


def main_text(page: str, pivot: Pivot | None) -> str:
    root = parse(page)
    template = pivot.is_template(root) if pivot else set()
    return "\n".join(n.text for n in blocks(root) if id(n) not in template)


def hashed(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, layout, slot, text, article) of the aligned texts of pages."""
    common.working("extract")
    known: dict = {}
    for batch in batches:
        host, layout, rows = batch.column(0), batch.column(1), ([], [], [], [])
        for i, (page, pivot) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
            root = parse(page)
            texts = {id(n): n.text for n in nodes(root) if n.tag == "#"}
            article = hashed("\0".join(n.text for n in blocks(root)))
            for leaf, slot in pivot_of(pivot, (), known).aligned(root).items():
                for col, x in zip(rows, (i, slot, hashed(texts[leaf]), article), strict=True):
                    col.append(x)
        at = pa.array(rows[0], pa.int64())
        yield pa.RecordBatch.from_arrays([host.take(at), layout.take(at), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.int64())], ["host", "layout", "slot", "text", "article"])


def _extracted(known: dict):
    def extracted(page: pa.Array, pivot: pa.Array, template: pa.Array) -> pa.Array:
        common.working("extract", known.clear)
        texts = []
        for x, p, t in zip(page.to_pylist(), pivot.to_pylist(), template.to_pylist(), strict=True):
            texts.append(main_text(x, pivot_of(p, tuple(t), known) if p and t else None) if x else "")
        return pa.array(texts, pa.string())

    return extracted


_BUILT = r"(?i)<(?:div|section|article|main|aside|nav|header|footer|table|ul|ol|form)\b(?:[^>]*?\sclass\s*=\s*[\"'][^\"'>]*)?"


def layout_of(page: Column) -> Column:
    """A hash of the block elements, with their classes, that a page is built of."""
    built = F.array_distinct(F.regexp_extract_all(page, F.lit(_BUILT), F.lit(0)))
    plain = F.transform(built, lambda x: F.regexp_replace(F.regexp_replace(F.lower(x), r"\s[^>]*class\s*=\s*.", "."), r"\d+", "#"))
    return F.xxhash64(F.array_sort(F.array_distinct(plain)))


def wrappers(p: DataFrame, folder: str) -> DataFrame:
    """(host, layout, pivot, template): for each layout of LEAST pages or more its
    pivot page and the numbers of the template slots."""
    rank = F.xxhash64("page_id", "url")
    p = p.where("html <> ''").withColumn("rank", rank)
    first = p.groupBy("host", "layout").agg(F.min("rank").alias("rank"), F.count_distinct("rank").alias("pages")).where(F.col("pages") >= LEAST).select("host", "layout", "rank")
    first = common.written(first, f"{folder}/first")
    pivots = p.join(first, ["host", "layout", "rank"]).groupBy("host", "layout").agg(F.min("html").alias("pivot"))
    pivots = common.written(pivots, f"{folder}/pivots")
    votes = common.spread_join(p, pivots, ["host", "layout"], "rank", "inner").select("host", "layout", "html", "pivot").mapInArrow(_votes, "host string, layout long, slot int, text long, article long")
    # copies of an article are one; a text that many articles share is counted in parts first
    one = votes.distinct().groupBy("host", "layout", "slot", "text").agg(F.count("*").alias("n"))
    slots = one.groupBy("host", "layout", "slot").agg(F.sum("n").alias("all"), F.sum(F.when(F.col("n") >= LEAST, F.col("n")).otherwise(0)).alias("again"))
    slots = slots.where(F.col("again") >= F.greatest(F.lit(LEAST), CONSTANT * F.col("all")))
    template = slots.groupBy("host", "layout").agg(F.array_sort(F.collect_list("slot")).alias("template"))
    return common.written(pivots.join(template, ["host", "layout"]), f"{folder}/wrappers")


def extract(pages: DataFrame, page: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: key, url, main text and its code points."""
    spark = pages.sparkSession
    common.ship(spark)
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit("")))
    p = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), host.alias("host"), F.col(page).alias("html")).withColumn("layout", layout_of(F.coalesce("html", F.lit(""))))
    known = wrappers(p, common.scratch(spark))
    text = F.arrow_udf(_extracted({}), "string")
    out = common.spread_join(p, known, ["host", "layout"], "page_id", "left").select(F.col("page_id").alias(key), F.col("url").alias(url), text("html", "pivot", "template").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
