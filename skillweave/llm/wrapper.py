"""Main text of pages by wrapper induction (operator 8).

A page becomes a tree of block elements in which neighbours of equal shape fall together; this shape is its skeleton. The skeletons of a
host are aligned by simple tree matching with the host's most frequent one. Texts of aligned nodes are counted over all pages of the host: a
node whose text is the same on two different pages or more, and everywhere, is template, the others are slots. The wrapper of a skeleton says which of its nodes carry
content: the slots and the prose of the article, or all slots where a page marks none, without the parts whose element or name says that
they are something else; unless such a part wraps the article or most of what varies. Pages are read twice, so that only text which may be content is shuffled once.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillweave.llm.common import SALTS, map_batches, salted
from skillweave.session import written

# Elements by their role in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe noembed noframes xmp".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd map mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}}
SCOPES = {"table", "ul", "ol", "dl", "select", "article", "section", "main", "body", "html"}
KEEPS_P = {"option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "head"}
DROPPED = set("head nav footer aside form button select label fieldset dialog menu svg canvas object audio video script style textarea title noscript template iframe".split())
UNSEEN = set("head svg canvas object audio video script style textarea title noscript template iframe".split())
PROSE = set("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt figcaption".split())
NAMES = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscri\w+|signup|login|comments?|disqus|replies|respond"
    r"|sidebar|widgets?|related|recommend\w*|share|sharing|social|breadcrumbs?|menu|navbar|nav|navigation|footer|toolbar|pagination|pager|skip|masthead|site-?header|page-?header|hidden)(?:$|[^a-z])"
)
# Names of a layout, not of the part itself; and names of what readers wrote.
MODIFIERS = re.compile(r"(?:^|(?<=[^a-z]))(?:with|without|has|no|is|overflow)[-_][a-z]+")
REPLIES = re.compile(r"(?:^|[^a-z])(?:comments?|disqus|replies|respond)(?:$|[^a-z])")
REGION_NAMES = re.compile(r"(?:^|[^a-z])(?:article|post|entry|story|content|main)(?:$|[^a-z])")
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S)
_NAME = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HOST = re.compile(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


class Page:
    """Block elements in document order (label, parent) and texts as (element, text)."""

    def __init__(self, source: str):
        self.labels, self.parents = ["#root"], [-1]
        self.blocks: list[tuple[int, str]] = []
        self.stack: list[tuple[str, int]] = [("#root", 0)]
        self.buffer: list[str] = []
        at, end = 0, len(source)
        while at < end:
            tag = _TAG.search(source, at)
            if tag is None:
                self.text(source[at:])
                break
            if tag.start() > at:
                self.text(source[at : tag.start()])
            at = tag.end()
            name = tag[2]
            if name is None:
                continue
            name = name.lower()
            if tag[1]:
                self.close(name)
                continue
            self.open(name, tag[3])
            if name in RAW:
                stop = re.compile(f"</{re.escape(name)}[\\s/>]", re.I).search(source, at)
                at = stop.start() if stop else end
        self.flush()

    def text(self, raw: str) -> None:
        self.buffer.append(html.unescape(raw) if "&" in raw else raw)

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                self.blocks.append((self.stack[-1][1], text))
            self.buffer.clear()

    def pop(self, depth: int) -> None:
        if any(n not in INLINE for n, _ in self.stack[depth:]):
            self.flush()
        del self.stack[depth:]

    def last(self, names: set[str], scopes: set[str]) -> int | None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth][0] in names:
                return depth
            if self.stack[depth][0] in scopes:
                return None
        return None

    def open(self, name: str, attributes: str) -> None:
        if name in INLINE:
            if name == "br":
                self.buffer.append(" ")
            elif name not in VOID:
                self.stack.append((name, self.stack[-1][1]))
            return
        self.flush()
        if name not in KEEPS_P and name not in VOID:
            depth = self.last({"p"}, SCOPES)
            if depth:
                self.pop(depth)
        if name in CLOSES:
            depth = self.last(CLOSES[name], SCOPES)
            if depth:
                self.pop(depth)
        if name in VOID:
            return
        names = " ".join(x for m in _NAME.findall(attributes) for x in m if x) if attributes else ""
        self.labels.append(f"{name} {re.sub('[0-9]+', '0', names.lower())}".strip())
        self.parents.append(self.stack[-1][1])
        self.stack.append((name, len(self.labels) - 1))

    def close(self, name: str) -> None:
        if name in INLINE:
            for depth in range(len(self.stack) - 1, 0, -1):
                if self.stack[depth][0] == name:
                    del self.stack[depth]
                    return
                if self.stack[depth][0] not in INLINE:
                    return
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth][0] == name:
                self.pop(depth)
                return

    def folded(self) -> tuple[str, list[int]]:
        """The skeleton, a line of depth and label per node, and the skeleton node of each element."""
        n = len(self.labels)
        children: list[list[int]] = [[] for _ in range(n)]
        for i in range(1, n):
            children[self.parents[i]].append(i)
        shape, known = [0] * n, {}
        for i in range(n - 1, -1, -1):
            inner = []
            for c in children[i]:
                if not inner or inner[-1] != shape[c]:
                    inner.append(shape[c])
            shape[i] = known.setdefault((self.labels[i], *inner), len(known))
        # The first of a row of equal siblings stands for all of them, and so do its descendants.
        node, stands, lines, depth = [0] * n, list(range(n)), [f"0 {self.labels[0]}"], [0] * n
        for parent in range(n):
            row, like = -1, self._row(children[stands[parent]], shape)
            for k, c in enumerate(children[parent]):
                row += not k or shape[children[parent][k - 1]] != shape[c]
                stands[c] = stands[like[row]] if like[row] != c else c
        for i in range(1, n):
            depth[i] = depth[self.parents[i]] + 1
            if stands[i] == i:
                node[i] = len(lines)
                lines.append(f"{depth[i]} {self.labels[i]}")
            else:
                node[i] = node[stands[i]]
        return "\n".join(lines), node

    @staticmethod
    def _row(siblings: list[int], shape: list[int]) -> list[int]:
        return [c for k, c in enumerate(siblings) if not k or shape[siblings[k - 1]] != shape[c]]


def tree(skeleton: str) -> tuple[list[str], list[int], list[int]]:
    """Labels, parents and depths of a skeleton."""
    labels, parents, depths, path = [], [], [], []
    for line in skeleton.split("\n"):
        depth, label = line.split(" ", 1)
        del path[int(depth) :]
        labels.append(label)
        parents.append(path[-1] if path else -1)
        depths.append(int(depth))
        path.append(len(labels) - 1)
    return labels, parents, depths


def match_trees(one: str, other: str) -> list[int]:
    """Simple tree matching: for each node of ``one`` the node of ``other`` it is aligned with, or -1.

    A pair of nodes counts one plus the best order-preserving assignment of their children; only equal labels pair, and only below a pair. Levels are
    worked off from the deepest, so deep trees need no recursion.
    """
    (la, pa_, da), (lb, pb, db) = tree(one), tree(other)
    if one == other:
        return list(range(len(la)))
    kids_a: list[list[int]] = [[] for _ in la]
    kids_b: list[list[int]] = [[] for _ in lb]
    for kids, parents in ((kids_a, pa_), (kids_b, pb)):
        for i in range(1, len(parents)):
            kids[parents[i]].append(i)
    level_b: dict[tuple[int, str], list[int]] = {}
    for j, label in enumerate(lb):
        level_b.setdefault((db[j], label), []).append(j)
    weight: dict[tuple[int, int], int] = {}

    def table(a: int, b: int) -> list[list[int]]:
        rows = [[0] * (len(kids_b[b]) + 1)]
        for x in kids_a[a]:
            last, row = rows[-1], [0]
            for k, y in enumerate(kids_b[b]):
                row.append(max(row[-1], last[k + 1], last[k] + weight.get((x, y), 0)))
            rows.append(row)
        return rows

    for a in sorted(range(len(la)), key=lambda i: -da[i]):
        for b in level_b.get((da[a], la[a]), ()):
            weight[a, b] = 1 + table(a, b)[-1][-1]
    found, todo = [-1] * len(la), [(0, 0)] if la[0] == lb[0] else []
    while todo:
        a, b = todo.pop()
        found[a] = b
        rows, i, k = table(a, b), len(kids_a[a]), len(kids_b[b])
        while i and k:
            if rows[i][k] == rows[i - 1][k]:
                i -= 1
            elif rows[i][k] == rows[i][k - 1]:
                k -= 1
            else:
                i, k = i - 1, k - 1
                todo.append((kids_a[a][i], kids_b[b][k]))
    return found


def dropped(labels: list[str], parents: list[int], spared: set[int] = frozenset()) -> list[bool]:
    """Whether a node, or one above it, is no part of an article by its element or name; ``spared`` ones are not so by themselves."""
    out: list[bool] = []
    for i, (label, parent) in enumerate(zip(labels, parents, strict=True)):
        name, _, names = label.partition(" ")
        above = parent >= 0 and out[parent]
        inside = _inside(labels, parents, parent, {"article", "main"})
        by_name = name not in ("article", "main", "body", "html", "#root") and bool(NAMES.search(MODIFIERS.sub("", names)))
        own = name in DROPPED or (name == "header" and not inside) or by_name
        out.append(above or (own and i not in spared))
    return out


def never(labels: list[str], parents: list[int]) -> list[bool]:
    """Whether a node is in an element that a page does not show as text."""
    out: list[bool] = []
    for label, parent in zip(labels, parents, strict=True):
        out.append(label.partition(" ")[0] in UNSEEN or parent >= 0 and out[parent])
    return out


def wrappers_of_content(labels: list[str], parents: list[int], constant: set[int], chars: dict[int, int]) -> set[int]:
    """Nodes that ``dropped`` must spare, as the page has its article only inside them, or most of its varying text.

    A part that names replies, and elements other than a form, count as wrappers of text only if nothing that varies is left outside.
    """
    gone = dropped(labels, parents)
    unseen = never(labels, parents)
    marks = [i for i, label in enumerate(labels) if label.partition(" ")[0] in ("article", "main") and not unseen[i]]
    held = [i for i in marks if any(_below(parents, j, {i}) for j in chars)]
    if any(not gone[i] for i in held):
        return set()
    if held:
        return {i for i in _lineage(parents, held) if not unseen[i]}
    mass = [0] * len(labels)
    for i, n in chars.items():
        mass[i] += n * (i not in constant and not unseen[i])
    left = sum(n for n, g in zip(mass, gone, strict=True) if not g)
    for i in range(len(labels) - 1, 0, -1):
        mass[parents[i]] += mass[i]
    spared = set()
    for i, label in enumerate(labels):
        name, _, names = label.partition(" ")
        weak = name not in DROPPED - {"form", "fieldset"} and name != "header" and not REPLIES.search(names)
        if not unseen[i] and 2 * mass[i] > mass[0] and (weak or not left):
            spared.add(i)
    return spared


def _lineage(parents: list[int], nodes: list[int]) -> set[int]:
    out: set[int] = set()
    for node in nodes:
        while node >= 0 and node not in out:
            out.add(node)
            node = parents[node]
    return out


def _inside(labels: list[str], parents: list[int], node: int, names: set[str]) -> bool:
    while node >= 0:
        if labels[node].partition(" ")[0] in names:
            return True
        node = parents[node]
    return False


def content_nodes(skeleton: str, constant: set[int], chars: dict[int, int]) -> list[bool]:
    """Which nodes of a skeleton carry content. ``constant``: template nodes; ``chars``: text of the nodes over all pages."""
    labels, parents, _ = tree(skeleton)
    gone = dropped(labels, parents, wrappers_of_content(labels, parents, constant, chars))
    names = [label.partition(" ") for label in labels]
    tests = (lambda t, n: t == "article", lambda t, n: t == "main" or "main" in n.split(), lambda t, n: bool(REGION_NAMES.search(n)))
    roots: set[int] = set()
    for test in tests:
        roots = {i for i, (t, _, n) in enumerate(names) if not gone[i] and test(t, n)}
        if roots and any(_below(parents, i, roots) and not gone[i] for i in chars):
            break
        roots = set()
    marked = bool(roots)
    if not marked:
        roots = {0}
    keep = []
    for i in range(len(labels)):
        template = i in constant and not (marked and names[i][0] in PROSE)
        keep.append(not gone[i] and not template and _below(parents, i, roots))
    return keep


def _below(parents: list[int], node: int, roots: set[int]) -> bool:
    while node >= 0:
        if node in roots:
            return True
        node = parents[node]
    return False


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def identity(texts: list[tuple[int, str]], gone: list[bool], unseen: list[bool]) -> int:
    """Hash of what a page says outside dropped parts, or of all it shows if these hold most; copies share it, whatever their scripts are."""
    shown = [(i, t) for i, t in texts if not unseen[i]]
    left = [t for i, t in shown if not gone[i]]
    if 2 * sum(map(len, left)) < sum(len(t) for _, t in shown):
        left = [t for _, t in shown]
    return xxhash.xxh64_intdigest("\n".join(left)) >> 1


_VIEW = "array<struct<node:int,hash:long,chars:long>>"
_BLOCKS = "array<struct<node:int,text:string>>"


def _slots(pages: DataFrame) -> DataFrame:
    """``host, skeleton, page, slots``: per page its identity, the hash and the length of each node's text."""

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"host": [], "skeleton": [], "page": [], "slots": []}
        shapes: dict[str, tuple[list[bool], list[bool]]] = {}
        for url, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            page = Page(source or "")
            skeleton, node = page.folded()
            texts: dict[int, list[str]] = {}
            for i, text in page.blocks:
                texts.setdefault(node[i], []).append(text)
            out["host"].append(host_of(url))
            out["skeleton"].append(skeleton)
            if skeleton not in shapes:
                labels, parents, _ = tree(skeleton)
                shapes[skeleton] = dropped(labels, parents), never(labels, parents)
            out["page"].append(identity([(node[i], t) for i, t in page.blocks], *shapes[skeleton]))
            out["slots"].append([{"node": k, "hash": xxhash.xxh64_intdigest("\n".join(t)) >> 1, "chars": sum(map(len, t))} for k, t in texts.items()])
        return out

    return map_batches(pages.select("url", "html"), run, f"host string, skeleton string, page long, slots {_VIEW}")


def induce(pages: DataFrame) -> DataFrame:
    """``host, skeleton, keep``: the wrapper, a flag per skeleton node."""
    seen = written(_slots(pages), "page-slots")
    shapes = written(seen.groupBy("host", "skeleton").agg(F.count("*").alias("n")), "skeletons")
    reference = shapes.groupBy("host").agg(F.max(F.struct("n", "skeleton")).alias("top")).select("host", F.col("top.skeleton").alias("reference"))
    pairs = shapes.join(reference, "host").select("host", "skeleton", "reference")

    def align(batch: pa.RecordBatch) -> dict:
        cache: dict[tuple[str, str], list[int]] = {}
        out = []
        for pair in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if pair not in cache:
                cache[pair] = match_trees(*pair)
            out.append(cache[pair])
        return {"host": batch.column(0), "skeleton": batch.column(1), "aligned": out}

    aligned = written(map_batches(pairs, align, "host string, skeleton string, aligned array<int>"), "alignments")
    # Copies of a page are no evidence of a template: a node must be on two different pages. A node without a partner is compared among the pages of its own skeleton.
    counted = seen.select("host", "skeleton", "page", F.explode("slots").alias("s")).groupBy("host", "skeleton", "s.node").agg(F.min("page").alias("first"), F.max("page").alias("last"), F.min("s.hash").alias("low"), F.max("s.hash").alias("high"), F.sum("s.chars").alias("chars"))
    met = counted.join(aligned, ["host", "skeleton"]).withColumn("partner", F.get("aligned", F.col("node"))).drop("aligned")
    met = written(met.withColumn("own", F.when(F.col("partner") < 0, F.col("skeleton"))), "slots")
    slots = met.groupBy("host", "own", "partner", F.when(F.col("partner") < 0, F.col("node")).alias("lone")).agg(
        ((F.min("first") < F.max("last")) & (F.min("low") == F.max("high"))).alias("constant"), F.sum("chars").alias("all_chars")
    )
    keys = slots.select(F.col("host").alias("h"), F.col("own").alias("o"), F.col("partner").alias("p"), F.col("lone").alias("l"), "constant", "all_chars")
    lone = F.when(F.col("partner") < 0, F.col("node"))
    judged = met.join(keys, (F.col("host") == F.col("h")) & (F.col("partner") == F.col("p")) & F.col("own").eqNullSafe(F.col("o")) & lone.eqNullSafe(F.col("l")))
    views = judged.groupBy("host", "skeleton").agg(F.collect_list(F.struct("node", "constant", "all_chars")).alias("nodes"))
    views = shapes.select("host", "skeleton").join(views, ["host", "skeleton"], "left")

    def decide(batch: pa.RecordBatch) -> dict:
        keep = []
        for skeleton, nodes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            nodes = nodes or []
            keep.append(content_nodes(skeleton, {n["node"] for n in nodes if n["constant"]}, {n["node"]: n["all_chars"] for n in nodes}))
        return {"host": batch.column(0), "skeleton": batch.column(1), "keep": keep}

    return written(map_batches(views, decide, "host string, skeleton string, keep array<boolean>"), "wrappers")


def extract(pages: DataFrame) -> DataFrame:
    """Every row as ``page_id, url, text``: the content blocks in page order, joined by line breaks.

    Character references are decoded, and white space within a block is one space. A null or empty page has an empty text, a page without host or
    whose host has no other page is judged by its elements and names alone. Repeated rows give equal results; an empty table gives an empty result; other
    columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    wrappers = induce(rows).withColumn("shape", F.sha2(F.concat_ws("\n", "host", "skeleton"), 256)).select("shape", "keep")

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"shape_of": [], "blocks": []}
        gone: dict[str, list[bool]] = {}
        for url, source in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            page = Page(source or "")
            skeleton, node = page.folded()
            if skeleton not in gone:
                gone[skeleton] = never(*tree(skeleton)[:2])
            out["shape_of"].append(f"{host_of(url)}\n{skeleton}")
            out["blocks"].append([{"node": node[i], "text": t} for i, t in page.blocks if not gone[skeleton][node[i]]])
        return out | {"page_id": batch.column(0), "url": batch.column(1)}

    found = map_batches(rows, run, f"page_id long, url string, shape_of string, blocks {_BLOCKS}")
    found = found.withColumn("shape", F.sha2("shape_of", 256)).drop("shape_of").withColumn("salt", salted(F.struct("page_id", "url")))
    # Every salt of a wrapper is made, as the wrappers are few beside the pages; so pages are not read again to see which are used.
    copies = wrappers.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    met = found.join(copies, ["shape", "salt"])
    kept = F.filter("blocks", lambda b: F.get(F.col("keep"), b["node"]))
    return met.select("page_id", "url", F.array_join(F.transform(kept, lambda b: b["text"]), "\n").alias("text"))
