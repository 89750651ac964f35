"""Operator 8 against a plain reading of each page alone, and its tree matching against all assignments of children."""

from __future__ import annotations

import random
from html.parser import HTMLParser

from skillweave.llm import queries, wrapper

PHRASING = set("a abbr b br cite code em i img mark q s small span strong sub sup time u wbr".split())
OUTSIDE = set("nav footer aside form button select script style noscript template iframe".split())
OTHER_NAMES = {"ad", "ads", "advert", "cookie", "consent", "notice", "comments", "comment", "sidebar", "newsletter", "share", "related", "promo"}


class Article(HTMLParser):
    """Blocks inside ``article``, without elements that are no part of it; neither hosts nor other pages matter."""

    def __init__(self, source: str):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool]] = []
        self.blocks, self.now = [], []
        self.feed(source)
        self.close()
        self.end_block()

    def end_block(self) -> None:
        text = " ".join("".join(self.now).split())
        self.now = []
        if text:
            self.blocks.append(text)

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.now.append(" ")
        if tag in ("br", "img", "hr", "meta", "link", "input", "wbr"):
            if tag not in PHRASING:
                self.end_block()
            return
        if tag not in PHRASING:
            self.end_block()
            if tag in ("p", "li") and any(t == tag for t, _ in self.open):
                self.handle_endtag(tag)
        names = set(" ".join(v or "" for k, v in attrs if k in ("class", "id", "role")).lower().replace("-", " ").replace("_", " ").split())
        self.open.append((tag, tag in OUTSIDE or bool(names & OTHER_NAMES) and tag != "article"))

    def handle_endtag(self, tag):
        if tag not in PHRASING:
            self.end_block()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        inside = any(t == "article" for t, _ in self.open)
        if inside and not any(gone for _, gone in self.open):
            self.now.append(data)


def test_query_equals_a_plain_reading_of_the_article(spark, sf):
    pages = {r.page_id: r.html or "" for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r.page_id: r for r in queries.op8_wrapper(spark, sf).collect()}
    assert set(got) == set(pages)
    with_article = {i: "\n".join(Article(h).blocks) for i, h in pages.items() if "<article" in h}
    assert len(with_article) > len(pages) // 4
    assert {i: got[i].text for i in with_article} == with_article
    assert all(r.n_chars == len(r.text) for r in got.values())


def _best(one, other) -> int:
    """Size of the largest matching of two nested trees (label, children), over all order-preserving choices of children."""
    if one[0] != other[0]:
        return 0

    def pairs(a, b):
        if not a or not b:
            return 0
        return max(pairs(a[1:], b), pairs(a, b[1:]), (w := _best(a[0], b[0])) and w + pairs(a[1:], b[1:]))

    return 1 + pairs(one[1], other[1])


def _lines(node, depth=0):
    return [f"{depth} {node[0]}", *[line for child in node[1] for line in _lines(child, depth + 1)]]


def test_tree_matching_equals_all_assignments():
    rng = random.Random(8)

    def grow(depth):
        return (rng.choice(["div", "p"]), [grow(depth - 1) for _ in range(rng.randrange(4))] if depth else [])

    for _ in range(150):
        one, other = ("#root", [grow(2) for _ in range(rng.randrange(4))]), ("#root", [grow(2) for _ in range(rng.randrange(4))])
        a, b = "\n".join(_lines(one)), "\n".join(_lines(other))
        found = wrapper.match_trees(a, b)
        pairs = [(i, j) for i, j in enumerate(found) if j >= 0]
        la, pa, _ = wrapper.tree(a)
        lb, pb, _ = wrapper.tree(b)
        assert len(pairs) == _best(one, other)
        assert [j for _, j in pairs] == sorted({j for _, j in pairs})
        assert all(la[i] == lb[j] and (i == 0 or found[pa[i]] == pb[j]) for i, j in pairs)


def _texts(spark, pages):
    rows = [(i, url, html) for i, (url, html) in enumerate(pages)]
    return [r.text for r in sorted(wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect(), key=lambda r: r.page_id)]


def test_copies_are_no_evidence_of_a_template(spark):
    plain = "<script>{}</script><nav>menu</nav><div><p>only story</p></div>"
    marked = "<article><div>bare text</div><p>prose</p></article>"
    lone = "<section><p>lone</p></section>"
    two = ["<div><p>same</p><p class=x>one</p></div>", "<div><p>same</p><p class=x>two</p></div>"]
    pages = [("http://a.example/", plain.format(i)) for i in range(3)] + [("http://b.example/", marked)] * 3
    pages += [("http://c.example/", h) for h in [*two, *two, lone, lone]]
    assert _texts(spark, pages) == ["only story"] * 3 + ["bare text\nprose"] * 3 + ["one", "two", "one", "two", "lone", "lone"]


def test_all_varying_parts_and_wrapped_articles_stay(spark):
    head = "<html><head><title>t{0}</title></head><body><h2>same everywhere</h2>"
    forms = [
        (head + "<div><h1>h {0}</h1></div><div id=a><p>a {0}</p></div><div id=b><p>longer b {0}</p></div>", "h {0}\na {0}\nlonger b {0}"),
        (head + "<p>one {0}</p><ul><li>a long item {0}<li>another long item {0}</ul><p>two {0}</p>", "one {0}\na long item {0}\nanother long item {0}\ntwo {0}"),
        (head + "<form><div><p>page-wide text {0}</p></div><nav>menu {0}</nav></form>", "page-wide text {0}"),
        (head + "<div class=overlay><p>a text of the page {0}</p></div><footer>f {0}</footer>", "a text of the page {0}"),
        (head + "<div id=x><p>text {0}</p></div><div class=comments><p>a comment that is longer than all {0}</p></div>", "text {0}"),
        (head + "<article><p>real {0}</p></article><div class=related><article><p>a longer teaser {0}</p></article></div>", "real {0}"),
    ]
    wraps = ["div class='with-sidebar'", "div class=has-sidebar", "div class=no-sidebar", "div class=overflow-hidden", "div class=overlay", "form"]
    forms += [(head + f"<{w}><article><p>story {{0}}</p></article></{w.split()[0]}><nav>n {{0}}</nav>", "story {0}") for w in wraps]
    pages = [(f"http://h{k}.example/{n}", form.format(n)) for k, (form, _) in enumerate(forms) for n in ("red", "blue")]
    assert _texts(spark, pages) == [text.format(n) for _, text in forms for n in ("red", "blue")]
