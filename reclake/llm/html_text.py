"""Main text of web pages by wrapper induction: pages of a host are aligned, what stays the same is template."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reclake.llm.registry import query, table
from reclake.session import materialize

# ---- fixed values: HTML elements by behaviour, names that mark furniture ----
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output q ruby rp rt s samp small span "
    "strike strong sub sup time tt u var wbr".split())
SKIPPED = set(
    "head title script style noscript template svg math canvas audio video picture iframe object nav header footer aside form "
    "button select textarea input dialog menu".split())
SKIPPED_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
SKIPPED_NAMES = set(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent footer form header "
    "login menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promotion related reply replies "
    "respond search share sharing sidebar side social sponsor sponsored subscribe toolbar topbar widget widgets".split())
CLOSES = {  # an element that ends an open one of these, up to the nearest of the stops
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
STOPS = set("ul ol dl table tbody thead tfoot div article section main body blockquote".split())
# ---- end of fixed values ----
MAX_BROADCAST_CHARS = 16_000_000
MAX_DEPTH = 200
MIN_PAGES, MIN_SHARE = 3, 0.5
MIN_PAGES_INSIDE, MIN_SHARE_INSIDE = 10, 0.9
STEP = 64
CACHE = 50_000


class Node:
    __slots__ = ("tag", "label", "kids", "shape", "skip", "number")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag = tag
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower()
        self.label = f"{tag} {names.strip()}".strip()
        self.kids: list[Node | str] = []
        words = set(names.replace("-", " ").replace("_", " ").split())
        self.skip = (
            tag in SKIPPED or (attrs.get("role") or "").lower() in SKIPPED_ROLES or bool(words & SKIPPED_NAMES)
            or "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in (attrs.get("style") or "").replace(" ", "")
        ) and tag not in ("html", "body", "article", "main") or (tag in ("article", "main") and bool(words & {"comment", "comments", "reply"}))


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        ends = CLOSES.get(tag) or ({"p"} if tag not in INLINE and tag not in VOID else None)
        if ends:
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at].tag in ends:
                    del self.open[at:]
                    break
                if self.open[at].tag in STOPS:
                    break
        node = Node(tag, dict(attrs))
        self.open[-1].kids.append(node)
        if tag not in VOID and len(self.open) < MAX_DEPTH:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                del self.open[at:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].kids.append(data)


def parse(html: str) -> Node:
    """Element tree of a page; elements nested deeper than ``MAX_DEPTH`` become siblings."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    _number(builder.root)
    return builder.root


def _number(root: Node) -> None:
    """Number the elements in page order and give each its shape: its label and the shapes of its elements."""
    count = 0

    def visit(node: Node) -> None:
        nonlocal count
        node.number = count
        count += 1
        for kid in node.kids:
            if isinstance(kid, Node):
                visit(kid)
        node.shape = _intern((node.label, *[kid.shape for kid in node.kids if isinstance(kid, Node)]))

    visit(root)


_MATCHES: dict[tuple[int, int], int] = {}


def _intern(key: tuple) -> int:
    """A 64-bit number for a shape, the same in every tree."""
    return hash(key)


def _elements(node: Node) -> list[Node]:
    return [kid for kid in node.kids if isinstance(kid, Node)]


def _rows(one: list[Node], other: list[Node]) -> list[list[int]]:
    best = [[0] * (len(other) + 1)]
    for a in one:
        above, row = best[-1], [0]
        for j, b in enumerate(other):
            value = above[j] + tree_match(a, b)
            up, left = above[j + 1], row[j]
            row.append(max(value, up, left))
        best.append(row)
    return best


def tree_match(one: Node, other: Node) -> int:
    """Simple tree matching: the largest number of node pairs of equal label that keeps parents and order."""
    if one.label != other.label:
        return 0
    key = one.shape, other.shape
    if key not in _MATCHES:
        if len(_MATCHES) >= CACHE:
            _MATCHES.clear()
        _MATCHES[key] = 1 + _rows(_elements(one), _elements(other))[-1][-1]
    return _MATCHES[key]


def align(one: Node, other: Node, pairs: dict[int, Node] | None = None) -> dict[int, Node]:
    """Node of ``other`` for the number of each node of ``one`` that simple tree matching pairs."""
    pairs = {} if pairs is None else pairs
    if one.label != other.label:
        return pairs
    pairs[one.number] = other
    mine, theirs = _elements(one), _elements(other)
    best = _rows(mine, theirs)
    i, j = len(mine), len(theirs)
    while i and j:
        weight = tree_match(mine[i - 1], theirs[j - 1])
        if weight and best[i][j] == best[i - 1][j - 1] + weight:
            i, j = i - 1, j - 1
            align(mine[i], theirs[j], pairs)
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return pairs


def blocks(root: Node) -> list[tuple[int, str, bool]]:
    """Text blocks in page order: number of the element, text with single spaces, whether in an article or main element.

    If the page has such an element, only what is inside counts. Furniture is left out; inline elements join their
    surroundings without a space, all others end a block.
    """
    found: list[tuple[int, list[str], bool]] = []

    def visit(node: Node, inside: bool, owner: int) -> None:
        if node.skip:
            return
        inside = inside or node.tag in ("article", "main")
        if node.tag not in INLINE and node.tag not in VOID:
            owner = node.number
            found.append((owner, [], inside))
        for kid in node.kids:
            if isinstance(kid, str):
                found[-1][1].append(kid)
            elif kid.tag == "br":
                found[-1][1].append(" ")
            else:
                visit(kid, inside, owner)
                if kid.tag not in INLINE and not kid.skip:
                    found.append((owner, [], inside))

    visit(root, False, 0)
    clean = [(number, " ".join("".join(parts).split()), inside) for number, parts, inside in found]
    clean = [block for block in clean if block[1]]
    return [block for block in clean if block[2]] or clean


PAGE = "host string, copy boolean, blocks array<struct<node:int,same:boolean,inside:boolean,text:string>>"


def align_pages(pages: DataFrame) -> DataFrame:
    """Blocks of every page, each with the node of the host's reference page (``_pivot``) that it is aligned with.

    ``same``: the block's text equals the reference's there. ``copy``: that holds for over half of the page's text, so the page
    is a copy of the reference and says nothing about the template.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("node", pa.int32()), ("same", pa.bool_()), ("inside", pa.bool_()), ("text", pa.string())])
        known: dict[str, tuple[Node, dict[int, set[str]]]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                copies, lists = [], []
                for html, pivot in zip(part.column(2).to_pylist(), part.column(4).to_pylist(), strict=True):
                    root = parse(html)
                    if pivot not in known:
                        if len(known) >= 200:
                            known.clear()
                        tree, texts = parse(pivot), {}
                        for number, text, _ in blocks(tree):
                            texts.setdefault(number, set()).add(text)
                        known[pivot] = tree, texts
                    tree, texts = known[pivot]
                    pairs = align(root, tree)
                    found = []
                    for number, text, inside in blocks(root):
                        node = pairs[number].number if number in pairs else -1
                        found.append({"node": node, "same": text in texts.get(node, ()), "inside": inside, "text": text})
                    total = sum(len(block["text"]) for block in found)
                    copies.append(2 * sum(len(block["text"]) for block in found if block["same"]) > total)
                    lists.append(found)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), part.column(3), pa.array(copies, pa.bool_()), pa.array(lists, pa.list_(item)),
                ], ["page_id", "url", "host", "copy", "blocks"])

    kinds = [pages.schema[name].dataType.simpleString() for name in ("page_id", "url")]
    return pages.select("page_id", "url", "_html", "host", "_pivot").mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, {PAGE}")


def extract_text(pages: DataFrame, max_broadcast: int = MAX_BROADCAST_CHARS) -> DataFrame:
    """``page_id``, ``url``, ``text``: the main text of every page, its blocks joined by one space.

    Each host has a reference page, the one with the smallest hash of its address. All pages of the host are aligned with it
    by simple tree matching. A block is template if its text is that of the reference on at least half of the pages aligned
    there and on three or more; inside an article, where pages may share passages, nine tenths and ten pages. Copies of
    the reference are no evidence. What is left of a page after furniture and template is its text.

    Each page is parsed once, in its own task; blocks are written, counts per host and node are summed before the shuffle, and
    templates are joined back. Reference pages are broadcast up to ``max_broadcast`` characters in all, else joined by host,
    where adaptive execution splits a large host.

    Null or empty html: empty text. Pages without a host form one host. Repeated rows are pages of their own. Other columns go.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("_html"), host.alias("host"))
    order = F.struct(F.xxhash64("page_id", "url").alias("hash"), "page_id", "url")
    first = rows.filter(F.col("_html") != "").groupBy("host").agg(F.min(order).alias("_first"))
    named = rows.withColumn("_first", order).filter(F.col("_html") != "")
    pivots = named.join(F.broadcast(first) if first.count() <= max_broadcast // 100 else first, ["host", "_first"], "left_semi")
    pivots = materialize(pivots.groupBy("host").agg(F.min("_html").alias("_pivot")), "pivots")
    size = pivots.agg(F.sum(F.length("_pivot"))).first()[0] or 0
    paired = rows.join(F.broadcast(pivots) if size <= max_broadcast else pivots, "host", "left")
    aligned = materialize(align_pages(paired.withColumn("_pivot", F.coalesce("_pivot", F.lit("")))), "aligned")
    seen = aligned.filter(~F.col("copy")).select("host", F.explode("blocks").alias("_b")).filter(F.col("_b.node") >= 0)
    share = F.avg(F.col("_b.same").cast("int"))
    template = seen.groupBy("host", "_b.node").agg(
        F.count("*").alias("_n"), share.alias("_share"), F.max("_b.inside").alias("_inside"))
    fixed = F.when(F.col("_inside"), (F.col("_n") >= MIN_PAGES_INSIDE) & (F.col("_share") >= MIN_SHARE_INSIDE)).otherwise(
        (F.col("_n") >= MIN_PAGES) & (F.col("_share") >= MIN_SHARE))
    template = template.filter(fixed).groupBy("host").agg(F.collect_set("node").alias("_template"))
    template = materialize(template, "templates")
    joined = aligned.join(template, "host", "left").withColumn("_template", F.coalesce("_template", F.array().cast("array<int>")))
    kept = F.filter("blocks", lambda b: ~(b["same"] & F.array_contains("_template", b["node"])))
    return joined.select("page_id", "url", F.array_join(F.transform(kept, lambda b: b["text"]), " ").alias("text"))


@query("op9_html_text")
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
