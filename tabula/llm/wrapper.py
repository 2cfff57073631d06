"""Main text of web pages by wrapper induction.

1. *Trees.*  A page's tags become a tree of block elements; runs of equally
   built siblings (menu entries, paragraphs) are folded into one node, so a
   tree has a few dozen nodes however long the page.  A folded node keeps a
   digest of each sibling.
2. *Reference.*  For every host the most frequent tree shape gives the
   reference tree.
3. *Alignment.*  Every other page of the host is aligned with the reference by
   simple tree matching: nodes match if their labels do, and their children
   are matched in order for the largest number of matching nodes.
4. *Template.*  A node of the reference, or one sibling of a folded node, whose
   text is found in the matching node of nearly all pages that differ from the
   reference elsewhere is constant: it belongs to the template.  All others are
   slots that vary.
5. *Content.*  A page's text is that of its varying slots, without those that
   the elements around them declare to be something other than the article
   (navigation, adverts, forms, comments ...), and, if the page marks an
   article or a main part, only what lies in it.

The host is the grouping key of steps 2 to 5.  Shapes and constant counts are
aggregated partially before any shuffle, and the joins with a host's one
reference are dealt by (host, salt): a host with more pages than one task
should have (``tabula.operators.hotkeys``) gets as many salts as its share is
worth, all others one.  Trees are written to the shared scratch folder once and
read for steps 2 to 4.
"""

from __future__ import annotations

import base64
import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import cut
from tabula.operators.hotkeys import hot_keys
from tabula.session import drop_scratch, scratch_path

#: A node is constant if its text is the same in this share of the pages that
#: differ from the reference, of which there are at least so many; the second
#: pair holds within a marked article, where repeated text is mostly content.
CONSTANT, LEAST_PAGES = 0.8, 5
CONSTANT_INSIDE, LEAST_PAGES_INSIDE = 0.95, 20
#: Words in links of a block outside a marked article that make it a menu.
LINK_SHARE = 0.6

#: Elements open at once; what is nested deeper hangs on the deepest.
DEEPEST = 150
#: Siblings of a folded node; more are folded by signature wherever they stand.
WIDEST = 64

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt "
    "s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements whose start ends an open paragraph.
BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
#: An open element of the first kind ends where one of the second kind starts.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
        "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}, "thead": {"tbody", "tfoot"},
        "tbody": {"tbody", "tfoot"}}
#: Elements that never hold article text.
NEVER = frozenset("head nav footer aside form button select datalist dialog menu template svg canvas object "
                  "audio video map math script style noscript iframe textarea title input".split())
MAIN = frozenset(("article", "main"))
#: Elements whose names say nothing about what lies in them.
WHOLE = MAIN | {"html", "body"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Words of class, id and role values that name something other than the article.
OTHER = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disclaimer footer hidden login masthead menu modal nav navbar navigation "
    "newsletter notice notices overlay pagination pager popup promo promoted reader recommended related "
    "replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "tags teaser toolbar widget widgets alert alerts complementary contentinfo search".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
                 re.S)
NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
RAW_END = {name: re.compile(rf"</{name}\s*[^>]*>", re.I) for name in RAW}
SPLIT = re.compile(r"[^a-z0-9]+")


class Node:
    """An element; ``other`` if it is not the article, ``named`` if only its names say so."""

    __slots__ = ("tag", "label", "other", "named", "children")

    def __init__(self, tag: str, label: str, other: bool, named: bool = False) -> None:
        self.tag, self.label, self.other, self.named = tag, label, other or named, named and not other
        self.children: list[Node | str] = []


def element(tag: str, attributes: str) -> Node:
    names, other, named = [], tag in NEVER, False
    if attributes and ("=" in attributes or "hidden" in attributes):
        for m in NAMES.finditer(attributes):
            value = (m[2] or m[3] or m[4] or "").lower()
            key = m[1].lower()
            if key in ("hidden", "aria-hidden"):
                other |= key == "hidden" or value == "true"
                continue
            words = SPLIT.split(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", m[2] or m[3] or m[4] or "").lower())
            named |= tag not in WHOLE and not OTHER.isdisjoint(words)
            if key != "id":
                names.append(value)
    return Node(tag, f"{tag}.{' '.join(names)}" if names else tag, other, named)


def parse(page: str) -> Node:
    """The tree of a page; wrongly nested and unclosed tags are put right as they come.

    If names mark something around every article or main part, what is around
    the first is not marked: it is the page's frame.
    """
    root = Node("#root", "#root", False)
    stack, at = [root], 0
    free, frame = False, None
    while True:
        m = TAG.search(page, at)
        if m is None:
            if at < len(page):
                stack[-1].children.append(page[at:])
            for node in () if free else frame or ():
                if node.named:
                    node.other = node.named = False
            return root
        if m.start() > at:
            stack[-1].children.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in BLOCKS:
            _close(stack, {"p"}, BLOCKS - {"p"})
        elif tag in ENDS or tag in ("tfoot", "optgroup"):
            _close(stack, {t for t, by in ENDS.items() if tag in by}, {"ul", "ol", "dl", "table", "select"})
        node = element(tag, m[3])
        if tag in MAIN and not free and not node.other and not any(n.other and not n.named for n in stack):
            free = not any(n.named for n in stack)
            frame = frame or stack[:]
        stack[-1].children.append(node)
        if tag in RAW:
            end = RAW_END[tag].search(page, at)
            at = len(page) if end is None else end.end()
        elif tag not in VOID and not m[3].rstrip().endswith("/") and len(stack) < DEEPEST:
            stack.append(node)


def _close(stack: list[Node], tags: set[str], bounds) -> None:
    """Ends the innermost open element of ``tags``, unless one of ``bounds`` is open in it."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].tag in bounds:
            return


# -------------------------------------------------------------- folded trees

class Folded:
    """A block element or a run of equally built ones: label, text, children, blocks.

    ``siblings`` are the blocks of each element of a run; empty for a single element.
    """

    __slots__ = ("label", "signature", "children", "blocks", "siblings")

    def __init__(self, label: str, children: list[Folded], blocks: list[Block]) -> None:
        self.label, self.children, self.blocks = label, children, blocks
        self.siblings: list[list[Block]] = []
        self.signature = f"{label}({','.join(c.signature for c in children)})"

    def absorb(self, sibling: Folded) -> None:
        if not self.siblings:
            self.siblings.append(list(self.all_blocks()))
        own = list(sibling.all_blocks())
        self.siblings.append(own)
        self.blocks.extend(own)

    def all_blocks(self) -> Iterator[Block]:
        yield from self.blocks
        for child in self.children:
            yield from child.all_blocks()


class Block:
    """One block's text, its place in the page, and where it lies."""

    __slots__ = ("text", "order", "other", "inside", "linked")

    def __init__(self, text: str, order: int, other: bool, inside: bool, linked: float) -> None:
        self.text, self.order, self.other, self.inside, self.linked = text, order, other, inside, linked


def fold(root: Node) -> tuple[Folded, list[Block]]:
    """The folded tree and all blocks in page order."""
    blocks: list[Block] = []

    def visit(node: Node, other: bool, inside: bool, in_header: bool) -> Folded:
        other = other or node.other
        inside = inside or (node.tag in MAIN and not other)
        if node.tag == "header":
            in_header = True
            other = other or not inside
        heading = node.tag in HEADINGS
        children: list[Folded] = []
        pieces: list[str] = []
        linked = [0]

        def flush() -> None:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                hidden = other or (in_header and not heading)
                block = Block(text, len(blocks), hidden, inside, linked[0] / len(text))
                blocks.append(block)
                children.append(Folded("#text", [], [block]))
            pieces.clear()
            linked[0] = 0

        def inline(part: Node, link: bool) -> None:
            for child in part.children:
                if isinstance(child, str):
                    pieces.append(child)
                    linked[0] += len(child) * link
                elif child.tag in INLINE and not (child.other and not other):
                    if child.tag in ("br", "wbr"):
                        pieces.append(" " if child.tag == "br" else "")
                    inline(child, link or child.tag == "a")
                else:
                    flush()
                    children.append(visit(child, other, inside, in_header))

        inline(node, False)
        flush()
        folded: list[Folded] = []
        for child in children:
            last = folded[-1] if folded else None
            if last is not None and last.signature == child.signature:
                last.absorb(child)
            else:
                folded.append(child)
        if len(folded) > WIDEST:
            by_signature: dict[str, Folded] = {}
            for child in folded:
                kept = by_signature.setdefault(child.signature, child)
                if kept is not child:
                    kept.absorb(child)
            folded = list(by_signature.values())
        return Folded(node.label, folded, [])

    return visit(root, False, False, False), blocks


def preorder(tree: Folded) -> list[Folded]:
    out = [tree]
    for child in tree.children:
        out.extend(preorder(child))
    return out


def digest(blocks: list[Block]) -> int:
    """Of the blocks' texts; 0 if there are none."""
    text = "\n".join(b.text for b in blocks)
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) if blocks else 0


#: Characters by which a sibling is known in a skeleton.
KEY = 8


def key(number: int) -> str:
    """The first 48 bits of a digest as ``KEY`` characters."""
    return base64.b64encode(number.to_bytes(8, "big")[:6]).decode()


def skeleton(tree: Folded) -> list:
    """[label, digest of the text, inside an article, children, keys], nested, for JSON.

    ``keys`` (of a run's siblings, end to end) is there for runs that may hold content.
    """
    children = [skeleton(c) for c in tree.children]
    own = list(tree.all_blocks())
    out = [tree.label, digest(own), int(bool(own) and all(b.inside for b in own)), children]
    if tree.siblings and not all(b.other for b in own):
        out.append("".join(key(digest(blocks)) for blocks in tree.siblings))
    return out


def keys(node: list) -> list[str]:
    """The keys of a skeleton node's siblings; of the node itself if it is a single one."""
    if len(node) > 4:
        return [node[4][k:k + KEY] for k in range(0, len(node[4]), KEY)]
    return [key(node[1])]


def match(a: list, b: list) -> int:
    """Simple tree matching: the largest number of node pairs, in order and level by level."""
    if a[0] != b[0]:
        return 0
    return 1 + _table(a[3], b[3])[len(a[3])][len(b[3])]


def _table(xs: list, ys: list) -> list[list[int]]:
    table = [[0] * (len(ys) + 1)]
    for x in xs:
        above, row = table[-1], [0]
        for k, y in enumerate(ys):
            row.append(max(above[k + 1], row[k], above[k] + (match(x, y) if x[0] == y[0] else 0)))
        table.append(row)
    return table


def aligned(a: list, b: list, i: int = 0, j: int = 0) -> Iterator[tuple[int, int, list, list]]:
    """Matched nodes (number in a, number in b, node of a, node of b), numbered in preorder."""
    if a[0] != b[0]:
        return
    yield i, j, a, b
    xs, ys = a[3], b[3]
    starts = lambda n, parts: [n + 1 + sum(map(size, parts[:k])) for k in range(len(parts))]
    at, bt = starts(i, xs), starts(j, ys)
    table = _table(xs, ys)
    m, n, pairs = len(xs), len(ys), []
    while m and n:
        if table[m][n] == table[m - 1][n]:
            m -= 1
        elif table[m][n] == table[m][n - 1]:
            n -= 1
        else:
            m, n = m - 1, n - 1
            pairs.append((m, n))
    for m, n in reversed(pairs):
        yield from aligned(xs[m], ys[n], at[m], bt[n])


def flat(node: list) -> list[list]:
    """A skeleton's nodes in preorder."""
    out = [node]
    for child in node[3]:
        out.extend(flat(child))
    return out


def size(node: list) -> int:
    return 1 + sum(map(size, node[3]))


# -------------------------------------------------------------- extraction

def content(blocks: list[Block], template: set[int]) -> str:
    """A page's main text from its blocks and the order numbers of its template blocks."""
    chosen = [b for b in blocks if not b.other and b.order not in template]
    if any(b.inside for b in blocks if not b.other):
        return " ".join(b.text for b in chosen if b.inside)
    return " ".join(b.text for b in chosen if b.linked < LINK_SHARE)


def extracted(page: str, reference: list | None, constant: list[tuple[int, str]]) -> str:
    """The main text of a page; ``constant`` names nodes of the reference and siblings in them."""
    tree, blocks = fold(parse(page))
    template: set[int] = set()
    if reference and constant:
        nodes, fixed = preorder(tree), set(constant)
        numbers = {i for i, _ in fixed}
        for i, j, _, b in aligned(reference, skeleton(tree)):
            if i in numbers:
                for own, name in zip(nodes[j].siblings or [list(nodes[j].all_blocks())], keys(b)):
                    if (i, name) in fixed:
                        template.update(block.order for block in own)
    return content(blocks, template)


HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def with_host(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    rows = pages.select(F.col(f"`{page_id}`").cast("bigint").alias("page_id"), F.col(f"`{url}`").alias("url"),
                        F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"))
    return rows.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1)))


def dealt(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with ``salt``: one of the parts of a hot host, 0 for all others."""
    return (rows.withColumn("__hot", F.xxhash64("host")).join(F.broadcast(hot), "__hot", "left")
            .withColumn("salt", F.pmod(F.xxhash64("page_id", "url", "html"), F.coalesce("__parts", F.lit(1))).cast("int"))
            .drop("__hot", "__parts"))


def skeletons(pages: DataFrame) -> DataFrame:
    """(host, salt, shape, skeleton) of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes, trees = [], []
            for value in batch.column(2):
                tree, _ = fold(parse(value.as_py()))
                shapes.append(xxhash.xxh3_64_intdigest(tree.signature.encode("utf-8", "replace")) >> 1)
                trees.append(json.dumps(skeleton(tree), separators=(",", ":")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shapes, pa.int64()), pa.array(trees, pa.string())],
                ["host", "salt", "shape", "skeleton"])

    return pages.select("host", "salt", "html").mapInArrow(
        run, "host string, salt int, shape bigint, skeleton string")


def salted(hosts: DataFrame, hot: DataFrame) -> DataFrame:
    """A hot host's row once for each of its salts, all others once."""
    every = F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)
    return (hosts.withColumn("__hot", F.xxhash64("host")).join(F.broadcast(hot), "__hot", "left")
            .withColumn("salt", F.explode(every)).drop("__hot", "__parts"))


def references(trees: DataFrame) -> DataFrame:
    """(host, reference): of each host's most frequent shape, the first tree in order."""
    shapes = trees.groupBy("host", "shape").agg(F.count("*").alias("pages"),
                                                F.min(F.struct("skeleton", "salt")).alias("least"))
    return shapes.groupBy("host").agg(F.max(F.struct("pages", "shape", "least")).alias("best")).select(
        "host", F.col("best.least.skeleton").alias("reference"), F.col("best.shape").alias("own_shape"))


def constants(trees: DataFrame, found: DataFrame, hot: DataFrame) -> DataFrame:
    """(host, constant): constant (node, sibling) of each reference, for hosts that have some."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str, list] = {}
        for batch in batches:
            counts: Counter = Counter()
            for host, tree, reference, alike in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if reference not in read:
                    if len(read) > 2000:
                        read.clear()
                    read[reference] = json.loads(reference)
                ours, theirs = read[reference], json.loads(tree)
                if ours[1] == theirs[1]:        # a copy of the reference says nothing
                    continue
                counts[host, -1, 0, ""] += 1
                # trees of one shape match node by node
                pairs = enumerate(zip(flat(ours), flat(theirs))) if alike else (
                    (i, (a, b)) for i, _, a, b in aligned(ours, theirs))
                for i, (a, b) in pairs:
                    if a[1] and b[1]:
                        for name in set(keys(a)).intersection(keys(b)):
                            counts[host, i, a[2], name] += 1
            if counts:
                found = list(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in found]), pa.array([k[1] for k in found], pa.int32()),
                     pa.array([k[2] for k in found], pa.int32()), pa.array([k[3] for k in found]),
                     pa.array(list(counts.values()), pa.int64())],
                    ["host", "node", "inside", "sibling", "pages"])

    met = trees.join(salted(found, hot), ["host", "salt"]).select(
        "host", "skeleton", "reference", (F.col("shape") == F.col("own_shape")).alias("alike"))
    same = cut(met.mapInArrow(run, "host string, node int, inside int, sibling string, pages bigint")
               .groupBy("host", "node", "inside", "sibling").agg(F.sum("pages").alias("pages")))
    per_host = same.where("node < 0").select("host", F.col("pages").alias("differ"))
    share = F.col("pages") / F.col("differ")
    return (same.where("node >= 0").join(per_host, "host")
            .where(((F.col("inside") == 0) & (share >= CONSTANT) & (F.col("differ") >= LEAST_PAGES))
                   | ((share >= CONSTANT_INSIDE) & (F.col("differ") >= LEAST_PAGES_INSIDE)))
            .groupBy("host").agg(F.sort_array(F.collect_list(F.struct("node", "sibling"))).alias("constant")))


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``.

    White space within a block becomes one blank, blocks are joined by one
    blank in page order.  NULL and empty pages have the text ""; pages without
    a host (NULL or odd url) form one host; repeated rows give repeated
    results; an empty table gives an empty table.
    """
    spark = pages.sparkSession
    rows = with_host(pages, page_id, url, html)
    hot = cut(hot_keys(rows, ["host"]))
    rows = dealt(rows, hot)
    path = scratch_path(spark, "trees")         # written once, read for references and for constants
    skeletons(rows).write.parquet(path)
    trees = spark.read.parquet(path)
    found = cut(references(trees))
    wrappers = cut(found.join(constants(trees, found, hot), "host").drop("own_shape"))
    drop_scratch(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str, list] = {}
        for batch in batches:
            for k in range(0, len(batch), 512):
                own = batch.slice(k, 512)
                texts = []
                for page, reference, constant in zip(*(own.column(c).to_pylist() for c in (2, 3, 4))):
                    if reference is not None and reference not in read:
                        if len(read) > 2000:
                            read.clear()
                        read[reference] = json.loads(reference)
                    texts.append(extracted(page, read.get(reference),
                                           [(c["node"], c["sibling"]) for c in constant or ()]))
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    joined = rows.join(salted(wrappers, hot), ["host", "salt"], "left")
    return joined.select("page_id", "url", "html", "reference", "constant").mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint")
