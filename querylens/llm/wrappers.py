"""Main text of web pages, by wrappers induced from the pages of a host.

The pages of a site come from a template. Each page's tree of block elements
is folded and aligned with the most frequent tree of its host by simple tree
matching: the largest number of matched nodes with equal labels, parents above
children and siblings in order. Aligned nodes are the same slot of the
template. A text that stands in one slot on nearly all pages of the host is
constant: it belongs to the template. Texts that vary are content, if they
aren't in a part of the page that its markup names as something else, such as
a menu, and if their slot isn't one of links.

A host's pages never meet in one task: shapes and texts are counted by Spark,
and each page is compared with its host's one tree alone.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from querylens.llm.common import add_columns
from querylens.llm.dom import ARTICLE, MAIN, NO_REGION, Page, parse
from querylens.llm.url_filter import host_of
from querylens.operators.joins import lookup_join
from querylens.sources.scratch import materialize

# A text is constant if it is in the same slot on this share of a host's different pages, and there are enough of them.
CONSTANT_SHARE = 0.9
LEAST_PAGES = 8
# A slot outside of articles is a menu if this share of its characters is in links.
MENU_SHARE = 0.5

# Pairs of children up to which two nodes' children are aligned for the most matches. Beyond, only equal subtrees are.
_PAIRS = 250_000
_CACHED = 4096
_UNMATCHED = 1 << 62


class Shape:
    """A tree read from its text, ``label(child,child)``; nodes are numbered in the order of the text."""

    def __init__(self, text: str):
        self.labels: list[str] = []
        self.parents: list[int] = []
        self.children: list[list[int]] = []
        self.texts: list[str] = []  # of each node's subtree
        above, began, word = [-1], [], 0
        for at, sign in enumerate(text + ","):
            if sign not in "(),":
                continue
            name = text[word:at]
            if name:
                self.labels.append(name)
                self.parents.append(above[-1])
                self.children.append([])
                self.texts.append(name)
                if above[-1] >= 0:
                    self.children[above[-1]].append(len(self.labels) - 1)
            if sign == "(":
                above.append(len(self.labels) - 1)
                began.append(at - len(name))
            elif sign == ")":
                self.texts[above.pop()] = text[began.pop() : at + 1]
            word = at + 1


def _equal_subtrees(a: Shape, b: Shape, left: Sequence[int], right: Sequence[int]) -> list[tuple[int, int]]:
    """Children with equal subtrees, each once and in order, the earliest first."""
    places: dict[str, list[int]] = {}
    for at, j in enumerate(right):
        places.setdefault(b.texts[j], []).append(at)
    found, least = [], 0
    for i in left:
        at = next((p for p in places.get(a.texts[i], ()) if p >= least), None)
        if at is not None:
            found.append((i, right[at]))
            least = at + 1
    return found


def simple_tree_matching(a: Shape, b: Shape) -> dict[int, int]:
    """Nodes of ``a`` with their partners in ``b``, as many as can be matched top down and in order; the roots match if equal.

    Nodes with more than ``_PAIRS`` pairs of children are matched by equal
    subtrees only, which may be fewer than could be.
    """
    if not a.labels or not b.labels or a.labels[0] != b.labels[0]:
        return {}
    order, seen, large = [(0, 0)], {(0, 0)}, {}
    for pair in order:  # grows while it is walked: pairs below come later
        left, right = a.children[pair[0]], b.children[pair[1]]
        if len(left) * len(right) > _PAIRS:
            more = large[pair] = _equal_subtrees(a, b, left, right)
        else:
            more = [(i, j) for i in left for j in right if a.labels[i] == b.labels[j]]
        for below in more:
            if below not in seen:
                seen.add(below)
                order.append(below)
    weight: dict[tuple[int, int], int] = {}
    steps: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for pair in reversed(order):
        if pair in large:
            chosen = large[pair]
        else:
            left, right = a.children[pair[0]], b.children[pair[1]]
            best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
            for x, i in enumerate(left):
                for y, j in enumerate(right):
                    with_both = best[x][y] + weight.get((i, j), 0)
                    best[x + 1][y + 1] = max(with_both, best[x][y + 1], best[x + 1][y])
            chosen, x, y = [], len(left), len(right)
            while x and y:
                if best[x][y] == best[x - 1][y]:
                    x -= 1
                elif best[x][y] == best[x][y - 1]:
                    y -= 1
                else:
                    x, y = x - 1, y - 1
                    chosen.append((left[x], right[y]))
        weight[pair] = 1 + sum(weight[p] for p in chosen)
        steps[pair] = chosen
    matched, todo = {0: 0}, [(0, 0)]
    while todo:
        for below in steps[todo.pop()]:
            matched[below[0]] = below[1]
            todo.append(below)
    return matched


@functools.lru_cache(maxsize=64)
def _shape(text: str) -> Shape:
    return Shape(text)


@functools.lru_cache(maxsize=_CACHED)
def slots(shape: str, reference: str) -> list[int]:
    """The slot of each node of a page: its partner's number, or a number made of its path if it has none."""
    page = _shape(shape)
    if shape == reference:
        return list(range(len(page.labels)))
    matched = simple_tree_matching(page, _shape(reference))
    paths: list[bytes] = []
    found = []
    for i, label in enumerate(page.labels):
        above = paths[page.parents[i]] if i else b""
        paths.append(hashlib.blake2b(above + b"/" + label.encode(), digest_size=8).digest())
        partner = matched.get(i)
        found.append(_UNMATCHED | int.from_bytes(paths[i], "big") >> 2 if partner is None else partner)
    return found


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


_BLOCKS = T.ArrayType(
    T.StructType(
        [
            T.StructField("node", T.IntegerType()),
            T.StructField("text", T.LongType()),
            T.StructField("chars", T.LongType()),
            T.StructField("linked", T.LongType()),
        ]
    )
)
_BLOCK_TYPE = pa.list_(
    pa.struct([("node", pa.int32()), ("text", pa.int64()), ("chars", pa.int64()), ("linked", pa.int64())])
)


def _described(pages: DataFrame) -> DataFrame:
    """(host, content, shape, blocks): pages without their texts, of which hashes are left."""
    fields = [
        T.StructField("shape", T.StringType()),
        T.StructField("content", T.LongType()),
        T.StructField("blocks", _BLOCKS),
    ]

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [parse(page) for page in _column(batch, "html")]
        blocks = []
        for page in found:
            rows = zip(page.nodes, map(_hash, page.texts), map(len, page.texts), page.linked)
            blocks.append([{"node": n, "text": h, "chars": c, "linked": x} for n, h, c, x in rows])
        content = [_hash("\n".join(str(b["text"]) for b in each)) for each in blocks]
        return [pa.array([p.shape for p in found], pa.string()), pa.array(content, pa.int64()), pa.array(blocks, _BLOCK_TYPE)]

    return add_columns(pages, fields, compute).select("host", "content", "shape", "blocks")


def _placed(described: DataFrame) -> DataFrame:
    """(host, pages, slot, text, chars, linked): each different block of each page in its slot."""
    placed = T.StructType(
        [
            T.StructField("slot", T.LongType()),
            T.StructField("text", T.LongType()),
            T.StructField("chars", T.LongType()),
            T.StructField("linked", T.LongType()),
        ]
    )
    kind = pa.list_(pa.struct([("slot", pa.int64()), ("text", pa.int64()), ("chars", pa.int64()), ("linked", pa.int64())]))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        out = []
        for shape, reference, blocks in zip(_column(batch, "shape"), _column(batch, "reference"), _column(batch, "blocks")):
            at = slots(shape, reference)
            different = {(at[b["node"]], b["text"]): (b["chars"], b["linked"]) for b in blocks}
            out.append([{"slot": s, "text": t, "chars": c, "linked": x} for (s, t), (c, x) in different.items()])
        return [pa.array(out, kind)]

    made = add_columns(described, [T.StructField("placed", T.ArrayType(placed))], compute)
    return made.select("host", "pages", F.explode("placed").alias("b")).select("host", "pages", "b.*")


def wrappers(pages: DataFrame, html: str = "html") -> DataFrame:
    """(host, reference, constants, menus) of each ``host`` of the pages, as a stored table; NULL and empty hosts have none.

    A host's row is as large as its template. Pages with the same blocks
    count once. Hosts of fewer than ``LEAST_PAGES`` different pages have no
    constant texts.
    """
    of_hosts = pages.where("host <> ''").select("host", F.col(html).alias("html"))
    described = materialize(_described(of_hosts), "described-pages")
    once = described.groupBy("host", "content").agg(F.min(F.struct("shape", "blocks")).alias("page"))
    once = materialize(once.select("host", "page.shape", "page.blocks"), "different-pages")
    shapes = once.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"))
    hosts = shapes.groupBy("host").agg(
        F.sum("n").alias("pages"), F.max_by("shape", F.struct("n", "shape")).alias("reference")
    )
    hosts = materialize(hosts, "hosts")
    placed = _placed(lookup_join(once, hosts, ["host"], "inner"))
    texts = placed.groupBy("host", "slot", "text").agg(
        F.count(F.lit(1)).alias("n"),
        F.first("pages").alias("pages"),
        F.sum("chars").alias("chars"),
        F.sum("linked").alias("linked"),
    )
    constant = (F.col("pages") >= LEAST_PAGES) & (F.col("n") >= F.col("pages") * CONSTANT_SHARE)
    in_slots = texts.groupBy("host", "slot").agg(
        F.collect_list(F.when(constant, F.col("text"))).alias("constants"),  # at most as many as a page has blocks / share
        (F.sum("linked") >= F.sum("chars") * MENU_SHARE).alias("menu"),
    )
    in_slots = in_slots.where("menu or size(constants) > 0")
    found = in_slots.groupBy("host").agg(
        F.flatten(F.collect_list(F.transform("constants", lambda t: F.struct(F.col("slot").alias("slot"), t.alias("text"))))).alias("constants"),
        F.collect_list(F.when(F.col("menu"), F.col("slot"))).alias("menus"),
    )
    return materialize(hosts.select("host", "reference").join(found, "host", "left"), "wrappers")


def main_blocks(page: Page, reference: str | None, constants: Sequence[tuple[int, int]], menus: Sequence[int]) -> list[str]:
    """The blocks of a page that belong to its main text, in order.

    Those of articles, if any are there; or else of main elements; or else of
    slots that aren't menus. Without a wrapper a slot's own links decide.
    """
    at = slots(page.shape, reference) if reference is not None else page.nodes and list(range(max(page.nodes) + 1))
    known = set(constants)
    varying = [i for i, text in enumerate(page.texts) if not known or (at[page.nodes[i]], _hash(text)) not in known]
    region = max((page.regions[i] for i in varying), default=NO_REGION)
    if region == NO_REGION:
        if reference is None:
            chars, linked = {}, {}
            for text, node, links in zip(page.texts, page.nodes, page.linked):
                chars[node] = chars.get(node, 0) + len(text)
                linked[node] = linked.get(node, 0) + links
            menus = [node for node in chars if linked[node] >= chars[node] * MENU_SHARE]
        skipped = set(menus)
        varying = [i for i in varying if at[page.nodes[i]] not in skipped]
    return [page.texts[i] for i in varying if page.regions[i] == region]


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text) of each row of ``pages``: the blocks of the main text, joined by a space.

    NULL and empty pages, and those of which nothing is left, have an empty
    text. A page whose URL is NULL or has no host is read by its own markup
    alone. Rows with the same id are read each for itself, and equal pages of
    a host count once in its wrapper. Pages are read as a whole, however long.
    An empty table gives an empty one.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host_of(F.col(url)).alias("host")
    )
    known = lookup_join(rows, wrappers(rows), ["host"])

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        columns = (_column(batch, name) for name in ("html", "reference", "constants", "menus"))
        texts = []
        for page, reference, constants, menus in zip(*columns):
            pairs = [(c["slot"], c["text"]) for c in constants or ()]
            texts.append(" ".join(main_blocks(parse(page), reference, pairs, menus or ())))
        return [pa.array(texts, pa.string())]

    return add_columns(known, [T.StructField("text", T.StringType())], compute).select("page_id", "url", "text")
