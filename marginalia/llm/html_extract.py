"""The main text of web pages, by wrappers that are induced from all pages of a host.

The trees of a host's pages are aligned by simple tree matching into one
wrapper. Its nodes know on how many pages they are, which texts stood on every
one of them (constant: the template) and how much of their text was links. A
page is then aligned with its host's wrapper: texts that vary are content,
unless their slot is by its name or its links a part of the page's furniture.

All pages count. A host of any size is learned in parts: pages of one layout are
summed up (sums and intersections, in any order), and layouts are merged in the
order of their names in buckets, and the buckets in the order of their numbers,
so that the wrapper does not depend on how the pages were dealt out.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm import html_tree as ht
from marginalia.llm.common import Memo, settled, stretches
from marginalia.llm.html_tree import preorder
from marginalia.llm.url_filter import url_parts

#: Elements that are furniture.
FURNITURE = frozenset("nav header footer aside form menu dialog select datalist option search fieldset".split())
#: Elements that hold the whole page or the article: their names describe the layout, not a part of it.
FRAMES = frozenset("page html body main article".split())

BROADCAST_BYTES = 32 << 20
STRETCH_BYTES = 4_000_000
LEARNED = "host string, bucket int, layout string, tree string"


@dataclass(frozen=True)
class Settings:
    #: A text is constant if it is on every page that has its slot, and these are at least so many.
    constant_pages: int = 5
    #: A slot is furniture if at least this share of its characters is links.
    link_share: float = 0.6
    #: Parts in which the layouts of a host are merged.
    buckets: int = 16
    #: Pages of a host that go to one task where wrappers are not broadcast.
    salt_rows: int = 2_000


class Slot:
    """A node of a wrapper."""

    __slots__ = ("label", "pages", "chars", "linked", "common", "children")

    def __init__(self, label, pages=0, chars=0, linked=0, common=(), children=()):
        self.label, self.pages, self.chars, self.linked = label, pages, chars, linked
        self.common, self.children = set(common), list(children)

    def dumped(self) -> list:
        """The nodes in preorder, each with the number of its children: trees may be deeper than JSON is read."""
        return [[x.label, x.pages, x.chars, x.linked, sorted(x.common), len(x.children)] for x in preorder(self)]


def loaded(tree: list) -> Slot:
    root, open_slots = None, []
    for *own, children in tree:
        slot = Slot(*own)
        if open_slots:
            open_slots[-1][0].children.append(slot)
        root = root or slot
        open_slots.append([slot, children])
        while open_slots and len(open_slots[-1][0].children) == open_slots[-1][1]:
            open_slots.pop()
    return root


def slot_of(shape: ht.Shape) -> Slot:
    """A page's tree as a wrapper of this one page."""
    made = {}
    for node in reversed(list(preorder(shape))):
        made[id(node)] = Slot(
            node.label, 1, sum(len(t) for _, t, _ in node.texts), sum(round(len(t) * x) for _, t, x in node.texts),
            [ht.text_hash(t) for _, t, _ in node.texts], [made[id(c)] for c in node.children],
        )
    return made[id(shape)]


def add_slot(slot: Slot, other: Slot) -> None:
    """The other's pages are pages of this slot too."""
    slot.common &= other.common
    slot.pages += other.pages
    slot.chars += other.chars
    slot.linked += other.linked


def add_alike(wrapper: Slot, other: Slot) -> Slot:
    """Two wrappers of one layout, node by node."""
    for slot, of in zip(preorder(wrapper), preorder(other)):
        add_slot(slot, of)
    return wrapper


def add_layout(wrapper: Slot, other: Slot) -> Slot:
    """Aligns the other wrapper with this one; what has no counterpart is put in at its place."""
    partner = {id(b): a for a, b in ht.matched(wrapper, other)[1]}
    for of in list(preorder(other)):
        slot = partner.get(id(of))
        if slot is None:
            continue
        add_slot(slot, of)
        merged, at = [], 0
        where = {id(c): n for n, c in enumerate(slot.children)}
        for child in of.children:
            known = partner.get(id(child))
            if known is None:
                merged.append(child)
            else:
                merged += slot.children[at : where[id(known)] + 1]
                at = where[id(known)] + 1
        slot.children = merged + slot.children[at:]
    return wrapper


def _words(label: str) -> tuple[str, list[str]]:
    name, _, words = label.rstrip("!").rstrip("]").partition("[")
    return name, words.split()


def kind_of(label: str) -> str:
    """``furniture``, ``article``, ``main``, ``named`` (by a word for main text) or ``plain``."""
    name, words = _words(label)
    if label.endswith("!"):
        return "furniture"
    if name not in FRAMES or name == "article" and "article" not in words:
        if name in FURNITURE or any(w in ht.FURNITURE_WORDS for w in words):
            return "furniture"
    if name in ("article", "main"):
        return name
    if name not in FRAMES and any(w in ht.MAIN_WORDS for w in words):
        return "named"
    return "plain"


KINDS = Memo(kind_of, 50_000)
RANKS = {"article": 3, "main": 2, "named": 1}


def main_text(shape: ht.Shape, partner: dict, settings: Settings) -> str:
    """The content of a page's tree; ``partner`` gives the wrapper's slot of each node."""
    found: list[tuple[int, str, int, bool]] = []  # (place, text, rank of the region, constant)

    around: set[int] | None = None
    stack = [(shape, 0)]
    while stack:
        node, rank = stack.pop()
        kind = KINDS[node.label]
        if kind == "furniture":
            around = _around_articles(shape) if around is None else around
            if not _may_hold_article(node) or id(node) not in around:
                continue
        rank = max(rank, RANKS.get(kind, 0))
        slot = partner.get(id(node))
        if slot is None or slot.linked < settings.link_share * slot.chars:
            constant = slot.common if slot is not None and slot.pages >= settings.constant_pages else ()
            found.extend((place, text, rank, bool(constant) and ht.text_hash(text) in constant) for place, text, _ in node.texts)
        stack.extend((child, rank) for child in node.children)
    best = max((rank for _, _, rank, _ in found), default=0)
    region = sorted(x for x in found if x[2] == best)
    varying = [x for x in region if not x[3]]
    # Where all pages of a host are copies of one another, nothing tells its article from its template.
    return "\n".join(text for _, text, _, _ in varying or (region if best else []))


def _may_hold_article(node: ht.Shape) -> bool:
    """Whether a part with a name of furniture may be wrapped around the article itself, as ``has-sidebar`` may be."""
    name, _ = _words(node.label)
    return name not in FURNITURE and not node.label.endswith("!")


def _around_articles(shape: ht.Shape) -> set[int]:
    """The nodes that have an article or a main part below them."""
    out: set[int] = set()
    for node in reversed(list(preorder(shape))):
        if any(id(c) in out or KINDS[c.label] in ("article", "main") for c in node.children):
            out.add(id(node))
    return out


def _texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def layouts(pages: DataFrame, settings: Settings) -> DataFrame:
    """``(host, bucket, layout, tree)``: each task's sum of its pages of one host and layout."""

    def run(batches):
        held: dict[tuple[str, str], Slot] = {}
        weight = 0
        for batch in batches:
            for part in stretches([batch], "html", STRETCH_BYTES):
                for host, html in zip(_texts(part, "host"), _texts(part, "html")):
                    shape = ht.shape_of(ht.parsed(html))
                    key, slot = (host, ht.skeleton(shape)), slot_of(shape)
                    known = held.get(key)
                    if known is None:
                        held[key] = slot
                        weight += sum(1 + len(s.common) for s in preorder(slot))
                    else:
                        add_alike(known, slot)
                if weight > 500_000:
                    yield from dumped(held)
                    held, weight = {}, 0
        yield from dumped(held)

    def dumped(held):
        rows = [(h, ht.text_hash(layout) % settings.buckets, layout, json.dumps(s.dumped())) for (h, layout), s in held.items()]
        for at in range(0, len(rows), 100):
            columns = zip(*rows[at : at + 100])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int32(), pa.string(), pa.string()))],
                ["host", "bucket", "layout", "tree"],
            )

    return pages.select("host", "html").mapInArrow(run, LEARNED)


def merged(parts: DataFrame, *by: str) -> DataFrame:
    """One wrapper for each value of ``by``, out of those that stream by in the order of their layouts."""
    ordered = parts.repartition(*by).sortWithinPartitions(*by, "layout")

    def run(batches):
        key = layout = total = alike = None

        def closed():
            return alike if total is None else add_layout(total, alike)

        def row():
            host, bucket = key[0], key[1] if len(key) > 1 else 0
            tree = json.dumps(closed().dumped())
            return pa.RecordBatch.from_pydict(
                {"host": pa.array([host]), "bucket": pa.array([bucket], pa.int32()), "layout": pa.array([f"{bucket:06}"]),
                 "tree": pa.array([tree])}
            )

        for batch in batches:
            for one in batch.to_pylist():
                here, slot = tuple(one[c] for c in by), loaded(json.loads(one["tree"]))
                if here != key:
                    if key is not None:
                        yield row()
                    key, layout, total, alike = here, one["layout"], None, slot
                elif one["layout"] == layout:
                    add_alike(alike, slot)
                else:
                    layout, total, alike = one["layout"], closed(), slot
        if key is not None:
            yield row()

    return ordered.mapInArrow(run, LEARNED)


def wrappers(pages: DataFrame, settings: Settings) -> DataFrame:
    """``(host, tree, pages)`` for each host."""
    learned = merged(merged(layouts(pages, settings), "host", "bucket"), "host")
    return settled(learned.select("host", "tree", F.get_json_object("tree", "$[0][1]").cast("long").alias("pages")))


def _extractor(settings: Settings) -> Callable[[str, str | None, str], str]:
    """(host, its wrapper, html) -> text; a wrapper is read and aligned once for each layout."""
    trees = Memo(lambda tree: loaded(json.loads(tree)), 2_000)
    aligned: dict[tuple[str, str], list] = {}

    def text_of(host: str, tree: str | None, html: str) -> str:
        shape = ht.shape_of(ht.parsed(html))
        if not shape.children and not shape.texts:
            return ""
        if tree is None:
            return main_text(shape, {}, settings)
        key = host, ht.skeleton(shape)
        known, nodes = aligned.get(key), list(preorder(shape))
        if known is None:
            partner = {id(a): b for a, b in ht.matched(shape, trees[tree])[1]}
            if len(aligned) >= 20_000:
                aligned.clear()
            known = aligned[key] = [partner.get(id(n)) for n in nodes]
        return main_text(shape, {id(n): s for n, s in zip(nodes, known) if s is not None}, settings)

    return text_of


def extracted(
    pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html", settings: Settings = Settings(),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(page_id, url, text, n_chars)``, a row for each page.

    The blocks of the main text are joined by one newline; references are
    decoded, and white space in a block is one space. Null and empty pages give
    the empty text; broken markup is read as far as it goes and long pages
    whole; pages of a null url or one without a host share the host ''. Rows that repeat, and
    repeated or null ids, give a row each. Other columns are not read; an empty
    table gives no row.

    Wrappers of up to ``broadcast_bytes`` in all are broadcast, so no page
    moves; otherwise pages are dealt by host, a large host to several tasks.
    """
    kind = dict(pages.dtypes)[key]
    rows = pages.select(
        F.col(key).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"),
        url_parts(F.col(url))[0].alias("host"),
    )
    learned = wrappers(rows, settings)
    schema = f"page_id {kind}, url string, text string, n_chars long"

    def result(part: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )

    size = learned.agg(F.sum(F.octet_length("tree") + F.octet_length("host"))).first()[0] or 0
    if size <= broadcast_bytes:
        known = pages.sparkSession.sparkContext.broadcast({r["host"]: r["tree"] for r in learned.collect()})

        def run(batches):
            text_of, trees = _extractor(settings), known.value
            for part in stretches(batches, "html", STRETCH_BYTES):
                yield result(part, [text_of(h, trees.get(h), x) for h, x in zip(_texts(part, "host"), _texts(part, "html"))])

        return rows.mapInArrow(run, schema)
    return _dealt(rows, learned, settings, schema, kind, result)


def _dealt(rows: DataFrame, learned: DataFrame, settings: Settings, schema: str, kind: str, result: Callable) -> DataFrame:
    """Each host's pages behind its wrapper, in as many tasks as the host's size asks for."""
    salts = F.ceil(F.col("pages") / settings.salt_rows).cast("int")
    counted = rows.join(learned.select("host", salts.alias("salts")), "host")
    salted = counted.withColumn("salt", F.pmod(F.xxhash64("html", "url"), F.col("salts")).cast("int")).drop("salts")
    heads = learned.select(
        F.lit(None).cast(kind).alias("page_id"), F.lit(None).cast("string").alias("url"), F.col("tree").alias("html"), "host",
        F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(False).alias("is_page"),
    )
    both = salted.withColumn("is_page", F.lit(True)).unionByName(heads)
    ordered = both.repartition("host", "salt").sortWithinPartitions("host", "salt", "is_page")

    def run(batches):
        text_of, tree = _extractor(settings), None
        for part in stretches(batches, "html", STRETCH_BYTES):
            texts, own = [], []
            for host, html, page in zip(_texts(part, "host"), _texts(part, "html"), part.column("is_page").to_pylist()):
                own.append(page)
                if page:
                    texts.append(text_of(host, tree, html))
                else:
                    tree = html
            yield result(part.filter(pa.array(own, pa.bool_())), texts)

    return ordered.mapInArrow(run, schema)
