"""Jaccard self-join of word shingle sets by PartEnum signatures, and its connected components.

PartEnum (Arasu, Ganti and Kaushik, VLDB 2006). Two sets whose sizes share a band and
whose Jaccard similarity is at least t differ in at most k elements. The domain is
dealt by hash into ``n1`` parts, of which at most k / (k2 + 1) hold more than ``k2``
of those elements. Each part is dealt into ``n2`` cells; for each choice of ``k2``
cells to leave out, a set has one signature: a hash of its elements in the others. So
in each of the remaining parts similar sets share a signature.

A band is stretched upwards by what a set of it can be similar to, so a set signs for its
own band and, if it is small enough, for the one below.

A signature without elements would be shared by many unlike sets. ``n1`` is larger than it
need be, so that similar sets share several signatures for certain; a set of which fewer
than that have no elements leaves these out, and still shares another one with each similar
set. Sets with more of them sign for all, apart, as only such a pair needs those.

As similar sets share several signatures, each may leave out all but one of those that it
shares for certain. Those that join the most pairs are left out, such as of a passage
that many documents hold; sets that share m of their signatures share one without the
m - 1 last of each in any one order.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from math import ceil, comb, floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.common import Memo, narrowed, released, settled, small_batches, stretches, word_hash

SHINGLE_WORDS = 5
STRETCH_BYTES = 1_000_000
SKETCH_BITS = 2048
SPARE_BITS = 20
#: The sketch folded to four numbers of 64 bits, which travel with a signature.
FOLDED = ("f0", "f1", "f2", "f3")
#: A signature's rows are paired directly if at most so many pairs within components come on one between them.
INNER_PAIRS = 4
#: A signature's open pairs beyond so many are told apart by a second, independent set of signatures first.
OPEN_PAIRS = 2_000


@dataclass(frozen=True)
class Similarity:
    """At least ``percent`` of the union is common. Sizes of one band differ by less than ``width`` times.

    A band is at least as wide as similar sets differ in size, so these are in one band or in neighbours.
    """

    percent: int = 80
    width: float = 1.3

    def __post_init__(self):
        if self.width * self.percent < 100:
            raise ValueError(f"bands of width {self.width} are narrower than {100 / self.percent}")

    def bottom(self, band: int) -> int:
        """The smallest size in a band."""
        return ceil(self.width**band - 1e-9)

    def bands(self, size: int) -> list[int]:
        """The size's own band, and the one below if a similar set can be in it."""
        own = floor(log(size) / log(self.width) + 1e-9)
        own += (self.bottom(own + 1) <= size) - (self.bottom(own) > size)
        return [own, own - 1] if own and self.percent * size <= 100 * (self.bottom(own) - 1) else [own]

    def differing(self, band: int) -> int:
        """How many elements two similar sets, the smaller one of this band, differ in at most."""
        small = self.bottom(band + 1) - 1
        return (small + 100 * small // self.percent) * (100 - self.percent) // (100 + self.percent)


@lru_cache(None)
def layout(k: int) -> tuple[int, int, int, np.ndarray]:
    """(n1, n2, sure, kept cells by choice) for sets that differ in at most ``k`` elements.

    ``sure`` is how many signatures such sets share at least. Small sets have one
    part, so that signatures still cover several elements.
    """
    if k <= 5:
        k2, n2 = k, (1, 4, 5, 6, 8, 9)[k]
    else:
        k2, n2 = 1, 2 + (k <= 20)
    least = k // (k2 + 1) + 1
    n1 = least + (least + 7) // 8 if least > 1 else 1
    # The d-th differing cell of a part spoils as many signatures; the first ones of all parts spoil most.
    kept = n2 - k2
    spoiled = sorted((comb(n2 - d, kept - 1) for d in range(1, n2 + 1) for _ in range(n1)), reverse=True)
    choices = [[cell not in out for cell in range(n2)] for out in combinations(range(n2), k2)]
    return n1, n2, n1 * comb(n2, k2) - sum(spoiled[:k]), np.array(choices, np.int64).T


_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(words: list[bytes], known: Memo) -> np.ndarray:
    """Sorted distinct hashes of runs of five words; fewer words are one run, none have none."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.int64, len(words)).view(np.uint64)
    width = min(SHINGLE_WORDS, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for at in range(width):
        total = mixed(total * _ODD + hashes[at : at + len(total)])
    return np.unique(total)


def signatures(elements: np.ndarray, similarity: Similarity, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of a set for the bands it signs for, and each one's band and how many of that band it can spare.

    These two are one number, ``band << SPARE_BITS | spare``.
    """
    out, codes = [], []
    spread = mixed(elements + np.uint64(seed) * np.uint64(0xD6E8FEB86659FD93))
    value = mixed(spread ^ _ODD)
    part_of, cell_of = spread >> np.uint64(34), spread & np.uint64(0x3FFFFFFF)
    for band in similarity.bands(len(elements)):
        n1, n2, sure, kept = layout(similarity.differing(band))
        # Numbers of 30 bits, scaled to the parts and to their cells.
        part, cell = (part_of * np.uint64(n1)) >> np.uint64(30), (cell_of * np.uint64(n2)) >> np.uint64(30)
        at = (part * np.uint64(n2) + cell).astype(np.int64)
        cells = np.zeros(n1 * n2, np.uint64)
        np.add.at(cells, at, value)
        sums = cells.reshape(n1, n2) @ kept.astype(np.uint64)
        counts = np.bincount(at, minlength=n1 * n2).reshape(n1, n2) @ kept
        full = counts > 0
        place = np.arange(sums.size, dtype=np.uint64).reshape(sums.shape) + np.uint64(band << 40) + np.uint64(seed << 56)
        signed = mixed(sums + mixed(place))
        empty = int((~full).sum())
        out.append(signed[full])
        if empty >= sure:
            out.append(mixed(signed[~full] + _ODD))
        spare = min(max(sure - empty - 1, 0), (1 << SPARE_BITS) - 1)
        codes.append(np.full(signed.size if empty >= sure else signed.size - empty, band << SPARE_BITS | spare, np.int32))
    return np.concatenate(out).view(np.int64), np.concatenate(codes)


def sketch(elements: np.ndarray) -> bytes:
    """For each of ``SKETCH_BITS`` cells, whether an odd number of elements falls into it."""
    cells = (mixed(elements) % np.uint64(SKETCH_BITS)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=SKETCH_BITS) & 1).astype(bool)).tobytes()


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have ``percent`` of their union in common, in whole numbers."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def could_be_similar(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets with these rows of bits and sums of sizes can be similar.

    Each bit that differs takes an element that only one of the sets has, so the
    sets differ in at least as many elements as bits.
    """
    differing = np.bitwise_count(a ^ b).sum(1, dtype=np.int64)
    common = (sizes - differing) // 2
    return 100 * common >= percent * (sizes - common)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``(id, elements)`` of ``(id, text)``: the whole text's set, as numbers of 64 bits; texts without words are left out."""

    def run(batches):
        known = Memo(word_hash)
        for batch in stretches(batches, "text", STRETCH_BYTES):
            sets = [shingles((x or b"").lower().split(), known) for x in batch.column("text").to_pylist()]
            some = pa.array([len(x) > 0 for x in sets], pa.bool_())
            found = pa.array([x.tobytes() for x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), found], ["id", "elements"]).filter(some)

    return docs.mapInArrow(released(run), f"id {dict(docs.dtypes)['id']}, elements binary")


def described(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """``(id, n_shingles, hash, sketch, f0, f1, f2, f3, sigs, codes)`` of each row of ``(id, text)``; the hash names the set.

    A task signs for equal sets once: the others have no signatures and find their group by the hash.
    """

    def run(batches):
        from xxhash import xxh3_128_digest

        known, seen = Memo(word_hash), set()
        none = np.zeros(0, np.int64), np.zeros(0, np.int32)
        for batch in stretches(batches, "text", STRETCH_BYTES):
            sets = [shingles((x or b"").lower().split(), known) for x in batch.column("text").to_pylist()]
            names = [xxh3_128_digest(x) for x in sets]
            signs = []
            for name, elements, key in zip(names, sets, batch.column("id").is_valid().to_pylist()):
                new = key and len(elements) > 0 and name not in seen
                signs.append(signatures(elements, similarity) if new else none)
                if new:
                    seen.add(name)
            sketches = [sketch(x) for x in sets]
            folded = np.bitwise_xor.reduce(np.frombuffer(b"".join(sketches), np.int64).reshape(len(sets), -1, len(FOLDED)), 1)
            starts = pa.array(np.cumsum([0, *(len(x) for x, _ in signs)]), pa.int32())
            columns = (
                pa.array([len(x) for x in sets], pa.int64()), pa.array(names, pa.binary()),
                pa.array(sketches, pa.binary()), *(pa.array(x) for x in folded.T.copy()),
                *(pa.ListArray.from_arrays(starts, pa.array(np.concatenate(x))) for x in zip(*signs)),
            )
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], list(names_of))

    names_of = ("id", "n_shingles", "hash", "sketch", *FOLDED, "sigs", "codes")
    kinds = (dict(docs.dtypes)["id"], "long", "binary", "binary", *["long"] * len(FOLDED), "array<long>", "array<int>")
    return docs.mapInArrow(released(run), ", ".join(f"{name} {kind}" for name, kind in zip(names_of, kinds)))


def signed(sets: DataFrame, similarity: Similarity, seed: int = 0) -> DataFrame:
    """``(id, sig)`` of each row of ``(id, elements)``; a task signs for equal sets once.

    The left out ones are rows of the same hash, which find their group by it.
    """

    def run(batches):
        from xxhash import xxh3_128_digest

        seen = set()
        for batch in stretches(batches, "elements", STRETCH_BYTES):
            at, found = [], []
            for row, body in enumerate(batch.column("elements").to_pylist()):
                name = xxh3_128_digest(body)
                if name not in seen:
                    seen.add(name)
                    found.append(signatures(np.frombuffer(body, np.uint64), similarity, seed)[0])
                    at.append(np.full(len(found[-1]), row))
            if found:
                ids = batch.column("id").take(pa.array(np.concatenate(at)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(found))], ["id", "sig"])

    return sets.select("id", "elements").mapInArrow(released(run), f"id {dict(sets.dtypes)['id']}, sig long")


def shared(sigs: DataFrame) -> DataFrame:
    """``(sig, id, code, low)`` of the signatures that several rows have, with the smallest id of each.

    Rows are dealt by signature and sorted by signature and id, and each task
    streams through them with a row in hand. A group of documents, whatever its
    size, is spread over as many signatures as its documents have.
    """
    kind = dict(sigs.dtypes)["id"]

    def run(batches):
        names, held = ["sig", "id", "code", "low"], None  # the last row, and whether its run goes back
        for batch in batches:
            rows = [batch.column(x).to_numpy() for x in names[:3]]
            if held is not None:
                rows = [np.concatenate([[x], column]) for x, column in zip(held, rows)]
            sig, ids, _ = rows
            back = held is not None and held[4]
            again = np.concatenate([[back], sig[1:] == sig[:-1]])
            start = np.maximum.accumulate(np.where(again, 0, np.arange(len(sig))))
            low = ids[start]
            if back:
                low[start == 0] = held[3]
            out = np.flatnonzero(again[:-1] | again[1:])
            yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (*rows, low)], names)
            held = (*(x[-1] for x in rows), low[-1], bool(again[-1]))
        if held is not None and held[4]:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in held[:4]], names)

    rows = sigs.repartition("sig").sortWithinPartitions("sig", "id")
    return rows.mapInArrow(released(run), f"sig long, id {kind}, code int, low {kind}")


def without_spared(placed: DataFrame) -> DataFrame:
    """The rows of ``(sig, id, code, root, open)`` without those that each set of a band can spare, of the most open pairs.

    Where an id has several texts in a band, it spares as many as the one that can spare least.
    """
    of_set = Window.partitionBy("id", F.shiftright("code", SPARE_BITS))
    spare = F.col("code").bitwiseAND((1 << SPARE_BITS) - 1)
    numbered = placed.withColumn("nth", F.row_number().over(of_set.orderBy(F.desc("open"), "sig")))
    return numbered.withColumn("spare", F.min(spare).over(of_set)).filter("nth > spare").drop("nth", "spare")


def still_open(placed: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, open, inner)``: signatures that hold several components, with the numbers of pairs between and within them."""
    held = placed.groupBy(*keys, "root").agg(F.count("*").alias("n"))
    return held.groupBy(*keys).agg(
        F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("inner"), F.count("*").alias("roots")
    ).filter("roots > 1").select(*keys, ((F.col("all") * F.col("all") - F.col("inner")) / 2).alias("open"), "inner")


def verified(pairs: DataFrame, docs: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """The distinct ``(a, b)`` of similar sets.

    Sketches, which move first, leave few pairs of unlike sets; then only the texts
    of what is left move, and sets are compared whole.
    """
    kind = dict(pairs.dtypes)["a"]

    def can_be(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SKETCH_BITS // 8) for c in ("left", "right"))
            yield batch.select(["a", "b", "equal"]).filter(pa.array(could_be_similar(a, b, batch.column("sizes").to_numpy(), percent)))

    def are(batches):
        known, held, center = Memo(word_hash), None, None
        for batch in batches:
            keep = []
            for name, left, right in zip(*(batch.column(c).to_pylist() for c in ("a", "left", "right"))):
                if held != (name, left):
                    held, center = (name, left), shingles(left.lower().split(), known)
                keep.append(similar(center, shingles(right.lower().split(), known), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = (
        about.select(F.col("id").alias(x), F.col("sketch").alias(side), F.col("n_shingles").alias(f"n_{x}"), F.col("hash").alias(f"hash_{x}"))
        for x, side in (("a", "left"), ("b", "right"))
    )
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    counted = pairs.select("a", "b").distinct().join(left, "a").join(right, "b").filter(fits).select(
        "a", "b", "left", "right", (F.col("n_a") + F.col("n_b")).alias("sizes"), (F.col("hash_a") == F.col("hash_b")).alias("equal")
    )
    likely = settled(counted.mapInArrow(released(can_be), f"a {kind}, b {kind}, equal boolean").distinct())
    equal, other = likely.filter("equal").select("a", "b"), likely.filter("NOT equal").select("a", "b")
    first, second = settled(other.select("a").distinct()), settled(other.select("b").distinct())
    lefts = narrowed(docs.withColumnRenamed("id", "a"), first, "a").select("a", F.col("text").alias("left"))
    rights = narrowed(docs.withColumnRenamed("id", "b"), second, "b").select("b", F.col("text").alias("right"))
    both = other.join(rights, "b").join(lefts, "a").select("a", "b", "left", "right")
    return both.mapInArrow(released(are), f"a {kind}, b {kind}").unionByName(equal).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(id, root)`` of every id of ``links`` ``(a, b)``: the smallest id it is connected with.

    Alternating large-star and small-star steps (Kiveris et al., SoCC 2014): each
    step links ids to the smallest id next to them, until nothing changes. A hub
    is never one group: the smallest neighbour is a partial minimum.
    """
    edges = settled(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select("a", F.col("m").alias("b")).unionByName(
            small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        after = settled(small)
        # Every id hangs on one smaller id that hangs on none: nothing is left to do.
        roots = after.select(F.col("b").alias("a")).distinct()
        if after.join(roots, "a", "left_semi").isEmpty() and after.groupBy("a").count().filter("count > 1").isEmpty():
            break
        edges = after
    return after.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(
        after.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
    )


def paired(rows: DataFrame, about: DataFrame, percent: int, *keys: str) -> DataFrame:
    """The pairs ``(a, b)`` of different components of ``(*keys, id, root)`` with equal keys that sizes and folded sketches allow.

    Folding keeps the parity of cells, so the bits that differ still count no more than the elements that do.
    """
    held = rows.select(*keys, "id", "root").join(about.select("id", "n_shingles", *FOLDED), "id")
    one, two = (held.select(*keys, *(F.col(c).alias(f"{c}_{side}") for c in held.columns if c not in keys)) for side in "xy")
    n_x, n_y = F.col("n_shingles_x"), F.col("n_shingles_y")
    differing = sum((F.bit_count(F.col(f"{f}_x").bitwiseXOR(F.col(f"{f}_y"))) for f in FOLDED), F.lit(0))
    fits = (
        (F.col("root_x") < F.col("root_y")) & (F.least(n_x, n_y) * 100 >= F.greatest(n_x, n_y) * percent)
        & ((n_x + n_y - differing) * 100 >= (n_x + n_y + differing) * percent)
    )
    return one.join(two, list(keys)).filter(fits).select(
        F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")
    ).filter("a < b")


def links(docs: DataFrame, about: DataFrame, similarity: Similarity) -> DataFrame:
    """``(id, root)`` of the ids of ``docs`` ``(id, text)`` that are linked with another.

    First each set is compared with one other, the smallest id of most of the
    signatures it shares, and the links found are joined into components: most of a
    group of near copies, however large, is one then.
    What is left are pairs of one signature but of different components, once sets have
    left out what they can spare. Each of them is compared too, so no link is lost; where a signature has many, both
    sides must also share a signature of a second, independent deal.
    """
    percent = similarity.percent
    each = about.select("id", F.explode(F.arrays_zip("sigs", "codes")).alias("x"))
    buckets = settled(shared(each.select("id", F.col("x.sigs").alias("sig"), F.col("x.codes").alias("code"))))
    # Of the smallest ids that a set shares a signature with, the one it shares most with.
    near = buckets.filter("low < id").groupBy("low", "id").agg(F.count("*").alias("n")).groupBy("id").agg(
        F.max_by("low", F.struct("n", -F.col("low"))).alias("a")
    ).select("a", F.col("id").alias("b"))
    found = settled(verified(near, docs, about, percent))
    roots = settled(components(found))
    placed = buckets.join(roots, "id", "left").select("sig", "id", "code", F.coalesce("root", "id").alias("root"))
    kept = settled(without_spared(placed.join(still_open(placed, "sig"), "sig")).drop("open", "inner"))
    rest = settled(kept.join(still_open(kept, "sig"), "sig"))
    few, direct = F.col("open") <= OPEN_PAIRS, F.col("inner") <= INNER_PAIRS * F.col("open")
    pool = rest.filter(few & ~direct).select("sig", F.lit(0).cast("long").alias("sig2"), "id", "root")
    close = paired(rest.filter(few & direct), about, percent, "sig")
    many = rest.filter(F.col("open") > OPEN_PAIRS).select("sig", "id", "root")
    if not many.isEmpty():
        again = signed(shingle_sets(narrowed(docs, settled(many.select("id").distinct()), "id")), similarity, seed=1)
        twice = many.join(again.withColumnRenamed("sig", "sig2"), "id").select("sig", "sig2", "id", "root").distinct()
        twice = settled(twice.join(still_open(twice, "sig", "sig2"), ["sig", "sig2"]))
        pool = pool.unionByName(twice.filter(~direct).select("sig", "sig2", "id", "root"))
        close = close.unionByName(paired(twice.filter(direct), about, percent, "sig", "sig2"))
    # Components are paired first, ids only where theirs differ: a large component costs no pairs within itself.
    roots_of = pool.select("sig", "sig2", "root").distinct()
    apart = roots_of.withColumnRenamed("root", "root_a").join(
        roots_of.withColumnRenamed("root", "root_b"), ["sig", "sig2"]
    ).filter("root_a < root_b")
    one = pool.select("sig", "sig2", F.col("id").alias("x"), F.col("root").alias("root_a"))
    two = pool.select("sig", "sig2", F.col("id").alias("y"), F.col("root").alias("root_b"))
    pairs = apart.join(one, ["sig", "sig2", "root_a"]).join(two, ["sig", "sig2", "root_b"]).select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
    ).filter("a < b")
    pairs = pairs.unionByName(close).distinct()
    more = settled(verified(pairs, docs, about, percent))
    return roots if more.isEmpty() else settled(components(found.unionByName(more)))


def near_groups(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", similarity: Similarity = Similarity()
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, a row for each row of ``docs``.

    Two documents link when their sets of five-word shingles (A-Z in lower case;
    fewer words are one shingle) have at least ``percent`` of the union in common;
    a component is named by its smallest id. Null and empty texts and texts without
    words have no shingles and link with nothing, and so does a row with a null id.
    Ids are whole numbers. Rows that repeat an id are one document of several
    texts, linked by any of them. Equal sets are a group from the start.
    Other columns are not read; an empty table gives no row.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    about = settled(described(rows, similarity))
    some = about.filter("n_shingles > 0 AND id IS NOT NULL")
    roots = links(rows.filter("id IS NOT NULL AND text IS NOT NULL"), some, similarity)
    # Equal sets have one hash; ids with several texts join the groups of all of them.
    same = some.groupBy("hash").agg(F.min("id").alias("low"))
    copies = some.join(same, "hash").select(F.col("low").alias("a"), F.col("id").alias("b")).filter("a < b")
    edges = copies.unionByName(roots.select(F.col("root").alias("a"), F.col("id").alias("b")).filter("a < b"))
    names = components(edges)
    joined = about.select("id", "n_shingles").join(names, "id", "left")
    linked = F.when(F.col("n_shingles") > 0, F.col("root"))
    return joined.select(
        F.col("id").alias("doc_id"), "n_shingles", F.coalesce(linked, "id").alias("component_id")
    )
