"""Hard negatives: rows of another label that score nearly as high as an anchor's positives.

Scores are integer inner products with the anchors, a stated query set that is
read in blocks of bounded size. Every task scores its rows against a block and
keeps, for each anchor, only what may be among the first ones of a window; both
passes are exact, as the first ones of all rows are among the first ones of each
part. What is left is dealt by anchor and sorted by (anchor, descending score,
positives first, id), and a streaming iterator opens the positives' windows and
emits their negatives row by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.common import settled

#: Anchors that are held in a task at once: some tens of MB with their vectors and first rows.
BLOCK_ANCHORS = 65_536
#: Anchors and rows whose scores are in memory at once.
TILE_ANCHORS, TILE_ROWS = 256, 4096
LONGEST = (1 << 63) - 1
#: Components are held within these bounds, scores within those of a long.
HELD = 1 << 62
FOUND = "anchor_id long, id long, score long"


@dataclass(frozen=True)
class Settings:
    #: A component x counts as floor(scale * x).
    scale: int = 256
    positives: int = 5
    negatives: int = 5
    #: Negatives score between these shares, in hundredths, of the positive.
    low: int = 80
    high: int = 100


def usable(rows: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """``(id, label, vector)`` of the rows that have an id, a label and a vector of finite numbers."""
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    named = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"), broken.alias("broken"))
    return named.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND NOT broken").drop("broken")


def matrix(vectors: pa.Array, scale: int) -> np.ndarray:
    """A row of whole numbers for each vector; shorter vectors end in zeros."""
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    with np.errstate(over="ignore"):
        whole = np.floor(scale * flat)
    out[row, place] = np.clip(whole, -float(HELD), float(HELD)).astype(np.int64)
    return out


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products of all rows with all anchors, exact; beyond a long's range, its nearest end."""
    width = min(rows.shape[1], anchors.shape[1])
    rows, anchors = rows[:, :width], anchors[:, :width]
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(anchors).max(initial=0)) * width
    if most < 1 << 53:
        return (rows.astype(np.float64) @ anchors.T.astype(np.float64)).astype(np.int64)
    exact = rows.astype(object) @ anchors.T.astype(object)
    return np.clip(exact, -LONGEST, LONGEST).astype(np.int64)


def window_of(score: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The least and the highest score of a positive's negatives (a positive below 0 has none)."""
    exact = np.asarray(score).astype(object)
    return (-((-exact * settings.low) // 100)).astype(np.int64), (exact * settings.high // 100).astype(np.int64)


class Firsts:
    """The first rows, by descending score and then id, of each (anchor, window)."""

    def __init__(self, first: int):
        self.first, self.kept, self.fresh, self.size = first, None, [], 0

    def add(self, anchor: np.ndarray, window: int, ids: np.ndarray, score: np.ndarray) -> None:
        self.fresh.append((anchor, np.full(len(anchor), window), ids, score))
        self.size += len(anchor)
        if self.size > 500_000:
            self.prune()

    def prune(self) -> tuple[np.ndarray, ...]:
        parts = ([self.kept] if self.kept else []) + self.fresh
        if not parts:
            return (np.zeros(0, np.int64),) * 4
        anchor, window, ids, score = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((ids, -score, window, anchor))
        anchor, window, ids, score = (x[order] for x in (anchor, window, ids, score))
        begins = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1])))[: len(anchor)]
        rank = np.arange(len(anchor)) - np.repeat(begins, np.diff(np.append(begins, len(anchor))))
        stays = rank < self.first
        self.kept, self.fresh, self.size = tuple(x[stays] for x in (anchor, window, ids, score)), [], 0
        return self.kept


def tops(scores: np.ndarray, allowed: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of the allowed scores that are no lower than each anchor's ``first``-highest one."""
    masked = np.where(allowed, scores, -LONGEST - 1)
    if len(masked) > first:
        least = np.partition(masked, len(masked) - first, axis=0)[len(masked) - first]
        allowed = allowed & (masked >= least)
    return np.nonzero(allowed)


def scored(rows: DataFrame, block, first: int, settings: Settings) -> DataFrame:
    """``(anchor_id, id, score)``: the first rows of each part for each anchor and window of a broadcast block.

    A block without windows looks for other rows of the anchor's own label, one
    with windows for rows of other labels within them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = block.value
        found = Firsts(first)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_ROWS):
                part = batch.slice(at, TILE_ROWS)
                ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy()
                values = matrix(part.column("vector"), settings.scale)
                for begin in range(0, len(anchors["id"]), TILE_ANCHORS):
                    tile = slice(begin, begin + TILE_ANCHORS)
                    score = products(values, anchors["values"][tile])
                    same = labels[:, None] == anchors["label"][tile]
                    if anchors["windows"] is None:
                        masks = [same & (ids[:, None] != anchors["id"][tile])]
                    else:
                        low, high = (x[tile] for x in anchors["windows"])
                        masks = (~same & (score >= low[:, k]) & (score <= high[:, k]) for k in range(low.shape[1]))
                    for k, mask in enumerate(masks):
                        row, anchor = tops(score, mask, first)
                        found.add(anchors["id"][tile][anchor], k, ids[row], score[row, anchor])
        # A row may be in several windows; one that occurs more than once stays as often.
        columns = dict(zip(("anchor_id", "window", "id", "score"), found.prune()))
        each = pa.table(columns).group_by(list(columns)).aggregate([([], "count_all")])
        once = each.group_by(["anchor_id", "id", "score"]).aggregate([("count_all", "max")])
        often = np.repeat(np.arange(once.num_rows), once["count_all_max"].to_numpy())
        out = once.select(["anchor_id", "id", "score"]).take(often)
        yield from out.cast(pa.schema([(n, pa.int64()) for n in out.schema.names])).to_batches(max_chunksize=10_000)

    return rows.mapInArrow(run, FOUND)


def _windows(ids: np.ndarray, positives: list, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Bounds by (anchor, window); (1, 0), which nothing fits, where an anchor has fewer windows."""
    row = {int(i): n for n, i in enumerate(ids)}
    low, high = np.ones((len(ids), settings.positives), np.int64), np.zeros((len(ids), settings.positives), np.int64)
    taken = np.zeros(len(ids), np.int64)
    for r in positives:
        if r["score"] >= 0:
            at = row[r["anchor_id"]]
            [low[at, taken[at]]], [high[at, taken[at]]] = window_of(np.array([r["score"]]), settings)
            taken[at] += 1
    return low, high


def _in_block(rows: DataFrame, anchors: DataFrame, settings: Settings) -> DataFrame:
    """``(anchor_id, id, score, positive)`` that decide on the negatives of one block of anchors."""
    context = rows.sparkSession.sparkContext
    table = anchors.toArrow().combine_chunks()  # at most about BLOCK_ANCHORS rows
    block = {
        "id": table["id"].to_numpy(), "label": table["label"].to_numpy(), "windows": None,
        "values": matrix(pa.concat_arrays(table["vector"].chunks) if table.num_rows else pa.array([], pa.list_(pa.float64())), settings.scale),
    }
    own = scored(rows, context.broadcast(block), settings.positives, settings)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    ranked = own.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= settings.positives)
    positives = settled(ranked.select("anchor_id", "id", "score"))
    bounds = _windows(block["id"], positives.collect(), settings)
    others = scored(rows, context.broadcast({**block, "windows": bounds}), settings.negatives, settings)
    return positives.withColumn("positive", F.lit(True)).unionByName(others.withColumn("positive", F.lit(False)))


def emitted(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[tuple]:
    """(anchor, positive, rank, negative, positive's score, negative's score) from rows sorted by
    (anchor, descending score, positives first, id). Held: the open windows of one anchor."""
    anchor, windows = None, []
    for batch in batches:
        for of, row, score, positive in zip(*(batch.column(x).to_pylist() for x in ("anchor_id", "id", "score", "positive"))):
            if of != anchor:
                anchor, windows = of, []
            if positive:
                if score >= 0:
                    [low], [high] = window_of(np.array([score]), settings)
                    windows.append([row, score, low, high, 0])
                continue
            for window in windows:
                if window[2] <= score <= window[3] and window[4] < settings.negatives:
                    window[4] += 1
                    yield anchor, window[0], window[4], row, window[1], score


def mined(
    rows: DataFrame, anchor: Column, *, key: str = "vec_id", label: str = "label", vector: str = "embedding",
    settings: Settings = Settings(),
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchor`` tells, from the key column, which rows are anchors. An anchor's positives are its first rows of the same label and
    another id, by descending score and then id; a positive's negatives are the
    first rows of other labels that score from ``low`` to ``high`` hundredths of
    it. Ids and labels are whole numbers.

    Rows with a null id, label or vector, or a component that is null or not
    finite, take no part. A shorter or empty vector ends in zeros. Equal scores
    go by id; rows that repeat an id are listed each, and of several anchors with one id the one
    of the smallest label and vector counts. Other columns are not read; an
    empty table gives no row, as does an anchor without positives or negatives.
    """
    if not 0 <= settings.low <= settings.high <= 100:
        raise ValueError("a negative may not score more than its positive")
    named = usable(rows, key, label, vector)
    heads = usable(rows.filter(anchor), key, label, vector)
    heads = settled(heads.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("x")).select("id", "x.label", "x.vector"))
    blocks = max(1, -(-heads.count() // BLOCK_ANCHORS))
    parts = [_in_block(named, heads.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == n), settings) for n in range(blocks)]
    dealt = reduce(DataFrame.unionByName, parts).repartition("anchor_id")
    ordered = dealt.sortWithinPartitions("anchor_id", F.desc("score"), F.desc("positive"), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        held: list[tuple] = []

        def packed(some: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*some), kinds)], NAMES)

        for one in emitted(batches, settings):
            held.append(one)
            if len(held) == 10_000:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    return ordered.mapInArrow(run, RESULT)


NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
