"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Each labelled text becomes a sparse vector of hashed features; weights learn by
the per-coordinate FTRL-proximal updates (McMahan et al., KDD 2013) and a score
is the logistic function of a sparse dot product.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import Memo, released, small_batches, stretches, with_columns, with_text, word_hash

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff]")
STRETCH_BYTES = 1_000_000


@dataclass(frozen=True)
class Settings:
    #: Labelled rows that are learned from at most: those with the lowest hash of their id.
    max_rows: int = 6000
    bits: int = 18
    epochs: int = 10
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.1


def terms(word: bytes) -> tuple[int, ...]:
    """Hashes of a word's parts: runs of letters and digits, and single other bytes."""
    return tuple(word_hash(t) for t in TERM.findall(word))


def features(text: bytes, known: Memo, bits: int) -> np.ndarray:
    """Feature numbers of a text, repeated as often as they occur.

    Terms, pairs of neighbouring terms, and whether neighbours are equal. Number 0
    is in every text, so an empty text has a score as well.
    """
    flat: list[int] = []
    for word in text.split():
        flat += known[word]
    term = np.fromiter(flat, np.int64, len(flat)).view(np.uint64)
    pair = term[1:] * np.uint64(0x9E3779B97F4A7C15) + term[:-1]
    same = (term[1:] == term[:-1]).astype(np.uint64)
    shift = np.uint64(64 - bits)
    spread = np.uint64(0xD6E8FEB86659FD93)
    out = [np.zeros(1, np.int64)]
    out += [((x * spread) >> shift).astype(np.int64) for x in (term, pair)]
    return np.concatenate([*out, (same + np.uint64(1)).astype(np.int64)])


def scaled(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and their values: the square roots of counts, of length one as a vector."""
    index, count = np.unique(numbers, return_counts=True)
    return index, np.sqrt(count / len(numbers))


class Ftrl:
    """FTRL-proximal state of one model."""

    def __init__(self, settings: Settings):
        self.s = settings
        self.z = np.zeros(1 << settings.bits)
        self.n = np.zeros(1 << settings.bits)

    def weights(self, index: np.ndarray) -> np.ndarray:
        z, n, s = self.z[index], self.n[index], self.s
        moved = -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)
        return np.where(np.abs(z) <= s.l1, 0.0, moved)

    def learn(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(index)
        gradient = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
        n = self.n[index]
        self.z[index] += gradient - (np.sqrt(n + gradient**2) - np.sqrt(n)) / self.s.alpha * w
        self.n[index] = n + gradient**2


def trained(docs: DataFrame, labels: DataFrame, settings: Settings, *, key: str, text: str, label: str) -> np.ndarray:
    """Weights learned from at most ``settings.max_rows`` labelled rows.

    The rows are picked by a hash of the id among the labels alone; only their
    texts are turned into features, where they lie, and one task learns from
    them, so its work is bounded by the parameter and the texts it picks.
    """
    picked = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.max(label).alias("label"), F.min(label).alias("low")
    ).filter("label = low").orderBy(F.xxhash64("_key"), "_key").limit(settings.max_rows).select("_key", "label")
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("binary").alias("text")).join(F.broadcast(picked), "_key")

    def vectors(batches):
        known = Memo(terms)
        for batch in stretches(batches, "text", STRETCH_BYTES):
            found = [scaled(features(x or b"", known, settings.bits)) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key").cast(pa.string()), batch.column("label").cast(pa.int32()),
                 pa.array([x.astype(np.int32) for x, _ in found], pa.list_(pa.int32())),
                 pa.array([x.astype(np.float32) for _, x in found], pa.list_(pa.float32()))],
                ["_key", "label", "index", "value"],
            )

    def learn(batches):
        rows = [(k, y, i, v) for b in batches for k, y, i, v in zip(
            b.column("_key").to_pylist(), b.column("label").to_pylist(),
            (x.values.to_numpy() for x in b.column("index")), (x.values.to_numpy() for x in b.column("value")))]
        rows.sort(key=lambda r: (word_hash(r[0].encode()), r[1], len(r[2])))  # whatever order the rows came in
        model = Ftrl(settings)
        for _ in range(settings.epochs):
            for _, y, index, value in rows:
                model.learn(index, value.astype(np.float64), y)
        weights = model.weights(np.arange(1 << settings.bits)).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary())], ["weights"])

    sparse = rows.mapInArrow(released(vectors), "_key string, label int, index array<int>, value array<float>")
    # A shuffle, not coalesce: the scan and the features stay with all tasks, one task gets the bounded vectors.
    return np.frombuffer(sparse.repartition(1).mapInArrow(released(learn), "weights binary").first()["weights"], np.float32)


def scores(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
    settings: Settings = Settings(), threshold: float = 0.3, extra: tuple[Column, ...] = (), within: tuple[str, int] | None = None,
) -> DataFrame:
    """``(doc_id, *extra, score, predicted)``, a row for each row of ``docs``.

    ``labels`` has ``(key, label)`` of the rows to learn from; labels that are
    null or contradict each other are not learned from. The score depends on the
    text alone; null counts as empty. Rows may repeat. ``within`` names a struct of ``extra`` and the number of its
    field that is the text: then tasks read it there and it is not sent beside it. Without any labelled
    document all weights are 0 and each score is 0.5. Scoring is one narrow pass
    with ``2**bits`` weights in hand.
    """
    small_batches(docs.sparkSession)
    weights = docs.sparkSession.sparkContext.broadcast(
        trained(docs, labels, settings, key=key, text=text, label=label)
    )
    rows = docs.select(F.col(key).alias("doc_id"), *extra, *([] if within else [F.col(text).cast("binary").alias("__text")]))

    def run(batches):
        known, w = Memo(terms), weights.value
        for batch in stretches(with_text(batches, "__text", within), "__text", STRETCH_BYTES):
            found = []
            for body in batch.column("__text").to_pylist():
                numbers = features(body or b"", known, settings.bits)
                index, value = scaled(numbers)
                found.append(float(w[index] @ value))
            score = 1 / (1 + np.exp(-np.clip(np.array(found), -35, 35)))
            kept = batch.drop_columns(["__text"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32), pa.int32())],
                [*kept.schema.names, "score", "predicted"],
            )

    return rows.mapInArrow(released(run), with_columns(rows.drop("__text"), "score double, predicted int"))
