"""Document fingerprints by locally consistent parsing.

A text is cut into phrases at places that only the symbols around them decide:
deterministic coin tossing turns neighbouring symbols into labels of a small
alphabet, and phrases begin at local maxima of the labels. Phrases are named by
their content and are the symbols of the next level. Equal substrings so get
equal phrases but at their edges, at any offset. The fingerprint keeps, for each
of ``BINS`` parts of the name space, the smallest name that occurs (a one
permutation MinHash), so its likeness is that of the sets of phrases.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.common import settled, stretches

BINS = 64
#: Levels whose phrase names go into the fingerprint (about 10 and 30 bytes of text a phrase).
LEVELS = (2, 3)
STRETCH_BYTES = 400_000
EMPTY = 0xFFFF
_LOWEST = np.array([0, *((i & -i).bit_length() - 1 for i in range(1, 256))], np.uint8)
_ODD = np.uint64(0x9E3779B97F4A7C15)
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(64, 0xD6E8FEB86659FD93, np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def tossed(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6 of symbols of which no two neighbours are equal; ``first`` marks where a text begins.

    A label is the lowest bit in which a symbol differs from the one before, and
    its value. Labels of 64-bit symbols lie below 128, then 14, 8 and 6; those
    of bytes below 16, 8 and 6. How often it is done depends on nothing else.
    """
    if symbols.dtype == np.uint64:
        differ = symbols.copy()
        differ[1:] ^= symbols[:-1]
        differ[first] = 1
        low = (differ & (~differ + np.uint64(1))).astype(np.float64)
        bit = ((low.view(np.int64) >> 52) - 1023).astype(np.uint64)
        symbols = ((bit << np.uint64(1)) | ((symbols >> bit) & np.uint64(1))).astype(np.uint8)
    for _ in range(3):
        differ = symbols.copy()
        differ[1:] ^= symbols[:-1]
        differ[first] = 1
        bit = _LOWEST[differ]
        symbols = (bit << 1) | ((symbols >> bit) & np.uint8(1))
    return symbols


def phrases(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of each owner's symbols, and their owners."""
    change = np.empty(len(symbols), bool)
    change[:1] = True
    change[1:] = (symbols[1:] != symbols[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(change)  # a run of equal symbols counts as one, told by its length
    length = np.diff(starts, append=len(symbols)).astype(np.uint64)
    symbols, owner = symbols[starts], owner[starts]
    first = np.empty(len(symbols), bool)
    first[:1] = True
    first[1:] = owner[1:] != owner[:-1]
    labels = tossed(symbols, first)
    begin = first.copy()
    begin[1:-1] |= (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:]) & ~first[2:]
    at = np.flatnonzero(begin)
    nth = np.arange(len(symbols)) - np.repeat(at, np.diff(at, append=len(symbols)))
    content = mixed(symbols.astype(np.uint64) + length * _ODD) * _POWERS[np.minimum(nth, 63)]
    return mixed(np.add.reduceat(content, at)), owner[at]


def sketches(texts: list[bytes]) -> np.ndarray:
    """A row of ``BINS`` numbers of 16 bits for each text; ``EMPTY`` where no name falls into a bin."""
    least = np.full(len(texts) * BINS, np.iinfo(np.uint64).max, np.uint64)
    symbols = np.frombuffer(b"".join(texts), np.uint8)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    for level in range(1, max(LEVELS) + 1):
        if not len(symbols):
            break
        symbols, owner = phrases(symbols, owner)
        if level in LEVELS:
            names = mixed(symbols + np.uint64(level))
            np.minimum.at(least, owner * BINS + (names >> np.uint64(58)).astype(np.int64), names & np.uint64((1 << 58) - 1))
    short = np.minimum(mixed(least) >> np.uint64(48), np.uint64(EMPTY - 1))
    short[least == np.iinfo(np.uint64).max] = EMPTY
    return short.astype(np.uint16).reshape(len(texts), BINS)


def shown(sketch: np.ndarray) -> str:
    """A sketch as hexadecimal digits, four to a bin."""
    return sketch.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal bins of all bins that hold a name, row by row; 1 where neither side holds any."""
    some = (a != EMPTY) | (b != EMPTY)
    return np.where(some.any(1), ((a == b) & some).sum(1) / np.maximum(some.sum(1), 1), 1.0)


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)``: hexadecimal, equal for equal texts; null counts as empty. No row moves."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"))

    def run(batches):
        for batch in stretches(batches, "text", STRETCH_BYTES):
            found = sketches([x or b"" for x in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([shown(x) for x in found], pa.string())], ["doc_id", "fingerprint"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, fingerprint string")


RESULT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(texts: list[str], nexts: list[str], own: np.ndarray, after: np.ndarray) -> list[list]:
    changed = [edited(a, b).encode() for a, b in zip(texts, nexts)]
    prints = sketches(changed)
    return [
        [len(t) for t in texts], [sha256(t).hexdigest() for t in changed],
        [shown(x) for x in own], [shown(x) for x in prints],
        likeness(own, prints).tolist(), likeness(own, after).tolist(),
    ]


def edit_likeness(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` of each row.

    The next document is the next row by id, then text (null id and null text
    first), and the first row after the last one. Rows are range-partitioned by
    id and sorted, so they move once, and each task streams through its range
    with one row in hand. A range's last row meets the first row of the next
    range in a second pass over those edges alone, two rows a task.
    A single document is its own next one; an empty table gives no row.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches):
        from pyspark import TaskContext

        part, held = TaskContext.get().partitionId(), None
        fields = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "part", "edge", "text"]
        id_type = None

        def batch_of(ids, columns, parts, edges, texts):
            kinds = [pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            arrays = [pa.array(ids, id_type), *map(pa.array, columns, kinds)]
            arrays += [pa.array(parts, pa.int32()), pa.array(edges, pa.string()), pa.array(texts, pa.string())]
            return pa.RecordBatch.from_arrays(arrays, fields)

        def edge(which, doc_id, body, own):
            return batch_of([doc_id], [[len(body)], [None], [shown(own[0])], [None], [None], [None]], [part], [which], [body])

        for batch in stretches(batches, "text", STRETCH_BYTES):
            id_type = batch.schema.field("doc_id").type
            ids = batch.column("doc_id").to_pylist()
            bodies = [x or "" for x in batch.column("text").to_pylist()]
            own = sketches([x.encode() for x in bodies])
            if held is None:
                yield edge("head", ids[0], bodies[0], own[:1])
            else:
                ids, bodies, own = [held[0], *ids], [held[1], *bodies], np.concatenate([held[2], own])
            if len(ids) > 1:
                n = len(ids) - 1
                columns = _compared(bodies[:-1], bodies[1:], own[:-1], own[1:])
                yield batch_of(ids[:-1], columns, [part] * n, [None] * n, [None] * n)
            held = (ids[-1], bodies[-1], own[-1:])
        if held is not None:
            yield edge("tail", *held)

    found = settled(rows.mapInArrow(run, f"doc_id {kind}, {RESULT}, part int, edge string, text string"))
    inner = found.filter("edge IS NULL").drop("part", "edge", "text")
    heads = found.filter("edge = 'head'").select("part", "text", "fingerprint")
    tails = found.filter("edge = 'tail'").select("part", "doc_id", "text", "fingerprint")
    # As many rows as tasks: which range follows which.
    order = Window.orderBy("part")
    ranges = heads.select("part", F.lead("part").over(order).alias("next"), F.min("part").over(Window.partitionBy()).alias("lowest"))
    ranges = ranges.select("part", F.coalesce("next", "lowest").alias("next"))
    nexts = heads.select(F.col("part").alias("next"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    pairs = tails.join(ranges, "part").join(nexts, "next").drop("part", "next")

    def close(batches):
        for batch in batches:
            texts, following = ([x or "" for x in batch.column(c).to_pylist()] for c in ("text", "next_text"))
            own, after = (
                np.array([np.frombuffer(bytes.fromhex(x), ">u2") for x in batch.column(c).to_pylist()]).reshape(-1, BINS)
                for c in ("fingerprint", "next_print")
            )
            kinds = [pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            names = [x.split()[0] for x in RESULT.split(", ")]
            arrays = map(pa.array, _compared(texts, following, own, after), kinds)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *names])

    return inner.unionByName(pairs.mapInArrow(close, f"doc_id {kind}, {RESULT}"))
