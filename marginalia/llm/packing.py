"""Best-fit packing of token sequences into bins of equal capacity.

Only a length's count matters for which lengths share a bin, so the packing is
planned on the histogram of lengths, which has at most ``capacity`` rows however
many documents there are. The plan is then looked up by each piece's rank among
the pieces of its length.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marginalia.llm.bpe import id_bytes
from marginalia.llm.common import gathered, released, settled, small_batches, stretches

CAPACITY = 2048
END_ID = 0
PIECE = "piece int, start long, length long, ids_crc32 long"
#: Chunks that the library encodes in one call.
JOINED_CHUNKS = 2000
#: Text whose distinct chunks are encoded together.
ENCODED_BYTES = 16_000_000
#: A line of chunks that may be cut or joined otherwise than at its line breaks: further white space, special tokens.
LOOSE = re.compile(r"[^\S\n]|[\x00-\x09\x0b-\x1f\x7f\u180e\u200b\u2060\ufeff]|<\|")


class ChunkIds:
    """Token ids of chunks by the library, of many chunks in one call.

    The vocabulary splits at blanks, and no merge crosses a blank, so the ids of
    chunks joined by line breaks are those of each in order. Which are whose is
    read off the bytes that the tokens stand for.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.normalizer, self.plain = self.library.normalizer, False
        suffix, vocab = self.library.model.end_of_word_suffix or "", self.library.get_vocab()
        # In a byte-level vocabulary each character of a token stands for a byte.
        self.size = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.size[i] = len(token.removesuffix(suffix))

    def ids(self, chunks: Iterable[bytes]) -> dict[bytes, bytes]:
        """The ids of chunks, as little-endian unsigned numbers of 32 bits."""
        chunks = list(chunks)
        ids, first, count = self.table(pa.array(chunks, pa.binary()).cast(pa.string()))
        return {x: ids[y : y + n].tobytes() for x, y, n in zip(chunks, first, count)}

    def _encoded(self, texts: list[str], plain: bool = False) -> list[list[int]]:
        """The library's ids; plain texts, of lower case and ASCII without blanks but line breaks, are not normalised, which changes none."""
        if plain != self.plain:
            self.library.normalizer, self.plain = None if plain else self.normalizer, plain
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _told_apart(self, text: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of chunks joined by line breaks, and how many there are up to each one's end; none if that is not certain."""
        if LOOSE.search(text):
            return None
        plain = text.isascii()
        if plain:
            text = text.lower()
        else:
            normal = [len(x.encode()) for x in self.normalizer.normalize_str(text).split(" ")]
            if len(normal) != len(sizes):
                return None
            sizes = np.array(normal)
        ids = np.array(self._encoded([text], plain)[0], "<u4")
        bytes_until, ends = np.cumsum(self.size[ids]), np.cumsum(sizes)
        at = np.searchsorted(bytes_until, ends)
        if len(ids) == 0 or bytes_until[-1] != ends[-1] or (bytes_until[at] != ends).any():
            return None
        return ids, at + 1

    def table(self, chunks: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, first, count)`` of chunks: where each one's ids begin, and how many it has, none if it is empty."""
        sizes, plain = pc.binary_length(chunks).to_numpy(), pc.string_is_ascii(chunks).to_numpy(zero_copy_only=False)
        count, flat, order = np.zeros(len(chunks), np.int64), [], []
        for alike in (np.flatnonzero(plain & (sizes > 0)), np.flatnonzero(~plain)):
            for at in range(0, len(alike), JOINED_CHUNKS):
                some = alike[at : at + JOINED_CHUNKS]
                own = chunks.take(pa.array(some))
                text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), own), "\n")[0].as_py()
                found = self._told_apart(text, sizes[some])
                if found is None:
                    each = [np.array(x, "<u4") for x in self._encoded(own.to_pylist())]
                    found = np.concatenate(each), np.cumsum([len(x) for x in each])
                flat.append(found[0])
                order.append(some)
                count[some] = np.diff(found[1], prepend=0)
        places, first = np.concatenate([np.zeros(0, np.int64), *order]), np.zeros(len(chunks), np.int64)
        first[places] = np.cumsum(count[places]) - count[places]
        return np.concatenate([np.zeros(0, "<u4"), *flat]), first, count


@lru_cache(1)
def opened(path: str) -> ChunkIds:
    """The vocabulary of a worker, which its next tasks go on with."""
    found = ChunkIds(path)
    gc.freeze()  # the vocabulary's tables are many objects and never garbage
    return found


def row_ids(path: str, batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each stretch of rows with the ids of each row's whole text, which are those of its chunks between ``[\\x20\\x09-\\x0D]``.

    The chunks of a stretch are numbered, and each distinct one is encoded once.
    """
    encoder = opened(path)
    for batch in stretches(gathered(batches, text, ENCODED_BYTES), text, 2 * ENCODED_BYTES):
        texts = pc.fill_null(batch.column(text).cast(pa.string()), "")
        # The vocabulary is of lower case; special tokens are not.
        plain = pc.and_not(pc.string_is_ascii(texts), pc.match_substring(texts, "<|"))
        rows = pc.ascii_split_whitespace(pc.if_else(plain, pc.ascii_lower(texts), texts))
        chunks = rows.flatten().dictionary_encode()
        ids, first, count = encoder.table(chunks.dictionary)
        of = chunks.indices.to_numpy()
        each = count[of]
        ends = np.cumsum(each)
        # Where a chunk's ids are, less where they go, is one number for all of them.
        away = np.repeat((first[of] - ends + each).astype(np.int32), each)
        found = ids[away + np.arange(len(away), dtype=np.int32)].tobytes()
        until = np.concatenate([[0], np.cumsum(rows.value_lengths().to_numpy())])
        places = (4 * np.concatenate([[0], ends])[until]).tolist()
        yield batch, [found[x:y] for x, y in zip(places, places[1:])]


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bins as ``(lengths, how often)`` that hold every item of a histogram of lengths.

    A bin is filled greedily, the longest item that fits first. Then its shortest
    item gives way to two unpacked items, if two fit into its place and the gap
    more tightly than it does. The same choice holds as long as no length in it
    runs out, so a bin is repeated that often at once: the number of different
    bins depends on the capacity, not on the number of items.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not within 1 and {capacity}")
        left[length] = count
    at = np.arange(capacity + 1)
    bins = []
    while left.any():
        chosen, gap, free = [], capacity, left.copy()
        while True:
            fits = np.flatnonzero(free[: gap + 1])
            if not len(fits):
                break
            length = int(fits[-1])
            often = min(gap // length, int(free[length]))
            chosen += [length] * often
            free[length] -= often
            gap -= length * often
        if gap:
            shortest = chosen[-1]
            room = gap + shortest
            free[shortest] += 1
            # below[x]: the longest unpacked length of at most x.
            below = np.maximum.accumulate(np.where(free > 0, at, 0))
            first = np.flatnonzero(free[: room + 1])
            second = below[room - first]
            twice = (second == first) & (free[first] < 2)
            second = np.where(twice, below[np.maximum(first - 1, 0)], second)
            total = np.where(second > 0, first + second, 0)
            best = int(total.argmax())
            if total[best] > shortest:
                chosen[-1:] = sorted((int(first[best]), int(second[best])), reverse=True)
        lengths, need = np.unique(chosen, return_counts=True)
        often = int((left[lengths] // need).min())
        left[lengths] -= need * often
        bins.append((chosen, often))
    return bins


def slots(bins: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first rank, first bin and offset of each run of its items, by rank.

    The items of ranks r, r+1, ... of a run lie in bins b, b+1, ... at one offset.
    """
    runs: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    number = 0
    for lengths, often in bins:
        offset = 0
        for length in lengths:
            rank = taken.get(length, 0)
            runs.setdefault(length, []).append((rank, number, offset))
            taken[length] = rank + often
            offset += length
        number += often
    return {length: tuple(np.array(x, np.int64) for x in zip(*of)) for length, of in runs.items()}


def token_pieces(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, part, nth)``: each document's ids and the end id, cut at ``capacity``.

    ``part`` and ``nth`` number the pieces of a length within the task that made
    them, from 0; the rows must be settled before these are used.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        from pyspark import TaskContext

        part, seen, end = TaskContext.get().partitionId(), {}, id_bytes([END_ID])
        for batch, found in row_ids(path, batches, "text"):
            at, out = [], []
            for row, ids in enumerate(found):
                ids += end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[start : start + 4 * capacity]
                    length = len(own) // 4
                    nth = seen.get(length, 0)
                    seen[length] = nth + 1
                    at.append(row)
                    out.append((piece, start // 4, length, zlib.crc32(own), part, nth))
            columns = list(zip(*out)) or [[]] * 6
            kinds = [pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
            arrays = [batch.column("doc_id").take(pa.array(at, pa.int64())), *map(pa.array, columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return rows.mapInArrow(released(run), f"doc_id {dict(rows.dtypes)['doc_id']}, {PIECE}, part int, nth long")


def packed(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, a row for each piece.

    Every document has at least one piece, as its end id is a token: a null or
    empty text is one piece of one id. Rows that repeat are packed each for
    itself; other columns are not read; an empty table gives no row.
    """
    small_batches(docs.sparkSession)
    pieces = settled(token_pieces(docs, path, key=key, text=text, capacity=capacity))
    # A row for each length and task; then at most ``capacity`` rows for the driver.
    ends = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    ends = settled(ends)
    counts = {r["length"]: r["n"] for r in ends.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = docs.sparkSession.sparkContext.broadcast(slots(best_two_fit(counts, capacity)))
    from pyspark.sql import Window

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ends.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    ranked = pieces.join(bases, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank")
    )

    def place(batches):
        runs = plan.value
        for batch in batches:
            length, rank = (batch.column(x).to_numpy() for x in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for one in np.unique(length):
                of = np.flatnonzero(length == one)
                first, number, where = runs[int(one)]
                run = np.searchsorted(first, rank[of], "right") - 1
                sequence[of] = number[run] + rank[of] - first[run]
                offset[of] = where[run]
            kept = batch.select(["doc_id", "piece", "start", "length", "ids_crc32"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence), pa.array(offset)], [*kept.schema.names, "sequence_id", "offset"]
            )

    kind = dict(ranked.dtypes)["doc_id"]
    return ranked.mapInArrow(released(place), f"doc_id {kind}, {PIECE}, sequence_id long, offset long")
