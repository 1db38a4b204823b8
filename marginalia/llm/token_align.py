"""Alignment of two tokenizers' tokens by their bytes, over many documents in lockstep.

One state vector holds, for every document of a batch, how far it is in both
token sequences. Each step moves the side whose token ends first, or both where
they end at one byte: there a group of tokens is cut off and its links are
emitted. Documents that are finished leave the vector.

Both vocabularies are read chunk by chunk: a chunk is blanks and the word behind
them, and neither tokenizer has a token across a chunk's border, so the tokens of a
text are those of its chunks, and the border is a cut of both. Long documents go
as several lanes that begin at such borders.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marginalia.llm.common import BROADCAST_KEYS, settled, stretches

#: Bytes of text that are aligned at a time, and chunks whose tokens are remembered. A stretch takes about a hundred
#: times its size in lists and arrays; half the text in lanes half as long takes as many steps a token.
STRETCH_BYTES = 500_000
MEMO_CHUNKS = 300_000
#: New chunks that are joined for one call of each library at most; fewer than the second go one by one if joined they cannot be told apart.
JOINED_CHUNKS = 1000
LEAST_JOINED = 15
#: Tokens of a lane: a longer document goes on in another lane.
LANE_TOKENS = 128
#: A group of more links than this is counted by its distinct ids instead of link by link.
WIDE_LINKS = 4096
DOC_BITS = 24  # of a row's number in its batch
PIECE_BITS = 18  # a pair of ids is one number: A's id above B's, which has at most so many bits

#: A chunk ends before a blank, the text's last character apart, that follows something no tokenizer takes for white space.
BORDER = re.compile(r"(?<=[^\s\u180e\u200b\u2581\ufeff])(?= .)", re.S)
LOOSE = re.compile(r"[\s\u180e\u200b\u2581\ufeff] ")
MARK = "\u2581"  # fixed value: the piece vocabulary's mark for a blank
STATS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
PAIRS = "array<struct<pair: long, links: long>>"


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Chunks:
    """Tokens of chunks by both vocabularies, as ragged arrays that grow as chunks are met."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece

        self.a = Tokenizer.from_file(byte_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        alphabet = byte_alphabet()
        vocab = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in alphabet for c in token):
                self.a_bytes[i] = bytes(alphabet[c] for c in token)
        pieces = range(self.b.get_piece_size())
        names = [self.b.id_to_piece(i) for i in pieces]
        if any(MARK in x.lstrip(MARK) for x in names) or len(names) > 1 << PIECE_BITS:
            raise ValueError(f"{piece_path} has pieces that go on behind a word's end, or too many")
        if len(self.a_bytes) > 1 << (63 - DOC_BITS - PIECE_BITS):
            raise ValueError(f"{byte_path} has too many tokens")
        self.b_bytes = [
            bytes([int(x[3:-1], 16)]) if self.b.is_byte(i) else x.replace(MARK, " ").encode() for i, x in zip(pieces, names)
        ]
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        self.forget()

    def forget(self) -> None:
        """Chunks that were met in two stretches or more stay, up to half of all."""
        stay = np.zeros(0, np.int64)
        if getattr(self, "number", None):
            often = np.argsort(-self.met[: len(self.number)], kind="stable")[: MEMO_CHUNKS // 2]
            stay = np.sort(often[self.met[often] > 1])
            names = list(self.number)
            self.number = {names[n]: at for at, n in enumerate(stay.tolist())}
            self.a_ids, self.b_ids, self.whole = self.a_ids.kept(stay), self.b_ids.kept(stay), self.whole[stay]
        else:
            self.number: dict[str, int] = {}
            self.a_ids, self.b_ids, self.whole = Ragged(), Ragged(), np.zeros(0, bool)
        self.met = np.zeros(len(stay), np.int32)

    def numbers(self, chunks: list[str]) -> np.ndarray:
        """A number for each chunk, which is a text behind one blank."""
        found = list(map(self.number.get, chunks))
        fresh = dict.fromkeys(c for c, n in zip(chunks, found) if n is None)
        if fresh:
            if len(self.number) + len(fresh) > MEMO_CHUNKS and self.number:
                self.forget()
                found = list(map(self.number.get, chunks))
                fresh = dict.fromkeys(c for c, n in zip(chunks, found) if n is None)
            new = list(fresh)
            plain, others = [c for c in new if c.isascii()], [c for c in new if not c.isascii()]
            for alike in (plain, others):
                for at in range(0, len(alike), JOINED_CHUNKS):
                    self.learn(alike[at : at + JOINED_CHUNKS])
            found = [self.number[c] if n is None else n for c, n in zip(chunks, found)]
        numbers = np.array(found, np.int64)
        self.met = np.append(self.met, np.zeros(len(self.number) - len(self.met), np.int32))
        self.met[np.unique(numbers)] += 1
        return numbers

    def learn(self, chunks: list[str]) -> None:
        """Remembers new chunks: of many joined by blanks, if their tokens are certain to be those of each."""
        if len(chunks) > 1 and self.learn_joined(chunks):
            return
        if len(chunks) > LEAST_JOINED:
            half = len(chunks) // 2
            self.learn(chunks[:half])
            self.learn(chunks[half:])
        elif chunks:
            self.learn_each(chunks)

    def learn_joined(self, chunks: list[str]) -> bool:
        """Whether the joined chunks are cut as given and both sides give them back byte by byte, with a token's end at each chunk's."""
        text = " ".join(chunks)
        if chunks_of(text) != chunks:
            return False
        a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b = self.b.encode(text, num_threads=1)
        everything = (" " + text).encode("utf-8")
        ends = np.cumsum([len(c.encode("utf-8")) + 1 for c in chunks])
        found = []
        for ids, table, sizes in ((a, self.a_bytes, self.a_size), (b, self.b_bytes, self.b_size)):
            flat = np.array(ids, np.int32)
            until = np.cumsum(sizes[flat])
            if not ids or until[-1] != ends[-1] or b"".join([table[i] for i in ids]) != everything:
                return False
            # Tokens without bytes, if there are any, are not dealt to chunks.
            at = np.searchsorted(until, ends)
            if (until[at] != ends).any() or not sizes[flat].all():
                return False
            found.append((flat, at + 1))
        first = len(self.number)
        self.number.update(zip(chunks, range(first, first + len(chunks))))
        for rows, (flat, cuts) in zip((self.a_ids, self.b_ids), found):
            rows.put(flat, cuts)
        self.whole = np.append(self.whole, np.ones(len(chunks), bool))
        return True

    def learn_each(self, chunks: list[str]) -> None:
        texts = [" " + c for c in chunks]
        a = [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = self.b.encode(chunks, num_threads=1)
        first = len(self.number)
        self.number.update(zip(chunks, range(first, first + len(chunks))))
        size = np.array([len(t.encode("utf-8")) for t in texts])
        everything = "".join(texts).encode("utf-8")
        whole = np.ones(len(chunks), bool)
        for ids, rows, table, sizes in ((self.a_ids, a, self.a_bytes, self.a_size), (self.b_ids, b, self.b_bytes, self.b_size)):
            flat, ends = ids.add(rows)
            total = np.append(0, np.cumsum(sizes[flat]))
            same = np.diff(total[np.append(0, ends)]) == size
            if not same.all() or b"".join([table[i] for i in flat.tolist()]) != everything:
                same = np.array([b"".join([table[i] for i in r]) == t.encode("utf-8") for r, t in zip(rows, texts)])
            whole &= same
        self.whole = np.append(self.whole, whole)

    def joined(self, numbers: np.ndarray) -> tuple[bytes, bytes]:
        """The bytes of all tokens of a text, by A and by B."""
        return tuple(
            b"".join([table[i] for i in ids.take(numbers)[0].tolist()])
            for table, ids in ((self.a_bytes, self.a_ids), (self.b_bytes, self.b_ids))
        )


@lru_cache(1)
def opened(byte_path: str, piece_path: str) -> Chunks:
    """The vocabularies and remembered chunks of a worker, which its next tasks go on with."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    chunks = Chunks(byte_path, piece_path)
    gc.freeze()  # the vocabularies' tables are many objects and never garbage
    return chunks


class Ragged:
    """Rows of numbers of any length, one after another."""

    def __init__(self):
        self.room, self.starts = np.empty(1000, np.int32), np.zeros(1, np.int64)

    def add(self, rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Puts rows at the end; gives their numbers and where each row ends in them."""
        flat = np.array(list(chain.from_iterable(rows)), np.int32)
        ends = np.cumsum([len(r) for r in rows], dtype=np.int64)
        self.put(flat, ends)
        return flat, ends

    def put(self, flat: np.ndarray, ends: np.ndarray) -> None:
        """Puts rows at the end that are already joined, with where each ends."""
        begin = int(self.starts[-1])
        if begin + len(flat) > len(self.room):
            self.room = np.append(self.room[:begin], np.empty(begin + len(flat), np.int32))
        self.room[begin : begin + len(flat)] = flat
        self.starts = np.append(self.starts, begin + ends)

    def kept(self, rows: np.ndarray) -> "Ragged":
        out = Ragged()
        out.room, sizes = self.take(rows)
        out.starts = np.append(0, np.cumsum(sizes))
        return out

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the given rows in order, and the size of each row."""
        begin = self.starts[rows]
        sizes = self.starts[rows + 1] - begin
        return self.room[spread(begin, sizes)], sizes


def spread(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... for each of the runs, one run after another."""
    return np.arange(int(sizes.sum())) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)


def chunks_of(text: str) -> list[str]:
    """The chunks of a blank and the text, each without its first blank."""
    if LOOSE.search(" " + text) is None and text[-1] != " ":
        return text.split(" ")
    return [c[1:] for c in BORDER.split(" " + text)]


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_first: np.ndarray, b_first: np.ndarray, a_stop: np.ndarray) -> tuple:
    """The groups of all lanes: (first A token, number of A tokens, first B token, number of B tokens).

    ``a_end`` and ``b_end`` give the byte at which each token ends, counted on within its
    lane; a lane has A's tokens from ``a_first`` to ``a_stop`` and B's from ``b_first`` on, of the same bytes.
    """
    live = np.flatnonzero(a_first < a_stop)
    a, b, stop = a_first[live], b_first[live], a_stop[live]
    a_open, b_open = a.copy(), b.copy()
    cuts = []
    while len(a):
        x, y = a_end[a], b_end[b]
        cut = x == y
        at = np.flatnonzero(cut)
        a += x <= y
        b += y <= x
        if len(at):
            cuts.append((a_open[at], a[at] - a_open[at], b_open[at], b[at] - b_open[at]))
            a_open[at], b_open[at] = a[at], b[at]
            going = a < stop
            if not going.all():
                a, b, stop, a_open, b_open = (v[going] for v in (a, b, stop, a_open, b_open))
    if not cuts:
        return (np.zeros(0, np.int64),) * 4
    groups = [np.concatenate(x) for x in zip(*cuts)]
    order = np.argsort(groups[0], kind="stable")
    return tuple(x[order] for x in groups)


def links_of(a_ids, b_ids, groups: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair of ids, links) of all pairs of tokens that share a group."""
    a_at, a_n, b_at, b_n = groups
    links = a_n * b_n
    narrow = np.flatnonzero(links <= WIDE_LINKS)
    sizes = links[narrow]
    group = np.repeat(narrow, sizes)
    nth = spread(np.zeros(len(narrow), np.int64), sizes)
    pair = (a_ids[a_at[group] + nth // b_n[group]].astype(np.int64) << PIECE_BITS) | b_ids[b_at[group] + nth % b_n[group]]
    parts = [(group, pair, np.ones(len(pair), np.int64))]
    for one in np.flatnonzero(links > WIDE_LINKS):
        x, xn = np.unique(a_ids[a_at[one] : a_at[one] + a_n[one]], return_counts=True)
        y, yn = np.unique(b_ids[b_at[one] : b_at[one] + b_n[one]], return_counts=True)
        pair = ((x.astype(np.int64) << PIECE_BITS)[:, None] | y).ravel()
        parts.append((np.full(len(pair), one), pair, np.outer(xn, yn).ravel()))
    return tuple(np.concatenate(x) for x in zip(*parts))


def summed(doc: np.ndarray, pair: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, pair) in order, and how many links each has."""
    key = doc << (63 - DOC_BITS) | pair
    if (links == 1).all():
        key = np.sort(key)
    else:
        order = np.argsort(key)
        key, links = key[order], links[order]
    begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))[: len(key)]
    total = np.add.reduceat(links, begins) if len(begins) else links
    return key[begins] >> (63 - DOC_BITS), key[begins] & ((1 << (63 - DOC_BITS)) - 1), total


def links_by_row(a_ids, b_ids, groups: tuple, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, pair) in order, and how many links each has; ``starts`` has where each row's groups begin, and the end."""
    group, pair, links = links_of(a_ids, b_ids, groups)
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[group]
    del group
    return summed(row, pair, links)


def group_digests(a_ids, b_ids, groups: tuple, starts: np.ndarray) -> list[str]:
    """The digest of each row's groups as they are shown; '' for a row without groups."""
    out, places = shown_groups(a_ids, b_ids, groups)
    places, whole = places[starts], out.data
    return [sha256(whole[x : y - 1]).hexdigest() if x < y else "" for x, y in zip(places[:-1], places[1:])]


@lru_cache(1)
def digits(count: int) -> tuple[np.ndarray, np.ndarray]:
    """For each number below ``count``: its decimal digits, the last one first, and how many they are."""
    numbers = np.arange(count)
    places = len(str(count))
    table = np.stack([ord("0") + numbers // 10**n % 10 for n in range(places)], 1).astype(np.uint8)
    return table, 1 + sum((numbers >= 10**n).astype(np.int32) for n in range(1, places))


def shown_groups(a_ids, b_ids, groups: tuple) -> tuple[np.ndarray, np.ndarray]:
    """The groups as bytes, ``a1,a2|b1;`` one after another, and where each begins and the last ends."""
    a_at, a_n, b_at, b_n = groups
    sizes = np.stack([a_n, b_n], 1).ravel()
    side = np.repeat(np.arange(len(sizes)) & 1, sizes).astype(bool)
    ids = np.empty(len(side), np.int32)
    ids[~side], ids[side] = a_ids[spread(a_at, a_n)], b_ids[spread(b_at, b_n)]
    last = np.cumsum(sizes) - 1
    mark = np.full(len(ids), ord(","), np.uint8)
    mark[last[::2]], mark[last[1::2]] = ord("|"), ord(";")
    table, widths = digits(int(ids.max(initial=0)) // 100_000 * 100_000 + 100_000)
    width = widths[ids]
    end = np.cumsum(width + 1)
    out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    out[end - 1] = mark
    for place in range(int(width.max(initial=0))):
        some = np.flatnonzero(width > place)
        out[end[some] - 2 - place] = table[ids[some], place]
    return out, np.append(0, end[last[1::2]])


def aligned(chunks: Chunks, texts: list[str]) -> tuple:
    """Of each text: token counts by A and B, where its groups begin; and all groups' tokens.

    ``(numbers of tokens A, B, first group and end, A ids, B ids, groups)``. Texts without
    bytes, or that either side does not give back, have no tokens.
    """
    cut = [chunks_of(t) if t else [] for t in texts]
    counts = np.array([len(c) for c in cut], np.int64)
    number = chunks.numbers([c for one in cut for c in one])
    doc = np.repeat(np.arange(len(texts)), counts)
    fits = np.ones(len(texts), bool)
    for one in np.unique(doc[~chunks.whole[number]]) if len(number) else ():
        a, b = chunks.joined(number[doc == one])
        fits[one] = a == b == b" " + texts[one].encode("utf-8")
    number, doc = number[fits[doc]], doc[fits[doc]]
    a_ids, a_n = chunks.a_ids.take(number)
    b_ids, b_n = chunks.b_ids.take(number)
    # A lane begins where a document does and where a document's tokens pass a multiple of LANE_TOKENS,
    # at a border of chunks; chunks that are not whole by themselves are no border.
    broken = np.isin(doc, np.unique(doc[~chunks.whole[number]]))
    first = np.append(True, doc[1:] != doc[:-1])[: len(doc)]
    before = np.cumsum(a_n) - a_n
    run = before - np.repeat(before[first], np.diff(np.append(np.flatnonzero(first), len(doc))))
    passed = np.append(0, (run[1:] // LANE_TOKENS) != (run[:-1] // LANE_TOKENS))[: len(doc)].astype(bool)
    lanes = np.flatnonzero(first | passed & ~broken)
    a_at, b_at = np.append(before, len(a_ids)), np.append(np.cumsum(b_n) - b_n, len(b_ids))
    a_first, b_first = a_at[lanes], b_at[lanes]
    a_stop = np.append(a_first[1:], len(a_ids))
    a_end, b_end = np.cumsum(chunks.a_size[a_ids]), np.cumsum(chunks.b_size[b_ids])
    groups = lockstep(a_end, b_end, a_first, b_first, a_stop)
    # Whole texts have the same bytes on both sides, so the ends may be counted on over all lanes.
    per_doc = [np.bincount(doc, x, len(texts)).astype(np.int64) for x in (a_n, b_n)]
    starts = np.searchsorted(groups[0], np.append(0, np.cumsum(per_doc[0])))
    return *per_doc, starts, a_ids, b_ids, groups


def alignments(docs: DataFrame, byte_path: str, piece_path: str, *, text: str = "text", keep: Iterable[str] = ()) -> DataFrame:
    """``(keep..., n_a, n_b, n_groups, n_links, groups_sha256, pairs)``, a row for each row.

    ``pairs`` has, for each pair of an A and a B id that are linked, the pair as
    one number and how many links it has. One narrow pass: no row moves.
    """
    keep = list(keep)
    rows = docs.select(*keep, F.col(text).alias("_text_of_row"))
    kinds = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = opened(byte_path, piece_path)
        for batch in stretches(batches, "_text_of_row", STRETCH_BYTES):
            texts = [x or "" for x in batch.column("_text_of_row").to_pylist()]
            n_a, n_b, starts, a_ids, b_ids, groups = aligned(chunks, texts)
            sums = group_digests(a_ids, b_ids, groups, starts)
            doc, pair, total = links_by_row(a_ids, b_ids, groups, starts)
            n_links = np.zeros(len(texts), np.int64)
            np.add.at(n_links, doc, total)
            del a_ids, b_ids, groups  # not needed while the links are handed on
            structs = pa.StructArray.from_arrays([pa.array(pair), pa.array(total)], ["pair", "links"])
            pairs = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)), pa.int32()), structs)
            made = [pa.array(x) for x in (n_a, n_b, np.diff(starts), n_links)] + [pa.array(sums, pa.string()), pairs]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *made], [*keep, *STATS_NAMES, "pairs"])

    return rows.mapInArrow(run, f"{kinds}{', ' if kinds else ''}{STATS}, pairs {PAIRS}")


STATS_NAMES = [c.split()[0] for c in STATS.split(", ")]


def pair_counts(found: DataFrame, pairs: str = "pairs") -> DataFrame:
    """``(pair, count, best)``: in how many rows a pair is linked, and whether that is its A id's highest count."""
    counts = found.select(F.explode(f"{pairs}.pair").alias("pair")).groupBy("pair").agg(F.count("*").alias("count"))
    counts = settled(counts)
    highest = counts.groupBy(F.shiftright("pair", PIECE_BITS).alias("a")).agg(F.max("count").alias("most"))
    joined = counts.join(highest, F.shiftright("pair", PIECE_BITS) == F.col("a"))
    return settled(joined.select("pair", "count", (F.col("count") == F.col("most")).alias("best")))


def with_counts(rows: DataFrame, counts: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """The rows of links with their pair's count.

    Up to ``most`` pairs, those of the highest counts, are broadcast: pairs that are in
    a large part of all documents are among them. Rows of the others are dealt by pair.
    """
    if counts.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(counts), "pair")
    # At most 64 rows: how many pairs have a count of so many bits.
    bits = F.length(F.bin("count"))
    levels = {r["bits"]: r["n"] for r in counts.groupBy(bits.alias("bits")).agg(F.count("*").alias("n")).collect()}
    least, taken = 65, 0
    while least - 1 > 0 and taken + levels.get(least - 1, 0) <= most:
        least -= 1
        taken += levels.get(least, 0)
    hot = counts.filter(bits >= least)
    tagged = rows.join(F.broadcast(hot), "pair", "left")
    rest = tagged.filter("count IS NULL").drop("count", "best").join(counts.filter(bits < least), "pair")
    return tagged.filter("count IS NOT NULL").unionByName(rest)


def link_counts(
    docs: DataFrame, byte_path: str, piece_path: str, *, key: str = "doc_id", text: str = "text", most: int = BROADCAST_KEYS
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, a row for each row.

    Null and empty texts, and texts that either vocabulary does not give back
    byte by byte, have no tokens: zeros, and '' for the digest. Rows that repeat
    (an id or all) count each as a document; other columns are not read; an
    empty table gives no row.
    """
    numbered = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    found = settled(alignments(numbered, byte_path, piece_path, keep=("doc_id", "row")))
    counts = pair_counts(found)
    links = found.select("row", F.explode("pairs").alias("x")).select("row", "x.pair", "x.links")
    sums = with_counts(links, counts, most).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
        F.sum(F.col("links") * F.col("count")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return found.drop("pairs").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
