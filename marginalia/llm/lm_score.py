"""Language-model scores of whole texts by logistic context mixing.

A text is its words in lower case (A-Z) and an end. Each token is told by bits: first
whether the word comes that most often followed the two tokens before it (if these were
seen), then, if it does not, whether the word is known, and which it is. A known word
has its share of the counted words; each word, known or not, is spelled as well: its bytes
and a closing blank, the end a blank alone, each bit predicted from the bytes before it in
the text, which reach over the word's start, and from the whole word so far. Both are mixed
by a share that is learned. Predictions of bits are combined in the logistic domain by weights that a gate
selects, learned online, and refined by an adaptive map from what was predicted to what
came (Mahoney, "Adaptive weighing of context models", 2005). Probabilities of bits
multiply to that of the text, so a score is comparable between texts and models.

A byte's prediction depends on the five bytes before it and on the word so far. So the first
five bytes of a word (its head) are told for each distinct run of six bytes, the others (its
rest) for each distinct word: the same numbers as byte by byte over the text.

What is counted grows with the input: words are a Spark table, contexts of two tokens and
runs of six bytes are dealt into ranges of their hashes, whose number follows the number of
tokens. Only shorter contexts of bytes, and those within a word, have tables of a fixed size.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import give_back, released, settled, stretches, with_columns

ORDERS = (1, 2, 3, 5)
INPUTS = len(ORDERS) + 1  # and the whole word so far
GATES = 9 * 5  # how often the whole word so far was seen, and its last bytes of the highest order
STEPS = 33
RANGE = 1 << 16
HEAD = ORDERS[-1]  # bytes of a word whose contexts reach over its start
WIDE = (1 << 8 * HEAD) - 1
EDGE = ord("\n")  # stands before a text; blanks part its words
SCRAMBLE = 0x9E3779B185
#: Shares of the spelling that are tried, besides that of tokens that come for the first time.
SHARES = (0.02, 0.1, 0.3, 0.5, 0.7, 0.9)


@dataclass(frozen=True)
class Settings:
    #: Slots of each of the two context tables, of orders and of whole words; their size is fixed, so they can be broadcast.
    bits: int = 22
    #: Whole words are remembered from this count on: rarer ones are told better by their parts.
    word_count: int = 2
    #: So many of the most frequent words are in every batch, with their share of its weight: they are most of the text.
    common: int = 1000
    #: Text of a block, whose distinct words are looked up together.
    block_bytes: int = 32_000_000
    #: Tokens of a range of contexts, which one task counts.
    range_tokens: int = 2_000_000
    #: Words from which one set of weights is learned; there are as many sets as the words ask for.
    lane_words: int = 100_000
    batch_bytes: int = 24_000
    rate: float = 0.05
    prior: float = 0.4


def further(total: np.ndarray, before: np.ndarray, back: int) -> np.ndarray:
    """The hash of the last bytes, longer by the one ``back`` bytes ago (plus one; 0 for none)."""
    return (total + before) * np.uint32(0x2C1B3C6D) + np.uint32(back)


def mark_of(byte: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """What a byte adds to the hash of the whole word so far."""
    mark = (byte + np.uint32(257) * pos.astype(np.uint32) + np.uint32(1)) * np.uint32(0x85EBCA6B)
    return (mark ^ (mark >> np.uint32(15))) * np.uint32(0xC2B2AE35)


def of_order(total: np.ndarray, n: int) -> np.ndarray:
    return (total ^ np.uint32(n + 1)) * np.uint32(0x297A2D39)


def of_word(total: np.ndarray) -> np.ndarray:
    return (total + np.uint32(7)) * np.uint32(0x27D4EB2F)


class Bits:
    """The contexts of a batch of words at each byte, and its bits."""

    def __init__(self, words: list[bytes], bits: int):
        self.data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        size = len(self.data)
        self.length = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        first = np.repeat(np.cumsum(self.length) - self.length, self.length)
        self.pos = np.arange(size) - first
        self.ends = np.cumsum(self.length) - self.length
        self.shift = np.uint32(32 - bits)
        byte = self.data.astype(np.uint32)
        self.contexts = []
        total = np.zeros(size, np.uint32)
        done = 0
        for n, order in enumerate(ORDERS):
            for back in range(done + 1, order + 1):
                before = np.zeros(size, np.uint32)
                before[back:] = byte[:-back] + np.uint32(1)
                before[self.pos < back] = 0
                total = further(total, before, back)
            done = order
            self.contexts.append(of_order(total, n))
        run = np.concatenate([np.zeros(1, np.uint32), np.cumsum(mark_of(byte, self.pos), dtype=np.uint32)])
        self.contexts.append(of_word(run[:-1] - run[first]))

    def slots(self, bit: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(the byte's bits so far, the bit, a slot for each context); whole words have the second table."""
        node = (np.uint32(1) << np.uint32(bit)) | (self.data >> np.uint8(8 - bit) if bit else np.zeros_like(self.data)).astype(np.uint32)
        value = (self.data >> np.uint8(7 - bit)) & np.uint8(1)
        by_node = node * np.uint32(0x9E3779B1)
        out = []
        for context in self.contexts:
            x = (context ^ by_node) * np.uint32(0x85EBCA6B)
            x ^= x >> np.uint32(13)
            out.append(((x * np.uint32(0xC2B2AE35)) >> self.shift).astype(np.int64))
        out[-1] += 1 << (32 - int(self.shift))
        return node, value, out

    def keep(self, wanted: np.ndarray) -> "Bits":
        """Some of the bytes, told from all that stand before them."""
        self.data, self.contexts = self.data[wanted], [x[wanted] for x in self.contexts]
        return self

    def counted(self, bit: int, every: np.ndarray, ones: np.ndarray):
        """(the byte's bits so far, the bit, how often each context was seen and followed by a one)."""
        node, value, slots = self.slots(bit)
        return node, value, [(every[s], ones[s]) for s in slots]


def scrambled(contexts: np.ndarray) -> np.ndarray:
    """Five bytes as other five: neighbours fall far apart."""
    x = contexts * np.uint64(SCRAMBLE) & np.uint64(WIDE)
    return (x ^ (x >> np.uint64(4 * HEAD))) * np.uint64(SCRAMBLE) & np.uint64(WIDE)


def unscrambled(x: np.ndarray) -> np.ndarray:
    back = np.uint64(pow(SCRAMBLE, -1, WIDE + 1))
    x = x * back & np.uint64(WIDE)
    return (x ^ (x >> np.uint64(4 * HEAD))) * back & np.uint64(WIDE)


class Heads(Bits):
    """Bytes at the start of words, each behind the five bytes before it, which hold the word's start.

    ``codes`` are in order, with all codes of a context: the five bytes (scrambled), then the byte. The longest context is
    counted from them as it is, so its counts have no table; the others are those of ``Bits``.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, bits: int):
        self.codes, self.counts, self.shift = codes, counts, np.uint32(32 - bits)
        self.data = (codes & np.uint64(255)).astype(np.uint8)
        five = unscrambled(codes >> np.uint64(8))
        past = [(five >> np.uint64(8 * (HEAD - 1 - at)) & np.uint64(255)).astype(np.uint32) for at in range(HEAD)]
        self.contexts, total, done = [], np.zeros(len(codes), np.uint32), 0
        for n, order in enumerate(ORDERS[:-1]):
            for back in range(done + 1, order + 1):
                total = further(total, past[-back] + np.uint32(1), back)
            done = order
            self.contexts.append(of_order(total, n))
        start = np.zeros(len(codes), np.int64)
        for at in range(HEAD):
            start[(past[at] == EDGE) | (past[at] == ord(" "))] = at + 1
        run = np.zeros(len(codes), np.uint32)
        for at in range(1, HEAD):
            run += np.where(at >= start, mark_of(past[at], at - start), np.uint32(0))
        self.contexts.append(of_word(run))

    def counted(self, bit: int, every: np.ndarray, ones: np.ndarray):
        node, value, found = super().counted(bit, every, ones)
        group = self.codes >> np.uint64(8 - bit)
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(group)), bool), group[1:] != group[:-1]]))
        of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(group))))
        found.insert(-1, tuple(np.add.reduceat(x, first)[of] for x in (self.counts, self.counts * value)))
        return node, value, found


def batches_of_heads(codes: np.ndarray, limit: int):
    """Ranges of codes with about ``limit`` of them, no context cut."""
    context = codes >> np.uint64(8)
    firsts = np.concatenate([[0], np.flatnonzero(context[1:] != context[:-1]) + 1])
    start = 0
    while start < len(codes):
        at = np.searchsorted(firsts, start + limit)
        end = int(firsts[at]) if at < len(firsts) else len(codes)
        yield start, end
        start = end


def packed(*arrays: np.ndarray) -> list[tuple[str, int, bytes]]:
    """Arrays as compressed bytes: a broadcast lies in several copies on disks and in memories."""
    return [(x.dtype.str, x.nbytes, pa.Codec("zstd", 1).compress(x.tobytes(), asbytes=True)) for x in arrays]


def unpacked(bodies: list[tuple[str, int, bytes]]) -> list[np.ndarray]:
    zstd = pa.Codec("zstd")
    return [np.frombuffer(zstd.decompress(body, decompressed_size=size, asbytes=True), kind) for kind, size, body in bodies]


def batches_of(words: list[bytes], limit: int):
    """Ranges of words with about ``limit`` bytes, a word at least."""
    start, total = 0, 0
    for at, word in enumerate(words):
        if at > start and total + len(word) > limit:
            yield start, at
            start, total = at, 0
        total += len(word) + 1
    if start < len(words):
        yield start, len(words)


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def stretched(ones: np.ndarray, all_: np.ndarray, prior: float) -> np.ndarray:
    """The log odds of a context's next bit; 0 for one that was never seen."""
    return np.clip(np.log((ones + prior) / (all_ - ones + prior)), -11, 11).astype(np.float32)


def evidence(value: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]], less: int, prior: float):
    """What a mixer reads of counts: its inputs, and how often the whole word and the highest order were seen.

    ``less`` is 1 where the byte itself was counted, and is taken off.
    """
    left = [np.maximum(every - less, 0) for every, _ in found]
    inputs = [stretched(np.clip(ones - less * value.astype(np.int64), 0, n), n, prior) for (_, ones), n in zip(found, left)]
    return inputs, seen_often(left[-1]), seen_often(left[-2])


def seen_often(every: np.ndarray) -> np.ndarray:
    """0 for never, then a number for each factor of four up to 8."""
    return np.where(every < 1, 0, np.minimum(np.log2(np.maximum(every, 1)) / 2 + 1, 8)).astype(np.uint8)


class Mixer:
    """Gated weights and the map that refines the mixed prediction."""

    def __init__(self, weights: np.ndarray, hits: np.ndarray, seen: np.ndarray):
        self.weights, self.hits, self.seen = weights, hits, seen
        self.squares = np.full(weights.shape, 1e-4)

    @staticmethod
    def untrained() -> "Mixer":
        centre = squash(np.linspace(-8, 8, STEPS))
        return Mixer(np.full((GATES, INPUTS), 0.3), np.tile(centre * 4, (256, 1)), np.full((256, STEPS), 4.0))

    def predict(self, node: np.ndarray, inputs: list[np.ndarray], word: np.ndarray, order: np.ndarray):
        """(gate, mixed log odds, cell of the map, refined probability of a one).

        ``word`` and ``order`` say how often the whole word and the highest order were seen.
        """
        gate = word.astype(np.int64) * 5 + np.minimum(order, 8) // 2
        mixed = np.zeros(len(node))
        for n, x in enumerate(inputs):
            mixed += self.weights[gate, n] * x
        mixed = np.clip(mixed, -12, 12)
        cell = node.astype(np.int64) * STEPS + np.clip(np.rint((mixed + 8) * 2), 0, STEPS - 1).astype(np.int64)
        refined = self.hits.ravel()[cell] / self.seen.ravel()[cell]
        return gate, mixed, cell, np.clip((squash(mixed) + refined) / 2, 1e-7, 1 - 1e-7)

    def learn(self, gate, mixed, cell, inputs, value, weight, rate: float) -> None:
        error = (value - squash(mixed)) * weight
        size = len(self.weights)
        total = np.maximum(np.bincount(gate, weight, size), 1e-9)
        for n, x in enumerate(inputs):
            slope = np.bincount(gate, error * x, size) / total
            self.squares[:, n] += slope**2
            self.weights[:, n] += rate * slope / np.sqrt(self.squares[:, n])
        self.hits += np.bincount(cell, weight * value, self.hits.size).reshape(self.hits.shape)
        self.seen += np.bincount(cell, weight, self.seen.size).reshape(self.seen.shape)

    def learn_all(self, rows: Bits, weight: np.ndarray, every: np.ndarray, ones: np.ndarray, settings: Settings) -> None:
        """A step for each bit of the bytes, which are taken off the counts."""
        for bit in range(8):
            node, value, found = rows.counted(bit, every, ones)
            inputs, word, order = evidence(value, found, 1, settings.prior)
            gate, mixed, cell, _ = self.predict(node, inputs, word, order)
            self.learn(gate, mixed, cell, inputs, value, weight, settings.rate)

    def logs(self, rows: Bits, every: np.ndarray, ones: np.ndarray, less: int, settings: Settings) -> np.ndarray:
        """The log10 probability of each byte."""
        out = np.zeros(len(rows.data))
        for bit in range(8):
            node, value, found = rows.counted(bit, every, ones)
            chance = self.predict(node, *evidence(value, found, less, settings.prior))[3]
            out += np.log10(np.where(value == 1, chance, 1 - chance))
        return out

    def numbers(self) -> pa.RecordBatch:
        """``(at, x)``: weights, and what the map has gained."""
        start = Mixer.untrained()
        numbers = np.concatenate([self.weights.ravel(), (self.hits - start.hits).ravel(), (self.seen - start.seen).ravel()])
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(numbers))), pa.array(numbers)], ["at", "x"])


def context_counts(words: DataFrame, heads: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """How often each slot's contexts were seen, and followed by a one, over all bytes times their counts.

    Words have the contexts of the whole word so far, and those of orders in their rest; heads
    have the others. Each task counts in one table; ranges of slots are then added up, a
    table of a fixed size for the driver.
    """
    size = 2 << settings.bits
    step = min(RANGE, size)

    def count(fill, batches):
        ones, every = np.zeros(size, np.int64), np.zeros(size, np.int64)

        def add_up(slot, by, value):
            np.add.at(every, slot, by)
            np.add.at(ones, slot, by * value)

        for batch in batches:
            fill(batch, add_up)
        zstd = pa.Codec("zstd", 1)
        for at in range(0, size, step):
            if every[at : at + step].any():
                both = np.concatenate([every[at : at + step], ones[at : at + step]]).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([at // step]), pa.array([zstd.compress(both, asbytes=True)], pa.binary())], ["at", "counts"])

    def of_words(batch, add_up):
        known, counts = batch.column("word").to_pylist(), batch.column("c").to_numpy()
        for start, end in batches_of(known, settings.batch_bytes * 10):
            rows = Bits(known[start:end], settings.bits)
            weight = np.repeat(counts[start:end], rows.length)
            often = np.where(weight >= settings.word_count, weight, 0)
            rest = np.where(rows.pos >= HEAD, weight, 0)
            for bit in range(8):
                _, value, slots = rows.slots(bit)
                for slot, by in zip(slots, [rest] * len(ORDERS) + [often]):
                    add_up(slot[by > 0], by[by > 0], value[by > 0])

    def of_heads(batch, add_up):
        for codes, counts in learned_heads(batch):
            rows = Heads(codes, counts, settings.bits)
            for bit in range(8):
                _, value, slots = rows.slots(bit)
                for slot in slots[:-1]:
                    add_up(slot, counts, value)

    def add(batches):
        held, total, zstd = None, None, pa.Codec("zstd", 1)
        for batch in batches:
            for at, body in zip(batch.column("at").to_pylist(), batch.column("counts").to_pylist()):
                part = np.frombuffer(zstd.decompress(body, decompressed_size=16 * step, asbytes=True), np.int64)
                if at != held:
                    if held is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([held]), pa.array([total.tobytes()])], ["at", "counts"])
                    held, total = at, np.zeros(2 * step, np.int64)
                total = total + part
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held]), pa.array([total.tobytes()])], ["at", "counts"])

    kind = "at long, counts binary"
    both = words.mapInArrow(released(partial(count, of_words)), kind).unionByName(heads.mapInArrow(released(partial(count, of_heads)), kind))
    ranges = both.repartition("at").sortWithinPartitions("at").mapInArrow(released(add), kind)
    every, ones = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for row in ranges.toLocalIterator():
        both = np.frombuffer(row["counts"], np.int64)
        every[row["at"] * step : (row["at"] + 1) * step] = both[:step]
        ones[row["at"] * step : (row["at"] + 1) * step] = both[step:]
    return every, ones


def by_lane(batches, *columns: str):
    """``(lane, its columns as lists)`` of rows that are sorted by lane."""
    held, kept = None, [[] for _ in columns]
    for batch in batches:
        lanes = batch.column("lane").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(lanes)) + 1).tolist(), len(lanes)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            if lanes[start] != held:
                if held is not None:
                    yield held, kept
                held, kept = lanes[start], [[] for _ in columns]
            for values, name in zip(kept, columns):
                values += batch.column(name).slice(start, end - start).to_pylist()
    if held is not None:
        yield held, kept


def mixer(words: DataFrame, tables, settings: Settings) -> Mixer:
    """Weights and map of the rests of words, learned online over lanes of words, a word's own occurrence taken off the counts.

    A word weighs as often as it occurs. Lanes are dealt by a hash, their number follows from the number of words, and each
    reads its words in order, so the outcome does not depend on tasks. The most frequent words are broadcast (a
    number of them that is a parameter), so that each batch resembles the text. The lanes' weights are averaged and
    their maps added up, number by number.
    """
    top = words.orderBy(F.desc("c"), "word").limit(settings.common).collect()
    rest = max(1, words.count() - len(top))
    top_words, top_counts = [bytes(r["word"]) for r in top], np.array([r["c"] for r in top], np.float64)
    lanes = max(1, -(-rest // settings.lane_words))
    dealt = words.withColumn("lane", F.pmod(F.xxhash64("word"), F.lit(lanes)))

    def learn(batches):
        every, ones = unpacked(tables.value)
        shared = set(top_words)
        for _, (lane_words, lane_counts) in by_lane(batches, "word", "c"):
            own = Mixer.untrained()
            pairs = [(w, c) for w, c in zip(lane_words, lane_counts) if w not in shared]
            known, counts = [w for w, _ in pairs], np.array([c for _, c in pairs], np.float64)
            for start, end in batches_of(known, settings.batch_bytes):
                rows = Bits(known[start:end] + top_words, settings.bits)
                weight = np.repeat(np.concatenate([counts[start:end], top_counts * (end - start) / rest]), rows.length)
                in_rest = rows.pos >= HEAD
                own.learn_all(rows.keep(in_rest), weight[in_rest], every, ones, settings)
            yield own.numbers()

    return averaged(dealt.repartition("lane").sortWithinPartitions("lane", "word").mapInArrow(released(learn), "at long, x double"))


def head_mixer(heads: DataFrame, tables, settings: Settings) -> Mixer:
    """Weights and map of the heads of words, learned over lanes as those of the rests are."""

    def learn(batches):
        every, ones = unpacked(tables.value)
        for batch in batches:
            for codes, counts in learned_heads(batch):
                own = Mixer.untrained()
                for start, end in batches_of_heads(codes, settings.batch_bytes // 6):
                    rows = Heads(codes[start:end], counts[start:end], settings.bits)
                    own.learn_all(rows, counts[start:end].astype(np.float64), every, ones, settings)
                yield own.numbers()

    return averaged(heads.mapInArrow(released(learn), "at long, x double"))


def averaged(numbers: DataFrame) -> Mixer:
    """One mixer of those that lanes have learned."""
    out = Mixer.untrained()
    size, cells = out.weights.size, out.hits.size
    summed = numbers.groupBy("at").agg(F.avg("x").alias("mean"), F.sum("x").alias("total")).collect()
    mean, total = np.zeros(size + 2 * cells), np.zeros(size + 2 * cells)
    for row in summed:
        mean[row["at"]], total[row["at"]] = row["mean"], row["total"]
    if summed:
        out.weights = mean[:size].reshape(out.weights.shape)
        out.hits += total[size : size + cells].reshape(out.hits.shape)
        out.seen += total[size + cells :].reshape(out.seen.shape)
    return out


def word_scores(words: DataFrame, tables, mix, settings: Settings) -> DataFrame:
    """``(word, c, score, less)``: the log10 probability of each distinct word's rest, its closing blank included.

    The rest is what stands behind the first five bytes, whose contexts reach into the text before the word and which are
    told by ``head_answers``. ``less`` is that of one of the counted occurrences, without itself.
    """

    def run(batches):
        every, ones = unpacked(tables.value)
        for batch in batches:
            known, counts = batch.column("word").to_pylist(), batch.column("c").to_numpy()
            found = np.zeros((2, len(known)))
            for start, end in batches_of(known, settings.batch_bytes * 10):
                rows = Bits(known[start:end], settings.bits)
                of = np.repeat(np.arange(start, end), rows.length)
                in_rest = rows.pos >= HEAD
                rows.keep(in_rest)
                found[0] += np.bincount(of[in_rest], mix.value.logs(rows, every, ones, 0, settings), len(known))
                own = counts[of[in_rest]] > 0
                rows.keep(own)
                found[1] += np.bincount(of[in_rest][own], mix.value.logs(rows, every, ones, 1, settings), len(known))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), *map(pa.array, found)], ["word", "c", "score", "less"])

    return words.mapInArrow(released(run), "word binary, c long, score double, less double")


def squeezed(numbers: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed; ``spread`` gives them back."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1).T
    return pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def spread(body: bytes, count: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = pa.Codec("zstd").decompress(body, decompressed_size=count * width, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, count).T).view(kind).ravel()


def coded(docs: DataFrame, key: str, extra: tuple[Column, ...], learn: Column, text: str, settings: Settings) -> DataFrame:
    """Blocks of documents as numbers of their words, a row for each block.

    It has the documents' columns (``head``, Arrow), how many tokens each has, whether it is learned from, the tokens as
    numbers, and the block's distinct words in the order of their numbers (no word holds a blank).
    """
    kept = len(extra) + 1
    rows = docs.select(F.col(key), *extra, F.coalesce(learn, F.lit(False)), F.col(text).cast("binary"))
    rows = rows.toDF(*[f"_{i}" for i in range(kept + 2)])

    def code(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in stretches(batches, f"_{kept + 1}", settings.block_bytes):
            index: defaultdict[bytes, int] = defaultdict()
            index.default_factory = index.__len__
            numbers, sizes = [], []
            for body in batch.column(kept + 1).to_pylist():
                words = (body or b"").lower().split()
                words.append(b"")
                numbers.append(np.fromiter(map(index.__getitem__, words), np.int32, len(words)))
                sizes.append(len(words))
            stream, joined = np.concatenate(numbers), b" ".join(index)
            sink = pa.BufferOutputStream()
            head = batch.select(list(range(kept)))
            with pa.ipc.new_stream(sink, head.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(head)
            row = {
                "block": block, "n": len(stream), "letters": len(joined), "head": sink.getvalue().to_pybytes(),
                "sizes": np.array(sizes, np.int32).tobytes(), "learned": np.array(batch.column(kept).to_pylist(), bool).tobytes(),
                "stream": squeezed(stream), "words": pa.Codec("zstd", 3).compress(joined, asbytes=True),
            }
            yield pa.RecordBatch.from_pylist([row])
            block += 1

    return rows.mapInArrow(released(code), "block long, n long, letters long, head binary, sizes binary, learned binary, stream binary, words binary")


def block_tokens(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(tokens of each document, the number of each token's word, whether it is learned from, the words)."""
    sizes = np.frombuffer(row["sizes"], np.int32)
    stream = spread(row["stream"], row["n"], np.int32)
    learned = np.repeat(np.frombuffer(row["learned"], bool), sizes)
    joined = pa.Codec("zstd").decompress(row["words"], decompressed_size=row["letters"], asbytes=True) if row["letters"] else b""
    return sizes, stream, learned, joined.split(b" ")


def block_words(blocks: DataFrame) -> DataFrame:
    """``(block, at, word, n)``: each block's distinct words with their numbers and learned occurrences."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, stream, learned, words = block_tokens(row)
                counts = np.bincount(stream[learned], minlength=len(words))
                for start in range(0, len(words), 100_000):
                    some = words[start : start + 100_000]
                    at = np.arange(start, start + len(some), dtype=np.int32)
                    columns = [pa.array(np.full(len(some), row["block"])), pa.array(at), pa.array(some, pa.binary()), pa.array(counts[at])]
                    yield pa.RecordBatch.from_arrays(columns, ["block", "at", "word", "n"])

    return blocks.select(*TOKENS).mapInArrow(released(run), "block long, at int, word binary, n long")


def by_block(known: DataFrame) -> DataFrame:
    """``(block, size, ats, counts, logs, less)``: rows ``(block, at, c, score, less)`` put together by block, task by task."""

    def pack(held):
        rows = pa.Table.from_batches(held)
        block, at, c, score, less = (rows.column(x).to_numpy() for x in ("block", "at", "c", "score", "less"))
        order = np.lexsort((at, block))
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(block[order])) + 1, [len(order)]])
        out = [
            {"block": int(block[own[0]]), "size": len(own), "ats": squeezed(np.diff(at[own], prepend=np.int32(0))),
             "counts": squeezed(c[own]), "logs": squeezed(score[own].astype(np.float32)), "less": squeezed(less[own].astype(np.float32))}
            for own in (order[start:end] for start, end in zip(cuts, cuts[1:]))
        ]
        return pa.RecordBatch.from_pylist(out)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= 1_000_000:
                yield pack(held)
                held, size = [], 0
        if held:
            yield pack(held)

    return known.mapInArrow(released(run), "block long, size long, ats binary, counts binary, logs binary, less binary")


TOKENS = ["block", "n", "letters", "sizes", "learned", "stream", "words"]
#: Bits that tell the words after one context apart.
WORD_BITS = 14
#: Outcomes of a context: not seen, another word came, its word came; three of them are remembered.
PAST = 27
CELLS = (1 + 2 * 64) * PAST


def before(values: np.ndarray, sizes: np.ndarray, back: int, none: int) -> np.ndarray:
    """For each token the value ``back`` tokens before it in its document, ``none`` where there is none."""
    out = np.empty_like(values)
    out[back:] = values[:-back]
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    for at in range(back):
        out[starts[sizes > at] + at] = none
    return out


def context_keys(stream: np.ndarray, sizes: np.ndarray, words: list[bytes], bits: int) -> np.ndarray:
    """For each token a hash of the two tokens before it (``bits`` bits) and of itself (``WORD_BITS``)."""
    word = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))[stream]
    context = before(word, sizes, 2, 1)
    context *= np.uint64(0x9E3779B97F4A7C15)
    context += before(word, sizes, 1, 1)
    context *= np.uint64(0xC2B2AE3D27D4EB4F)
    context ^= context >> np.uint64(31)
    context *= np.uint64(0x165667B19E3779F9)
    context >>= np.uint64(64 - bits)
    context <<= np.uint64(WORD_BITS)
    word >>= np.uint64(64 - WORD_BITS)
    context |= word
    return context


def distinct_keys(keys: np.ndarray, kind: str = "quicksort") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys in order, the order of all, for each of these the number of its distinct key)."""
    order = np.argsort(keys, kind=kind)
    ordered = keys[order]
    first = np.concatenate([np.ones(min(1, len(keys)), bool), ordered[1:] != ordered[:-1]])
    return ordered[first], order, np.cumsum(first, dtype=np.int32) - np.int32(1)


def range_cuts(keys: np.ndarray, ranges: int, bits: int, behind: int = WORD_BITS) -> np.ndarray:
    """Where the equal ranges of contexts begin in sorted keys, which have some bits behind the context."""
    borders = [(-(-(i << bits) // ranges)) << behind for i in range(1, ranges)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(borders, np.uint64)), [len(keys)]])


def steps_of(x: np.ndarray) -> np.ndarray:
    """0, 1, 2, then a number for each factor of two, up to 7."""
    return np.minimum(np.where(x < 2, x, np.log2(np.maximum(x, 1)).astype(np.int64) + 1), 7)


def outcomes(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each distinct key's context foretold: for an unlearned token, and for a learned one without itself.

    0 if the context was not seen, else 1, and 1 more if its most frequent word (of equal ones that of the smaller
    hash) is the key's, and twice a number from 0 to 63 of how often that word and others came.
    """
    context = keys >> np.uint64(WORD_BITS)
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), context[1:] != context[:-1]]))
    of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
    total = np.add.reduceat(counts, first)[of]

    def best(x):
        most = np.maximum.reduceat(x, first)
        at = np.flatnonzero(x == most[of])
        found = at[np.unique(of[at], return_index=True)[1]]
        return most[of], found[of]

    here = np.arange(len(keys))
    most, top = best(counts)
    without = counts.copy()
    without[top] = -1
    second, runner = best(without)
    second = np.maximum(second, 0)

    def told(total, most, hit):
        return np.where(total < 1, 0, 1 + hit + 2 * (8 * steps_of(most) + steps_of(total - most))).astype(np.uint8)

    is_top = top == here
    own = counts - 1
    stays = is_top & (own > 0) & ((own > second) | (own == second) & (here < runner))
    return told(total, most, is_top), told(total - 1, np.where(is_top, np.maximum(own, second), most), stays)


def context_outcomes(blocks: DataFrame, tokens: int, settings: Settings) -> tuple[DataFrame, int]:
    """``(block, range, answers)`` and the contexts' bits: outcomes of each block's distinct keys, by range.

    A block asks for each distinct key once, so a context that is everywhere costs a range a key and block. Blocks and
    ranges are dealt by number; both are of bounded size, their numbers follow from the tokens.
    """
    bits = min(64 - WORD_BITS, int(tokens).bit_length() + 6)
    ranges = max(1, -(-tokens // settings.range_tokens))

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                sizes, stream, learned, words = block_tokens(row)
                keys = context_keys(stream, sizes, words, bits)
                counted = np.sort(keys[learned])
                keys.sort()
                told = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
                counts = np.diff(np.searchsorted(counted, told, "right"), prepend=0)
                cuts = range_cuts(told, ranges, bits)
                out = []
                for at, (start, end) in enumerate(zip(cuts, cuts[1:])):
                    if end > start:
                        own = told[start:end]
                        out.append((at, row["block"], end - start, squeezed(np.diff(own, prepend=np.uint64(0))), squeezed(counts[start:end])))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], ["lane", "block", "size", "keys", "counts"])

    def answer(batches):
        for at, (block, size, keys, counts) in by_lane(batches, "block", "size", "keys", "counts"):
            keys = np.concatenate([np.cumsum(spread(k, n, np.uint64), dtype=np.uint64) for k, n in zip(keys, size)])
            counts = np.concatenate([spread(c, n, np.int64) for c, n in zip(counts, size)])
            told, order, number = distinct_keys(keys, "stable")  # which merges the blocks' sorted keys
            sums = np.bincount(number, counts[order], len(told)).astype(np.int64)
            both = np.empty((len(keys), 2), np.uint8)
            for n, found in enumerate(outcomes(told, sums)):
                both[order, n] = found[number]
            cuts = np.cumsum([0, *size])
            for i, one in enumerate(block):
                body = squeezed(both[cuts[i] : cuts[i + 1]])
                yield pa.RecordBatch.from_arrays([pa.array([one]), pa.array([at]), pa.array([size[i]]), pa.array([body], pa.binary())], ["block", "range", "size", "answers"])

    asked = blocks.mapInArrow(released(ask), "lane long, block long, size long, keys binary, counts binary")
    told = asked.repartition(min(ranges, 1 << 16), "lane").sortWithinPartitions("lane", "block")
    return told.mapInArrow(released(answer), "block long, range long, size long, answers binary"), bits


def edges(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first five bytes of each word and its closing blank (filled up with zeros), how many these are, and its last five."""
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.uint64)
    length = np.fromiter(map(len, words), np.int64, len(words)) + 1
    stop = np.cumsum(length)
    first = stop - length
    heads, ends = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
    for n in range(HEAD):
        heads = heads << np.uint64(8) | np.where(n < length, data[np.minimum(first + n, stop - 1)], np.uint64(0))
        at = stop - HEAD + n
        ends = ends << np.uint64(8) | np.where(at >= first, data[np.maximum(at, 0)], np.uint64(0))
    return heads, np.minimum(length, HEAD), ends


class HeadCodes:
    """The heads of a block's tokens in the text: ``units`` tells for each token which of the distinct ones it is."""

    def __init__(self, stream: np.ndarray, sizes: np.ndarray, words: list[bytes]):
        heads, length, ends = edges(words)
        by, ends = np.append(8 * length, 0).astype(np.uint64), np.append(ends, np.uint64(0))
        tail = np.full(len(stream), int.from_bytes(bytes([EDGE]) * HEAD), np.uint64)
        for back in (3, 2, 1):  # three words and their blanks have more than five bytes
            of = before(stream, sizes, back, -1)
            tail = (tail << by[of] | ends[of]) & np.uint64(WIDE)
        distinct, first, head = np.unique(heads, return_index=True, return_inverse=True)
        if len(distinct) < 1 << 24:
            told, order, number = distinct_keys(tail << np.uint64(24) | head.astype(np.uint64)[stream])
            self.units = np.empty(len(stream), np.int32)
            self.units[order] = number
            of = first[(told & np.uint64((1 << 24) - 1)).astype(np.int64)]
            self.tail, self.head, self.length = told >> np.uint64(24), heads[of], length[of]
        else:
            self.units, self.tail, self.head, self.length = np.arange(len(stream)), tail, heads[stream], length[stream]

    def codes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(distinct heads that have a byte ``n``, its code with the five bytes before it)."""
        own = np.flatnonzero(self.length > n)
        tail, head = self.tail[own], self.head[own]
        five = (tail << np.uint64(8 * n) | head >> np.uint64(8 * (HEAD - n))) & np.uint64(WIDE)
        return own, scrambled(five) << np.uint64(8) | head >> np.uint64(8 * (HEAD - 1 - n)) & np.uint64(255)


def head_questions(blocks: DataFrame, ranges: int) -> DataFrame:
    """``(lane, block, size, keys, counts, wants)``: each block's distinct codes, by place in the word and range of contexts.

    ``counts`` are learned occurrences; ``wants`` is 1 for a code that others have, 2 for one that learned tokens have, 3 for both.
    """

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                sizes, stream, learned, words = block_tokens(row)
                heads = HeadCodes(stream, sizes, words)
                both = [np.bincount(heads.units[x], minlength=len(heads.tail)) for x in (learned, ~learned)]
                del stream, learned, words
                out = []
                for n in range(HEAD):
                    own, codes = heads.codes(n)
                    told, order, number = distinct_keys(codes)
                    counts, others = (np.bincount(number, x[own][order], len(told)).astype(np.int64) for x in both)
                    wants = ((others > 0) + 2 * (counts > 0)).astype(np.uint8)
                    cuts = range_cuts(told, ranges, 8 * HEAD, 8)
                    for at, (start, end) in enumerate(zip(cuts, cuts[1:])):
                        if end > start:
                            keys = np.diff(told[start:end], prepend=np.uint64(0))
                            out.append((n * ranges + at, row["block"], end - start, *map(squeezed, (keys, counts[start:end], wants[start:end]))))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], ["lane", "block", "size", "keys", "counts", "wants"])

    return blocks.mapInArrow(released(ask), "lane long, block long, size long, keys binary, counts binary, wants binary")


def head_counts(asked: DataFrame, lanes: int) -> DataFrame:
    """``(lane, block, size, keys, counts)``: a lane's distinct codes with their learned occurrences, in one row of block -1."""

    def run(batches):
        for lane, (size, keys, counts) in by_lane(batches, "size", "keys", "counts"):
            keys = np.concatenate([np.cumsum(spread(k, n, np.uint64), dtype=np.uint64) for k, n in zip(keys, size)])
            counts = np.concatenate([spread(c, n, np.int64) for c, n in zip(counts, size)])
            told, order, number = distinct_keys(keys, "stable")
            sums = np.bincount(number, counts[order], len(told)).astype(np.int64)
            yield pa.RecordBatch.from_pylist([
                {"lane": int(lane), "block": -1, "size": len(told), "keys": squeezed(np.diff(told, prepend=np.uint64(0))), "counts": squeezed(sums)}
            ])

    dealt = asked.repartition(min(lanes, 1 << 16), "lane").sortWithinPartitions("lane")
    return dealt.mapInArrow(released(run), "lane long, block long, size long, keys binary, counts binary")


def learned_heads(batch: pa.RecordBatch):
    """``(codes, counts)`` of each lane's codes that are learned from."""
    for size, keys, counts in zip(*(batch.column(x).to_pylist() for x in ("size", "keys", "counts"))):
        codes, counts = np.cumsum(spread(keys, size, np.uint64), dtype=np.uint64), spread(counts, size, np.int64)
        if counts.any():
            yield codes[counts > 0], counts[counts > 0]


def head_answers(asked: DataFrame, counted: DataFrame, lanes: int, tables, mix, settings: Settings) -> DataFrame:
    """``(block, lane, size, spelling)``: the log10 probabilities of each block's codes, by lane.

    Two numbers each: of a token that is not learned from, and of one that is, without itself; 0 where none is asked for.
    """

    def run(batches):
        every, ones = unpacked(tables.value)
        for lane, (block, size, keys, counts, wants) in by_lane(batches, "block", "size", "keys", "counts", "wants"):
            own = block.index(-1)
            told = np.cumsum(spread(keys[own], size[own], np.uint64), dtype=np.uint64)
            sums = spread(counts[own], size[own], np.int64)
            logs = np.zeros((len(told), 2), np.float32)
            for start, end in batches_of_heads(told, settings.batch_bytes):
                rows = Heads(told[start:end], sums[start:end], settings.bits)
                for less in (0, 1):
                    logs[start:end, less] = mix.value.logs(rows, every, ones, less, settings)
            for one, count, some, wanted in zip(block, size, keys, wants):
                if one >= 0:
                    at = np.searchsorted(told, np.cumsum(spread(some, count, np.uint64), dtype=np.uint64))
                    body = squeezed((logs[at] * (spread(wanted, count, np.uint8)[:, None] & np.array([1, 2]) > 0)).astype(np.float32).ravel())
                    yield pa.RecordBatch.from_pylist([{"block": one, "lane": int(lane), "size": count, "spelling": body}])

    both = asked.unionByName(counted, allowMissingColumns=True)
    dealt = both.repartition(min(lanes, 1 << 16), "lane").sortWithinPartitions("lane", "block")
    return dealt.mapInArrow(released(run), "block long, lane long, size long, spelling binary")


def head_logs(heads: HeadCodes, answers: list[dict], ranges: int) -> np.ndarray:
    """The log10 probability of each distinct head of a block, for a token that is not learned from and one that is."""
    out = np.zeros((2, len(heads.tail)))
    for n in range(HEAD):
        told = [spread(r["spelling"], 2 * r["size"], np.float32) for r in answers if r["lane"] // ranges == n]
        if told:
            own, codes = heads.codes(n)
            _, order, number = distinct_keys(codes)
            logs = np.concatenate(told).reshape(-1, 2)
            out[:, own[order]] += logs[number].T
    return out


def cells_of(told: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The outcome of each token's context with those of the three tokens before it in its document."""
    kind = np.where(told == 0, 0, 2 - told % 2).astype(np.uint8)
    past = np.zeros(len(told), np.uint16)
    for back in (1, 2, 3):
        past += before(kind, sizes, back, 0) * np.uint16(3 ** (back - 1))
    return told * np.uint16(PAST) + past


def outcome_logs(seen: np.ndarray, rate: float = 0.05, rounds: int = 100) -> np.ndarray:
    """The log10 probability of each cell's outcome, mixed from several contexts of it.

    ``seen`` counts the cells of learned tokens: all the mixer learns from, whatever the corpus. The contexts are how often
    the foretold word and others came, the last outcomes, and both in part; the mixer is that of the spelled bits.
    """
    counts = seen[PAST:].reshape(64, 2, PAST)
    state, past = (x.ravel() for x in np.meshgrid(np.arange(64), np.arange(PAST), indexing="ij"))
    misses, hits = counts[:, 0].ravel(), counts[:, 1].ravel()
    inputs = []
    for context in (state, past, state // 8 * 3 + past % 3, state % 8 * 9 + past % 9):
        one, all_ = np.bincount(context, hits), np.bincount(context, hits + misses)
        inputs.append(stretched(one, all_, 0.4)[context])
    mix = Mixer.untrained()
    for _ in range(rounds):
        for value, weight in ((0, misses), (1, hits)):
            gate, mixed, cell, _ = mix.predict(state, inputs, past % 9, state // 8)
            mix.learn(gate, mixed, cell, inputs, value, weight / max(1, seen.sum()) * 1000, rate)
    chance = mix.predict(state, inputs, past % 9, state // 8)[3].reshape(64, PAST)
    return np.concatenate([np.zeros(PAST), np.stack([np.log10(1 - chance), np.log10(chance)], 1).ravel()])


def scores(
    docs: DataFrame, learn: Column, *, key: str = "doc_id", text: str = "text", settings: Settings = Settings(),
    extra: tuple[Column, ...] = (),
) -> DataFrame:
    """``(doc_id, *extra, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)`` of each row.

    ``learn`` says of which rows the model learns; null counts as no. All their
    words are counted. Null text is empty: one end. ``base_score`` is the add-half
    unigram model over whole tokens. Rows may repeat; an empty table gives no row;
    if nothing is learned from, all counts are 0 and the base is a probability of
    one half a token over one unknown token. Words of any length are read whole.

    A row that is learned from is scored without its own occurrence of each token and each context.

    Texts are read once, where they are: blocks of bounded size become numbers of words. A block's distinct words are
    counted, looked up in the word table once, and meet their block again, as do the outcomes of its contexts and the
    spelling of its words' heads behind the text before them.
    """
    blocks = settled(coded(docs, key, extra, learn, text, settings))
    wanted = block_words(blocks)
    words = settled(wanted.groupBy("word").agg(F.sum("n").alias("c")))
    learned = words.filter("c > 0")
    n, v, once = (x or 0 for x in learned.agg(F.sum("c"), F.count("*"), F.count_if(F.col("c") == 1)).first())
    tokens = blocks.agg(F.sum("n")).first()[0] or 0
    told, bits = context_outcomes(blocks.select(*TOKENS), tokens, settings)
    context = docs.sparkSession.sparkContext
    ranges = max(1, -(-tokens // settings.range_tokens))
    asked = settled(head_questions(blocks.select(*TOKENS), ranges))
    heads = settled(head_counts(asked, HEAD * ranges))
    every, ones = context_counts(learned, heads, settings)
    whole = np.int32 if every.max() < 1 << 31 else np.int64
    tables = context.broadcast(packed(every.astype(whole), ones.astype(whole)))
    del every, ones
    mix, head_mix = context.broadcast(mixer(learned, tables, settings)), context.broadcast(head_mixer(heads, tables, settings))
    spelt = head_answers(asked, heads, HEAD * ranges, tables, head_mix, settings)
    scored = word_scores(words, tables, mix, settings)
    known = by_block(wanted.join(scored, "word").select("block", "at", "c", "score", "less"))
    unknown = (once + 0.5) / (n + 1)  # the share of tokens that come for the first time
    shares = [unknown, *SHARES]

    def score(rows):
        rows = rows.to_pylist()
        row = next(r for r in rows if r["stream"] is not None)
        answers = sorted((r for r in rows if r["answers"] is not None), key=lambda r: r["range"])
        both = np.concatenate([spread(r["answers"], r["size"], "V2").view(np.uint8).reshape(-1, 2) for r in answers])
        sizes, stream, own, words = block_tokens(row)
        c, rest = np.zeros(len(words), np.int64), np.zeros((2, len(words)))
        for r in rows:
            if r["ats"] is not None:
                at = np.cumsum(spread(r["ats"], r["size"], np.int32))
                c[at] = spread(r["counts"], r["size"], np.int64)
                rest[:, at] = [spread(r[x], r["size"], np.float32) for x in ("logs", "less")]
        found = HeadCodes(stream, sizes, words)
        spelled = head_logs(found, sorted((r for r in rows if r["spelling"] is not None), key=lambda r: r["lane"]), ranges)
        less = own.view(np.uint8)
        spelled = spelled[less, found.units] + rest[less, stream]
        del found, rest
        _, order, number = distinct_keys(context_keys(stream, sizes, words, bits))
        told = np.empty(len(stream), np.uint8)
        told[order] = both[number, less[order]]
        del order, number, both
        starts = np.cumsum(sizes) - sizes
        letters = np.fromiter(map(len, words), np.int64, len(words)) + 1
        with np.errstate(divide="ignore"):
            share = np.log(np.stack([np.maximum(c - x, 0) / max(1, n - x) for x in (0, 1)]))
        others = np.flatnonzero((told == 0) | (told % 2 == 1))  # else the foretold word came
        share, spelled = share[less[others], stream[others]], spelled[others] * np.log(10)
        mine = np.zeros((len(shares), len(sizes)))
        of = np.repeat(np.arange(len(sizes)), sizes)[others]
        for at, x in enumerate(shares):
            mine[at] = np.bincount(of, np.logaddexp(share + np.log1p(-x), spelled + np.log(x)), len(sizes)) / np.log(10)
        del share, spelled, others, of
        base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))[stream]
        cells = cells_of(told, sizes)
        ends = np.append(starts, len(cells)) * 2
        body = cells.tobytes()
        with pa.ipc.open_stream(row["head"]) as stored:
            head = stored.read_all()
        more = [
            pa.array(np.frombuffer(row["learned"], bool)), pa.array(sizes.astype(np.int64)),
            pa.array(np.add.reduceat((c > 0).astype(np.int64)[stream], starts)), pa.array(np.add.reduceat(base, starts)),
            pa.array(mine.T.tolist(), pa.list_(pa.float64())), pa.array(np.add.reduceat(letters[stream], starts)),
            pa.array([body[a:b] for a, b in zip(ends, ends[1:])], pa.binary()),
        ]
        give_back()
        return pa.Table.from_arrays([*head.columns, *more], [*head.schema.names, *[x.split()[0] for x in DOCUMENT.split(", ")]])

    names = [x.split()[0] for x in DOCUMENT.split(", ")]
    shape = docs.select(F.col(key).alias("doc_id"), *extra)
    numbered = shape.toDF(*[f"_{i}" for i in range(len(shape.columns))])
    coming = blocks
    for more in (told, known, spelt):
        coming = coming.unionByName(more, allowMissingColumns=True)
    found = settled(coming.groupBy("block").applyInArrow(score, with_columns(numbered, DOCUMENT)))

    def count(batches):
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            body = b"".join(batch.column("cells").to_pylist())
            total += np.bincount(np.frombuffer(body, np.uint16), minlength=CELLS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    seen = np.zeros(CELLS)
    for r in found.filter("learned").select("cells").mapInArrow(released(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        seen[r["cell"]] = r["n"]
    gained = found.filter("learned").select(*[F.sum(F.col("mine")[at]) for at in range(len(shares))]).first()
    best = max(range(len(shares)), key=lambda at: gained[at] or 0)  # the share of the spelling by which learned tokens are told best
    of_cell = outcome_logs(seen)  # a number for each of the cells, which are as many whatever the corpus

    own_names = numbered.columns

    def finish(batches):
        for batch in batches:
            body = [np.frombuffer(x, np.uint16) for x in batch.column("cells").to_pylist()]
            added = np.array([of_cell[x].sum() for x in body])
            mine = pc.list_element(batch.column("mine"), best).to_numpy() + added
            per_byte = -mine / np.log10(2) / batch.column("bytes").to_numpy()
            kept = [batch.column(i) for i in range(len(own_names))]
            yield pa.RecordBatch.from_arrays(
                [*kept, batch.column("n_tokens"), batch.column("n_known"), pa.array(np.full(len(mine), n, np.int64)),
                 batch.column("base"), pa.array(mine), pa.array(per_byte)],
                [*own_names, *RESULT],
            )

    kinds = "n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    return found.select(*numbered.columns, *names).mapInArrow(released(finish), with_columns(numbered, kinds)).toDF(*shape.columns, *RESULT)


DOCUMENT = "learned boolean, n_tokens long, n_known long, base double, mine array<double>, bytes long, cells binary"
RESULT = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
