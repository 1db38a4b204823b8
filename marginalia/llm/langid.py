"""Language identification by unigram models over a fixed public vocabulary of pieces.

A word's probability in a language is the sum over all its segmentations into
pieces of the product of the pieces' probabilities, which a forward pass gives.
The piece probabilities of each language are learned by expectation
maximisation over the same segmentations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.bpe import Remembered
from marginalia.llm.common import give_back, released, small_batches, stretches, with_columns, with_text

UNKNOWN = "und"
START = "▁"  # fixed value: the vocabulary's mark for the start of a word
STRETCH_BYTES = 2_000_000
MEMO_WORDS = 400_000


@dataclass(frozen=True)
class Settings:
    #: Labelled rows of each language that are learned from at most: those with the lowest hash of their id.
    max_rows: int = 500
    rounds: int = 4
    #: A word is read in stretches of this length, each with the state that the one before left.
    word_chars: int = 32
    #: Added to the expected count of each piece.
    smoothing: float = 0.05


def load_pieces(path: str) -> dict[str, int]:
    """All pieces of the vocabulary, numbered from 1; 0 is a character that has no piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return {piece: n for n, piece in enumerate(dict.fromkeys(found), 1)}


def has_letter(word: str) -> bool:
    return any(map(str.isalpha, word))


def marked(word: bytes) -> str | None:
    """A word in lower case with its start marked; None without a letter."""
    text = word.decode("utf-8")
    return START + text.lower() if has_letter(text) else None


class PieceTrie:
    """The prefixes of all pieces as nodes; steps are looked up for many nodes at once."""

    def __init__(self, pieces: dict[str, int]):
        prefixes = sorted({p[:n] for p in pieces for n in range(1, len(p) + 1)})
        node = {p: n for n, p in enumerate(["", *prefixes])}
        #: The piece that a node spells, -1 for none; node 0 is the root, and the end of words that no piece goes on with.
        self.longest = max(map(len, pieces), default=1)
        self.piece = np.array([-1, *(pieces.get(p, -1) for p in prefixes)], np.int32)
        steps = np.array([node[p[:-1]] << 21 | ord(p[-1]) for p in prefixes], np.int64)
        self.nodes = np.argsort(steps) + 1
        self.steps = np.append(steps[self.nodes - 1], -1)  # -1 is beyond the last step and equals none
        self.nodes = np.append(self.nodes, 0)

    def after(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        wanted = nodes.astype(np.int64) << 21 | chars
        at = np.searchsorted(self.steps[:-1], wanted)
        return np.where(self.steps[at] == wanted, self.nodes[at], 0)


def lattices(words: list[str], pieces: PieceTrie, longest: int):
    """Words of one length at a time: their places in ``words``, and piece numbers by (word, end, size - 1), -1 for none."""
    by_size: dict[int, list[int]] = {}
    for at, word in enumerate(words):
        by_size.setdefault(len(word), []).append(at)
    for size, places in by_size.items():
        chars = np.frombuffer("".join([words[at] for at in places]).encode("utf-32-le", "surrogatepass"), np.uint32)
        chars = chars.astype(np.int64).reshape(len(places), size)
        found = np.full((len(places), size, longest), -1, np.int32)
        # From every start at once, a character further in each step, as long as some piece goes on.
        nodes = pieces.after(np.zeros_like(chars), chars)
        found[:, :, 0] = np.maximum(pieces.piece[nodes], 0)
        row, end = np.nonzero(nodes)
        nodes = nodes[row, end]
        for n in range(1, longest):
            inside = end + 1 < size
            row, end = row[inside], end[inside] + 1
            nodes = pieces.after(nodes[inside], chars[row, end])
            on = nodes > 0
            row, end, nodes = row[on], end[on], nodes[on]
            found[row, end, n] = pieces.piece[nodes]
        yield np.array(places), found


def windows(words: list[str], pieces: PieceTrie, word_chars: int):
    """Stretches of words, the first stretch of all words first: (places in ``words``, ``lead``, lattice).

    A stretch begins with the ``lead`` characters before it that its pieces may reach back to.
    """
    places, at = np.arange(len(words)), 0
    while len(places):
        lead = min(at, pieces.longest - 1)
        for some, lattice in lattices([words[n][at - lead : at + word_chars] for n in places], pieces, pieces.longest):
            yield places[some], lead, lattice
        at += word_chars
        places = np.array([n for n in places if len(words[n]) > at], np.int64)


def steps_of(lattice: np.ndarray, lead: int):
    """(end, piece size, the words with such a piece or all of them, their pieces), by end and then size."""
    count, size, _ = lattice.shape
    held = lattice >= 0
    some = held.any(axis=0)
    for end in range(lead + 1, size + 1):
        for n in np.flatnonzero(some[end - 1, :end]) + 1:
            rows = np.flatnonzero(held[:, end - 1, n - 1])
            yield end, n, slice(None) if len(rows) == count else rows, lattice[rows, end - 1, n - 1]


def forward(lattice: np.ndarray, chance: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """(word, end, language): the probability of all segmentations of each word's first ``end`` characters.

    ``chance`` has a row of languages for each piece, and a last row of zeros for -1.
    ``before`` has the first ends of a stretch, which the one before it left.
    """
    count, size, _ = lattice.shape
    total = np.zeros((count, size + 1, chance.shape[1]))
    lead = 0 if before is None else before.shape[1] - 1
    total[:, : lead + 1] = 1 if before is None else before
    for end, n, rows, piece in steps_of(lattice, lead):
        total[rows, end] += total[rows, end - n] * chance[piece]
    return total


def swept(stretches_, count: int, longest: int, chance: np.ndarray):
    """(places, lead, lattice, forward totals, their last ones) of each stretch of ``windows``.

    Each stretch's totals are relative to the last total of the one before, so
    that a word of any length does not underflow: its probability is the product
    of the last totals.
    """
    left = np.zeros((count, longest, chance.shape[1]))
    for places, lead, lattice in stretches_:
        total = forward(lattice, chance, left[places, longest - 1 - lead :] if lead else None)
        last = np.maximum(total[:, -1], 1e-300)
        kept = min(longest, total.shape[1])
        left[places, longest - kept :] = total[:, -kept:] / last[:, None]
        yield places, lead, lattice, total, last


def log_chances(words: list[str], pieces: PieceTrie, chance: np.ndarray, word_chars: int) -> np.ndarray:
    """(word, language): the log probability of each word."""
    logs = np.zeros((len(words), chance.shape[1]))
    for places, _, _, _, last in swept(windows(words, pieces, word_chars), len(words), pieces.longest, chance):
        logs[places] += np.log(last)
    return logs


def expected(stretches_: list, chance: np.ndarray, weight: np.ndarray, longest: int) -> np.ndarray:
    """Expected counts of the pieces in words that occur ``weight`` times, for one language."""
    counts = np.zeros(len(chance))
    ahead = list(swept(stretches_, len(weight), longest, chance))
    carried = np.zeros((len(weight), longest))
    ended = np.zeros(len(weight), bool)
    for places, lead, lattice, total, last in reversed(ahead):
        back = np.zeros(total.shape[:2])
        kept = min(longest, back.shape[1])
        back[:, -kept:] = carried[places, longest - kept :]
        back[:, -1] = np.where(ended[places], back[:, -1], 1)
        back[:, -kept:] /= last
        ended[places] = True
        for end, n, rows, piece in reversed(list(steps_of(lattice, lead))):
            by = chance[piece, 0] * back[rows, end]
            np.add.at(counts, piece, total[rows, end - n, 0] * by * weight[places][rows])
            back[rows, end - n] += by
        carried[places, longest - 1 - lead :] = back[:, : lead + 1]
    return counts


def fitted(words: dict[str, int], pieces: dict[str, int], settings: Settings) -> np.ndarray:
    """Probabilities of the pieces, learned from words and how often they occur."""
    size = len(pieces) + 1
    chance = np.full((size + 1, 1), 1 / size)
    chance[-1] = 0
    order = sorted(words)
    weight = np.array([words[w] for w in order], np.float64)
    trie = PieceTrie(pieces)
    read = list(windows(order, trie, settings.word_chars))
    for _ in range(settings.rounds):
        counts = expected(read, chance, weight, trie.longest)[:-1] + settings.smoothing
        chance[:-1, 0] = counts / counts.sum()
    return chance[:-1, 0]


def trained(docs: DataFrame, path: str, settings: Settings, *, key: str, text: str, lang: str) -> tuple[list[str], np.ndarray]:
    """The languages in order, and piece probabilities with a column for each.

    At most ``settings.max_rows`` rows of each language are learned from, picked by
    a hash of their id; each language is one task with the counts of their words.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(key).isNotNull())
    from pyspark.sql import Window

    # Rows of one language and hash bucket are ranked apart, so no task holds a whole language.
    order = F.xxhash64(key)
    keys = known.select(F.col(lang).alias("_lang"), F.col(key).alias("_key")).withColumn("_part", F.spark_partition_id())
    low = Window.partitionBy("_lang", "_part").orderBy(F.xxhash64("_key"), "_key")
    best = keys.withColumn("n", F.row_number().over(low)).filter(F.col("n") <= settings.max_rows)
    best = best.groupBy("_lang").agg(F.array_sort(F.collect_set(F.xxhash64("_key"))).alias("hashes"))
    limits = best.select("_lang", F.element_at("hashes", F.least(F.size("hashes"), F.lit(settings.max_rows))).alias("_most"))
    rows = known.join(F.broadcast(limits), F.col(lang) == F.col("_lang")).filter(order <= F.col("_most"))
    rows = rows.select(F.col("_lang"), F.col(text).cast("binary").alias("__text"))

    def counted(batches):
        for batch in stretches(batches, "__text", STRETCH_BYTES):
            counts: dict[tuple[str, bytes], int] = {}
            for language, body in zip(batch.column("_lang").to_pylist(), batch.column("__text").to_pylist()):
                for word in (body or b"").split():
                    counts[language, word] = counts.get((language, word), 0) + 1
            pairs = [(language, text, n) for (language, word), n in counts.items() if (text := marked(word)) is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(list(zip(*pairs)) or [[], [], []], (pa.string(), pa.string(), pa.int64()))],
                ["lang", "word", "n"],
            )

    words = rows.mapInArrow(released(counted), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))

    def fit(key, frame):
        import pandas as pd

        pieces = load_pieces(path)
        chance = fitted(dict(zip(frame["word"], frame["n"])), pieces, settings)
        give_back()
        return pd.DataFrame({"lang": [key[0]], "chance": [chance.tobytes()]})

    models = words.groupBy("lang").applyInPandas(fit, "lang string, chance binary").orderBy("lang").collect()
    if not models:
        return [], np.zeros((0, 0))
    return [r["lang"] for r in models], np.stack([np.frombuffer(r["chance"]) for r in models], axis=1)


def languages(
    docs: DataFrame, labelled: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
    settings: Settings = Settings(), extra: tuple[Column, ...] = (), within: tuple[str, int] | None = None,
) -> DataFrame:
    """``(doc_id, *extra, lang_pred, score)``, a row for each row of ``docs``.

    ``labelled`` has the rows to learn from (``lang`` null: left out); a
    prediction depends on the text alone. ``score`` is the probability of the
    predicted language given the text, all languages being equally likely
    beforehand. Without a letter, or for null, the language is ``und`` and the
    score 0; so are all rows if nothing could be learned. Words of any length are
    read whole, and pieces of any length. Equal probabilities go to the language that sorts
    first. Scoring is one narrow pass: the model has a row for each piece of the
    fixed vocabulary and a column for each language. ``within`` is as for the quality scores.
    """
    small_batches(docs.sparkSession)
    names, chance = trained(labelled, path, settings, key=key, text=text, lang=lang)
    model = docs.sparkSession.sparkContext.broadcast(np.vstack([chance, np.zeros((1, len(names)))]) if names else None)
    rows = docs.select(F.col(key).alias("doc_id"), *extra, *([] if within else [F.col(text).cast("binary").alias("__text")]))

    def run(batches):
        pieces, table = PieceTrie(load_pieces(path)), model.value
        memo = Remembered(MEMO_WORDS)

        def scored(words: set[bytes]) -> dict[bytes, np.ndarray | None]:
            """Log probability of each word in each language; None without a letter."""
            texts = {w: marked(w) for w in words}
            order = sorted({x for x in texts.values() if x is not None})
            of = dict(zip(order, log_chances(order, pieces, table, settings.word_chars).astype(np.float32)))
            return {w: of.get(x) for w, x in texts.items()}

        for batch in stretches(with_text(batches, "__text", within), "__text", STRETCH_BYTES):
            texts = [(x or b"").split() for x in batch.column("__text").to_pylist()]
            predicted, score = [], []
            known = memo.take(set().union(*texts), scored) if names else {}
            for words in texts:
                found = [x for x in (known.get(w) for w in words) if x is not None]
                if not found:
                    predicted.append(UNKNOWN)
                    score.append(0.0)
                    continue
                total = np.sum(found, axis=0, dtype=np.float64)
                best = int(total.argmax())
                predicted.append(names[best])
                score.append(float(1 / np.exp(total - total[best]).sum()))
            kept = batch.drop_columns(["__text"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(predicted, pa.string()), pa.array(score, pa.float64())],
                [*kept.schema.names, "lang_pred", "score"],
            )

    return rows.mapInArrow(released(run), with_columns(rows.drop("__text"), "lang_pred string, score double"))
