"""Byte-pair encoding and decoding with a stored vocabulary, by a walk over a trie of distinct words.

For each prefix of a word, the last token of the prefix's encoding is a state
that depends on that prefix alone: among the tokens that end there it is the one
that may follow the last token of what stands before it. Distinct words in sorted
order are the leaves of a trie in depth-first order, so the states on the path
from the root are computed once for all words that share them, and a word's
encoding is read back from its last state.
"""

from __future__ import annotations

import gc
import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marginalia.llm.common import stretches

NEVER = 1 << 60
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
#: Separators of ASCII that ``\\s`` of the tokenizer may read differently are left to it.
PLAIN = re.compile(rb"[\x21-\x7e]+\Z")
#: Bytes of text whose words are held at a time, and chunks whose encoding is remembered.
STRETCH_BYTES = 2_000_000
MEMO_CHUNKS = 600_000
MEMO_WORDS = 400_000


class Remembered:
    """Values of keys seen lately: at least ``limit`` / 2 of them, at most ``limit`` besides the keys in hand."""

    def __init__(self, limit: int):
        self.limit, self.recent, self.older = limit, {}, {}

    def take(self, keys: set, compute: Callable[[set], dict]) -> dict:
        """A mapping that has all ``keys``; ``compute`` gives the values of new ones."""
        here = keys - self.recent.keys()
        if len(self.recent) + len(here) > self.limit // 2:
            here, self.recent, self.older = keys, {}, self.recent
        fresh = here - self.older.keys()
        self.recent.update((k, self.older[k]) for k in here - fresh)
        self.recent.update(compute(fresh))
        return self.recent


class PrefixEncoder:
    """The merges of a vocabulary file as states over prefixes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        end = len(self.suffix)
        self.inner = {t: i for t, i in self.vocab.items() if not t.endswith(self.suffix)}
        self.final = {t[:-end]: i for t, i in self.vocab.items() if t.endswith(self.suffix)}
        # Every end of a token, with the token of that name if there is one: a search stops where no token goes on.
        self.inner_ends, self.final_ends = self.ends(self.inner), self.ends(self.final)
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}  # -> (rank, merged token)
        self.parts: dict[int, tuple[int, int, int]] = {}  # -> (rank, left, right) that makes the token
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, whole = self.vocab[left], self.vocab[right], self.vocab[left + right]
            self.pairs[a, b] = (rank, whole)
            self.parts[whole] = (rank, a, b)
        self.fits: dict[tuple[int, int], bool] = {}
        self.proper: dict[int, bool] = {}
        self.words = Remembered(MEMO_WORDS)

    @staticmethod
    def ends(tokens: dict[str, int]) -> dict[str, int]:
        return dict.fromkeys((t[i:] for t in tokens for i in range(len(t))), -1) | tokens

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces at one edge of a token while its merges run: (piece, rank at which it is merged)."""
        chain, ends = [(token, NEVER)], token
        while ends in self.parts:
            rank, *both = self.parts[ends]
            ends = both[side]
            chain.append((ends, rank))
        return chain[::-1]

    def follows(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of the two tokens: then both stay as they are."""
        known = self.fits.get((left, right))
        if known is None:
            a, b, i, j, known = self.edge(left, 1), self.edge(right, 0), 0, 0, True
            while known:
                (x, until_x), (y, until_y) = a[i], b[j]
                rank = self.pairs.get((x, y), (NEVER, 0))[0]
                # The leftmost of equal ranks goes first: the left token's own merge, then the border's.
                if rank < until_x and rank <= until_y and rank < NEVER:
                    known = False
                elif until_x == until_y == NEVER:
                    break
                elif until_x <= until_y:
                    i += 1
                else:
                    j += 1
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            self.fits[left, right] = known
        return known

    def is_proper(self, token: int) -> bool:
        """Whether the merges make this token out of its own characters."""
        known = self.proper.get(token)
        if known is None:
            if token not in self.parts:
                known = True
            else:
                _, a, b = self.parts[token]
                rank = self.parts[token][0]
                known = self.is_proper(a) and self.is_proper(b) and self._joined_at(a, b, rank)
            self.proper[token] = known
        return known

    def _joined_at(self, left: int, right: int, whole: int) -> bool:
        """Whether the first merge across the border is that of the two whole tokens."""
        a, b, i, j = self.edge(left, 1), self.edge(right, 0), 0, 0
        while True:
            (x, until_x), (y, until_y) = a[i], b[j]
            rank = self.pairs.get((x, y), (NEVER, 0))[0]
            if until_x == until_y == NEVER:
                return rank == whole
            if rank < until_x and rank <= until_y:
                return False
            if until_x <= until_y:
                i += 1
            else:
                j += 1

    def _state(self, word: str, end: int, ends: dict[str, int], last: list[int]) -> tuple[int, int]:
        """(last token, where it starts) of the first ``end`` characters."""
        fits, proper = self.fits, self.proper
        for start in range(end - 1, -1, -1):
            token = ends.get(word[start:end])
            if token is None:
                break
            if token < 0 or not (proper[token] if token in proper else self.is_proper(token)):
                continue
            if start == 0:
                return token, start
            fit = fits.get((last[start], token))
            if fit or fit is None and self.follows(last[start], token):
                return token, start
        raise ValueError(f"the vocabulary has no token for {word[end - 1]!r}")

    def encode(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Token ids of distinct words, given as the characters that stand for their bytes."""
        out: dict[str, list[int]] = {}
        path, last, starts = "", [0], [0]
        for word in sorted(words):
            stem, shared = word[:-1], 0
            for a, b in zip(path, stem):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], starts[shared + 1 :]
            for end in range(shared + 1, len(stem) + 1):
                token, start = self._state(stem, end, self.inner_ends, last)
                last.append(token)
                starts.append(start)
            token, at = self._state(word, len(word), self.final_ends, last)
            ids = [token]
            while at:
                ids.append(last[at])
                at = starts[at]
            out[word] = ids[::-1]
            path = stem
        return out

    def pieces(self, chunk: bytes) -> list[str | int]:
        """A chunk without blanks as words to encode and ids of special tokens."""
        if PLAIN.match(chunk) and b"<|" not in chunk:
            return ASCII_PIECES.findall(chunk.decode("ascii").lower())
        text, out = chunk.decode("utf-8"), []
        for part in self.at_special.split(text) if self.at_special else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                normal = self.library.normalizer.normalize_str(part)
                out += [x for x, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return out

    def chunk_ids(self, chunks: Iterable[bytes]) -> dict[bytes, list[int]]:
        """Token ids of distinct chunks: their words go through one trie."""
        cut = {c: self.pieces(c) for c in chunks}
        words = {w for ws in cut.values() for w in ws if isinstance(w, str)}
        known = self.words.take(words, self.encode)
        return {c: [i for w in ws for i in (known[w] if isinstance(w, str) else (w,))] for c, ws in cut.items()}

    def names(self) -> dict[int, str]:
        return {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}


def encoded_batches(
    path: str, batches: Iterator[pa.RecordBatch], text: str, remember: Callable[[PrefixEncoder], Callable[[list[int]], object]]
) -> Iterator[tuple[pa.RecordBatch, list[list]]]:
    """Each stretch of rows with, for each row, what ``remember`` keeps of its chunks in order.

    The vocabulary splits at blanks, and no merge crosses a blank, so a text is
    the sequence of its chunks between ``[\\x20\\x09-\\x0D]``. Long and short
    texts alike are read whole; a null text has no chunks.
    """
    encoder = PrefixEncoder(path)
    keep, chunks = remember(encoder), Remembered(MEMO_CHUNKS)
    gc.freeze()  # the vocabulary's tables are many objects and never garbage
    for batch in stretches(batches, text, STRETCH_BYTES):
        rows = [(x or b"").split() for x in batch.column(text).cast(pa.binary()).to_pylist()]
        known = chunks.take(set().union(*rows), lambda new: {c: keep(ids) for c, ids in encoder.chunk_ids(new).items()})
        yield batch, [[known[c] for c in row] for row in rows]


def encoded(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ids, decoded)``: token ids of each whole text, and the text decoded from them.

    One narrow pass: no row moves. Null and empty texts have no ids and decode
    to the empty text; rows may repeat; other columns are not read.
    """
    return _mapped(docs, path, key, text, "ids array<int>, decoded string", _ids_and_text)


def digests(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of the same ids and decoded texts."""
    return _mapped(docs, path, key, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", _sums)


def _mapped(docs: DataFrame, path: str, key: str, text: str, columns: str, make) -> DataFrame:
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        # Decoding without a decoder joins the tokens' own strings with blanks.
        def remember(encoder):
            names = encoder.names()
            return lambda ids: (" ".join(map(str, ids)), " ".join(names[i] for i in ids)) if ids else None

        for batch, found in encoded_batches(path, batches, "text", remember):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *make(found)], ["doc_id", *fields])

    fields = [c.split()[0] for c in columns.split(", ")]
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, {columns}")


def _ids_and_text(rows: list[list]) -> list[pa.Array]:
    ids = [[int(i) for x in row if x for i in x[0].split(" ")] for row in rows]
    return [pa.array(ids, pa.list_(pa.int32())), pa.array([" ".join(x[1] for x in row if x) for row in rows], pa.string())]


def _sums(rows: list[list]) -> list[pa.Array]:
    from hashlib import sha256

    counts, ids, texts = [], [], []
    for row in rows:
        row = [x for x in row if x]
        joined = " ".join([x[0] for x in row])
        counts.append(joined.count(" ") + 1 if joined else 0)
        ids.append(sha256(joined.encode()).hexdigest())
        texts.append(sha256(" ".join([x[1] for x in row]).encode()).hexdigest())
    return [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]


def id_bytes(ids: list[int]) -> bytes:
    """The ids as little-endian unsigned numbers of 32 bits."""
    return np.array(ids, "<u4").tobytes()
