"""Many chunks are encoded in one call of the library, with the ids of each."""

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from marginalia.llm import packing

WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "don't", "x's.", "A1b2", "<|endoftext|>", "a<|endoftext|>b", "<|ENDOFTEXT|>", "<|", "H̱", "́a", "İİ", "K",
    " ", "\u0085", "a\u0085b", " ", "a　b", "\x1c", "a\x1fb", "\x00", "\x7f", "᠎", "​", "﻿a", "漢字",
    "\U0001f600‍", "١٢", "½", "été", "Σς", "ẞﬁ", "각가", "क़",
]


def expected(texts):
    library = Tokenizer.from_file(WORDS)
    library.no_truncation()
    library.no_padding()
    return [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_of_joined_chunks_are_those_of_each():
    plain = [f"w{n}ord{'s,' * (n % 3)}" for n in range(300)] + ["é" * n + "lle" for n in range(1, 40)]
    for chunks in (plain, ODD, plain + ODD, *([x, "plain", "été"] for x in ODD)):
        ids = packing.ChunkIds(WORDS).ids([c.encode() for c in chunks])
        assert [np.frombuffer(ids[c.encode()], "<u4").tolist() for c in chunks] == expected(chunks)


def test_few_calls_for_many_words(monkeypatch):
    encoder = packing.ChunkIds(WORDS)
    calls = []

    class Counted:
        normalizer = encoder.library.normalizer

        def encode_batch_fast(self, texts, **more):
            calls.append(len(texts))
            return library.encode_batch_fast(texts, **more)

    library = encoder.library
    monkeypatch.setattr(encoder, "library", Counted())
    encoder.ids([f"word{n}".encode() for n in range(10_000)] + [f"é{n}".encode() for n in range(10_000)])
    assert calls == [1] * 10


def test_rows_have_the_ids_of_their_whole_texts():
    texts = [None, "", " \n\t", "The END. the end", "a <|endoftext|> B", *(f"Go {x} on\n{x}" for x in ODD), " ".join(ODD)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    for _ in range(2):
        found = [ids for _, rows in packing.row_ids(WORDS, iter([batch]), "text") for ids in rows]
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == expected([t or "" for t in texts])


def test_plain_chunks_are_not_normalised(monkeypatch):
    encoder = packing.ChunkIds(WORDS)
    library, seen = encoder.library, []

    class Watched:
        def __setattr__(self, name, value):
            setattr(library, name, value)

        def encode_batch_fast(self, texts, **more):
            seen.append((library.normalizer is None, texts[0].isascii()))
            return library.encode_batch_fast(texts, **more)

    monkeypatch.setattr(encoder, "library", Watched())
    chunks = ["plain", "Upper", "été", "Σς", "x's.", "a\x1fb"]
    for _ in range(2):
        ids, first, count = encoder.table(pa.array(["", *chunks]))
        assert [ids[x : x + n].tolist() for x, n in zip(first, count)] == [[], *expected(chunks)]
    assert encoder.table(pa.array(["plain", "Upper"]))[2].tolist() == [len(x) for x in expected(["plain", "Upper"])]
    assert seen[-1] == (True, True) and (False, False) in seen


def test_ids_do_not_depend_on_batches(monkeypatch):
    texts = ["The END. the end", None, "one é two", "", "a <|endoftext|> B", "the end of one"] * 5
    whole = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    for limit in (1, 40, 1_000_000):
        monkeypatch.setattr(packing, "ENCODED_BYTES", limit)
        batches = [whole.slice(at, 4) for at in range(0, len(texts), 4)]
        found = [ids for _, rows in packing.row_ids(WORDS, iter(batches), "text") for ids in rows]
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == expected([t or "" for t in texts])
