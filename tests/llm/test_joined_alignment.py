"""New chunks are learned many in one call of each library, with the tokens of each."""

import pyarrow as pa
import pytest

from marginalia.llm import queries, token_align

BYTES, PIECES = queries.byte_vocabulary(), queries.piece_vocabulary()
ODD = [
    "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "▁", "a▁b", " ", "a b", "​", "﻿x", "᠎", "　",
    "\n", "a\nb", "\t", "\x00", "é", "́", "각", "하", "ﬁ", "½", "\U0001f600‍", "漢字", "", "don't", "x's.", "A1b2",
]


def tokens(chunks, names):
    number = chunks.numbers(names)
    return [
        (chunks.a_ids.take(number[n : n + 1])[0].tolist(), chunks.b_ids.take(number[n : n + 1])[0].tolist(), bool(chunks.whole[number[n]]))
        for n in range(len(names))
    ]


@pytest.fixture(scope="module")
def alone():
    found = token_align.Chunks(BYTES, PIECES)
    found.learn = found.learn_each
    return found


def test_tokens_of_joined_chunks_are_those_of_each(alone):
    plain = [f"w{n}ord{'s,' * (n % 3)}" for n in range(300)] + ["é" * n + "lle" for n in range(1, 40)]
    for names in (plain, plain + ODD, *([x, "plain", "été", "words"] for x in ODD)):
        assert tokens(token_align.Chunks(BYTES, PIECES) if len(names) > 9 else fresh(), names) == tokens(alone, names)


def fresh(kept=[]):  # noqa: B006
    """Vocabularies that have learned nothing, without opening them each time."""
    if not kept:
        kept.append(token_align.Chunks(BYTES, PIECES))
    kept[0].number = {}
    kept[0].forget()
    return kept[0]


def test_few_calls_for_many_words(monkeypatch):
    chunks, calls = token_align.Chunks(BYTES, PIECES), []
    library = chunks.a

    class Counted:
        def encode_batch_fast(self, texts, **more):
            calls.append(len(texts))
            return library.encode_batch_fast(texts, **more)

    monkeypatch.setattr(chunks, "a", Counted())
    chunks.numbers([f"word{n}" for n in range(5_000)] + [f"é{n}" for n in range(5_000)])
    assert calls == [1] * 10


def test_tasks_of_a_worker_share_what_is_learned(spark, monkeypatch):
    batch = pa.RecordBatch.from_arrays([pa.array(["One text and one more.", None])], ["_text_of_row"])
    docs = spark.createDataFrame([("One text and one more.",)], "text string")
    taken = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: taken.append(run) or self)
    token_align.alignments(docs, BYTES, PIECES)
    token_align.opened.cache_clear()
    first, second = (next(taken[0](iter([batch]))).to_pylist() for _ in range(2))
    assert first == second and token_align.opened.cache_info().hits == 1
