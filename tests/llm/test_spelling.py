"""Bytes of words are told from the text before them, over the word's start."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.llm import lm_score


def block(texts):
    words, stream, sizes = {}, [], []
    for text in texts:
        tokens = [*text.split(), b""]
        stream += [words.setdefault(w, len(words)) for w in tokens]
        sizes.append(len(tokens))
    return np.array(stream, np.int32), np.array(sizes, np.int32), list(words)


def test_heads_by_the_bytes_of_the_text():
    rnd = random.Random(3)
    texts = [b"", b"a", b"a bc d", b"abcdefgh i\xc3\xa9\x00 " * 3]
    texts += [b" ".join(bytes(rnd.choices(b"ab\xff\x00", k=rnd.randint(1, 8))) for _ in range(rnd.randint(0, 30))) for _ in range(40)]
    stream, sizes, words = block(texts)
    heads = lm_score.HeadCodes(stream, sizes, words)
    found = [{} for _ in stream]
    for n in range(lm_score.HEAD):
        own, codes = heads.codes(n)
        five = lm_score.unscrambled(codes >> np.uint64(8)).tolist()
        of = dict(zip(own.tolist(), zip((x.to_bytes(5, "big") for x in five), (codes & np.uint64(255)).tolist())))
        for at, unit in enumerate(heads.units.tolist()):
            if unit in of:
                found[at][n] = of[unit]
    at = 0
    for text in texts:
        tokens, past = [*text.split(), b""], b"\n" * 5
        for token in tokens:
            spelled = token + b" "
            whole = past + spelled
            assert found[at] == {n: (whole[len(past) + n - 5 : len(past) + n], byte) for n, byte in enumerate(spelled[:5])}
            past, at = whole, at + 1
    assert at == len(stream) and len(heads.tail) < len(stream)


@pytest.mark.parametrize("five", [b"\n\n\n\n\n", b"the a", b"e ab ", b" word", b"\xc3\xa9 \x00z"])
def test_probabilities_of_the_byte_behind_five_sum_to_one(five):
    rnd = np.random.default_rng(2)
    settings = lm_score.Settings(bits=10)
    mix = lm_score.Mixer(rnd.normal(0.2, 0.3, (lm_score.GATES, lm_score.INPUTS)), rnd.uniform(1, 5, (256, lm_score.STEPS)), np.full((256, lm_score.STEPS), 6.0))
    every = rnd.integers(0, 9, 2 << settings.bits)
    ones = rnd.integers(0, every + 1)
    context = lm_score.scrambled(np.array([int.from_bytes(five, "big")], np.uint64)) << np.uint64(8)
    rows = lm_score.Heads(context + np.arange(256, dtype=np.uint64), rnd.integers(0, 5, 256), settings.bits)
    total = 10 ** mix.logs(rows, every, ones, 0, settings)
    assert len(set(total)) > 100 and total.sum() == pytest.approx(1)


def test_heads_and_words_have_one_hash():
    """A context of bytes is the same slot whether a head or a word's rest asks for it."""
    word = b"abcdefghij"
    whole = lm_score.Bits([word], 16)
    at = [lm_score.unscrambled(lm_score.scrambled(np.array([int.from_bytes(x, "big")], np.uint64))) for x in (b"x yza", b"y abc")]
    assert [int(x[0]).to_bytes(5, "big") for x in at] == [b"x yza", b"y abc"]
    five = lm_score.scrambled(np.array([int.from_bytes(b"y abc", "big")], np.uint64))
    head = lm_score.Heads(five << np.uint64(8) | np.uint64(ord("d")), np.ones(1, np.int64), 16)
    for bit in range(8):
        node, value, slots = whole.slots(bit)
        one, of, found = head.slots(bit)
        assert (node[3], value[3]) == (one[0], of[0])
        assert [int(found[n][0]) for n in (0, 1, 2, 3)] == [int(slots[n][3]) for n in (0, 1, 2, 4)]


def test_a_word_is_told_from_the_text_before_it(spark):
    """New words begin as those did that followed the word before: the same words the other way round score less."""
    rnd = random.Random(5)

    def word(first):
        return first + "".join(rnd.choices("aeiou", k=9))

    rows = [(i, f"left {word('b')} right {word('k')}", True) for i in range(200)]
    new = [(word("b"), word("k")) for _ in range(10)]
    rows += [(1000 + i, f"left {b} right {k}", False) for i, (b, k) in enumerate(new)]
    rows += [(2000 + i, f"left {k} right {b}", False) for i, (b, k) in enumerate(new)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    out = lm_score.scores(docs, F.col("learn"), settings=lm_score.Settings(bits=14, range_tokens=300, lane_words=100, common=5))
    of = {r["doc_id"]: r["score"] for r in out.collect()}
    assert all(of[1000 + i] > of[2000 + i] + 1 for i in range(10))
