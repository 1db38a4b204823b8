"""A user's stemmer is called once for a word, and a batch costs what it holds."""

import time

import pandas as pd

from marginalia.operators import features as of


def test_a_stem_does_not_cost_what_is_remembered(spark):
    """Small batches after a large one: each looks up its own words only."""
    apply = of.word_function(str.upper).func
    large = pd.Series([f"w{n}" for n in range(150_000)])
    begun = time.monotonic()
    found = list(apply(iter([large] + [pd.Series(["w1", None, "w2", "w1"])] * 300)))
    assert time.monotonic() - begun < 5
    assert found[0][149_999] == "W149999" and list(found[-1]) == ["W1", None, "W2", "W1"]


def test_a_stemmer_starts_afresh_beyond_its_bound(spark, monkeypatch):
    monkeypatch.setattr(of, "MEMO_WORDS", 2)
    batches = [pd.Series(["a", "b"]), pd.Series(["b", "c"]), pd.Series(["a", "b", "c", None])]
    assert [list(s) for s in of.word_function(str.upper).func(iter(batches))] == [["A", "B"], ["B", "C"], ["A", "B", "C", None]]
