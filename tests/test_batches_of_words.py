"""Python workers hold few objects at once, and do the work of a word once."""

import pyarrow as pa
import pytest

from marginalia.operators import tagging as tg


def test_documents_become_objects_in_slices_of_bounded_tokens(monkeypatch):
    monkeypatch.setattr(tg, "HELD", 10)
    values = [["t"] * n for n in (3, 4, 30, 0, 1)] + [None] + [["t"] * 9, ["t"] * 2]
    batch = pa.RecordBatch.from_pydict({"id": list(range(8)), "tokens": pa.array(values, pa.list_(pa.string()))})
    parts = list(tg._small(iter([batch]), "tokens"))
    assert [p.column("id").to_pylist() for p in parts] == [[0, 1], [2], [3, 4, 5], [6], [7]]
    assert sum((p.column("tokens").to_pylist() for p in parts), []) == values


def test_every_document_keeps_its_row_across_slices(spark, monkeypatch):
    monkeypatch.setattr(tg, "HELD", 5)
    docs = spark.createDataFrame([(n, None if n == 4 else ["a"] * n) for n in range(9)], "id long, tokens array<string>").coalesce(1)

    def open_tagger():
        def tag(tokens):
            if len(tokens) == 3:
                raise ValueError("three")
            return ["O"] * len(tokens)

        return tag

    rows = tg.tag_sequences(docs, open_tagger).collect()
    assert [r["id"] for r in rows] == list(range(9))
    assert [None if r["labels"] is None else len(r["labels"]) for r in rows] == [0, 1, 2, None, None, 5, 6, 7, 8]
    assert rows[3]["error"] == "ValueError: three" and rows[4]["status"] == "error"


def feature_batch(rows):
    kind = pa.schema([
        ("_head", pa.struct([("doc_id", pa.int64())])), ("_raw", pa.list_(pa.string())), ("token", pa.string()),
        ("_feature", pa.struct([("names", pa.string()), ("made", pa.int64())])),
    ])
    return pa.RecordBatch.from_pylist([
        {"_head": None if d is None else {"doc_id": d}, "_raw": raw, "token": t, "_feature": {"names": t, "made": n}}
        for n, (d, raw, t) in enumerate(rows)
    ], kind)


def test_words_of_a_document_come_once_and_give_a_copy_for_each_token(monkeypatch):
    for bound in (1, 50_000):
        monkeypatch.setattr(tg, "MEMO_FEATURES", bound)
        first = feature_batch([(1, ["a", "b", "a"], "a"), (None, None, "b"), (2, [], None), (3, ["b", "c", "d", "b"], "b"), (None, None, "c")])
        second = feature_batch([(None, None, "d"), (4, ["a"], "a")])
        found = list(tg._streamed(iter([first, second])))
        assert [(h["doc_id"], [f["names"] for f in fs]) for h, fs in found] == [(1, ["a", "b", "a"]), (2, []), (3, ["b", "c", "d", "b"]), (4, ["a"])]
        one = found[0][1]
        one[0]["names"] = "changed by the tagger"
        assert one[2]["names"] == "a" and found[3][1][0]["names"] == "a"


def test_no_batch_gives_no_document():
    assert list(tg._streamed(iter([]))) == []


def test_words_are_rows_without_the_tokens_of_their_document(spark):
    """The tokens would be copied for each distinct word of a document, a square of its length."""
    from marginalia.plans import catalog

    plan = catalog.feature_tagger(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    made = [x for x in plan.split("BroadcastExchange")[0].splitlines() if "Generate " in x and "token" in x]
    assert len(made) == 1 and made[0].rstrip().endswith("]") and "), false, [_row#" in made[0]


@pytest.mark.parametrize("values", [
    pa.array([None, "a", "\u00e9\x00"]), pa.array([], pa.string()), pa.array([1, 2], pa.int32()), pa.array([1, None]), pa.array([True, False]),
    pa.array([True, None]), pa.array([1.5, 2.0]), pa.array([None, 0.5]), pa.array([["a"], None, [], ["b", None], ["x"]])[1:4], pa.array([None]),
    pa.array([], pa.list_(pa.string())),
])
def test_columns_become_the_same_objects(values):
    found, want = tg._objects(values), values.to_pylist()
    assert found == want and [type(x) for x in found] == [type(x) for x in want]


def test_long_documents_of_many_words(spark):
    words = [f"w{n}" for n in range(12_000)]
    docs = spark.createDataFrame([(1, " ".join([*words, "W1", *words])), (2, "."), (3, None), (4, "w1 w1")], "doc_id long, text string").coalesce(1)
    empty = spark.createDataFrame([], "word string, lemma string")
    tagged = tg.tag_features(docs, lambda: lambda fs: [f"{f['names']}/{f['Lowercase']}" for f in fs], lexicon=empty, lemmas=empty)
    rows = {r["doc_id"]: (r["tokens"], r["labels"], r["status"]) for r in tagged.collect()}
    tokens = [*words, "W1", *words]
    assert rows[1] == (tokens, [f"{t}/{t.lower()}" for t in tokens], "ok")
    assert rows[2] == ([], [], "ok") == rows[3] and rows[4] == (["w1", "w1"], ["w1/w1"] * 2, "ok")
