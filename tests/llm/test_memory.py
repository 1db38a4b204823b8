"""What a task holds at once: a carried text is sent once, and alignment keeps its arrays apart."""

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from marginalia.llm import common, quality, token_align

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("columns", ["doc_id long, text string, lang string", "lang string, TEXT string, doc_id long"])
def test_a_carried_text_is_sent_to_a_task_once(spark, columns):
    rows = {"doc_id": 5, "lang": "en", "text": "Some words are here."}
    names = [c.split()[0] for c in columns.split(", ")]
    docs = spark.createDataFrame([tuple(rows[n.lower()] for n in names), tuple({**rows, "text": None}[n.lower()] for n in names)], columns)
    for stage in (corpus_pipeline.quality_classifier, corpus_pipeline.language_id):
        kept = stage(spark, docs, SF)
        assert "__text" not in kept._jdf.queryExecution().optimizedPlan().toString()
        assert kept.columns == names


def test_scores_of_a_carried_text_are_the_same(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, ""), (4, "é 1 2 and more")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (4, 0)], "doc_id long, quality int")
    whole = corpus_pipeline._carried(docs)
    plain = quality.scores(docs, labels, extra=whole).collect()
    assert quality.scores(docs, labels, extra=whole, within=("_document", 1)).collect() == plain


def test_text_within_follows_slices_and_nulls():
    rows = pa.array([{"a": 1, "t": "x"}, {"a": 2, "t": None}, {"a": 3, "t": "é"}])
    batch = pa.RecordBatch.from_arrays([rows], ["d"]).slice(1)
    (found,) = common.with_text(iter([batch]), "__text", ("d", 1))
    assert found.column("__text").to_pylist() == [None, "é".encode()]


def test_digests_and_links_of_rows_without_groups():
    none = (np.zeros(0, np.int64),) * 4
    ids, starts = np.zeros(0, np.int32), np.zeros(3, np.int64)
    assert token_align.group_digests(ids, ids, none, starts) == ["", ""]
    assert [len(x) for x in token_align.links_by_row(ids, ids, none, starts)] == [0, 0, 0]


def test_batches_of_whole_texts_are_small(spark):
    docs = spark.createDataFrame([(n, "word " * 400) for n in range(4_000)], "doc_id long, text string").coalesce(1)
    before = spark.conf.get(common.BATCH_LIMIT, None)
    most = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["bytes"])

    spark.conf.unset(common.BATCH_LIMIT)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    try:
        corpus_pipeline.language_id(spark, docs.selectExpr("*", "'en' AS lang"), SF)
        found = [r["bytes"] for r in docs.mapInArrow(sizes, "bytes long").collect()]
        assert sum(found) > 8_000_000 and max(found) < 5_000_000
        spark.conf.set(common.BATCH_LIMIT, "1000000")
        common.small_batches(spark)
        assert spark.conf.get(common.BATCH_LIMIT) == "1000000"
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
        spark.conf.unset(common.BATCH_LIMIT) if before is None else spark.conf.set(common.BATCH_LIMIT, before)


def test_a_task_gives_back_unused_memory_at_its_end(monkeypatch):
    class Pool:
        calls = 0

        def release_unused(self):
            self.calls += 1

    pool = Pool()
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: pool)
    run = common.released(lambda batches: (b + 1 for b in batches))(iter([1, 2]))
    assert next(run) == 2 and pool.calls == 0
    assert list(run) == [3] and pool.calls == 1
