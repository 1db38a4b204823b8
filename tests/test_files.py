"""Sources, sinks, user models and the streaming read, on small folders."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marginalia.functions import text as tx
from marginalia.operators import features as of
from marginalia.operators import metrics
from marginalia.operators import sequences as sq
from marginalia.operators import tagging as tg
from marginalia.operators import text as ot
from marginalia.plans import jobs
from marginalia.sinks import files as sink
from marginalia.sources import files as source
from marginalia.sources import listing
from marginalia.streaming.incremental import annotate_arrivals, arriving_documents


@pytest.fixture
def corpus(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.1.txt").write_text("Mr John has 12 fevers.\nNone")
    (folder / "b c+d%.txt").write_text("Né Paul")
    (folder / "blank.txt").write_text(" ")
    (folder / "x.xml").write_text(
        '<alto><Page><TextLine><String CONTENT="John"/><String CONTENT="x"/></TextLine></Page></alto>'
    )
    return str(folder)


def test_text_and_markup_documents(spark, corpus):
    docs = {r["doc_id"]: r["text"] for r in source.text_documents(spark, corpus).collect()}
    assert docs == {"a.1": "Mr John has 12 fevers.\nNone", "b c+d%": "Né Paul", "blank": " "}
    short = {r["doc_id"] for r in source.text_documents(spark, corpus, short_ids=True).collect()}
    assert short == {"a", "b c+d%", "blank"}
    pages = source.markup_documents(spark, corpus)
    entities = jobs.markup_job(pages).first()["entities"]
    assert [(e["text"], e["start"]) for e in entities] == [("John", 21)]


def test_finer_splits_without_shuffle_or_setting(spark, corpus):
    docs = source.text_documents(spark, corpus, min_partitions=3, keep_empty=False)
    assert 1 < docs.rdd.getNumPartitions() <= 3
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None
    assert "Exchange" not in docs._jdf.queryExecution().executedPlan().toString()
    # Files of zero length come from the listing, which the tasks make; nothing is joined or shuffled.
    plan = source.text_documents(spark, corpus)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" in plan and "BatchScan keys" in plan and "Exchange" not in plan and "LocalTableScan" not in plan
    assert source.text_documents(spark, corpus, min_partitions=3).count() == 3


def test_keys_where_the_folders_name_recurs(spark, tmp_path):
    for name in ("1.txt", "b/a/1.txt", "b/c/2.txt", "b.txt", "ab/3.txt", "_tmp/4.txt", "b/.5.txt", "bb/6.txt"):
        path = tmp_path / "a" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("Mr")
    (tmp_path / "a" / "b" / "empty.txt").write_text("")
    folder = str(tmp_path / "a")
    every = ["1", "ab/3", "b", "b/a/1", "b/c/2", "b/empty", "bb/6"]
    for root in (folder, f"file://{folder}", f"{folder}/"):
        assert sorted(r["doc_id"] for r in source.text_documents(spark, root, recursive=True).collect()) == every
        assert sorted(r["key"] for r in source.list_keys(spark, root).collect()) == sorted(f"{x}.txt" for x in every)
    listed = lambda **how: sorted(r["key"] for r in source.list_keys(spark, folder, **how).collect())
    assert listed(prefix="b") == ["b.txt", "b/a/1.txt", "b/c/2.txt", "b/empty.txt", "bb/6.txt"]
    assert listed(prefix="b/") == ["b/a/1.txt", "b/c/2.txt", "b/empty.txt"] == listed(prefix="b/", start_after="b/")
    assert listed(prefix="b/c/2") == ["b/c/2.txt"] and listed(prefix="x/") == []
    assert listed(start_after="b/a/1.txt") == ["b/c/2.txt", "b/empty.txt", "bb/6.txt"]
    relative = os.path.relpath(folder)
    assert sorted(r["doc_id"] for r in source.text_documents(spark, relative, recursive=True).collect()) == every


def test_listing_by_resuming_and_by_any_number_of_tasks(spark, tmp_path):
    names = [f"{a}/{b}/{n}.txt" for a in "abc" for b in ("x", "y", "xy") for n in range(30)] + [f"flat{n}" for n in range(40)]
    for name in names:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("")
    keys, after = [], ""
    while True:  # pages of 100 keys, each resumed after the one before
        page = [r["key"] for r in source.list_keys(spark, str(tmp_path), start_after=after).orderBy("key").limit(100).collect()]
        if not page:
            break
        keys += page
        after = page[-1]
    assert keys == sorted(names)
    for tasks in (1, 2, 5, 1000):
        options = {"path": str(tmp_path), "tasks": str(tasks), "prefix": "b/x"}
        reader = listing.KeyReader(options)
        parts = reader.partitions()
        assert sorted(k for p in parts for k, _, _ in reader.read(p)) == sorted(n for n in names if n.startswith("b/x"))
        assert len(parts) == len({p.below for p in parts}) and all(p.below.startswith("b/") for p in parts)


@pytest.mark.parametrize("size", [1, 700, 1 << 20])
def test_lines_of_a_file_of_many_splits(spark, tmp_path, size):
    texts = {
        "long": "".join(f"line {n} é\n" * (n % 3 + 1) for n in range(4000)), "open": "a\nb", "blank": "\n\n \n", "none": "",
        "cr": "x\r\ny\r\n", "wide": "w" * 5000 + "\nend\n",
    }
    folder = tmp_path / "in"
    folder.mkdir()
    for name, text in texts.items():
        (folder / f"{name}.txt").write_bytes(text.encode())
    found = {}
    size = max(size, 1 << 12) if size == 1 else size  # 4 kB, or the whole of a small file
    lines = source.numbered_lines(spark, str(folder), suffix=".txt", split_bytes=size)
    for r in lines.collect():
        found.setdefault(r["doc_id"], {})[r["line_no"]] = r["line"]
    for name, text in texts.items():
        want = text.split("\n")
        want = want[:-1] if want[-1] == "" else want
        assert found.get(name, {}) == dict(enumerate(want)), name
    if size < 1 << 20:
        assert lines.select(F.spark_partition_id()).distinct().count() > 8
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_stored_features_and_labels_of_many_splits(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "d.txt").write_text("".join(f"t{n} x y\n" for n in range(3000)))
    (tmp_path / "l.d").mkdir()
    (tmp_path / "l.d" / "d.txt").write_text("log\nlog\n" + "".join(f"L{n} \n" for n in range(3000)))
    whole = sq.align_labels(source.feature_tokens(spark, str(tmp_path / "f")), source.label_stream(spark, str(tmp_path / "l.d")))
    split = sq.align_labels(
        source.feature_tokens(spark, str(tmp_path / "f"), split_bytes=1000),
        source.label_stream(spark, str(tmp_path / "l.d"), split_bytes=1000),
    )
    rows = sorted(map(tuple, split.select("doc_id", "pos", "token", "label").collect()))
    assert rows == sorted(map(tuple, whole.select("doc_id", "pos", "token", "label").collect()))
    assert rows == [("d", n, f"t{n}", f"L{n}") for n in range(3000)]


def test_list_keys(spark, corpus):
    keys = source.list_keys(spark, corpus)
    assert {r["key"] for r in keys.collect()} == {"a.1.txt", "b c+d%.txt", "blank.txt", "x.xml"}
    assert [r["key"] for r in source.list_keys(spark, corpus, start_after="b", suffix=".txt").orderBy("key").collect()] == [
        "b c+d%.txt", "blank.txt",
    ]
    assert metrics.count_outputs(keys, "x").first()["outputs"] == 1
    assert [r["key"] for r in source.list_keys(spark, corpus, prefix="b").orderBy("key").collect()] == ["b c+d%.txt", "blank.txt"]
    assert source.list_keys(spark, corpus, prefix="[a]").count() == 0


def test_files_of_zero_length_and_equal_names(spark, tmp_path):
    for name, text in (("a/1.txt", "Mr One"), ("b/1.txt", "Mr Two"), ("b/é +%.txt", ""), ("c/x.y.txt", "")):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    folder = str(tmp_path / "in")
    docs = {r["doc_id"]: r["text"] for r in source.text_documents(spark, folder, recursive=True).collect()}
    assert docs == {"a/1": "Mr One", "b/1": "Mr Two", "b/é +%": "", "c/x.y": ""}
    flat = {r["doc_id"]: r["text"] for r in source.text_documents(spark, folder + "/b").collect()}
    assert flat == {"1": "Mr Two", "é +%": ""}
    keys = {r["key"]: r["length"] for r in source.list_keys(spark, folder).collect()}
    assert keys == {"a/1.txt": 6, "b/1.txt": 6, "b/é +%.txt": 0, "c/x.y.txt": 0}
    under = source.list_keys(spark, folder, prefix="b/")
    assert {r["key"] for r in under.collect()} == {"b/1.txt", "b/é +%.txt"}


def test_feature_lines_and_labels_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([("d1", "Mr NA null. 12 é x"), ("d2", "b")], "doc_id string, text string")
    words = spark.createDataFrame([("Mr",)], "word string")
    lemmas = spark.createDataFrame([("b", "bee")], "word string, lemma string")
    table = of.feature_table(ot.tokenize(docs), lexicon=words, lemmas=lemmas, stemmer=str.lower)
    assert table.columns[2:] == of.ft.FEATURE_ORDER
    out = str(tmp_path / "features")
    sink.write_feature_lines(table, out, per_document=True)
    lines = spark.read.text(out).filter("doc_id = 'd1'").collect()
    assert lines[0]["value"].split(" ")[:6] == ["Mr", "False", "False", "False", "True", "Mr"]

    stored = tmp_path / "stored"
    stored.mkdir()
    for name in ("d1", "d2"):
        rows = spark.read.text(out).filter(F.col("doc_id") == name).collect()
        (stored / f"{name}.txt").write_text("\n".join(r["value"] for r in rows) + "\n")
    tokens = source.feature_tokens(spark, str(stored))
    got = [r["token"] for r in tokens.filter("doc_id = 'd1'").orderBy("pos").collect()]
    assert got == ["Mr", "NA", "null", "12", "", "x"]

    logs = tmp_path / "labels"
    logs.mkdir()
    (logs / "d1.txt").write_text("log one\nlog two\nB-N \nI-N \nO \nB-D \nO \nO \n")
    (logs / "d2.txt").write_text("log one\nlog two\n")
    labels = source.label_stream(spark, str(logs))
    assert [r["label"] for r in labels.orderBy("pos").collect()] == ["B-N", "I-N", "O", "B-D", "O", "O"]
    found = sq.bio_entities(sq.token_offsets(sq.align_labels(tokens, labels)))
    assert sorted(map(tuple, found.collect())) == [("d1", "12", 11, 13, "D"), ("d1", "Mr NA", 0, 5, "N")]
    flags = {r["doc_id"]: (r["tokens"], r["labels"], r["mismatch"]) for r in metrics.label_diagnostics(tokens, labels).collect()}
    assert flags == {"d1": (6, 6, False), "d2": (1, 0, True)}


@pytest.mark.parametrize("each", [False, True])
def test_feature_lines_written_twice_are_one_copy(spark, tmp_path, each):
    texts = [(f"d{i}", " ".join(f"w{n} Mr" for n in range(i * 7 % 11))) for i in range(20)]
    docs = spark.createDataFrame(texts, "doc_id string, text string").repartition(3)
    words = spark.createDataFrame([("Mr",)], "word string")
    table = of.feature_table(
        ot.tokenize(docs), lexicon=words, lemmas=words.withColumn("lemma", F.lit("mister")), stemmer=str.lower
    )
    out = str(tmp_path / "lines")
    sink.write_feature_lines(table, out, run="a", per_document=each)
    sink.write_feature_lines(table, out, run="b", per_document=each)
    sink.write_feature_lines(table, out, run="a", per_document=each)

    def written():
        rows = spark.read.text(out).collect()
        if each:
            return sorted((r["run"], r["doc_id"], r["value"]) for r in rows)
        return sorted((r["run"], *r["value"].split("\t")) for r in rows)

    first = written()
    want = [(r["doc_id"], r["line"]) for r in table.select("doc_id", of.feature_line().alias("line")).collect()]
    assert first == sorted((run, *x) for run in "ab" for x in want) and len(want[0][1].split(" ")) == 19
    sink.write_feature_lines(table.filter("doc_id = 'd3'" if each else "true"), out, run="a", per_document=each)
    assert written() == first
    # A document's lines are in token order, in one file.
    for path in (tmp_path / "lines").rglob("part-*.txt"):
        seen = {}
        for x in path.read_text().splitlines():
            doc, line = (path.parent.name, x) if each else x.split("\t")
            seen.setdefault(doc, []).append(line.split(" ")[0])
        for tokens in seen.values():
            assert tokens[::2] == [f"w{n}" for n in range(len(tokens) // 2)]


def test_json_keeps_null_sections_and_empty_documents(spark, corpus, tmp_path):
    result = jobs.sentence_job(source.text_documents(spark, corpus))
    sink.write_json(result, str(tmp_path / "lines"))
    records = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "lines")).collect()]
    by_id = {r["doc_id"]: r["entities"] for r in records}
    assert by_id["blank"] == []
    assert by_id["b c+d%"][0] == {"text": "N  Paul", "start": 0, "end": 7, "type": "NAME", "section": None}
    sink.write_json(result, str(tmp_path / "each"), per_document=True)
    each = spark.read.text(str(tmp_path / "each")).filter("doc_id = 'a.1'").first()["value"]
    assert json.loads(each)[0]["text"] == "Mr John"
    assert '"section":null' in each


def test_incremental_write_is_idempotent(spark, corpus, tmp_path):
    out = str(tmp_path / "out")
    docs = source.text_documents(spark, corpus)
    for _ in range(2):
        sink.write_pending(docs, jobs.sentence_job, out)
        assert sorted(r["doc_id"] for r in sink.written_documents(spark, out).collect()) == ["a.1", "b c+d%", "blank"]


def test_failed_documents_are_kept_and_tried_again(spark, tmp_path):
    docs = spark.createDataFrame([("a", "Mr One"), ("b", "bad"), ("c", "short"), ("d", "")], "doc_id string, text string")
    out = str(tmp_path / "out")

    def job(healthy):
        def open_tagger():
            def tag(tokens):
                if not healthy and "bad" in tokens:
                    raise RuntimeError("cannot")
                return [] if not healthy and "short" in tokens else ["B-X"] * len(tokens)

            return tag

        return lambda d: jobs.token_job(d, open_tagger)

    def finished():
        return sorted(r["doc_id"] for r in sink.written_documents(spark, out).collect())

    assert sink.open_failures(spark, out).count() == 0
    sink.write_pending(docs, job(False), out)
    assert finished() == ["a", "d"]
    failures = {r["doc_id"]: r["error"] for r in sink.open_failures(spark, out).collect()}
    assert failures == {"b": "RuntimeError: cannot", "c": "ValueError: 0 labels for 1 elements"}
    for _ in range(2):
        sink.write_pending(docs, job(True), out)
        assert finished() == ["a", "b", "c", "d"]
        assert sink.open_failures(spark, out).count() == 0
    rows = spark.read.parquet(out).filter("doc_id = 'b'").collect()
    assert sorted((r["status"], r["entities"] is None) for r in rows) == [("error", True), ("ok", False)]


def test_stream_keeps_failures_apart(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "b c.txt").write_text("good")
    (folder / "x.txt").write_text("bad")

    def open_tagger():
        def tag(tokens):
            return [] if "bad" in tokens else ["O"] * len(tokens)

        return tag

    docs = arriving_documents(spark, str(folder))
    job = lambda d: jobs.token_job(d, open_tagger)
    annotate_arrivals(docs, job, out, checkpoint=str(tmp_path / "check")).awaitTermination()
    assert {(r["doc_id"], r["status"]) for r in spark.read.json(out).collect()} == {("b c", "ok"), ("x", "error")}


def test_run_table_grows(spark, tmp_path):
    out = str(tmp_path / "runs")
    for n in (3, 4):
        row = metrics.run_summary(
            spark.range(n), spark.range(2), start=datetime(2024, 1, 1), end=datetime(2024, 1, 2), instances=1
        )
        sink.append_run_summary(row, out)
    assert sorted(r["failed"] for r in spark.read.parquet(out).collect()) == [1, 2]


def test_one_failing_document_does_not_end_the_job(spark):
    docs = spark.createDataFrame([(1, "Good One"), (2, "bad"), (3, "")], "doc_id int, text string")

    def open_tagger():
        def tag(tokens):
            if "bad" in tokens:
                raise RuntimeError("cannot")
            return ["B-X"] * len(tokens)

        return tag

    result = {r["doc_id"]: r for r in jobs.token_job(docs, open_tagger).collect()}
    assert [e["text"] for e in result[1]["entities"]] == ["Good", "One"]
    assert (result[2]["status"], result[2]["error"], result[2]["entities"]) == ("error", "RuntimeError: cannot", [])
    assert (result[3]["status"], result[3]["error"]) == ("ok", None)


def test_sentence_model_sees_batches_of_fifty(spark):
    docs = spark.createDataFrame([(1, "A b. " * 120)], "doc_id int, text string")
    split = docs.select("doc_id", tx.sentences(tx.model_text("text")).alias("sentences"))

    def open_model():
        return lambda batch: [[(str(len(batch)), 0, 1, "N")] for _ in batch]

    sizes = [f["text"] for f in tg.tag_sentences(split, open_model).first()["found"]]
    assert len(sizes) == 120 and set(sizes) == {"50", "20"}


def test_sentence_batches_are_filled_across_documents(spark):
    texts = [(i, "A b. " * (i * 13 % 60 + 1)) for i in range(30)] + [(30, ""), (31, None)]
    docs = spark.createDataFrame(texts, "doc_id int, text string").coalesce(1)
    split = docs.select("doc_id", tx.sentences(tx.model_text("text")).alias("sentences"))
    total = sum(i * 13 % 60 + 2 for i in range(30)) + 1  # the rest behind the last cut is one, as is the empty text

    def open_model():
        calls = iter(range(10**6))

        def find(batch):
            call = next(calls)
            return [[(f"{call}:{len(batch)}", 0, 1, "N")] for _ in batch]

        return find

    rows = tg.tag_sentences(split, open_model, keep_sentences=False).collect()
    assert [r["doc_id"] for r in rows] == list(range(32)) and "sentences" not in rows[0].asDict()
    calls = [e["text"] for r in rows for e in r["found"]]
    sizes = split.select(F.size("sentences").alias("n")).agg(F.sum(F.greatest("n", F.lit(0)))).first()[0]
    assert len(calls) == sizes and abs(sizes - total) <= 30
    assert len(set(calls)) == -(-sizes // 50) and all(c.endswith(":50") for c in calls[: sizes // 50 * 50])
    assert all([e["sent_id"] for e in r["found"]] == list(range(len(r["found"]))) for r in rows)


def test_a_sentence_model_fails_by_document(spark):
    docs = spark.createDataFrame([(i, "Good one. " * 3 + ("Bad here. " if i % 4 == 1 else "End.")) for i in range(40)], "doc_id int, text string")

    def open_model():
        def find(batch):
            if any("Bad" in x for x in batch):
                raise ValueError("bad sentence")
            return [[(x.strip(), 0, len(x.strip()), "S")] for x in batch]

        return find

    rows = jobs.sentence_job(docs.coalesce(2), open_model).collect()
    assert {r["doc_id"] for r in rows if r["status"] == "error"} == {i for i in range(40) if i % 4 == 1}
    assert all(len(r["entities"]) == 4 for r in rows if r["status"] == "ok")
    assert all(r["entities"] == [] and r["error"] == "ValueError: bad sentence" for r in rows if r["status"] == "error")
    assert [(e["start"], e["end"]) for e in rows[0]["entities"]] == [(0, 9), (9, 18), (19, 28), (29, 33)]
    plan = jobs.sentence_job(docs, open_model)._jdf.queryExecution().executedPlan().toString()
    python = next(x for x in plan.splitlines() if "MapInArrow" in x)
    assert "text" not in python.split("run(")[1].split(")")[0]


def feature_docs(spark):
    texts = ["Mr 12 cats; naïve Cats", "", None, "12", "the " * 900 + "Mr", "naïve naive"]
    return spark.createDataFrame([(i, f"k{i}", t) for i, t in enumerate(texts)] + [(None, "k", "the")], "doc_id int, kept string, text string")


WORDS = {"Mr": (True, None, None), "cats": (True, "cat", "cat"), "naive": (False, "naïf", None), "nave": (False, "boat", "nav"), "naïve": (True, None, None)}


def word_tables(spark):
    def table(column, name):
        rows = [(w, v[column]) for w, v in WORDS.items() if v[column]]
        return spark.createDataFrame(rows * 2, f"word string, {name} {'boolean' if name == 'known' else 'string'}")

    return {"lexicon": table(0, "known"), "lemmas": table(1, "lemma"), "stems": table(2, "stem")}


@pytest.mark.parametrize("bound", [10**9, 0])
def test_feature_rows_reach_the_tagger(spark, bound):
    docs = feature_docs(spark).repartition(3)

    def open_tagger():
        return lambda seq: [f"B-{f['names']}|{f['ExistinDict']}|{f['Lemma']}|{f['Stem']}|{f['length']}|{list(f)[0]}" for f in seq]

    tagged = tg.tag_features(docs, open_tagger, keep=("kept",), broadcast_bytes=bound, **word_tables(spark))
    rows = {r["doc_id"]: r for r in tagged.collect()}
    assert len(rows) == 7 and all(r["status"] == "ok" for r in rows.values())
    want = {}
    for r in docs.collect():
        tokens = (r["text"] or "").replace(";", " ").split()
        want[r["doc_id"]] = []
        for t in tokens:
            name = t.encode("ascii", "ignore").decode()
            known, lemma, stem = WORDS.get(t, (False, None, None))[0], *WORDS.get(name, (False, None, None))[1:]
            want[r["doc_id"]].append(f"B-{name}|{known}|{lemma or name}|{stem or name}|{len(name)}|names")
        assert rows[r["doc_id"]]["kept"] == r["kept"]
    assert {k: r["labels"] for k, r in rows.items()} == want
    assert rows[0]["tokens"] == ["Mr", "12", "cats", "nave", "Cats"] and rows[1]["tokens"] == []


@pytest.mark.parametrize("bound", [10**9, 0])
def test_a_feature_tagger_that_fails(spark, bound):
    def open_tagger():
        def tag(seq):
            if len(seq) > 100:
                raise ValueError("too long")
            return ["O"] * (len(seq) - (len(seq) == 1))

        return tag

    rows = {r["doc_id"]: r for r in tg.tag_features(feature_docs(spark), open_tagger, broadcast_bytes=bound, **word_tables(spark)).collect()}
    assert rows[4]["error"] == "ValueError: too long" and rows[4]["labels"] is None and len(rows[4]["tokens"]) == 901
    assert rows[3]["error"] == "ValueError: 0 labels for 1 elements" and rows[0]["status"] == "ok"


def test_a_stemmer_in_the_features(spark):
    tables = word_tables(spark)
    del tables["stems"]

    def open_tagger():
        return lambda seq: [f["Stem"] for f in seq]

    tagged = tg.tag_features(feature_docs(spark).filter("doc_id = 0"), open_tagger, stemmer=str.upper, **tables)
    assert tagged.first()["labels"] == ["MR", "12", "CATS", "NAVE", "CATS"]


def test_feature_tagging_shuffles_lookups_only(spark):
    from marginalia.plans import catalog

    text = catalog.feature_tagger(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    documents = text.split("BroadcastExchange")[0]
    assert not [x for x in documents.splitlines() if "Exchange " in x and "RoundRobin" not in x]


def test_chunk_model(spark):
    docs = spark.createDataFrame([(1, "a bb - c d")], "doc_id int, text string")
    labels = dict(zip("a bb - c d".split(), "X X X X Y".split()))

    def open_model():
        return lambda text: [(t, labels[t]) for t in text.split(" ")]

    entities = jobs.chunk_job(docs, open_model).first()["entities"]
    assert [(e["text"], e["start"], e["end"], e["type"]) for e in entities] == [
        ("a bb", 0, 4, "X"), ("c", 6, 7, "X"), ("d", 8, 9, "Y"),
    ]


def test_arriving_documents_are_annotated_once(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    folder.mkdir()
    for name, text in (("one", "Mr John"), ("two", "none")):
        (folder / f"{name}.txt").write_text(text + "\nmore")
        docs = arriving_documents(spark, str(folder))
        annotate_arrivals(docs, jobs.token_job, out, checkpoint=checkpoint).awaitTermination()
    written = [json.loads(r["value"]) for r in spark.read.text(out).collect()]
    assert sorted((r["doc_id"], len(r["entities"])) for r in written) == [("one", 1), ("two", 0)]
