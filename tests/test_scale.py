"""Ways that only matter at scale give the same rows as the plain ways."""

import bisect
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marginalia.functions import sequence as fs
from marginalia.functions import spans as sp
from marginalia.operators import assertion, batching, features, lookup, metrics
from marginalia.operators import sequences as sq


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def ints(values):
    return F.array(*[F.lit(v) for v in values]).cast("array<int>")


@pytest.mark.parametrize("n", [0, 1, 2, 5, 16, 17, 100, 331])
def test_running_total(value, n):
    values = [random.Random(n).randrange(9) for _ in range(n)]
    assert value(fs.running_total(ints(values))) == [sum(values[:i]) for i in range(n)]


@pytest.mark.parametrize("pieces", [[], [""], ["a"], ["ab", "", "c"], ["a", fs.MARK, "b"], ["é☃", "x" * 40, ""]])
@pytest.mark.parametrize("gap", [0, 1])
def test_starts(value, pieces, gap):
    column = F.array(*[F.lit(p) for p in pieces]).cast("array<string>")
    assert value(fs.starts(column, gap)) == [sum(len(p) + gap for p in pieces[:i]) for i in range(len(pieces))]


def test_starts_of_long_texts(value, monkeypatch):
    monkeypatch.setattr(fs, "MARKED_CHARS", 5)
    pieces = ["word"] * 30
    assert value(fs.starts(F.array(*[F.lit(p) for p in pieces]), 1)) == [5 * i for i in range(30)]


def test_counts_up_to(value):
    rng = random.Random(1)
    marks, points = sorted(rng.choices(range(50), k=30)), rng.choices(range(60), k=25)
    expected = [bisect.bisect_right(marks, p) for p in points]
    assert value(fs.counts_up_to(ints(points), ints(marks))) == expected
    assert value(fs.counts_up_to(ints(points), ints([]))) == [0] * 25
    assert value(fs.counts_up_to(ints([]), ints(marks))) == []


def sequence_table(spark, label):
    """One key owns a third of all rows."""
    rng = random.Random(3)
    data = [(0, i, label(rng)) for i in range(400)]
    for key in range(1, 30):
        data += [(key, i, label(rng)) for i in range(rng.randrange(60))]
    rng.shuffle(data)
    return spark.createDataFrame(data, "doc_id int, pos int, label string")


@pytest.mark.parametrize("size", [1, 3, 64, 1000])
def test_chunked_sums_and_carries(spark, size):
    df = sequence_table(spark, lambda r: r.choice(["H", None, None, "x"]))
    chunk = sq.position_chunk("pos", size)
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    args = {"key": "doc_id", "order": ["pos"], "chunk": chunk}
    plain = df.withColumn("out", F.coalesce(F.sum("pos").over(w), F.lit(0)))
    assert rows(sq.running_sum(df, F.col("pos"), "out", **args)) == rows(plain)
    plain = df.withColumn("out", F.last("label", ignorenulls=True).over(w))
    assert rows(sq.carry_forward(df, F.col("label"), "out", **args)) == rows(plain)


@pytest.mark.parametrize("size", [1, 3, 64, 1000])
def test_chunked_runs(spark, size):
    df = sequence_table(spark, lambda r: r.choice("aaaaab"))
    w = Window.partitionBy("doc_id").orderBy("pos")
    flagged = df.withColumn("new", (~F.col("label").eqNullSafe(F.lag("label").over(w))).cast("int"))
    runs = flagged.withColumn("run", F.sum("new").over(w)).groupBy("doc_id", "label", "run")
    plain = runs.agg(F.min("pos"), F.max("pos"), F.count("*")).drop("run")
    got = sq.runs(df, "label", key="doc_id", order=["pos"], chunk=sq.position_chunk("pos", size))
    assert rows(got.select("doc_id", "label", "first.pos", "last.pos", "rows")) == rows(plain)


@pytest.mark.parametrize("size", [1, 3, 40, 1000])
def test_measured_chunks(spark, monkeypatch, size):
    monkeypatch.setattr(sq, "CHUNK_ROWS", size)
    df = sequence_table(spark, lambda r: r.choice(["H", None, "x"])).withColumn("at", F.expr("timestamp_seconds(pos * 7)"))
    extra = spark.createDataFrame([(None, i, "H" if i % 9 else None) for i in range(70)], "doc_id int, pos int, label string")
    df = df.unionByName(extra.withColumn("at", F.expr("timestamp_seconds(pos)")))
    df = df.withColumn("at", F.when((F.col("doc_id") == 2) & (F.col("pos") < 9), F.lit(None)).otherwise(F.col("at")))
    chunked = sq.with_chunks(df, "doc_id", ["at"], None)
    if size == 40:
        sizes = {(r["doc_id"], r["_chunk"]): r["count"] for r in chunked.groupBy("doc_id", "_chunk").count().collect()}
        assert max(sizes.values()) <= 60 and len([k for k in sizes if k[0] == 0]) >= 9 and len([k for k in sizes if k[0] is None]) >= 2
        falling = Window.partitionBy("doc_id").orderBy("at", "pos")
        assert chunked.withColumn("fell", F.col("_chunk") < F.lag("_chunk").over(falling)).filter("fell").isEmpty()
    w = Window.partitionBy("doc_id").orderBy("at", "pos")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    args = {"key": "doc_id", "order": ["at", "pos"]}
    plain = df.withColumn("out", F.last("label", ignorenulls=True).over(before))
    assert rows(sq.carry_forward(df, F.col("label"), "out", **args)) == rows(plain)
    flagged = df.withColumn("new", (~F.col("label").eqNullSafe(F.lag("label").over(w)) | (F.row_number().over(w) == 1)).cast("int"))
    plain = flagged.withColumn("run", F.sum("new").over(w)).groupBy("doc_id", "label", "run").agg(F.min("pos"), F.max("pos"), F.count("*"))
    got = sq.runs(df, "label", **args).select("doc_id", "label", "first.pos", "last.pos", "rows")
    assert rows(got) == rows(plain.drop("run"))


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_row_decode_equals_array_decode(spark, size):
    labels = ["O", "B-X", "I-X", "I-Y", "I-X", "B-Y"]
    df = sequence_table(spark, lambda r: r.choice(labels)).withColumn("token", F.concat(F.lit("t"), "pos"))
    offsets = sq.token_offsets(df, chunk=sq.position_chunk("pos", size))
    by_rows = sq.bio_entities(offsets, chunk=sq.position_chunk("pos", size))
    arrays = df.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", "token", "label"))).alias("a"))
    spans = sp.bio_spans(F.col("a.token"), F.col("a.label"))
    by_arrays = arrays.select("doc_id", F.explode(spans).alias("e")).select("doc_id", "e.*")
    assert rows(by_rows) == rows(by_arrays)


def test_lookup_beyond_the_broadcast_bound(spark):
    tokens = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("pos"),
        F.when(F.col("id") % 3 == 0, "the").otherwise(F.concat(F.lit("w"), F.col("id") % 50)).alias("token"),
    )
    lexicon = spark.createDataFrame([("the",), ("the",), ("w7",), ("w20",)], "word string")
    small = features.in_lexicon(tokens, lexicon)
    large = features.in_lexicon(tokens, lexicon, broadcast_bytes=0)
    assert "BroadcastHashJoin" in plan(small)
    assert rows(small) == rows(large) and small.count() == 3000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "_salt" in plan(large)
        assert rows(features.in_lexicon(tokens, lexicon, broadcast_bytes=0)) == rows(small)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_word_is_spread_evenly(spark):
    """A word that is a third of all tokens, and tokens without a word, over 8 tasks."""
    token = F.when(F.col("id") % 3 == 0, "the").when(F.col("id") % 3 == 1, F.concat(F.lit("w"), F.col("id") % 997))
    tokens = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit(0).alias("pos"), token.alias("token"))
    table = spark.createDataFrame([("the", "THE"), ("w7", "SEVEN"), (None, "none")], "word string, form string")
    args = {"word": "word", "salt_by": ["doc_id", "pos"]}
    keep = {n: spark.conf.get(n) for n in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert dict(lookup.hot_keys(tokens, "token", 8)) == {"the": 22, None: 22}
        spread = lookup.lookup(tokens, table, F.col("token"), broadcast_bytes=0, **args)
        sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 1.6 * 60_000 / 8
        assert rows(spread) == rows(lookup.lookup(tokens, table, F.col("token"), **args))
        even = tokens.withColumn("token", F.concat(F.lit("w"), F.col("doc_id") % 997))
        assert lookup.hot_keys(even, "token", 8) == []
        assert "_salt" not in plan(lookup.lookup(even, table, F.col("token"), broadcast_bytes=0, **args))
    finally:
        for name, value in keep.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("bound", [lookup.BROADCAST_BYTES, 0])
def test_cues_of_a_table_are_those_of_a_list(spark, bound):
    from marginalia.plans import catalog, jobs

    docs = catalog.documents(spark, "/root/testdata/sf0.001")
    more = [("the the", "pre"), ("is  the", "pseudo"), ("of the and of the", "term"), ("LA des", "post"), ("and of", "pseudo")]
    cues = catalog.CUES + more
    table = spark.createDataFrame(cues, "cue string, kind string")
    args = {"broadcast_bytes": bound}
    listed = rows(assertion.cue_spans(docs, cues))
    assert len(listed) > 1000 and rows(assertion.cue_spans(docs, table, **args)) == listed
    found = jobs.sentence_job(docs).select("doc_id", "entities").join(docs, "doc_id")
    found = found.unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")).select("doc_id", F.lit(None).cast(
        dict(found.dtypes)["entities"]).alias("entities"), F.lit(None).cast("string").alias("text")))
    both = [rows(assertion.assert_entities(found, c, **a)) for c, a in ((cues, {}), (table, args))]
    assert both[0] == both[1] and "negated" in str(both[0])
    short = jobs.sentence_job(docs.limit(5), cues=table.limit(0)).select("entities.assertion").collect()
    assert {a for r in short for a in r["assertion"]} <= {"affirmed"}


def test_a_large_cue_table_makes_no_larger_plan(spark):
    from pyspark.errors import PySparkException

    docs = spark.createDataFrame([(1, "He has word7 word8 and no Fever."), (2, "none")], "doc_id int, text string")
    sizes = []
    for n in (100_000, 20):
        words = spark.range(n).select(F.concat(F.lit("word"), "id", F.lit(" word"), F.col("id") + 1).alias("cue"), F.lit("pre").alias("kind"))
        spans = assertion.cue_spans(docs, words)
        sizes.append(len(spans._jdf.queryExecution().optimizedPlan().toString()))
        assert [r["cue"] for r in spans.collect()] == ["word7 word8"]
    assert abs(sizes[0] - sizes[1]) < 200
    many = [(f"word{i} word{i + 1}", "pre") for i in range(5000)]  # a long list is a table
    assert [r["cue"] for r in assertion.cue_spans(docs, many).collect()] == ["word7 word8"]
    with pytest.raises(PySparkException, match="unknown cue kind"):
        assertion.cue_spans(docs, spark.createDataFrame([("word7", "odd")], "cue string, kind string")).collect()


def test_pending_both_ways(spark):
    docs = spark.range(100).withColumnRenamed("id", "doc_id")
    done = docs.filter("doc_id % 3 = 0").unionAll(docs.filter("doc_id = 3"))
    near = metrics.pending_documents(docs, done)
    far = metrics.pending_documents(docs, done, broadcast_bytes=0)
    assert rows(near) == rows(far) == sorted(((i,) for i in range(100) if i % 3), key=repr)


def test_measured_bytes(spark):
    table = spark.createDataFrame([("abc", 1), (None, 2)], "word string, n long")
    assert lookup.measured_bytes(table) == 2 * (lookup.ROW_OVERHEAD + 8) + 3
    assert lookup.measured_bytes(table.limit(0)) == 0


def test_dense_index_over_many_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k")).repartition(7)
    got = batching.dense_index(df, "k").collect()
    assert sorted((r["k"], r["idx"]) for r in got) == [(i, i) for i in range(1000)]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_a_null_key_stay(spark):
    from marginalia.operators import sequences as sq

    rows = spark.createDataFrame([(None, 0, "a"), ("x", 0, "b"), ("x", 1, "cc")], "doc_id string, pos int, token string")
    assert sq.token_offsets(rows).count() == 3


def test_a_wrong_number_of_labels_is_an_error(spark):
    from marginalia.operators.tagging import tag_sequences

    docs = spark.createDataFrame([("d", ["a", "b"])], "doc_id string, tokens array<string>")
    row = tag_sequences(docs, lambda: lambda tokens: ["O"]).first()
    assert row["status"] == "error" and row["labels"] is None and "1 labels for 2" in row["error"]


def test_entity_rows_to_arrays(spark):
    rows = [(1, "b", 3, 4, "X"), (1, "a", 0, 1, "Y"), (2, "c", 5, 6, "X")]
    entities = spark.createDataFrame(rows, "doc_id int, text string, start int, end int, type string")
    got = {r["doc_id"]: [tuple(e) for e in r["entities"]] for r in sq.entity_arrays(entities).collect()}
    assert got == {1: [("a", 0, 1, "Y"), ("b", 3, 4, "X")], 2: [("c", 5, 6, "X")]}
