"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import exact_dedup, jaccard_join, langid, packing, quality
from marginalia.llm.common import fold_remainder, settled, table
from marginalia.llm.queries import piece_vocabulary, word_vocabulary
from marginalia.session import ensure_checkpoint_dir

#: A language that is less probable than this, given the text, is not relied on.
LEAST_LANGUAGE_SCORE = 0.5

#: The models of two stages and the token ids of the last are not expressible in SQL.
ORACLE_SQL = None


def _carried(docs: DataFrame) -> tuple:
    """The row of ``docs`` as one column, to be carried along by a stage that scores rows where they are."""
    return (F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_document"),)


def _text_within(docs: DataFrame) -> tuple[str, int]:
    """Where the carried row has its text, which then goes to a task once."""
    names = docs.columns
    return "_document", names.index("text") if "text" in names else [c.lower() for c in names].index("text")


def _kept(scored: DataFrame, docs: DataFrame, condition) -> DataFrame:
    return scored.filter(condition).select("_document.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier, learned from the labels of four folds of five, predicts as 0.

    Null and empty texts are scored as the empty text; rows that repeat or share an id are judged each by its
    text; equal texts have equal scores; all columns, whatever they are called, come back as they are; an
    empty table gives an empty one.
    """
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").filter(fold_remainder(F.col("doc_id")) != 0)
    return _kept(quality.scores(docs, labels, extra=_carried(docs), within=_text_within(docs)), docs, "predicted = 1")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents without a language: no letter in them, or none that is probable enough.

    Null and empty texts have no letter and go; rows that repeat or share an id are judged each by its text; all
    columns come back as they are; an empty table gives an empty one, as does one without labelled rows.
    """
    labelled = docs.filter(fold_remainder(F.col("doc_id")) != 0)
    found = langid.languages(docs, labelled, piece_vocabulary(), extra=_carried(docs), within=_text_within(docs))
    return _kept(found, docs, (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE))


def _one_of_each(docs: DataFrame, group_of) -> DataFrame:
    """One row of each group: of the smallest id, null being larger than any, and the first of several.

    ``group_of`` gives ``(row, part)`` of rows ``(row, text)``; ``row`` is a number of its own, so rows that share
    an id or have none are judged each by its text. The document stays in one column beside it, so that its
    columns may have any names. A null text is as good as an empty one; an empty table gives an empty one.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    rows = settled(docs.select(F.monotonically_increasing_id().alias("row"), whole))
    parts = group_of(rows.select("row", "document.text")).toDF("row", "part")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    first = parts.join(rows.select("row", "document.doc_id"), "row").groupBy("part").agg(F.min(order).alias("first"))
    return rows.join(first.select(F.col("first.row").alias("row")), "row", "left_semi").select("document.*")


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, that of the smallest id."""
    return _one_of_each(docs, lambda rows: exact_dedup.exact_groups(rows, key="row").select("doc_id", "keep_id"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, that of the smallest id; texts without words stay all."""
    return _one_of_each(docs, lambda rows: jaccard_join.near_groups(rows, key="row").select("doc_id", "component_id"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, and their places in sequences of at most 2048 tokens.

    A null or empty text is one piece of one token; rows that repeat are packed each for itself.
    """
    return packing.packed(docs, word_vocabulary())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("exact_dedup", exact_deduplication),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each result is a Parquet table in the shared folder."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus_pipeline-{uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
