"""Results to files: JSON records, feature lines, run metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from marginalia.operators.features import feature_line
from marginalia.operators.metrics import pending_documents

RECORD_OPTIONS = {"ignoreNullFields": "false"}  # a missing section is written as null
OK = "ok"  # the status of a document that was annotated


def entity_json(entities: Column) -> Column:
    """A document's entities as the text of one JSON array; none is ``[]``."""
    return F.coalesce(F.to_json(entities, RECORD_OPTIONS), F.lit("[]"))


def write_json(
    df: DataFrame, folder: str, *, doc: str = "doc_id", entities: str = "entities", per_document: bool = False,
    mode: str = "overwrite",
) -> None:
    """Write one record per document.

    The default is one JSON-lines dataset ``{doc, entities}``.  ``per_document``
    writes each array to its own folder ``<doc>=<id>``: easy to fetch by name,
    but one file per document.
    """
    if per_document:
        arrays = df.select(doc, entity_json(F.col(entities)).alias("value"))
        arrays.write.mode(mode).partitionBy(doc).text(folder)
    else:
        df.select(doc, entities).write.mode(mode).option("ignoreNullFields", "false").json(folder)


def with_outcome(df: DataFrame, *, doc: str = "doc_id", entities: str = "entities") -> DataFrame:
    """``(doc, entities, error, status)``; rows of a job without a user's model are ``ok``.

    A document whose model failed has null entities, never an empty array.
    """
    status = F.col("status") if "status" in df.columns else F.lit(OK)
    error = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    kept = F.when(status == OK, F.col(entities))
    return df.select(doc, kept.alias(entities), error.alias("error"), status.alias("status"))


def _outcomes(spark: SparkSession, folder: str, columns: str) -> DataFrame:
    """Named columns of what ``write_pending`` wrote; no rows where nothing was written yet."""
    try:
        return spark.read.schema(columns).parquet(folder)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], columns)


def written_documents(spark: SparkSession, folder: str, *, doc: str = "doc_id", kind: str = "string") -> DataFrame:
    """Ids of the finished documents; failed ones are not finished."""
    return _outcomes(spark, folder, f"{doc} {kind}, status string").filter(F.col("status") == OK).select(doc)


def open_failures(
    spark: SparkSession, folder: str, *, doc: str = "doc_id", kind: str = "string"
) -> DataFrame:
    """``(doc, error)`` of every failed attempt at a document that no later run has finished."""
    failed = _outcomes(spark, folder, f"{doc} {kind}, error string, status string").filter(F.col("status") != OK)
    done = written_documents(spark, folder, doc=doc, kind=kind)
    return pending_documents(failed.select(doc, "error"), done, doc=doc)


def write_pending(
    docs: DataFrame, annotate, folder: str, *, doc: str = "doc_id", entities: str = "entities"
) -> None:
    """Annotate and append only documents that are not finished yet.

    ``annotate`` maps document rows to rows with an entity array.  The output is
    one Parquet dataset divided by ``status``: a run is written in one pass and
    one commit, and the next run reads the id column of ``status=ok`` alone.
    Failed documents are kept with their error under ``status=error`` and tried
    again by the next run.  ``write_json`` turns the finished ones into records.
    """
    kind = dict(docs.dtypes)[doc]
    done = written_documents(docs.sparkSession, folder, doc=doc, kind=kind)
    todo = pending_documents(docs, done, doc=doc)
    outcome = with_outcome(annotate(todo), doc=doc, entities=entities)
    outcome.write.mode("append").partitionBy("status").parquet(folder)


def write_feature_lines(
    features: DataFrame, folder: str, *, run: str = "all", doc: str = "doc_id", pos: str = "pos", per_document: bool = False,
) -> None:
    """Blank-separated feature lines without header, in token order per document.

    The output is divided by ``run``; a run that is written again replaces what
    it wrote before and leaves other runs alone.  Lines begin with the document's id and a
    tab; ``per_document`` writes bare lines to a folder ``<doc>=<id>`` for each document instead.

    Tokens are sorted within their task, and nothing is shuffled: a document's
    lines are together as long as its tokens are, as they come out of ``tokenize``.
    """
    line = feature_line()
    value = line if per_document else F.concat(F.coalesce(F.col(doc).cast("string"), F.lit("")), F.lit("\t"), line)
    divided = ["run", doc] if per_document else ["run"]
    lines = features.select(F.lit(run).alias("run"), doc, pos, value.alias("value"))
    ordered = lines if not per_document else lines.sortWithinPartitions("run", doc, pos)
    writer = ordered.select(*divided, "value").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*divided).text(folder)


def append_run_summary(summary: DataFrame, folder: str) -> None:
    """Append the one row of a run to the table of runs."""
    summary.coalesce(1).write.mode("append").parquet(folder)
