"""The jobs of ``plans`` over files as they arrive.

A job is stateless per document, so it runs unchanged on a streaming read; the
checkpoint of the query takes the place of asking which documents are done.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marginalia.functions.keys import document_id
from marginalia.sinks.files import with_outcome
from marginalia.sources.files import stored_path


def arriving_documents(
    spark: SparkSession, folder: str, *, suffix: str = ".txt", files_per_batch: int = 100_000
) -> DataFrame:
    """``(doc_id, text)`` of whole files as they appear in the folder."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    files = reader.text(folder, wholetext=True, pathGlobFilter=f"*{suffix}")
    return files.select(document_id(stored_path()).alias("doc_id"), F.col("value").alias("text"))


def annotate_arrivals(
    docs: DataFrame, job: Callable[[DataFrame], DataFrame], out: str, *, checkpoint: str
) -> StreamingQuery:
    """Annotate what has arrived since the last run, append it, and stop.

    Records are divided by ``status``.  A file is presented once, so documents
    under ``status=error`` are to be tried again by ``write_pending``, into a
    folder of its own.
    """
    annotated = with_outcome(job(docs))
    writer = annotated.writeStream.format("json").option("ignoreNullFields", "false").partitionBy("status")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
