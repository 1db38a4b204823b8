"""Run bookkeeping: counts, diagnostics, pending and failed documents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions.keys import listed_after
from marginalia.operators.lookup import BROADCAST_BYTES, unlisted


def run_summary(
    inputs: DataFrame, outputs: DataFrame, *, start: datetime, end: datetime, instances: int
) -> DataFrame:
    """One typed row about a run: counts of both sides, times and instances."""
    sides = inputs.select(F.lit(1).alias("i"), F.lit(0).alias("o")).unionAll(
        outputs.select(F.lit(0).alias("i"), F.lit(1).alias("o"))
    )
    counts = sides.agg(
        F.coalesce(F.sum("i"), F.lit(0)).alias("inputs"), F.coalesce(F.sum("o"), F.lit(0)).alias("outputs")
    )
    return counts.select(
        "inputs",
        "outputs",
        F.col("outputs").alias("success"),
        F.greatest(F.col("inputs") - F.col("outputs"), F.lit(0)).alias("failed"),
        F.lit(start).cast("timestamp").alias("start"),
        F.lit(end).cast("timestamp").alias("end"),
        F.lit((end - start).total_seconds()).alias("total_seconds"),
        F.lit(instances).alias("instances"),
    )


def count_outputs(keys: DataFrame, prefix: str, *, key: str = "key") -> DataFrame:
    """How many keys a listing under the prefix returns."""
    return keys.filter(listed_after(F.col(key), prefix)).agg(F.count("*").alias("outputs"))


def label_diagnostics(tokens: DataFrame, labels: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """``(doc, tokens, labels, aligned, mismatch)`` by counts alone, no join."""
    sides = tokens.select(doc, F.lit(1).alias("t"), F.lit(0).alias("l")).unionAll(
        labels.select(doc, F.lit(0).alias("t"), F.lit(1).alias("l"))
    )
    counts = sides.groupBy(doc).agg(F.sum("t").alias("tokens"), F.sum("l").alias("labels"))
    return counts.withColumn("aligned", F.least("tokens", "labels")).withColumn(
        "mismatch", F.col("tokens") != F.col("labels")
    )


def pending_documents(
    docs: DataFrame, done: DataFrame, *, doc: str = "doc_id", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Documents not yet among the written ones."""
    return unlisted(docs, done, doc, broadcast_bytes=broadcast_bytes)


def failed_documents(
    inputs: DataFrame, outputs: DataFrame, *, doc: str = "doc_id", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Ids of inputs without an output; the true list behind the ``failed`` number."""
    return unlisted(inputs.select(doc), outputs, doc, broadcast_bytes=broadcast_bytes)


def processed_keys(results: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """Ids of the processed documents, as a table to write."""
    return results.select(doc)
