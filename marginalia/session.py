"""Session settings the library is tuned for, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Rows are whole documents: keep the batches handed to Python small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def build_session(app: str = "marginalia", **settings: str) -> SparkSession:
    """A session with the settings above; master and sizes come from the cluster."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="marginalia-checkpoint-")
    context.setCheckpointDir(folder)
    return folder
