"""Fixed-size batches of keys in key order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.session import ensure_checkpoint_dir

PARTITION_BITS = 33  # monotonically_increasing_id keeps the row number below this bit


def dense_index(df: DataFrame, *order: str, out: str = "idx") -> DataFrame:
    """Add the position of every row in the total order, without one task for all.

    Rows are range-partitioned and sorted, then checkpointed, so that a lost
    executor cannot change the row numbers.  The count per partition (one row
    each) gives every partition its base.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("_row", PARTITION_BITS)
    placed = placed.withColumn("_part", part)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    within = F.col("_row") - F.shiftleft(F.col("_part"), PARTITION_BITS)
    # One row per partition: bounded by the number of shuffle partitions.
    joined = placed.join(F.broadcast(bases), "_part")
    return joined.withColumn(out, F.col("_base") + within).drop("_row", "_part", "_base")


def batches(df: DataFrame, key: str, size: int, *, fill: bool = False) -> DataFrame:
    """``(batch, slot, key)``: keys in order, ``size`` to a batch.

    The size is at most the number of keys.  With ``fill`` the first keys are
    repeated to fill the last batch (they are then processed twice).
    """
    indexed = dense_index(df.select(key), key)
    if fill:
        total = indexed.count()
        size = max(min(size, total), 1)
        missing = -total % size
        repeated = indexed.filter(F.col("idx") < missing)
        indexed = indexed.unionByName(repeated.withColumn("idx", F.col("idx") + total))
    batch = F.floor(F.col("idx") / size)
    return indexed.select(batch.alias("batch"), (F.col("idx") - batch * size).alias("slot"), key)
