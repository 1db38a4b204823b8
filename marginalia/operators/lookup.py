"""Word-table lookups that hold for any table size and for hot words.

The table's real size is measured.  Up to ``BROADCAST_BYTES`` it is broadcast,
so the token rows are not shuffled.  Beyond that both sides are dealt by word,
and words that would overfill a task, which a sketch of the tokens finds, are
spread over as many tasks as their share asks for.  Both ways give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 32
TRACKED = 16  # items that the sketch follows for each word it is to find
FINE = 8  # parts of a hot word for each task's share that it has: many small parts fall evenly on the tasks


def measured_bytes(table: DataFrame) -> int:
    """Bytes of the table's values plus a fixed overhead per row (one job)."""
    width = F.lit(ROW_OVERHEAD)
    for name, kind in table.dtypes:
        width = width + (F.coalesce(F.octet_length(name), F.lit(0)) if kind == "string" else F.lit(8))
    return table.agg(F.sum(width.cast("long"))).first()[0] or 0


def hot_keys(df: DataFrame, key: str, tasks: int) -> list[tuple[str | None, int]]:
    """``(key, parts)`` of the keys that have more than half of one task's share of all rows: fewer than ``2 * tasks``.

    Rows without a key match nothing, so they are spread over all tasks if they are hot.
    """
    top = F.expr(f"approx_top_k({key}, {2 * tasks}, {max(2 * TRACKED * tasks, 1000)})")
    found = df.agg(F.count("*").alias("rows"), F.count(key).alias("keyed"), top.alias("top")).first()
    share = max(found["rows"] / tasks, 1)
    counts = [(item["item"], item["count"]) for item in found["top"] or [] if item["item"] is not None]
    counts.append((None, found["rows"] - found["keyed"]))
    return [(item, -int(-FINE * n // share)) for item, n in counts if 2 * n > share]


def spread_join(keyed: DataFrame, right: DataFrame, salt_by: list[str]) -> DataFrame:
    """Left join of ``_key`` with ``_word``, rows of a hot key in several tasks, its table row in each of them."""
    tasks = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(keyed, "_key", tasks)
    if not hot:
        return keyed.join(right, F.col("_key") == F.col("_word"), "left")
    parts = F.broadcast(keyed.sparkSession.createDataFrame(hot, "_hot string, _parts int"))
    salted = keyed.join(parts, F.col("_key").eqNullSafe(F.col("_hot")), "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*salt_by), F.coalesce("_parts", F.lit(1))).cast("int")
    )
    copies = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    spread = right.join(parts, F.col("_word") == F.col("_hot"), "left").withColumn("_salt_of", F.explode(copies))
    joined = salted.drop("_hot", "_parts").join(
        spread.drop("_hot", "_parts"), (F.col("_key") == F.col("_word")) & (F.col("_salt") == F.col("_salt_of")), "left"
    )
    return joined.drop("_salt", "_salt_of")


def lookup(
    df: DataFrame,
    table: DataFrame,
    key: Column,
    *,
    word: str,
    salt_by: list[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    measured: int | None = None,
) -> DataFrame:
    """Left join of ``df`` with a table that has one row per ``word``.

    The columns of ``table`` other than ``word`` are added; a null key finds
    nothing.  ``salt_by`` names columns of ``df`` that differ between rows of the
    same word; ``measured`` is the table's size where it is known already.
    """
    keyed = df.withColumn("_key", key)
    right = table.withColumnRenamed(word, "_word")
    size = measured_bytes(table) if measured is None else measured
    if size <= broadcast_bytes:
        joined = keyed.join(F.broadcast(right), F.col("_key") == F.col("_word"), "left")
    else:
        joined = spread_join(keyed, right, salt_by)
    return joined.drop("_key", "_word")


def unlisted(df: DataFrame, listed: DataFrame, key: str, *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``df`` whose key is not in ``listed`` (anti join on a unique key).

    A listing of a proven small size is broadcast, so that wide rows such as
    whole documents stay where they are.
    """
    keys = listed.select(key).distinct()
    if measured_bytes(keys) <= broadcast_bytes:
        keys = F.broadcast(keys)
    return df.join(keys, key, "left_anti")
