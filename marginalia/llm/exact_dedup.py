"""Exact deduplication: 128-bit content hashes, then a comparison of bytes inside each group."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import settled

#: A group's rows are compared with its kept text in tasks of about so many rows.
SALT_ROWS = 4096


def normalised(text: Column) -> Column:
    """Each run of ``[\\x20\\x09-\\x0D]`` as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def content_hash(text: Column) -> Column:
    """128 bits of the text."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_groups(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", hashed: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, a row for each row of ``docs``.

    Texts are equal when their normalised bytes are. A group keeps its smallest
    id; a null id is larger than any other. Rows that repeat an id are rows of
    their own, and each that carries the smallest id is kept. An empty table
    gives no row; other columns are not read.

    Hash groups are first counted (partial sums: a hot group is a few rows).
    Only rows of groups of two or more move with their texts; each is compared
    with the text of the group's smallest id, a large group spread over salts.
    Texts that differ from it, which takes a collision, are grouped again
    among themselves until none is left.
    """
    todo = docs.select(F.col(key).alias("doc_id"), normalised(F.col(text)).alias("body"))
    done = []
    while True:
        rows = todo.withColumn("hash", hashed(F.col("body")))
        # min() alone would pass over a null id. The sums are of use for groups of one row.
        low = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.sha2("body", 256).alias("sha"))
        groups = settled(rows.groupBy("hash").agg(F.min(low).alias("low"), F.count("*").alias("size")))
        done.append(groups.filter("size = 1").select(
            F.col("low.doc_id").alias("doc_id"), F.col("low.doc_id").alias("keep_id"),
            F.col("size").alias("group_size"), F.lit(True).alias("kept"), F.col("low.sha").alias("text_sha256"),
        ))
        several = groups.filter("size > 1").select(
            "hash", F.col("low.doc_id").alias("keep_id"), "size", F.col("low.sha").alias("sha"),
            F.ceil(F.col("size") / SALT_ROWS).cast("int").alias("parts"),
        )
        members = rows.join(several, "hash")
        heads = members.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.sha2("body", 256) == F.col("sha")))
        heads = heads.groupBy("hash", "parts").agg(F.min("body").alias("head"))
        heads = heads.select("hash", "head", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
        spread = members.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
        compared = spread.join(heads, ["hash", "salt"])
        same = F.col("body") == F.col("head")
        found = settled(compared.select(
            "doc_id", "hash", "keep_id", "size", "sha", same.alias("same"), F.when(~same, F.col("body")).alias("body")
        ))
        others = found.filter("NOT same")
        none_left = others.isEmpty()
        equal = found.filter("same")
        if none_left:
            size = F.col("size")
        else:
            equal = equal.join(others.groupBy("hash").agg(F.count("*").alias("others")), "hash", "left")
            size = F.col("size") - F.coalesce("others", F.lit(0))
        done.append(equal.select(
            "doc_id", "keep_id", size.alias("group_size"),
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"),
        ))
        if none_left:
            return reduce(DataFrame.unionByName, done)
        todo = others.select("doc_id", "body")
