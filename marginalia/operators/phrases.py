"""Phrases of a table found in the words of texts, for tables of any size.

The words are looked up, not the phrases: first the words that open a phrase,
then, behind such a word only, the phrases of the lengths that it opens.  The
table stays a table: it is joined, and never becomes part of the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions import text as tx
from marginalia.operators.lookup import BROADCAST_BYTES, lookup, measured_bytes


def phrase_table(table: DataFrame, phrase: str, value: str) -> DataFrame:
    """``(phrase, value, opener, words)``: phrases in lower case with single blanks; of several values the last in order counts."""
    normal = F.btrim(F.regexp_replace(F.lower(phrase), f"[{tx.SPACE_RANGES}]+", " "), F.lit(" "))
    named = table.select(normal.alias("phrase"), F.col(value).alias("value")).filter("phrase <> ''")
    once = named.groupBy("phrase").agg(F.max("value").alias("value"))
    words = F.split("phrase", " ")
    return once.select("phrase", "value", words[0].alias("opener"), F.size(words).alias("words"))


def found_phrases(
    words: DataFrame, phrases: DataFrame, *, by: list[str], longest: int, at: str = "i", keep: tuple[str, ...] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``by`` and ``found``, the phrases of a text in order: ``array<struct<at, n, phrase, value, end, keep...>>``.

    ``words`` has a row for each word, the ``opener``, with ``ahead``, the text of it and of
    those behind it that a phrase of up to ``longest`` words may run on to, and ``ends``, where
    each of these words ends.  At each word the longest phrase counts; one inside another one is dropped.
    """
    openers = phrases.groupBy("opener").agg(F.sort_array(F.collect_set("words")).alias("lengths"))
    size = measured_bytes(phrases)
    args = {"broadcast_bytes": broadcast_bytes, "measured": size, "salt_by": [*by, at]}
    opening = lookup(words, openers.withColumnRenamed("opener", "_opens"), F.col("opener"), word="_opens", **args)
    opening = opening.filter("lengths IS NOT NULL")
    tried = opening.select(*by, at, "ahead", "ends", *keep, F.explode("lengths").alias("n")).filter(F.col("n") <= F.size("ends"))
    spelled = F.call_function("substring_index", F.col("ahead"), F.lit(" "), F.col("n"))
    tried = tried.select(*by, at, "n", spelled.alias("phrase"), F.get("ends", F.col("n") - 1).alias("end"), *keep)
    values = phrases.select(F.col("phrase").alias("_known"), "value")
    hits = lookup(tried, values, F.col("phrase"), word="_known", **args).filter("value IS NOT NULL")
    # What a text holds is grouped by text, once: at most a phrase of each length for each of its words.
    rows = hits.groupBy(*by).agg(F.sort_array(F.collect_set(F.struct(at, "n", "phrase", "value", "end", *keep))).alias("found"))
    rows = rows.withColumn("found", F.filter("found", lambda p, k: ~F.coalesce(F.get("found", k + 1)[at] == p[at], F.lit(False))))
    # One that begins so many words before this one, or phrases, cannot hold it.
    before = F.lit(longest - 1)
    return rows.withColumn("found", F.filter("found", lambda p, k: ~F.exists(
        F.slice("found", F.greatest(k - before, F.lit(0)) + 1, F.least(k, before)), lambda q: q[at] + q["n"] >= p[at] + p["n"]
    )))
