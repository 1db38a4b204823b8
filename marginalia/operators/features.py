"""Token feature table and word-table lookups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions import features as ft
from marginalia.functions.text import ascii_drop
from marginalia.operators.lookup import BROADCAST_BYTES, lookup, measured_bytes

MEMO_WORDS = 200_000  # words a task remembers before it starts afresh


def token_features(tokens: DataFrame, *, doc: str = "doc_id", pos: str = "pos", token: str = "token") -> DataFrame:
    """``(doc, pos, names, 15 features)``: one projection, no shuffle."""
    named = tokens.select(doc, pos, ascii_drop(token).alias("names"))
    cols = ft.token_features(F.col("names"))
    return named.select(doc, pos, "names", *[c.alias(n) for n, c in cols.items()])


def in_lexicon(
    tokens: DataFrame, lexicon: DataFrame, *, doc: str = "doc_id", pos: str = "pos", token: str = "token",
    word: str = "word", out: str = "ExistinDict", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add whether the raw token is in the word list."""
    table = lexicon.select(word).distinct().withColumn("_known", F.lit(True))
    found = lookup(tokens, table, F.col(token), word=word, salt_by=[doc, pos], broadcast_bytes=broadcast_bytes)
    return found.withColumn(out, F.coalesce(F.col("_known"), F.lit(False))).drop("_known")


def word_form(
    tokens: DataFrame, table: DataFrame, *, form: str, out: str, doc: str = "doc_id", pos: str = "pos",
    token: str = "token", word: str = "word", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the lemma or stem of the ASCII token; unknown words stay as they are.

    ``table`` has ``word`` and ``form``; of several forms the smallest counts.
    """
    one = table.groupBy(word).agg(F.min(form).alias("_form"))
    found = lookup(tokens, one, ascii_drop(token), word=word, salt_by=[doc, pos], broadcast_bytes=broadcast_bytes)
    return found.withColumn(out, F.coalesce(F.col("_form"), ascii_drop(token))).drop("_form")


def word_function(fn: Callable[[str], str]) -> Callable[[Column], Column]:
    """A stemmer or lemmatizer of the user's as a column function.

    Called once per distinct word of a batch, and remembered within the task, so
    frequent words cost nothing and no token is shuffled.
    """

    @F.pandas_udf("string")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo: dict[str, str] = {}
        for words in batches:
            codes, distinct = pd.factorize(words)  # a missing word has no code
            fresh = [w for w in distinct if w not in memo]
            if len(memo) + len(fresh) > MEMO_WORDS:
                memo.clear()
                fresh = list(distinct)
            memo.update((w, fn(w)) for w in fresh)
            # A batch looks up its own words only: its time does not grow with what is remembered.
            found = np.array([*(memo[w] for w in distinct), None], dtype=object)
            yield pd.Series(found[codes])

    return apply


def word_table(lexicon: DataFrame, lemmas: DataFrame, stems: DataFrame | None = None, *, word: str = "word") -> DataFrame:
    """``(word, _known, _lemma, _stem)``: all that is stored of a word, in one row; of several forms the smallest counts."""
    blank = {"_known": F.lit(None).cast("boolean"), "_lemma": F.lit(None).cast("string"), "_stem": F.lit(None).cast("string")}

    def rows(table: DataFrame, **value: Column) -> DataFrame:
        return table.select(F.col(word).alias("word"), *[c.alias(n) for n, c in (blank | value).items()])

    every = rows(lexicon, _known=F.lit(True)).unionByName(rows(lemmas, _lemma=F.col("lemma")))
    if stems is not None:
        every = every.unionByName(rows(stems, _stem=F.col("stem")))
    return every.groupBy("word").agg(F.max("_known").alias("_known"), F.min("_lemma").alias("_lemma"), F.min("_stem").alias("_stem"))


def with_word_values(
    rows: DataFrame, table: DataFrame, *, salt_by: list[str], token: str = "token", stemmer: Callable[[str], str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES, measured: int | None = None,
) -> DataFrame:
    """Add ``names`` (the ASCII token), ``ExistinDict``, ``Lemma`` and ``Stem`` to rows of tokens.

    The raw token is looked up once, for all three.  Only where the ASCII token
    differs from it, it is looked up as well, for its forms.
    """
    size = measured_bytes(table) if measured is None else measured
    args = {"word": "word", "salt_by": salt_by, "broadcast_bytes": broadcast_bytes, "measured": size}
    named = rows.withColumn("names", ascii_drop(token))
    found = lookup(named, table, F.col(token), **args)
    forms = table.select("word", F.col("_lemma").alias("_lemma_of"), F.col("_stem").alias("_stem_of"))
    same = F.col("names") == F.col(token)
    found = lookup(found, forms, F.when(~same, F.col("names")), **args)

    def form(of: str) -> Column:
        return F.coalesce(F.when(same, F.col(of)).otherwise(F.col(f"{of}_of")), F.col("names"))

    stem = word_function(stemmer)(F.col("names")) if stemmer is not None else form("_stem")
    valued = found.withColumns({"ExistinDict": F.coalesce("_known", F.lit(False)), "Lemma": form("_lemma"), "Stem": stem})
    return valued.drop("_known", "_lemma", "_stem", "_lemma_of", "_stem_of")


def feature_columns() -> list[Column]:
    """The 19 features in their fixed order, of rows that ``with_word_values`` gives."""
    cols = {n: F.col(n) for n in ("names", "ExistinDict", "Lemma", "Stem")} | ft.token_features(F.col("names"))
    return [cols[n].alias(n) for n in ft.FEATURE_ORDER]


def feature_table(
    tokens: DataFrame, *, lexicon: DataFrame, lemmas: DataFrame, stems: DataFrame | None = None,
    stemmer: Callable[[str], str] | None = None, doc: str = "doc_id", pos: str = "pos", token: str = "token",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The full table: key columns and the 19 features in their fixed order.

    Stems come from a ``(word, stem)`` table or from a ``stemmer`` function.
    """
    rows = with_word_values(
        tokens.select(doc, pos, token), word_table(lexicon, lemmas, stems), salt_by=[doc, pos], token=token, stemmer=stemmer,
        broadcast_bytes=broadcast_bytes,
    )
    return rows.select(doc, pos, *feature_columns())


def feature_line(columns: list[str] | None = None) -> Column:
    """One blank-separated line per token, booleans as ``True`` / ``False``."""
    booleans = {"AllPunctuations", "HasPunctuation", "Digit", "ExistinDict", "Title", "digit_in_words"}
    parts = [
        F.when(F.col(c), "True").otherwise("False") if c in booleans else F.col(c).cast("string")
        for c in columns or ft.FEATURE_ORDER
    ]
    return F.concat_ws(" ", *parts)
