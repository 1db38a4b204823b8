"""Tokens, lines, chunks and sentences of documents, as rows.

Each operator is narrow: one document row in, its rows out, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions import text as tx
from marginalia.functions.sequence import let

CHUNK_MAX = 50  # fixed value: lines that fill a chunk
CHUNK_MIN = 10  # fixed value: a full stop closes a chunk longer than this
FOLD_LINES = 1024  # lines that are folded at once


def explode_rows(df: DataFrame, array: Column, *keep: str, pos: str = "pos", item: str = "item") -> DataFrame:
    """``posexplode`` of a computed array.

    The outer form is used because for the inner one the optimizer adds a
    ``size(array) > 0`` filter that computes the array a second time.
    """
    return df.select(*keep, F.posexplode_outer(array).alias(pos, item)).filter(F.col(pos).isNotNull())


def tokenize(df: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, pos, token)``; separators vanish, other punctuation stays."""
    return explode_rows(df, tx.tokens(text), doc, item="token")


def tokenize_lines(df: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, pos, line)``; as ``tokenize`` but empty lines stay."""
    return explode_rows(df, tx.token_lines(text), doc, item="line")


def word_count(df: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines read and words found per document, without exploding."""
    return df.select(
        doc,
        F.size(tx.token_lines(text)).alias("lines"),
        F.size(tx.tokens(text)).alias("words"),
    )


def chunk_texts(lines: Column) -> Column:
    """Chunks of 50 lines as texts, for lines that hold no full stop."""
    return let(
        lines,
        lambda ls: let(
            F.ceil(F.size(ls) / CHUNK_MAX).cast("int"),
            lambda n: F.transform(
                F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
                lambda k: F.array_join(F.slice(ls, k * CHUNK_MAX + 1, F.lit(CHUNK_MAX)), " "),
            ),
        ),
    )


def chunks(df: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Pseudo-sentences ``(doc, chunk, chunk_text)`` of 50 token lines.

    The separator pass leaves no full stop in a line, so only the length rule
    can close a chunk; ``line_chunks`` has both rules.
    """
    exploded = explode_rows(df, chunk_texts(tx.token_lines(text)), doc, pos="chunk", item="chunk_text")
    return exploded.withColumn("chunk_text", tx.ascii_drop("chunk_text"))


def line_chunks(df: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunks of ordinary lines: closed at 50 lines, or after a line with a
    full stop once the chunk has more than 10 lines; the rest is kept.

    A fold over the lines yields the chunk ends (at least 11 lines apart).  It
    runs over blocks of lines, as an array that grows is copied each time: only
    a block's own ends are, so the time grows with the number of lines.
    """
    def step(acc: Column, line: Column) -> Column:
        size = acc["size"] + 1
        full = (size == CHUNK_MAX) | (line.contains(".") & (size > CHUNK_MIN))
        return F.struct(
            (acc["at"] + 1).alias("at"),
            F.when(full, 0).otherwise(size).alias("size"),
            F.when(full, F.array_append(acc["ends"], acc["at"] + 1)).otherwise(acc["ends"]).alias("ends"),
        )

    def block_step(acc: Column, block: Column) -> Column:
        begin = F.struct(acc["at"].alias("at"), acc["size"].alias("size"), F.array().cast("array<int>").alias("ends"))
        return let(
            F.aggregate(block, begin, step),
            lambda done: F.struct(
                done["at"].alias("at"), done["size"].alias("size"), F.array_append(acc["ends"], done["ends"]).alias("ends")
            ),
        )

    def cut(lines: Column) -> Column:
        n = F.size(lines)
        firsts = F.when(n > 0, F.sequence(F.lit(1), n, F.lit(FOLD_LINES))).otherwise(F.array().cast("array<int>"))
        blocks = F.transform(firsts, lambda first: F.slice(lines, first, F.lit(FOLD_LINES)))
        none = F.struct(
            F.lit(0).alias("at"), F.lit(0).alias("size"), F.array().cast("array<array<int>>").alias("ends")
        )
        ends = F.aggregate(blocks, none, block_step, lambda acc: F.flatten(acc["ends"]))
        return let(
            ends,
            lambda e: let(
                F.when(F.coalesce(F.get(e, F.size(e) - 1), F.lit(0)) < n, F.array_append(e, n)).otherwise(e),
                lambda b: F.transform(
                    b,
                    lambda end, k: let(
                        F.coalesce(F.get(b, k - 1), F.lit(0)),
                        lambda first: F.array_join(F.slice(lines, first + 1, end - first), " "),
                    ),
                ),
            ),
        )

    lines = F.transform(tx.text_lines(text), lambda x: F.btrim(tx.ascii_drop(x), F.lit(tx.ASCII_SPACES)))
    return explode_rows(df, let(lines, cut), doc, pos="chunk", item="chunk_text")


def sentence_rows(df: DataFrame, *, doc: str = "doc_id", text: str = "text", model_form: bool = True) -> DataFrame:
    """``(doc, sent_id, start, end, sentence)`` with document offsets.

    ``model_form`` first brings the text to the length-kept ASCII form.
    """
    source = tx.model_text(text) if model_form else F.col(text)
    return _span_rows(df, tx.with_starts(tx.sentences(source)), doc)


def scope_sentence_rows(df: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``sentence_rows`` for assertion scopes (newlines end a scope too)."""
    return _span_rows(df, tx.with_starts(tx.scope_sentences(text)), doc)


def _span_rows(df: DataFrame, spans: Column, doc: str) -> DataFrame:
    rows = explode_rows(df, spans, doc, pos="sent_id", item="s")
    return rows.select(
        doc,
        "sent_id",
        F.col("s.start").alias("start"),
        F.col("s.end").alias("end"),
        F.col("s.piece").alias("sentence"),
    )
