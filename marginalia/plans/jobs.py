"""Whole annotation jobs, composed of the operators.

Each takes document rows ``(doc_id, text)`` and gives one row per document with
an ``entities`` array.  A job is one narrow stage: a document is read, cleaned,
tagged and decoded in its own row, and no text is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions import features as ft
from marginalia.functions import spans as sp
from marginalia.functions import text as tx
from marginalia.functions.sequence import let, running_total
from marginalia.operators import assertion as asr
from marginalia.operators import tagging as tg
from marginalia.operators.markup import markup_text
from marginalia.operators.text import chunk_texts, explode_rows


def token_job(
    docs: DataFrame, open_tagger: Callable | None = None, *, doc: str = "doc_id", text: str = "text",
    keep: tuple[str, ...] = (), kind=ft.rule_type,
) -> DataFrame:
    """Plain text, sequence tagger over tokens, BIO decode.

    Without ``open_tagger`` the built-in rule labels the tokens.
    """
    if open_tagger is None:
        tagged = tg.rule_tags(docs, doc=doc, text=text, keep=keep, kind=kind)
    else:
        tokens = docs.select(doc, *keep, tx.ascii_tokens(text).alias("tokens"))
        tagged = tg.tag_sequences(tokens, open_tagger)
    status = [c for c in ("status", "error") if c in tagged.columns]
    labels = F.coalesce("labels", F.array().cast("array<string>"))
    return tagged.select(doc, *keep, *status, sp.bio_spans(F.col("tokens"), labels).alias("entities"))


def feature_job(
    docs: DataFrame, open_tagger: Callable, *, lexicon: DataFrame, lemmas: DataFrame, stems: DataFrame | None = None,
    stemmer: Callable[[str], str] | None = None, doc: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (),
    **bounds,
) -> DataFrame:
    """Plain text, sequence tagger over the tokens' 19 features, BIO decode."""
    tagged = tg.tag_features(
        docs, open_tagger, lexicon=lexicon, lemmas=lemmas, stems=stems, stemmer=stemmer, doc=doc, text=text, keep=keep, **bounds
    )
    labels = F.coalesce("labels", F.array().cast("array<string>"))
    return tagged.select(doc, *keep, "status", "error", sp.bio_spans(F.col("tokens"), labels).alias("entities"))


def sentence_job(
    docs: DataFrame, open_model: Callable | None = None, *, cues: asr.Cues | None = None, doc: str = "doc_id",
    text: str = "text", keep: tuple[str, ...] = (), kind=ft.rule_type,
) -> DataFrame:
    """Sentences, entity model, document offsets, sections, then assertions.

    Without ``open_model`` the built-in rule finds the entities; without ``cues``
    no assertion is added.
    """
    if open_model is None:
        raw = docs.select(doc, *keep, text, tg.rule_entities(tx.marked_model_text(text), kind).alias("entities"))
    else:
        # The text itself goes along only where cues are to be found in it.
        also = [text] if cues is not None else []
        split = docs.select(doc, *keep, *also, tx.sentences(tx.model_text(text)).alias("sentences"))
        begins = let(F.col("sentences"), lambda ss: running_total(F.transform(ss, F.length)))
        found = tg.tag_sentences(split.withColumn("_begins", begins), open_model, keep_sentences=False)
        moved = tg.moved_by(F.coalesce("found", F.array().cast(tg.FOUND_TYPE)), F.col("_begins"))
        raw = found.select(doc, *keep, "status", "error", *also, moved.alias("entities"))
    finished = let(
        sp.trim_entity_text(F.col("entities")), lambda es: sp.drop_empty_entities(sp.carry_sections(es))
    )
    result = raw.withColumn("entities", finished)
    if cues is not None:
        result = asr.assert_entities(result, cues, text=text)
    return result.drop(text)


def markup_job(
    docs: DataFrame, open_model: Callable | None = None, *, markup: dict | None = None, doc: str = "doc_id",
    text: str = "text", **options,
) -> DataFrame:
    """Page markup to text, then ``sentence_job``."""
    plain = markup_text(docs, doc=doc, text=text, **(markup or {}))
    return sentence_job(plain, open_model, doc=doc, text=text, **options)


def chunk_job(
    docs: DataFrame, open_model: Callable | None = None, *, doc: str = "doc_id", text: str = "text", kind=ft.rule_type,
) -> DataFrame:
    """Chunks of token lines, entity model per chunk, runs of equal labels.

    Without ``open_model`` every token line is labelled by the built-in rule.
    """
    lines = F.transform(tx.token_lines(text), tx.ascii_drop)
    if open_model is None:
        pairs = F.transform(
            lines, lambda t: F.struct(t.alias("token"), F.coalesce(kind(t), F.lit(sp.OUTSIDE)).alias("label"))
        )
        tagged = docs.select(doc, pairs.alias("tagged"))
    else:
        chunked = docs.select(doc, chunk_texts(lines).alias("chunks"))
        tagged = tg.tag_chunks(chunked, open_model)
    status = [c for c in ("status", "error") if c in tagged.columns]
    pairs = F.coalesce("tagged", F.array().cast("array<struct<token:string,label:string>>"))
    entities = let(
        pairs,
        lambda ps: sp.run_spans(
            F.transform(ps, lambda p: sp.blank_rule_token(p["token"])),
            F.transform(ps, lambda p: sp.blank_rule_label(p["token"], p["label"])),
        ),
    )
    return tagged.select(doc, *status, entities.alias("entities"))


def entity_rows(result: DataFrame, *, doc: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per entity of a job's result, in document order (``n``)."""
    rows = explode_rows(result, F.col("entities"), doc, *keep, pos="n")
    return rows.select(doc, *keep, "n", "item.*")
