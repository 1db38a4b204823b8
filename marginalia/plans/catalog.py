"""One query per operator, each over whole tables of a data folder."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginalia.functions import features as ft
from marginalia.functions import keys as ky
from marginalia.functions import spans as sp
from marginalia.functions import text as tx
from marginalia.functions.sequence import let
from marginalia.operators import assertion as asr
from marginalia.operators import batching, metrics
from marginalia.operators import features as of
from marginalia.operators import markup as mk
from marginalia.operators import sequences as sq
from marginalia.operators import tagging as tg
from marginalia.operators import text as ot
from marginalia.plans import jobs
from marginalia.sinks.files import OK, entity_json, with_outcome
from marginalia.sources.tables import partition_floor, read_table

# The page tables use other element names than the default markup.
HTML = {"page": "article", "line": "p", "content": mk.inner_text, "skip": ("script", "style")}

# A cue list made of words that are frequent in the documents.
CUES = [
    ("is", "pre"), ("by", "pre"), ("le", "pre"), ("der", "pre"), ("que el", "pre"),
    ("was", "post"), ("des", "post"), ("la", "post"),
    ("and", "term"), ("und", "term"), ("et", "term"), ("y", "term"),
    ("is the", "pseudo"), ("by the", "pseudo"), ("of the", "pseudo"), ("that is it", "pseudo"),
]
RUN_START = datetime(2024, 1, 1, 8, 0, 0)
RUN_END = datetime(2024, 1, 1, 9, 30, 30)


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return partition_floor(read_table(spark, folder, "documents", *(columns or ("doc_id", "text"))))


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    return ot.tokenize(documents(spark, folder))


def header_rule(token):
    """Numbers head a section, title case is a name."""
    return F.when(ft.is_digit(token), F.lit(sp.SECTION_HEADER)).when(ft.is_title(token), F.lit("NAME"))


def benchmark_words(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct raw tokens of the benchmark texts."""
    rows = ot.tokenize(read_table(spark, folder, "benchmark"), doc="item_id")
    return rows.select(F.col("token").alias("word")).distinct()


def lemma_table(spark: SparkSession, folder: str) -> DataFrame:
    words = benchmark_words(spark, folder).filter(F.col("word").endswith("s"))
    return words.select("word", F.regexp_replace("word", "s$", "").alias("lemma"))


def stem_table(spark: SparkSession, folder: str) -> DataFrame:
    stem = F.regexp_replace(F.lower("word"), "(ing|ed|es|s)$", "")
    return benchmark_words(spark, folder).select("word", stem.alias("stem"))


def suffix_stemmer(word: str) -> str:
    return re.sub("(ing|ed|es|s)$", "", word.lower())


def gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    words = benchmark_words(spark, folder).select(tx.ascii_drop("word").alias("word")).distinct()
    kind = F.when(F.length("word") > 6, "LONG").when(F.length("word") > 3, "SHORT")
    return words.select("word", kind.alias("type")).filter(F.col("type").isNotNull())


def cleaned(change) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: documents(spark, folder).select("doc_id", change("text").alias("text"))


def feature_group(*columns: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark, folder):
        return of.token_features(tokens(spark, folder)).select("doc_id", "pos", "names", *columns)

    return query


def rule_tagged(spark, folder):
    return tg.rule_tags(documents(spark, folder))


def rule_labels(spark, folder):
    zipped = F.arrays_zip("tokens", "labels")
    rows = ot.explode_rows(rule_tagged(spark, folder), zipped, "doc_id")
    return rows.select("doc_id", "pos", F.col("item.tokens").alias("token"), F.col("item.labels").alias("label"))


def lexicon_labels(spark, folder):
    return lexicon_tagged(spark, folder).drop("tok_start", "tok_end")


def lexicon_tagged(spark, folder):
    return tg.lexicon_tags(documents(spark, folder), gazetteer(spark, folder))


def line_labels(spark, folder):
    """A label stream counted by lines, empty ones included: longer than the tokens."""
    lines = ot.tokenize_lines(documents(spark, folder))
    return lines.select("doc_id", "pos", F.coalesce(ft.rule_type(tx.ascii_drop("line")), F.lit("O")).alias("label"))


def label_align(spark, folder):
    return sq.align_labels(tokens(spark, folder), line_labels(spark, folder)).select("doc_id", "pos", "token", "label")


def token_offsets(spark, folder):
    offsets = sp.token_offsets(tx.ascii_tokens("text"))
    return ot.explode_rows(documents(spark, folder), offsets, "doc_id").select("doc_id", "pos", "item.*")


def token_offset_rows(spark, folder):
    rows = rule_labels(spark, folder).select("doc_id", "pos", "token")
    return sq.token_offsets(rows)


def bio_entities(spark, folder):
    return jobs.entity_rows(jobs.token_job(documents(spark, folder))).drop("n")


def bio_entity_rows(spark, folder):
    return sq.bio_entities(lexicon_tagged(spark, folder))


def entity_arrays(spark, folder):
    """The array of every document, empty ones included; it is made in the document's row."""
    arrays = jobs.token_job(documents(spark, folder))
    return arrays.select("doc_id", F.size("entities").alias("n"), entity_json(F.col("entities")).alias("records"))


def entity_counts(spark, folder):
    """Entities of all documents by language and type."""
    docs = documents(spark, folder, "doc_id", "lang", "text")
    rows = jobs.entity_rows(jobs.token_job(docs, keep=("lang",)), keep=("lang",))
    return rows.groupBy("lang", "type").agg(
        F.count("*").alias("entities"), F.sum(F.col("end") - F.col("start")).alias("chars")
    )


def run_entities(spark, folder):
    return jobs.entity_rows(jobs.chunk_job(documents(spark, folder))).drop("n")


def blank_rule(spark, folder):
    """The rule on each line and its label, which are columns of one row."""
    lines = ot.tokenize_lines(documents(spark, folder)).withColumn("raw", tx.ascii_drop("line"))
    label = F.coalesce(ft.rule_type(F.col("raw")), F.lit(sp.OUTSIDE))
    return lines.select(
        "doc_id", "pos", sp.blank_rule_token(F.col("raw")).alias("token"), sp.blank_rule_label(F.col("raw"), label).alias("label"),
    )


def role_runs(spark, folder):
    turns = read_table(spark, folder, "conversations", "conv_id", "turn", "role")
    found = sq.runs(turns, "role", key="conv_id", order=["turn"])
    return found.select(
        "conv_id", "role", F.col("first.turn").alias("first_turn"), F.col("last.turn").alias("last_turn"), "rows"
    )


def event_runs(spark, folder):
    events = read_table(spark, folder, "events", "event_id", "ts", "user_id", "event_type")
    found = sq.runs(events, "event_type", key="user_id", order=["ts", "event_id"])
    return found.select(
        "user_id", "event_type",
        F.col("first.event_id").alias("first_event"), F.col("last.event_id").alias("last_event"), "rows",
    )


def turn_sections(spark, folder):
    turns = read_table(spark, folder, "conversations")
    carried = sq.section_carry(
        turns, F.col("role") == "system", F.col("text"),
        key="conv_id", order=["turn"],
    )
    return carried.select("conv_id", "turn", "role", "section")


def event_sections(spark, folder):
    events = read_table(spark, folder, "events", "event_id", "ts", "user_id", "event_type")
    carried = sq.section_carry(
        events, F.col("event_type") == "error", F.col("event_id").cast("string"),
        key="user_id", order=["ts", "event_id"],
    )
    return carried.select("user_id", "event_id", "event_type", "section")


def found_in_sentences(spark, folder):
    split = documents(spark, folder).select("doc_id", tx.sentences(tx.model_text("text")).alias("sentences"))
    return split.withColumn("found", tg.rule_found(F.col("sentences")))


def sentence_offsets(spark, folder):
    found = found_in_sentences(spark, folder)
    entities = let(F.col("found"), lambda f: tg.document_offsets(f, F.col("sentences")))
    return jobs.entity_rows(found.select("doc_id", entities.alias("entities"))).drop("n")


def section_carry(spark, folder):
    return jobs.entity_rows(jobs.sentence_job(documents(spark, folder), kind=header_rule)).drop("n")


def entity_trim(spark, folder):
    """Whole lines as raw entities: texts are trimmed, empty ones dropped, offsets kept."""
    lines = tx.with_starts(F.split(tx.ascii_blank(tx.returns_to_newlines("text")), r"(?<=\n)", -1))
    raw = F.transform(
        lines,
        lambda p: F.struct(
            p["piece"].alias("text"), p["start"].alias("start"), p["end"].alias("end"), F.lit("LINE").alias("type")
        ),
    )
    rows = documents(spark, folder).select("doc_id", raw.alias("entities"))
    trimmed = let(F.col("entities"), lambda es: sp.drop_empty_entities(sp.trim_entity_text(es)))
    return jobs.entity_rows(rows.withColumn("entities", trimmed)).drop("n")


def html_pages(spark, folder):
    return partition_floor(read_table(spark, folder, "pages", "page_id", "html"))


def on_pages(operator) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: operator(html_pages(spark, folder), doc="page_id", text="html", **HTML)


def page_entities(spark, folder):
    result = jobs.markup_job(html_pages(spark, folder), markup=HTML, doc="page_id", text="html")
    return jobs.entity_rows(result, doc="page_id").drop("n", "section")


def in_lexicon(spark, folder):
    return of.in_lexicon(tokens(spark, folder), benchmark_words(spark, folder))


def lemma_lookup(spark, folder):
    return of.word_form(tokens(spark, folder), lemma_table(spark, folder), form="lemma", out="Lemma")


def stem_vocab(spark, folder):
    return of.word_form(tokens(spark, folder), stem_table(spark, folder), form="stem", out="Stem")


def stem_function(spark, folder):
    stem = of.word_function(suffix_stemmer)
    return tokens(spark, folder).withColumn("Stem", stem(tx.ascii_drop("token")))


def feature_table(spark, folder):
    return of.feature_table(
        tokens(spark, folder), lexicon=benchmark_words(spark, folder),
        lemmas=lemma_table(spark, folder), stems=stem_table(spark, folder),
    )


def feature_lines(spark, folder):
    """All 19 columns as one line for each token."""
    return feature_table(spark, folder).select("doc_id", "pos", of.feature_line().alias("line"))


def cue_spans(spark, folder):
    return asr.cue_spans(documents(spark, folder), CUES)


def cue_table(spark, folder):
    """A dictionary out of the benchmark: its long words, and the pairs and triples of its neighbouring words."""
    rows = ot.tokenize(read_table(spark, folder, "benchmark"), doc="item_id").filter(F.col("token").rlike("^[A-Za-z]+$"))
    behind = Window.partitionBy("item_id").orderBy("pos")
    words = rows.select("pos", F.lower("token").alias("w1"), *[
        F.when(F.lead("pos", n).over(behind) == F.col("pos") + n, F.lower(F.lead("token", n).over(behind))).alias(f"w{n + 1}")
        for n in (1, 2)
    ])
    single = words.filter(F.length("w1") > 6).select(F.col("w1").alias("cue"), F.lit("pre").alias("kind"))
    double = words.filter("w2 IS NOT NULL").select(F.concat_ws(" ", "w1", "w2"), F.lit("post"))
    triple = words.filter("w2 IS NOT NULL AND w3 IS NOT NULL").select(F.concat_ws(" ", "w1", "w2", "w3"), F.lit("term"))
    return single.unionAll(double).unionAll(triple).distinct()


def cue_table_spans(spark, folder):
    """Cues of a table of thousands, which is joined."""
    return asr.cue_spans(documents(spark, folder), cue_table(spark, folder))


def assertions(spark, folder):
    return jobs.entity_rows(jobs.sentence_job(documents(spark, folder), cues=CUES)).drop("n", "section")


def entity_records(spark, folder):
    result = jobs.sentence_job(documents(spark, folder), kind=header_rule)
    return result.select("doc_id", entity_json(F.col("entities")).alias("records"))


# Stand-ins for a user's models, in plain Python.


def open_title_tagger():
    """A sequence tagger with the built-in rule: digits and title case."""

    def kind(token: str) -> str | None:
        if token.isdigit():
            return "NUM"
        return "NAME" if token.istitle() else None

    def tag(sequence: list[str]) -> list[str]:
        labels, before = [], None
        for token in sequence:
            now = kind(token)
            labels.append("O" if now is None else ("I-" if now == before else "B-") + now)
            before = now
        return labels

    return tag


def open_feature_tagger():
    """A sequence tagger that reads features: numbers, capitalised words of the lexicon, and words that have a stem or lemma."""

    def kind(f: dict) -> str | None:
        if f["Digit"]:
            return "NUM"
        if f["ExistinDict"] and f["Title"]:
            return "KNOWN"
        if f["Stem"] != f["names"] and f["percentagelower"] == 1.0:
            return "FORM" if f["Lemma"] == f["names"] else "PLURAL"
        return None

    def tag(features: list[dict]) -> list[str]:
        kinds = [kind(f) for f in features]
        return ["O" if k is None else ("I-" if n and kinds[n - 1] == k else "B-") + k for n, k in enumerate(kinds)]

    return tag


def open_capital_model():
    """An entity model that finds words in capitals; texts come in batches."""
    pattern = re.compile(r"\b[A-Z]{2,}\b")

    def find(batch: list[str]):
        return [[(m.group(), m.start(), m.end(), "CAPS") for m in pattern.finditer(text)] for text in batch]

    return find


def open_picky_tagger():
    """A tagger that fails on documents that hold a number."""
    tag = open_title_tagger()

    def picky(sequence: list[str]) -> list[str]:
        if any(token.isdigit() for token in sequence):
            raise ValueError("numbers are not supported")
        return tag(sequence)

    return picky


def user_sequence_tagger(spark, folder):
    return jobs.entity_rows(jobs.token_job(documents(spark, folder), open_title_tagger)).drop("n")


def feature_tagger(spark, folder):
    """Entities by a tagger that gets every token's 19 features."""
    result = jobs.feature_job(
        documents(spark, folder), open_feature_tagger, lexicon=benchmark_words(spark, folder),
        lemmas=lemma_table(spark, folder), stems=stem_table(spark, folder),
    )
    return jobs.entity_rows(result).drop("n")


def user_sentence_model(spark, folder):
    result = jobs.sentence_job(documents(spark, folder), open_capital_model)
    return jobs.entity_rows(result).drop("n", "section")


def failed_taggings(spark, folder):
    result = jobs.token_job(documents(spark, folder), open_picky_tagger)
    return result.select("doc_id", "status", "error")


def pending_after_failures(spark, folder):
    """Documents that are still to do after a run whose tagger failed on some."""
    docs = documents(spark, folder)
    done = with_outcome(jobs.token_job(docs, open_picky_tagger)).filter(F.col("status") == OK)
    return metrics.pending_documents(docs.select("doc_id"), done)


def urls(spark, folder):
    return read_table(spark, folder, "pages", "page_id", "url")


def key_filter(spark, folder):
    return urls(spark, folder).filter(ky.has_suffix(F.col("url"), ".html"))


def key_prefix(spark, folder):
    return urls(spark, folder).filter(ky.listed_after(F.col("url"), "https://", "https://m"))


def doc_key(spark, folder):
    url = F.col("url")
    return urls(spark, folder).select(
        "page_id", ky.short_id(url).alias("short_id"), ky.document_id(url).alias("document_id")
    )


def batches(spark, folder):
    return batching.batches(read_table(spark, folder, "documents", "doc_id"), "doc_id", 32, fill=True)


def pending_docs(spark, folder):
    docs = read_table(spark, folder, "documents", "doc_id", "text")
    done = read_table(spark, folder, "labels", "doc_id")
    return metrics.pending_documents(docs, done)


def run_summary(spark, folder):
    return metrics.run_summary(
        read_table(spark, folder, "documents", "doc_id"), read_table(spark, folder, "labels", "doc_id"),
        start=RUN_START, end=RUN_END, instances=2,
    )


def output_count(spark, folder):
    return metrics.count_outputs(urls(spark, folder), "https://", key="url")


def align_diagnostics(spark, folder):
    return metrics.label_diagnostics(tokens(spark, folder), line_labels(spark, folder))


def failed_docs(spark, folder):
    return metrics.failed_documents(
        read_table(spark, folder, "documents", "doc_id"), read_table(spark, folder, "labels", "doc_id")
    )


def processed_keys(spark, folder):
    return metrics.processed_keys(jobs.token_job(documents(spark, folder)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    on_docs = {
        "tokenize": ot.tokenize, "tokenize_keep_empty": ot.tokenize_lines, "word_count": ot.word_count,
        "chunks": ot.chunks, "line_chunks": ot.line_chunks, "sentences": ot.sentence_rows,
        "line_sentences": ot.scope_sentence_rows,
    }

    def over_documents(operator):
        return lambda spark, folder: operator(documents(spark, folder))

    catalog = {
        "ascii_drop": cleaned(tx.ascii_drop),
        "ascii_blank": cleaned(tx.ascii_blank),
        "ascii_newline": cleaned(tx.ascii_newline),
        "newline_norm": cleaned(lambda c: tx.newlines_to_blanks(tx.returns_to_newlines(c))),
        **{name: over_documents(operator) for name, operator in on_docs.items()},
        "token_features": lambda spark, folder: of.token_features(tokens(spark, folder)),
        "suffixes": feature_group("last_2", "last_3", "length"),
        "case_flags": feature_group("Lowercase", "Uppercase", "Title"),
        "punct_flags": feature_group("Digit", "digit_in_words", "HasPunctuation", "AllPunctuations"),
        "char_shares": feature_group("percentageDigit", "percentagePunc", "percentageUpper", "percentagelower"),
        "vowel_count": feature_group("Vowel_count"),
        "markup_lines": on_pages(mk.page_lines),
        "markup_text": on_pages(mk.markup_text),
        "page_counts": on_pages(mk.page_counts),
    }
    for query in (
        entity_counts, rule_labels, lexicon_labels, label_align, token_offsets, token_offset_rows, bio_entities,
        bio_entity_rows, entity_arrays, run_entities, blank_rule, role_runs, event_runs, turn_sections,
        event_sections, sentence_offsets, section_carry, entity_trim, page_entities, in_lexicon, lemma_lookup,
        stem_vocab, stem_function, feature_table, feature_lines, cue_spans, cue_table_spans, assertions, entity_records,
        user_sequence_tagger, feature_tagger, user_sentence_model, failed_taggings, pending_after_failures, key_filter, key_prefix,
        doc_key, batches, pending_docs, run_summary, output_count, align_diagnostics, failed_docs, processed_keys,
    ):
        catalog[query.__name__] = query
    return catalog
