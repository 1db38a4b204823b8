"""Entity spans from tokens and labels, inside one document row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginalia.functions.sequence import let, positions, running_total, segments, starts
from marginalia.functions.text import ASCII_SPACES

OUTSIDE = "O"
SECTION_HEADER = "SectionHeader"


def begins(label: Column) -> Column:
    return (label == "B") | label.startswith("B-")


def continues(label: Column) -> Column:
    return (label == "I") | label.startswith("I-")


def label_type(label: Column) -> Column:
    """All that follows the first dash."""
    return F.substr(label, F.lit(3))


def bio_label(kind: Column, previous: Column) -> Column:
    """``I-`` when the previous token has the same type, else ``B-``; null is ``O``."""
    return (
        F.when(kind.isNull(), F.lit(OUTSIDE))
        .when(kind.eqNullSafe(previous), F.concat(F.lit("I-"), kind))
        .otherwise(F.concat(F.lit("B-"), kind))
    )


def bio_labels(kinds: Column) -> Column:
    """BIO labels of a whole array of types (null = outside)."""
    return let(
        kinds,
        lambda ks: F.transform(ks, lambda k, i: bio_label(k, F.when(i > 0, F.get(ks, i - 1)))),
    )


def is_blank_token(token: Column) -> Column:
    return token.isin(" ", "  ", "-")


def blank_rule_token(token: Column) -> Column:
    """A blank, two blanks or a dash count as the empty token."""
    return F.when(is_blank_token(token), F.lit("")).otherwise(token)


def blank_rule_label(token: Column, label: Column) -> Column:
    """Blank tokens and empty labels are outside."""
    outside = is_blank_token(token) | F.coalesce(F.trim(label), F.lit("")).isin("")
    return F.when(outside, F.lit(OUTSIDE)).otherwise(label)


def token_offsets(tokens: Column) -> Column:
    """``array<struct<token, tok_start, tok_end>>`` in the blank-joined text."""
    return let(
        tokens,
        lambda tk: let(
            starts(tk, 1),
            lambda at: F.transform(
                tk,
                lambda t, i: F.struct(
                    t.alias("token"),
                    F.get(at, i).alias("tok_start"),
                    (F.get(at, i) + F.length(t)).alias("tok_end"),
                ),
            ),
        ),
    )


def _cut_to(array: Column, n: Column) -> Column:
    return F.when(F.size(array) == n, array).otherwise(F.slice(array, F.lit(1), n))


def _spans(tokens: Column, labels: Column, is_cut, is_entity, kind) -> Column:
    """Entities from cuts of a label sequence.

    ``is_cut(labels, label, i)`` tells where a stretch of tokens begins; only
    stretches are measured and added up, not single tokens.  Sequences are cut
    to the shorter side.
    """

    def measured(tk: Column, bounds: Column, n: Column) -> Column:
        return F.transform(
            segments(bounds, n),
            lambda s: F.struct(
                s["first"].alias("first"),
                F.array_join(F.slice(tk, s["first"] + 1, s["last"] - s["first"] + 1), " ").alias("text"),
            ),
        )

    def entities(parts: Column, lb: Column) -> Column:
        return let(
            running_total(F.transform(parts, lambda p: F.length(p["text"]) + 1)),
            lambda at: F.transform(
                F.filter(
                    F.transform(parts, lambda p, k: p.withField("start", F.get(at, k))),
                    lambda p: is_entity(F.get(lb, p["first"])),
                ),
                lambda p: F.struct(
                    p["text"].alias("text"),
                    p["start"].alias("start"),
                    (p["start"] + F.length(p["text"])).alias("end"),
                    kind(F.get(lb, p["first"])).alias("type"),
                ),
            ),
        )

    def decode(tk: Column, lb: Column) -> Column:
        return let(
            positions(lb, lambda x, i: (i == 0) | is_cut(lb, x, i)),
            lambda bounds: let(measured(tk, bounds, F.size(lb)), lambda parts: entities(parts, lb)),
        )

    def aligned(tk: Column, lb: Column) -> Column:
        return let(
            F.least(F.size(tk), F.size(lb)),
            lambda n: let(_cut_to(tk, n), lambda t: let(_cut_to(lb, n), lambda x: decode(t, x))),
        )

    return let(tokens, lambda tk: let(labels, lambda lb: aligned(tk, lb)))


def bio_spans(tokens: Column, labels: Column) -> Column:
    """Decode BIO labels to ``array<struct<text, start, end, type>>``.

    ``B-X`` opens an entity, the ``I`` labels after it extend it whatever their
    type, anything else closes it; an ``I`` with nothing open is ignored.
    """

    def is_cut(lb: Column, label: Column, i: Column) -> Column:
        closes = ~continues(label) & (F.get(lb, i - 1) != OUTSIDE)
        return (label != OUTSIDE) & begins(label) | closes

    return _spans(tokens, labels, is_cut, begins, label_type)


def run_spans(tokens: Column, labels: Column) -> Column:
    """Runs of equal labels as entities; runs labelled ``O`` are dropped."""
    return _spans(
        tokens, labels,
        lambda lb, label, i: label != F.get(lb, i - 1),
        lambda label: label != OUTSIDE,
        lambda label: label,
    )


def carry_sections(entities: Column) -> Column:
    """Add ``section`` to an ordered entity array.

    The text of a section header holds for the entities after it; the header
    itself, and entities before any header, have none.
    """

    def sectioned(e: Column, section: Column) -> Column:
        return F.struct(
            e["text"].alias("text"),
            e["start"].alias("start"),
            e["end"].alias("end"),
            e["type"].alias("type"),
            section.alias("section"),
        )

    none = F.lit(None).cast("string")
    return let(
        entities,
        lambda es: let(
            positions(es, lambda e, i: e["type"] == SECTION_HEADER),
            lambda heads: F.concat(
                F.transform(
                    F.slice(es, F.lit(1), F.coalesce(F.get(heads, F.lit(0)), F.size(es))),
                    lambda e: sectioned(e, none),
                ),
                F.flatten(
                    F.transform(
                        segments(heads, F.size(es)),
                        lambda s: F.transform(
                            F.slice(es, s["first"] + 1, s["last"] - s["first"] + 1),
                            lambda e, i: sectioned(
                                e, F.when(i > 0, F.get(es, s["first"])["text"])
                            ),
                        ),
                    )
                ),
            ),
        ),
    )


def trim_entity_text(entities: Column) -> Column:
    """Trim the text of every entity; offsets stay as they are."""
    return F.transform(
        entities, lambda e: e.withField("text", F.btrim(e["text"], F.lit(ASCII_SPACES)))
    )


def drop_empty_entities(entities: Column) -> Column:
    return F.filter(entities, lambda e: e["text"] != "")
