"""Page markup to lines and text, by patterns that tolerate broken files.

A page (line) runs from its opening tag to its closing tag, or to the next
opening tag or the end of the file when the closing tag is missing; cutting at
opening tags is linear and never fails, whatever the file looks like.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.sequence import let
from marginalia.operators.text import explode_rows

# What stands before every page in the text form.
PAGE_BREAK = "\n<EPI_PAGEBREAKER>\n\n"
PREFIX = r"(?:[\w.-]+:)?"


# What follows a tag's name up to its end, where a quoted value may hold ``>``; a quote that is
# not closed before the next ``<`` is none, and the tag ends at the first ``>``.  A tag that the
# end of the text cuts off is none.
VALUES = r"""(?:[^>"']*+(?:(?:"[^"<]*+"|'[^'<]*+')[^>"']*+)*+>|(?![^<]*+\z)[^>]*+>)"""


def _open(tag: str) -> str:
    return rf"<{PREFIX}{tag}(?:\s{VALUES}|>)"


def _elements(markup: Column, tag: str) -> Column:
    """Contents of the elements of this name, in order."""
    quoted = r"""\s[^>"'/]*+(?:(?:"[^"<]*+"|'[^'<]*+'|/(?!>))[^>"'/]*+)*+"""
    closed = F.regexp_replace(markup, rf"<({PREFIX}{tag})(?:{quoted})?/>", r"<$1></$1>")
    pieces = F.split(closed, _open(tag))
    return F.transform(
        F.slice(pieces, F.lit(2), F.size(pieces)),
        lambda p: F.get(F.split(p, rf"</{PREFIX}{tag}\s*>", 2), F.lit(0)),
    )


def _rewritten(c: Column, pattern: str, change) -> Column:
    """Every match of the pattern replaced by ``change(match)``, in one pass from left to right."""

    def joined(pieces: Column, found: Column) -> Column:
        parts = F.transform(
            pieces, lambda p, i: F.concat(p, F.coalesce(change(F.get(found, i)), F.lit("")))
        )
        return F.array_join(parts, "")

    return let(
        F.split(c, pattern, -1),
        lambda pieces: let(
            F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), lambda found: joined(pieces, found)
        ),
    )


def unescape(c: Column) -> Column:
    """Character references to characters, each decoded once."""

    def decoded(ref: Column) -> Column:
        hexed = F.substring(ref, 3, 1).isin("x", "X")
        digits = F.regexp_extract(ref, "^&#[xX]?0*([0-9A-Fa-f]*);$", 1)
        known = F.length(digits) <= 7  # no character has a longer number, leading zeros apart
        code = F.when(known, F.when(hexed, F.conv(digits, 16, 10)).otherwise(digits).try_cast("long"))
        valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        named = F.when(ref == "&lt;", "<").when(ref == "&gt;", ">").when(ref == "&quot;", '"')
        named = named.when(ref == "&apos;", "'").when(ref == "&amp;", "&")
        return F.when(~ref.startswith("&#"), named).otherwise(F.when(valid, char).otherwise(ref))

    references = r"&(?:#[xX][0-9A-Fa-f]+|#[0-9]+|lt|gt|quot|apos|amp);"
    return F.when(c.contains("&"), _rewritten(c, references, decoded)).otherwise(c)


def plain_markup(markup: Column, skip: tuple[str, ...] = ()) -> Column:
    """Markup without comments and the elements to skip; CDATA sections become escaped text.

    Whatever begins first counts: a comment in a skipped element is part of it, and the reverse.
    """
    skipped = "".join(rf"|<{tag}(?:\s{VALUES}|>).*?</{tag}\s*>" for tag in skip)
    pattern = rf"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>{skipped}"

    def text(found: Column) -> Column:
        inner = F.substring(found, F.lit(10), F.length(found) - 12)
        for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            inner = F.replace(inner, F.lit(char), F.lit(ref))
        return F.when(found.startswith("<![CDATA["), inner).otherwise(F.lit(""))

    if skip:
        return _rewritten(markup, pattern, text)
    return F.when(markup.contains("<!"), _rewritten(markup, pattern, text)).otherwise(markup)


def attribute_words(word_tag: str, attribute: str):
    """Line content as the attribute values of its word elements, blank-joined.

    A word without the attribute is skipped.
    """
    value = rf"""<{PREFIX}{word_tag}\s(?:[^<]*?\s)?{attribute}\s*=\s*("[^"<]*"|'[^'<]*')"""

    def content(line: Column) -> Column:
        quoted = F.regexp_extract_all(line, F.lit(value), F.lit(1))
        return F.array_join(
            F.transform(quoted, lambda q: F.substring(q, F.lit(2), F.length(q) - 2)), " "
        )

    return content


def inner_text(line: Column) -> Column:
    """Line content as its text with inner tags removed."""
    return F.regexp_replace(line, rf"<[A-Za-z/]{VALUES}|<[^>]*>", "")


def pages(
    markup: Column, *, page: str = "Page", line: str = "TextLine", content=None, skip: tuple[str, ...] = (),
) -> Column:
    """``array<array<string>>``: the line texts of every page.

    ``skip`` names elements (scripts, styles) removed with their content first,
    together with comments.
    """
    content = content or attribute_words("String", "CONTENT")
    return F.transform(
        _elements(plain_markup(markup, skip), page),
        lambda p: F.transform(_elements(p, line), lambda x: unescape(content(x))),
    )


def page_lines(df: DataFrame, *, doc: str = "doc_id", text: str = "text", **markup) -> DataFrame:
    """``(doc, page_no, line_no, line)``; a page without lines has no row."""
    per_page = explode_rows(df, pages(F.col(text), **markup), doc, pos="page_no", item="lines")
    return explode_rows(per_page, F.col("lines"), doc, "page_no", pos="line_no", item="line")


def markup_text(df: DataFrame, *, doc: str = "doc_id", text: str = "text", **markup) -> DataFrame:
    """``(doc, text)``: a page-break mark before each page, then its lines."""
    joined = let(
        pages(F.col(text), **markup),
        lambda ps: F.array_join(
            F.flatten(F.transform(ps, lambda lines: F.concat(F.array(F.lit(PAGE_BREAK)), lines))), "\n"
        ),
    )
    return df.select(doc, joined.alias(text))


def page_counts(df: DataFrame, *, doc: str = "doc_id", text: str = "text", **markup) -> DataFrame:
    """``(doc, pages, lines, chars)`` per document, without exploding."""
    return df.select(doc, pages(F.col(text), **markup).alias("_pages")).select(
        doc,
        F.size("_pages").alias("pages"),
        F.aggregate("_pages", F.lit(0), lambda n, p: n + F.size(p)).alias("lines"),
        F.aggregate(
            F.flatten("_pages"), F.lit(0).cast("long"), lambda n, x: n + F.length(x)
        ).alias("chars"),
    )
