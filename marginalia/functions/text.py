"""Text cleaning and splitting as column expressions (no UDFs).

Every function takes and returns a ``Column``.  Expressions built only from
``regexp_replace`` / ``split`` / ``translate`` stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginalia.functions.sequence import MARK, let, starts

# The characters that end a token, and those a trim removes.
# Single characters below 256 are one look into a bit table of the pattern, each range
# is a test of its own on every character: so the first are listed one by one, and the
# others stand behind the range that holds them all.
_ASCII_SPACES = r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20"
SPACE_RANGES = (
    _ASCII_SPACES + r"\x{85}\x{A0}"
    r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]]"
)
SEPARATOR = f"[{SPACE_RANGES};.,:]"
NOT_SEPARATOR = f"[^{SPACE_RANGES};.,:]"
NON_ASCII = r"[^\x00-\x7F]"
ASCII_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
SENTENCE_CUT = r"(?<=[.?])(?=\s+[A-Z])"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_foreign(c, put: str, each: bool = True) -> Column:
    """Put ``put`` for every non-ASCII character (or for every run of them).

    ASCII text, whose bytes are as many as its characters, skips the pattern.
    """
    c = _col(c)
    pattern = NON_ASCII if each else NON_ASCII + "+"
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(F.regexp_replace(c, pattern, put))


def ascii_drop(c) -> Column:
    """Remove every non-ASCII character (the text gets shorter)."""
    return replace_foreign(c, "", each=False)


def ascii_blank(c) -> Column:
    """Put a blank in place of every non-ASCII character (length is kept)."""
    return replace_foreign(c, " ")


def ascii_newline(c) -> Column:
    """Put a newline in place of every non-ASCII character (length is kept)."""
    return replace_foreign(c, "\n")


def returns_to_newlines(c) -> Column:
    """``\\r`` becomes ``\\n``, one for one."""
    return F.translate(_col(c), "\r", "\n")


def newlines_to_blanks(c) -> Column:
    """``\\n`` becomes a blank, one for one."""
    return F.translate(_col(c), "\n", " ")


def tokens(c) -> Column:
    """Tokens between runs of whitespace and ``; . , :``; no empty ones."""
    return F.array_remove(F.split(_col(c), SEPARATOR + "+"), "")


def token_lines(c) -> Column:
    """As ``tokens``, but each separator ends a line, so empty lines stay.

    A text that ends in a separator has no extra empty line after it.
    """
    return let(
        F.split(_col(c), SEPARATOR),
        lambda a: F.when(
            F.element_at(a, -1) == "", F.slice(a, 1, F.size(a) - 1)
        ).otherwise(a),
    )


def sentences(c) -> Column:
    """Cut just after ``.`` or ``?`` where blanks and a capital follow.

    The pieces concatenate to the input; a text without a cut is one sentence.
    """
    return F.split(_col(c), SENTENCE_CUT, -1)


def model_text(c) -> Column:
    """The form entity models read: ASCII only, one line, length kept."""
    return newlines_to_blanks(ascii_blank(returns_to_newlines(c)))


def cue_text(c) -> Column:
    """The form cues are searched in: non-ASCII ends the line, length kept."""
    return ascii_newline(returns_to_newlines(c))


def scope_sentences(c) -> Column:
    """Assertion scopes: the pieces of ``sentences`` cut again after newlines.

    Taken on the length-kept text, so the pieces concatenate to it.
    """
    return F.split(
        ascii_blank(returns_to_newlines(c)), SENTENCE_CUT + r"|(?<=\n)", -1
    )


def with_starts(pieces) -> Column:
    """``array<struct<piece, start, end>>`` for pieces that concatenate to a text."""
    return let(
        _col(pieces),
        lambda p: let(
            starts(p, 0),
            lambda s: F.transform(
                p,
                lambda x, i: F.struct(
                    x.alias("piece"),
                    F.get(s, i).alias("start"),
                    (F.get(s, i) + F.length(x)).alias("end"),
                ),
            ),
        ),
    )


# Pieces of ASCII text: a token and the separators after it.  The mark ends a
# sentence, FOREIGN stands for a character that is not ASCII; since neither is
# ASCII, the text itself cannot hold them.
FOREIGN = "\ue001"
ASCII_SEPARATORS = ASCII_SPACES + ";.,:"
_ASCII_SEPARATOR = _ASCII_SPACES + f";.,:{MARK}-{FOREIGN}"
PIECE_CUT = f"(?<=[{_ASCII_SEPARATOR}])(?=[^{_ASCII_SEPARATOR}])"


def marked_model_text(c) -> Column:
    """``model_text`` with a mark at every sentence cut."""
    return F.regexp_replace(model_text(c), SENTENCE_CUT, MARK)


def marked_scope_text(c) -> Column:
    """The text with marks at scope cuts and ``FOREIGN`` for non-ASCII characters."""
    plain = replace_foreign(returns_to_newlines(c), FOREIGN)
    return F.regexp_replace(plain, rf"(?<=[.?])(?=[\s{FOREIGN}]+[A-Z])|(?<=\n)", MARK)


def piece_token(piece: Column) -> Column:
    return F.rtrim(piece, F.lit(ASCII_SEPARATORS + MARK + FOREIGN))


def piece_words(marked: Column) -> Column:
    """The tokens of the pieces of a marked text, in one pass over it: ``piece_token`` of the k-th piece is element k.

    Only the first piece can be without a token; behind the last one an empty element may follow.
    """
    return F.split(F.regexp_replace(marked, f"[{_ASCII_SEPARATOR}]+", " "), " ", -1)


def ascii_tokens(c) -> Column:
    """``tokens`` with ``ascii_drop`` on each, in passes over the whole text.

    A token of non-ASCII characters alone stays, as the empty token.
    """
    # The empty piece at the end keeps "no token" apart from "one empty token".
    return let(
        F.array_join(F.array_append(tokens(c), ""), " "),
        lambda joined: let(
            F.split(ascii_drop(joined), " ", -1), lambda a: F.slice(a, 1, F.size(a) - 1)
        ),
    )


def text_lines(c) -> Column:
    """Lines of a text; the newline that ends the text opens no further line."""
    return let(
        F.split(_col(c), "\n"),
        lambda a: F.when(
            F.element_at(a, -1) == "", F.slice(a, 1, F.size(a) - 1)
        ).otherwise(a),
    )
