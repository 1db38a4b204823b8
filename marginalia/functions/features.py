"""Lexical features of one token, as column expressions.

The token is expected to be ASCII (``ascii_drop``); it may be empty.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

PUNCT = r"\p{Punct}"
MIXED_CASE = "(^|[^A-Za-z])[a-z]|[A-Za-z][A-Z]"

# A character that stands for each class of ASCII characters.
CLASSES = {
    "0": string.digits, ".": string.punctuation, "e": "aeiou", "E": "AEIOU",
    "b": "bcdfghjklmnpqrstvwxyz", "B": "BCDFGHJKLMNPQRSTVWXYZ",
}

# The output order of the feature table.
FEATURE_ORDER = [
    "names", "AllPunctuations", "HasPunctuation", "Digit", "ExistinDict", "Lemma", "Stem",
    "Lowercase", "Title", "Uppercase", "Vowel_count", "digit_in_words", "last_2", "last_3",
    "length", "percentageDigit", "percentagePunc", "percentageUpper", "percentagelower",
]


def last_chars(t: Column, n: int) -> Column:
    return F.right(t, F.lit(n))


def is_digit(t: Column) -> Column:
    """The pattern is tried only where the first character is a digit."""
    return (t >= "0") & (t < ":") & t.rlike("^[0-9]+$")


def is_title(t: Column) -> Column:
    """A capital only after a caseless character, a small letter only after a cased one.

    The patterns are tried only where lower case differs from the token.
    """
    return (F.lower(t) != t) & t.rlike("[A-Z]") & ~t.rlike(MIXED_CASE)


def vowel_count(t: Column) -> Column:
    return F.regexp_count(t, F.lit("[aeiouAEIOU]"))


def has_digit(t: Column) -> Column:
    return t.rlike("[0-9]")


def has_punctuation(t: Column) -> Column:
    return t.rlike(PUNCT)


def all_punctuation(t: Column) -> Column:
    """True for the empty token as well."""
    return t.rlike(f"^{PUNCT}*$")


def share(t: Column, char_class: str) -> Column:
    """Share 0..1 of the characters in ``char_class``; 0 for the empty token."""
    return F.when(F.length(t) == 0, F.lit(0.0)).otherwise(F.regexp_count(t, F.lit(char_class)) / F.length(t))


def token_features(t: Column) -> dict[str, Column]:
    """All features that need the token alone, by output name.

    The token is read once: each character becomes its class, and the classes
    are counted by length.  The generated code does both once per token.
    """
    size = F.length(t)
    shape = F.translate(t, "".join(CLASSES.values()), "".join(k * len(of) for k, of in CLASSES.items()))

    def count(mark: str) -> Column:
        return size - F.length(F.replace(shape, F.lit(mark), F.lit("")))

    digits, punct, upper, lower = count("0"), count("."), count("E") + count("B"), count("e") + count("b")

    def part(count: Column) -> Column:
        return F.when(size == 0, F.lit(0.0)).otherwise(count / size)

    return {
        "AllPunctuations": punct == size,
        "HasPunctuation": punct > 0,
        "Digit": (digits == size) & (size > 0),
        "Lowercase": F.lower(t),
        "Title": (upper > 0) & ~shape.rlike(MIXED_CASE),
        "Uppercase": F.upper(t),
        "Vowel_count": count("e") + count("E"),
        "digit_in_words": digits > 0,
        "last_2": last_chars(t, 2),
        "last_3": last_chars(t, 3),
        "length": size,
        "percentageDigit": part(digits),
        "percentagePunc": part(punct),
        "percentageUpper": part(upper),
        "percentagelower": part(lower),
    }


def rule_type(t: Column) -> Column:
    """Built-in rule: all digits is ``NUM``, title case is ``NAME``, else null."""
    return F.when(is_digit(t), F.lit("NUM")).when(is_title(t), F.lit("NAME"))
