"""Separators and token features that are cheap by character hold for every character."""

import re

from pyspark.sql import functions as F

from marginalia.functions import features as ft
from marginalia.functions import text as tx

OLD_SPACES = (
    r"\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)


def test_separators_are_the_same_characters(spark):
    every = spark.range(1, 0xFFFF).filter("id < 55296 OR id > 57343").select(F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("c"))
    cut = [(f"[{tx.SPACE_RANGES};.,:]", f"[{OLD_SPACES};.,:]"), (f"[^{tx.SPACE_RANGES};.,:]", f"[^{OLD_SPACES};.,:]")]
    cut.append((f"[{tx._ASCII_SEPARATOR}]", r"[\t-\r\x1c-\x20;.,:" + tx.MARK + tx.FOREIGN + "]"))
    cut.append((f"[^{tx._ASCII_SEPARATOR}]", r"[^\t-\r\x1c-\x20;.,:" + tx.MARK + tx.FOREIGN + "]"))
    assert every.count() == 0xFFFF - 1 - 2048
    for new, old in cut:
        assert every.filter(F.col("c").rlike(new) != F.col("c").rlike(old)).count() == 0


def test_ascii_separators_need_no_test_of_a_range():
    """Ranges below 256 are tested one after the other on each character."""
    assert not re.search(r"\\t-|\\x1c-", tx.SEPARATOR + tx.PIECE_CUT)


def test_features_are_counts_of_single_characters(spark):
    names = ["", "Abc", "ABC", "aB", "12", "1a", "x!", "!?", "A1b", "(Ab)", "aeiouAEIOU", "Z\n", "12\n", "O'Neil", "é", "É", "Éa", "a b", None]
    names += [chr(n) for n in range(1, 128)] + [f"{chr(n)}B{chr(n)}c" for n in range(1, 128)]
    df = spark.createDataFrame([(n,) for n in names], "t string")
    t = F.col("t")

    def count(pattern):
        return F.regexp_count(t, F.lit(pattern))

    size, made = F.length(t), ft.token_features(t)
    title = t.rlike("[A-Z]") & ~t.rlike("(^|[^A-Za-z])[a-z]|[A-Za-z][A-Z]")
    digit = t.rlike("^[0-9]+$")
    wanted = {
        "AllPunctuations": count(ft.PUNCT) == size, "HasPunctuation": count(ft.PUNCT) > 0, "Title": title,
        "Digit": (count("[0-9]") == size) & (size > 0), "Vowel_count": count("[aeiouAEIOU]"), "digit_in_words": count("[0-9]") > 0,
        "percentageUpper": F.when(size == 0, 0.0).otherwise(count("[A-Z]") / size),
        "percentagelower": F.when(size == 0, 0.0).otherwise(count("[a-z]") / size),
        "percentagePunc": F.when(size == 0, 0.0).otherwise(count(ft.PUNCT) / size),
        "percentageDigit": F.when(size == 0, 0.0).otherwise(count("[0-9]") / size),
    }
    pairs = {**{n: (made[n], w) for n, w in wanted.items()}, "is_title": (ft.is_title(t), title), "is_digit": (ft.is_digit(t), digit)}
    wrong = df.select(t, *[(~a.eqNullSafe(b)).alias(n) for n, (a, b) in pairs.items()])
    assert wrong.filter(" OR ".join(pairs)).collect() == []
    assert "regexp" not in str(made["Vowel_count"]) and "regexp" not in str(made["percentagelower"])
