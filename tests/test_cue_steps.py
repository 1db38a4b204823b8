"""The steps by which cues are found: words of one pass, starts without single characters, hits grouped once."""

import io
import random
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from marginalia.functions import text as tx
from marginalia.functions.sequence import running_total
from marginalia.operators import assertion as asr

CUES = [("no", "pre"), ("no sign of", "pre"), ("but", "term"), ("of", "post"), ("sign", "pseudo")]


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def odd_texts() -> list[str]:
    parts = ["no", "No", "sign", "of", "but.", " ", "\n", ". ", "? ", "é", ", ", "Z", "\r\n", ":"]
    pick = random.Random(3)
    return ["", " ", "\n\n", " . a", "Why? Yes", "end. \nNext\n\n Two", None] + [
        "".join(pick.choice(parts) for _ in range(pick.randint(0, 40))) for _ in range(200)
    ]


def test_piece_words_are_the_tokens_of_the_pieces(spark):
    texts = spark.createDataFrame([(x,) for x in odd_texts()], "text string").select(tx.marked_scope_text("text").alias("m"))
    pieces = F.split("m", tx.PIECE_CUT, -1)
    rows = texts.select(
        F.transform(pieces, tx.piece_token).alias("one_by_one"),
        F.slice(tx.piece_words(F.col("m")), 1, F.size(pieces)).alias("at_once"),
    ).collect()
    assert all(r["one_by_one"] == r["at_once"] for r in rows)


def test_scope_tokens_do_not_take_the_text_apart_into_characters(spark):
    docs = spark.createDataFrame([(1, "no sign of it")], "doc_id long, text string")
    assert ", , -1)" not in plan(asr.cue_spans(docs, CUES))


def test_scope_tokens_stand_where_their_words_are(spark):
    texts = [x for x in odd_texts() if x]
    docs = spark.createDataFrame([(x,) for x in texts], "text string")
    for row in docs.select("text", asr.scope_tokens(F.col("text")).alias("tokens")).collect():
        for t in row["tokens"]:
            assert t["word"] and row["text"][t["start"] : t["end"]].lower() == t["word"]


def test_running_totals_beyond_32_bits(spark):
    rows = spark.createDataFrame([([1 << 40] * 50,), ([],), (None,)], "v array<long>")
    found = [r[0] for r in rows.select(running_total(F.col("v"), "long")).collect()]
    assert found[0] == [n << 40 for n in range(50)]


def test_table_cues_are_grouped_once(spark):
    docs = spark.createDataFrame(enumerate(x for x in odd_texts()), "doc_id long, text string")
    table = spark.createDataFrame(CUES, "cue string, kind string")
    by_table = asr.cue_spans(docs, table)
    assert plan(by_table).count("hashpartitioning(doc_id") == 1
    rows = [sorted(map(tuple, d.collect())) for d in (by_table, asr.cue_spans(docs, CUES))]
    assert rows[0] == rows[1] and rows[0]
