"""Hand-worked cases."""

import pytest
from pyspark.sql import functions as F

from marginalia.functions import features as ft
from marginalia.functions import keys as ky
from marginalia.functions import spans as sp
from marginalia.functions import text as tx
from marginalia.operators import assertion as asr
from marginalia.operators import batching, metrics
from marginalia.operators import markup as mk
from marginalia.operators import text as ot
from marginalia.plans import jobs


def strings(*items):
    return F.array(*[F.lit(i) for i in items]).cast("array<string>")


def tuples(rows):
    return [tuple(r) for r in rows]


def test_tokens(value):
    text = F.lit("a, b.c\nMr. X-1")
    assert value(tx.tokens(text)) == ["a", "b", "c", "Mr", "X-1"]
    assert value(tx.token_lines(text)) == ["a", "", "b", "c", "Mr", "", "X-1"]
    assert value(tx.token_lines(F.lit(""))) == []
    assert value(tx.tokens(F.lit(" .; "))) == []


def test_ascii_tokens_keep_the_empty_token(value):
    assert value(tx.ascii_tokens(F.lit("é a né."))) == ["", "a", "n"]
    assert value(tx.ascii_tokens(F.lit("é"))) == [""]
    assert value(tx.ascii_tokens(F.lit(" , "))) == []


def test_sentences(value):
    found = value(tx.with_starts(tx.sentences(F.lit("No fever. Has cough? Yes. ok"))))
    assert tuples(found) == [("No fever.", 0, 9), (" Has cough?", 9, 20), (" Yes. ok", 20, 28)]
    assert value(tx.sentences(F.lit(""))) == [""]
    assert value(tx.sentences(F.lit("Stop! Now"))) == ["Stop! Now"]


def test_length_kept_forms(value):
    text = "a\r\né☃b"
    assert value(tx.model_text(F.lit(text))) == "a    b"
    assert value(tx.cue_text(F.lit(text))) == "a\n\n\n\nb"
    assert value(tx.ascii_drop(F.lit(text))) == "a\r\nb"


MARKUP = (
    '<?xml version="1.0"?><alto xmlns="http://x/y#"><Layout><Page ID="1"><PrintSpace><TextLine>'
    "<String CONTENT=\"Chief\"/><SP/><String ID=\"2\" CONTENT='complaint &amp; x' /></TextLine>"
    '<TextLine><String CONTENT="none"/></TextLine></PrintSpace></Page></Layout></alto>'
)


@pytest.mark.parametrize("cut", [0, 7, 30])
def test_markup_also_when_cut_short(spark, cut):
    docs = spark.createDataFrame([(1, MARKUP[: len(MARKUP) - cut])], "doc_id int, text string")
    assert mk.markup_text(docs).first()["text"] == "\n<EPI_PAGEBREAKER>\n\n\nChief complaint & x\nnone"


def test_markup_variants(spark, value):
    text = (
        '<a:alto><a:Page><a:TextLine><a:String CONTENT="n&#233;&#x41;"/><a:String ID="3"/>'
        '<a:String CONTENT="&amp;lt;>"/></a:TextLine><a:TextLine/></a:Page>'
        "<a:Page/><Page2><TextLine><String CONTENT='no'/></TextLine></Page2></a:alto>"
    )
    docs = spark.createDataFrame([(1, text), (2, "")], "doc_id int, text string")
    rows = [tuple(r) for r in mk.page_lines(docs).orderBy("page_no", "line_no").collect()]
    assert rows[0] == (1, 0, 0, "néA &lt;>")
    assert rows[1] == (1, 0, 1, "")
    counts = {r["doc_id"]: (r["pages"], r["lines"]) for r in mk.page_counts(docs).collect()}
    assert counts[2] == (0, 0)
    assert value(mk.unescape(F.lit("&#0;&#xD800;&#x10FFFF;"))) == "&#0;&#xD800;\U0010ffff"
    assert value(mk.unescape(F.lit("&#38;lt;&amp;#65;&#x0000041;&#00000065;&#x110000;&#99999999999;&zz;&"))) == (
        "&lt;&#65;AA&#x110000;&#99999999999;&zz;&"
    )


def test_comments_and_cdata(spark):
    rows = [
        ("<Page><!-- <Page><L>no</L> --><L>a<!-- x > y -->b</L></Page>", ["ab"]),
        ("<Page><L><![CDATA[<i> & &lt; <!-- kept -->]]></L></Page>", ["<i> & &lt; <!-- kept -->"]),
        ("<Page><!-- <![CDATA[ --><L>x</L><!-- open </Page>", ["x"]),
        ("<Page><s>a <!-- b</s><L>y</L></Page>", ["y"]),
    ]
    for text, expected in rows:
        docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
        lines = mk.page_lines(docs, line="L", content=mk.inner_text, skip=("s",)).orderBy("page_no", "line_no").collect()
        assert [r["line"] for r in lines] == expected
        assert {r["page_no"] for r in lines} == {0}


FEATURES = {
    "O'Neil": (6, "eil", "il", False, True, 3, False, True, False, 0, 1 / 6, 2 / 6, 3 / 6),
    "3rd": (3, "3rd", "rd", False, False, 0, True, False, False, 1 / 3, 0, 0, 2 / 3),
    "12": (2, "12", "12", True, False, 0, True, False, False, 1, 0, 0, 0),
    "--": (2, "--", "--", False, False, 0, False, True, True, 0, 1, 0, 0),
    "é": (0, "", "", False, False, 0, False, False, True, 0, 0, 0, 0),
}


def test_features(spark):
    columns = [
        "length", "last_3", "last_2", "Digit", "Title", "Vowel_count", "digit_in_words", "HasPunctuation",
        "AllPunctuations", "percentageDigit", "percentagePunc", "percentageUpper", "percentagelower",
    ]
    docs = spark.createDataFrame([(t,) for t in FEATURES], "raw string")
    made = ft.token_features(tx.ascii_drop("raw"))
    for row in docs.select("raw", *[made[c].alias(c) for c in columns]).collect():
        assert tuple(row)[1:] == pytest.approx(FEATURES[row["raw"]]), row["raw"]


@pytest.mark.parametrize("token", ["3Rd", "3rd", "O'Neil", "O'neil", "A", "AB", "Ab", "aB", "1", "", "A1b", "A1B"])
def test_title_is_like_python(value, token):
    assert value(ft.is_title(F.lit(token))) == token.istitle()


def test_bio_spans(value):
    tokens = strings("Mr", "John", "Smith", "has", "fever")
    found = value(sp.bio_spans(tokens, strings("O", "B-PER", "I-PER", "O", "B-SYM")))
    assert tuples(found) == [("John Smith", 3, 13, "PER"), ("fever", 18, 23, "SYM")]
    found = value(sp.bio_spans(strings(*"abcde"), strings("I-A", "B-A", "I-B", "O", "I-A")))
    assert tuples(found) == [("b c", 2, 5, "A")]
    assert tuples(value(sp.bio_spans(strings("x", "y"), strings("B-A-C", "B-D", "O")))) == [
        ("x", 0, 1, "A-C"), ("y", 2, 3, "D"),
    ]
    assert value(sp.bio_spans(strings(), strings())) == []
    assert value(sp.bio_spans(strings("a"), strings("O"))) == []


def test_run_spans_with_blank_rule(value):
    tokens, labels = strings("a", "bb", "-", "c", "d"), strings("X", "X", "O", "X", "Y")
    pairs = F.arrays_zip(tokens.alias("t"), labels.alias("l"))
    found = sp.run_spans(
        F.transform(tokens, sp.blank_rule_token), F.transform(pairs, lambda p: sp.blank_rule_label(p["t"], p["l"]))
    )
    assert tuples(value(found)) == [("a bb", 0, 4, "X"), ("c", 6, 7, "X"), ("d", 8, 9, "Y")]
    assert value(sp.blank_rule_label(F.lit("x"), F.lit(""))) == "O"


def entities(*pairs):
    return F.array(
        *[
            F.struct(F.lit(t).alias("text"), F.lit(i).alias("start"), F.lit(i + 1).alias("end"), F.lit(k).alias("type"))
            for i, (k, t) in enumerate(pairs)
        ]
    )


def test_sections(value):
    found = entities(
        ("Dx", "flu"), ("SectionHeader", "HPI"), ("Dx", "cough"), ("SectionHeader", "PMH"), ("Dx", "copd")
    )
    assert [e["section"] for e in value(sp.carry_sections(found))] == [None, None, "HPI", None, "PMH"]


def test_an_empty_header_still_sets_the_section(value):
    found = entities(("SectionHeader", "HPI"), ("SectionHeader", " \t"), ("Dx", " a "))
    kept = value(sp.drop_empty_entities(sp.carry_sections(sp.trim_entity_text(found))))
    assert [(e["text"], e["start"], e["section"]) for e in kept] == [("HPI", 0, None), ("a", 2, "")]


CUES = [("no", "pre"), ("denies", "pre"), ("no increase", "pseudo"), ("but", "term"), ("ruled out", "post")]


def asserted(spark, text, cues=CUES):
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    return {e["text"]: e["assertion"] for e in jobs.sentence_job(docs, cues=cues).first()["entities"]}


@pytest.mark.parametrize(
    "text, entity, expected",
    [
        ("has no Fever", "Fever", "negated"),
        ("no sign but Fever", "Fever", "affirmed"),
        ("no a b c d e Fever", "Fever", "negated"),
        ("no a b c d e f Fever", "Fever", "affirmed"),
        ("Fever was ruled out", "Fever", "negated"),
        ("Fever but x ruled out", "Fever", "affirmed"),
        ("no increase in Fever", "Fever", "affirmed"),
        ("no. Fever", "Fever", "affirmed"),
        ("no\nFever", "Fever", "affirmed"),
        ("Fever was ruled é out", "Fever", "affirmed"),
        ("No and Fever", "No", "affirmed"),
    ],
)
def test_assertions(spark, text, entity, expected):
    assert asserted(spark, text)[entity] == expected


def test_cue_spans(spark):
    docs = spark.createDataFrame([(1, "has no pain.\nno increase. Ruled out")], "doc_id int, text string")
    rows = asr.cue_spans(docs, CUES).orderBy("start").collect()
    assert [(r["sent_id"], r["start"], r["end"], r["cue"], r["kind"]) for r in rows] == [
        (0, 4, 6, "no", "pre"), (1, 13, 24, "no increase", "pseudo"), (2, 26, 35, "ruled out", "post"),
    ]


def test_long_cue_lists_and_cue_tables(spark):
    many = CUES + [(f"word{i} again", "pseudo") for i in range(2_500)]
    text = "He denies pain. Fever ruled out word2499 again."
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    table = spark.createDataFrame(many, "cue string, kind string")
    for cues in (many, table):
        found = asr.cue_spans(docs, cues).orderBy("start").collect()
        assert [(r["cue"], r["kind"]) for r in found] == [
            ("denies", "pre"), ("ruled out", "post"), ("word2499 again", "pseudo"),
        ]


def test_documents_without_entities_keep_an_empty_array(spark):
    docs = spark.createDataFrame([(1, ""), (2, "plain words"), (3, "...")], "doc_id int, text string")
    for job in (jobs.token_job, jobs.sentence_job, jobs.chunk_job, lambda d: jobs.sentence_job(d, cues=CUES)):
        assert sorted((r["doc_id"], r["entities"]) for r in job(docs).collect()) == [(1, []), (2, []), (3, [])]


@pytest.mark.parametrize("n", [0, 1, 49, 50, 51, 120])
def test_chunks(spark, n):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(n)))], "doc_id int, text string")
    rows = [r["chunk_text"] for r in ot.chunks(docs).orderBy("chunk").collect()]
    assert rows == [" ".join(f"w{i}" for i in range(k, min(k + 50, n))) for k in range(0, n, 50)]


def test_line_chunks_against_a_plain_loop(spark):
    lines = [("a." if i % 7 == 0 else "b") for i in range(140)] + ["c"] * 75
    docs = spark.createDataFrame([(1, "\n".join(lines))], "doc_id int, text string")
    expected, open_chunk = [], []
    for line in lines:
        open_chunk.append(line)
        if len(open_chunk) == 50 or ("." in line and len(open_chunk) > 10):
            expected.append(" ".join(open_chunk))
            open_chunk = []
    expected.append(" ".join(open_chunk))
    assert [r["chunk_text"] for r in ot.line_chunks(docs).orderBy("chunk").collect()] == expected


@pytest.mark.parametrize(
    "n, size, fill, expected",
    [
        (5, 2, True, [["k1", "k2"], ["k3", "k4"], ["k5", "k1"]]),
        (5, 2, False, [["k1", "k2"], ["k3", "k4"], ["k5"]]),
        (3, 32, True, [["k1", "k2", "k3"]]),
        (0, 4, True, []),
    ],
)
def test_batches(spark, n, size, fill, expected):
    keys = spark.createDataFrame([(f"k{i + 1}",) for i in range(n)], "key string")
    rows = batching.batches(keys, "key", size, fill=fill).orderBy("batch", "slot").collect()
    got: dict[int, list[str]] = {}
    for r in rows:
        got.setdefault(r["batch"], []).append(r["key"])
    assert list(got.values()) == expected


@pytest.mark.parametrize("inputs, outputs, failed", [(10, 7, 3), (5, 6, 0), (0, 0, 0)])
def test_run_summary(spark, inputs, outputs, failed):
    from datetime import datetime

    row = metrics.run_summary(
        spark.range(inputs), spark.range(outputs),
        start=datetime(2024, 1, 1), end=datetime(2024, 1, 1, 0, 1), instances=2,
    ).first()
    assert (row["inputs"], row["success"], row["failed"]) == (inputs, outputs, failed)
    assert row["total_seconds"] == 60.0


def test_keys(value):
    key = F.lit("s3://b/x/a.1.txt")
    assert value(ky.short_id(key)) == "a"
    assert value(ky.document_id(key)) == "a.1"
    assert value(ky.has_suffix(key, ".txt")) and not value(ky.has_suffix(F.lit("b/x.txt/"), ".txt/"))
    assert value(ky.listed_after(F.lit("p/b"), "p/", "p/a")) and not value(ky.listed_after(F.lit("p/a"), "p/", "p/a"))


def folded(lines):
    """The chunk rule, line by line."""
    chunks, chunk = [], []
    for line in lines:
        chunk.append(line)
        if len(chunk) == 50 or "." in line and len(chunk) > 10:
            chunks.append(" ".join(chunk))
            chunk = []
    return chunks + ([" ".join(chunk)] if chunk else [])


@pytest.mark.parametrize("block", [1, 7, 50, 1024])
def test_line_chunks_over_blocks(spark, monkeypatch, block):
    import random

    monkeypatch.setattr(ot, "FOLD_LINES", block)
    rnd = random.Random(block)
    texts = [[f"l{n}" + "." * (rnd.random() < share) for n in range(size)] for size in (0, 1, 10, 11, 12, 49, 50, 51, 101, 1500) for share in (0, 0.05, 0.5, 1)]
    docs = spark.createDataFrame([(i, "\n".join(t)) for i, t in enumerate(texts)], "doc_id int, text string")
    found = {}
    for r in ot.line_chunks(docs).orderBy("doc_id", "chunk").collect():
        found.setdefault(r["doc_id"], []).append(r["chunk_text"])
    assert found == {i: folded(t) for i, t in enumerate(texts) if t}


def test_quoted_values_may_hold_the_end_of_a_tag(spark):
    from marginalia.operators import markup as mk

    how = {"page": "article", "line": "p", "content": mk.inner_text, "skip": ("script",)}
    cases = {
        '<article x="a>b"><p title="a>b">text</p></article>': ["text"],
        "<article><p title='1 > 0' class=\"x\">one</p><p>t<b id='>'>w</b>o</p></article>": ["one", "two"],
        '<article><p title="open>still</p><p class="y">more</p></article>': ["still", "more"],
        '<article><script type="a>b">x<p>no</p></script><p>yes</p></article>': ["yes"],
        '<article><p title="a>b"/><p>after</p></article>': ["", "after"],
        "<article><p>a < b and c > d</p><p>3 <4</p></article>": ["a  d", "3 <4"],
        '<article><p>cut</p><p title="a>b': ["cut"],
        "<article><p a=b/c>slash</p><p a='/' />": ["slash", ""],
        "<article><p " + "x='>' " * 2000 + ">many</p></article>": ["many"],
    }
    docs = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "doc_id int, text string")
    got = {i: [] for i in range(len(cases))}
    for r in mk.page_lines(docs, **how).orderBy("doc_id", "line_no").collect():
        got[r["doc_id"]].append(r["line"])
    assert list(got.values()) == list(cases.values())
