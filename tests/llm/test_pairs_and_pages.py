"""Token alignment, hard negatives and page extraction against brute force, and over awkward tables."""

import hashlib
import html as html_module
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marginalia.llm import hard_negatives, html_extract, html_tree, queries, token_align

SF = "/root/testdata/sf0.001"
BYTES, PIECES = queries.byte_vocabulary(), queries.piece_vocabulary()


# --- token alignment ---------------------------------------------------------

PARTS = [
    " ", "  ", "\n", "\t", " \n ", "  ", "　", "a", "the", "'s", " x", "é", "é", "\U0001f642",
    "\U0001f469‍\U0001f467", "▁", "<s>", "<|endoftext|>", "<0x41>", "<unk>", "123", "!!", "中文", "\r",
    "\x00", "﻿ ", "​ ", "᠎ ", "ß", "  the", "\x1c ", "\x85 ", "ﬁ",
]


def alignment_by_brute_force(docs):
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    alphabet = token_align.byte_alphabet()

    def piece_bytes(i):
        name = pieces.id_to_piece(i)
        return bytes([int(name[3:-1], 16)]) if pieces.is_byte(i) else name.replace("▁", " ").encode()

    read, documents_with = {}, Counter()
    for i, text in docs:
        read[i] = None
        if not text:
            continue
        found = library.encode(" " + text, add_special_tokens=False)
        a = [(x, len(name)) for x, name in zip(found.ids, found.tokens)]
        b = [(x, len(piece_bytes(x))) for x in pieces.encode(text)]
        whole = (" " + text).encode()
        if bytes(alphabet[c] for t in found.tokens for c in t) != whole or b"".join(piece_bytes(x) for x, _ in b) != whole:
            continue
        ends = [set(np.cumsum([n for _, n in side]).tolist()) for side in (a, b)]
        cuts = sorted(ends[0] & ends[1])
        groups = [([], []) for _ in cuts]
        for side, tokens in enumerate((a, b)):
            at = 0
            for x, n in tokens:
                at += n
                groups[next(k for k, c in enumerate(cuts) if c >= at) if len(cuts) < 50 else np.searchsorted(cuts, at)][side].append(x)
        links = Counter((x, y) for xs, ys in groups for x in xs for y in ys)
        documents_with.update(links.keys())
        read[i] = len(a), len(b), groups, links
    best = {}
    for (x, _), n in documents_with.items():
        best[x] = max(best.get(x, 0), n)
    out = {}
    for i, one in read.items():
        if one is None:
            out[i] = (0, 0, 0, 0, 0, 0, "")
            continue
        n_a, n_b, groups, links = one
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[i] = (
            n_a, n_b, len(groups), sum(links.values()), sum(n for p, n in links.items() if documents_with[p] == best[p[0]]),
            sum(n * documents_with[p] for p, n in links.items()), hashlib.sha256(shown.encode()).hexdigest(),
        )
    return out


def rows_of(df):
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return {r["doc_id"]: tuple(r[n] for n in names) for r in df.collect()}


def test_alignment_by_brute_force(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(1, 40))) for _ in range(600)]
    texts += [None, "", " ", "  ", "a ", "a  ", " a", "x" * 20_000, "中" * 3000, "ab " * 9000, "▁", "\U0001f642" * 2000]
    texts += ["the same words again"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = alignment_by_brute_force(list(enumerate(texts)))
    assert rows_of(token_align.link_counts(docs, BYTES, PIECES)) == want
    # Pairs beyond those that are broadcast are dealt by pair; the rows are the same.
    assert rows_of(token_align.link_counts(docs, BYTES, PIECES, most=40)) == want


def test_alignment_query_by_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows_of(queries.op11_token_alignment(spark, SF)) == alignment_by_brute_force(docs)


def test_alignment_does_not_depend_on_lanes_or_memory(monkeypatch):
    chunks = token_align.Chunks(BYTES, PIECES)
    texts = ["one two three " * 400, "", "▁ x", "word " * 30 + "é"]
    whole = token_align.aligned(chunks, texts)
    for lane, memo in ((1, 10_000), (7, 3), (10**9, 2)):
        monkeypatch.setattr(token_align, "LANE_TOKENS", lane)
        monkeypatch.setattr(token_align, "MEMO_CHUNKS", memo)
        again = token_align.aligned(token_align.Chunks(BYTES, PIECES), texts)
        for one, other in zip(whole[:5] + whole[5], again[:5] + again[5]):
            assert np.array_equal(one, other)


def test_wide_groups_count_every_link(monkeypatch):
    a, b = np.array([5, 5, 7]), np.array([1, 2, 1, 1])
    groups = tuple(np.array([x]) for x in (0, 3, 0, 4))
    counted = []
    for limit in (4096, 1):
        monkeypatch.setattr(token_align, "WIDE_LINKS", limit)
        counts = Counter()
        for _, pair, n in zip(*token_align.links_of(a, b, groups)):
            counts[pair >> token_align.PIECE_BITS, pair & ((1 << token_align.PIECE_BITS) - 1)] += n
        counted.append(counts)
    assert counted[0] == counted[1] == {(5, 1): 6, (5, 2): 2, (7, 1): 3, (7, 2): 1}


def test_alignment_of_awkward_tables(spark):
    schema = "doc_id long, text string, row string, pair long, n_a string, count string"
    rows = [(1, "some text", "r", 1, "n", "c")] * 3 + [(None, "some text", None, None, None, None), (2, None, "", 0, "", "")]
    docs = spark.createDataFrame(rows, schema)
    found = token_align.link_counts(docs, BYTES, PIECES).collect()
    assert len(found) == 5 and len({r["groups_sha256"] for r in found}) == 2
    assert {r["count_sum"] // max(r["n_links"], 1) for r in found} == {0, 4}  # each of the four rows counts as a document
    assert token_align.link_counts(docs.filter("doc_id > 5"), BYTES, PIECES).collect() == []


# --- hard negatives ----------------------------------------------------------


def negatives_by_brute_force(rows, is_anchor, settings=hard_negatives.Settings()):
    def fine(x):
        return x is not None and math.isfinite(x)

    usable = [(i, k, [math.floor(settings.scale * x) for x in v]) for i, k, v in rows
              if i is not None and k is not None and v is not None and all(map(fine, v))]
    anchors = {}
    for i, k, v in usable:
        if is_anchor(i):
            anchors[i] = min(anchors.get(i, (k, v)), (k, v))
    out = []
    for i, (label, vector) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(vector, v)), j, k) for j, k, v in usable)
        positives = [(-s, j) for s, j, k in scored if k == label and j != i][: settings.positives]
        for score, j in positives:
            fits = [(-s, n) for s, n, k in scored if k != label and settings.low * score <= -100 * s <= settings.high * score]
            out += [(i, j, rank, n, score, s) for rank, (s, n) in enumerate(fits[: settings.negatives], 1)]
    return sorted(out)


def mined(spark, rows, partitions=3, **more):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(partitions)
    return sorted(map(tuple, hard_negatives.mined(df, F.col("vec_id") % 10 == 0, **more).collect()))


@pytest.fixture(scope="module")
def vectors():
    rnd = random.Random(4)
    rows = [(i, rnd.randrange(3), [rnd.randint(-4, 4) / 4 for _ in range(6)]) for i in range(300)]  # many equal scores
    rows += [(1000 + i, i % 2, [0.5] * 6) for i in range(120)]  # a large group of copies
    rows += [(2000, None, [1.0] * 6), (2010, 1, None), (2020, 1, [1.0, None]), (2030, 1, [float("nan")]), (None, 1, [1.0] * 6),
             (2040, 1, [float("inf")]), (2050, 1, []), (2060, 2, [1.0]), (10, 0, [0.25] * 6)]
    return rows


def test_negatives_by_brute_force(spark, vectors, monkeypatch):
    want = negatives_by_brute_force(vectors, lambda i: i % 10 == 0)
    assert len(want) > 500
    assert mined(spark, vectors) == want
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 11)  # several blocks of anchors
    assert mined(spark, vectors, partitions=7) == want


def test_negatives_of_other_settings(spark, vectors):
    settings = hard_negatives.Settings(scale=16, positives=2, negatives=3, low=50, high=90)
    assert mined(spark, vectors, settings=settings) == negatives_by_brute_force(vectors, lambda i: i % 10 == 0, settings)
    with pytest.raises(ValueError):
        mined(spark, vectors, settings=hard_negatives.Settings(high=120))


def test_products_are_exact_beyond_the_floats():
    rows, anchors = np.array([[1 << 40, 1]]), np.array([[1 << 20, 1], [1 << 40, 0]])
    assert hard_negatives.products(rows, anchors).tolist() == [[(1 << 60) + 1, hard_negatives.LONGEST]]


def test_negatives_of_awkward_tables(spark):
    schema = "vec_id long, label int, embedding array<float>, id string, score string, anchor_id long, vector int"
    rows = [(0, 1, [1.0], "", "", 1, 1), (1, 1, [1.0], "", "", 1, 1), (2, 2, [0.9], "", "", 1, 1), (2, 2, [0.9], "", "", 1, 1)]
    df = spark.createDataFrame(rows, schema)
    found = sorted(map(tuple, hard_negatives.mined(df, F.col("vec_id") == 0).collect()))
    assert found == [(0, 1, 1, 2, 65536, 256 * 230), (0, 1, 2, 2, 65536, 256 * 230)]  # a row that repeats is listed each time
    assert hard_negatives.mined(df.filter("vec_id > 9"), F.col("vec_id") == 0).collect() == []
    assert hard_negatives.mined(df.filter("vec_id = 0"), F.col("vec_id") == 0).collect() == []


# --- page extraction ---------------------------------------------------------


def texts(spark, pages, **more):
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    rows = html_extract.extracted(df, **more).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    return {r["page_id"]: r["text"] for r in rows}


def article_of(page):
    """The text of the one article of the synthetic pages, read by patterns."""
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S).group(1).replace("<br>", " ")
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner))
    return "\n".join(x for x in (" ".join(html_module.unescape(b).split()) for b in blocks) if x)


@pytest.mark.parametrize("more", [{}, {"broadcast_bytes": 0, "settings": html_extract.Settings(salt_rows=20, buckets=3)}])
def test_articles_of_the_synthetic_pages(spark, more):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = html_extract.extracted(pages, **more).join(pages.select("page_id", "html"), "page_id").collect()
    assert len(rows) == pages.count()
    for r in rows:
        assert r["text"] == article_of(r["html"]) and r["n_chars"] == len(r["text"])


def plain_page(i, extra=""):
    """A layout without telling names: only the other pages of the host tell the template."""
    return (
        f"<html><body><div class=x1><p>Welcome to the site</p><p>Read this first</p></div><div class=x2><p>Story {i} begins "
        f"here.</p><p>And goes&nbsp;on   with {i * 7} words &amp; more.</p><p>Share this with friends</p>{extra}</div>"
        "<div class=x3><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></div><div class=x4>All rights of the site</div>"
    )


def test_constant_nodes_are_template_and_varying_ones_content(spark):
    pages = [(i, "http://plain.example/p", plain_page(i)) for i in range(8)]
    # Another layout of the host, with an additional block in between.
    pages += [(20 + i, "http://plain.example/q", plain_page(20 + i, f"<blockquote>Said {i}</blockquote>")) for i in range(6)]
    for more in ({}, {"broadcast_bytes": 0, "settings": html_extract.Settings(salt_rows=3)}):
        found = texts(spark, pages, **more)
        for i in range(8):
            assert found[i] == f"Story {i} begins here.\nAnd goes on with {i * 7} words & more."
        assert found[23] == "Story 23 begins here.\nAnd goes on with 161 words & more.\nSaid 3"


def test_wrapper_does_not_depend_on_partitions(spark):
    pages = [(i, "http://plain.example/p", plain_page(i, "<pre>x</pre>" * (i % 3) + "<h2>y</h2>" * (i % 2))) for i in range(30)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("h"))
    trees = {
        html_extract.wrappers(df.repartition(n), html_extract.Settings(buckets=2)).first()["tree"] for n in (1, 4, 9)
    }
    assert len(trees) == 1


def test_furniture_by_its_names(spark):
    page = (
        "<html><head><title>t</title><style>p{}</style><script>var a='</p>';</script></head><body class='has-sidebar'>"
        "<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class='cookie-notice'>We use cookies</div>"
        "<form><p>Name</p><button>Send</button></form><main class='with-sidebar'><article><h1>Title</h1><p>First <b>bold</b>, "
        "<i>it</i>.<br>Next.<div class=advert>Buy</div><aside>Side</aside><p>Second&lt;p&gt; &#233;<script>x</script>"
        "<ul><li>item<li>other</ul><table><tr><td>a<td>b<tr><td>c</table><p style='display: none'>gone</p>"
        "<section id=comments-12><article class=comment><p>I say</p></article></section></article></main>"
        "<noscript>no</noscript><div class=sidebar>Menu</div><footer>&copy; us</footer><!-- ad --></body></html>"
    )
    want = "Title\nFirst bold, it. Next.\nSecond<p> é\nitem\nother\na b\nc"
    found = texts(spark, [(1, "http://a.com/x", page), (2, None, page), (3, "http://a.com/x", page[: page.index("<section")])])
    assert set(found.values()) == {want}


def test_copies_on_all_pages_of_a_host_stay(spark):
    page = "<body><nav>n</nav><article><p>The same story.</p></article></body>"
    found = texts(spark, [(i, "http://copies.example/", page) for i in range(9)])
    assert set(found.values()) == {"The same story."}


def test_awkward_pages(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after</p>"
    long = "<article>" + "<p>x y</p>" * 40_000 + "</article>"
    odd = ["<p>a<p", "<!-- open", "a < b > c", "<script>x", "<p title='a>b'>text</p>", "</div></p>t", "&#xD800;&#0;&bogus;", '<p x="y>z</p>', "<table><tr><td>1"]
    pages = [(1, None, None), (2, "", ""), (3, "x", " \n "), (4, "http://h/", deep), (5, "http://h/", long), (5, "http://h/", long)]
    pages += [(10 + i, "http://o/", x) for i, x in enumerate(odd)] + [(None, "http://o/", "<p>no id")]
    found = texts(spark, pages)
    assert found[1] == found[2] == found[3] == "" and found[4] == "deep\nafter" and found[5].count("x y") == 40_000
    assert found[10] == "a" and found[11] == "" and found[12] == "a < b > c" and found[13] == "" and found[14] == "text"
    assert found[None] == "no id" and found[18] == "1" and found[15] == "t"
    df = spark.createDataFrame([(1, "http://a/", "<p>t", "h", "x", 1)], "page_id long, url string, html string, host string, text string, n_chars int")
    assert [r["text"] for r in html_extract.extracted(df).collect()] == ["t"]
    assert html_extract.extracted(df.filter("page_id > 1")).collect() == []


def matching_by_brute_force(one, other):
    """The most pairs of nodes in a matching that keeps labels, parents and order."""
    if one.label != other.label:
        return 0

    def best(xs, ys):
        if not xs or not ys:
            return 0
        return max(best(xs[1:], ys), best(xs, ys[1:]), matching_by_brute_force(xs[0], ys[0]) + best(xs[1:], ys[1:]))

    return 1 + best(one.children, other.children)


def test_tree_matching_by_brute_force():
    rnd = random.Random(7)

    def tree(depth):
        return html_tree.Shape(rnd.choice("ab"), [tree(depth - 1) for _ in range(rnd.randint(0, 3))] if depth else [])

    for _ in range(150):
        one, other = html_tree.Shape("r", [tree(2) for _ in range(3)]), html_tree.Shape("r", [tree(2) for _ in range(3)])
        count, pairs = html_tree.matched(one, other)
        assert count == matching_by_brute_force(one, other) == len(pairs)
        assert len({id(a) for a, _ in pairs}) == len({id(b) for _, b in pairs}) == count
        assert all(a.label == b.label for a, b in pairs)


@pytest.mark.parametrize("name", ["op12_hard_negatives"])
def test_query_equals_sql(spark, name):
    from check import compare, connect

    assert compare(spark, connect(SF), SF, name).startswith("ok")
